"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last seven bytes ends a chunk wherever it falls in the lowest
1 / block size of its range; each chunk gives one signature character. The block size is chosen by the
text's own cuts: the smallest whose chunks fit into a signature (see ``levels`` for repetitive
texts). A second signature is taken at twice that size, so that texts of up to twice the length
remain comparable. Fingerprint: ``size:signature:signature at twice the size``.
Likeness is one less the edit distance of two signatures of equal block size, as a share of
the longer one; signatures without a common run of ``COMMON`` characters are not alike.

Defined results: a null or empty text has the fingerprint ``3::`` and is alike (1.0) only to
equal fingerprints; equal texts have equal fingerprints; in ``edited``, rows of equal
doc_id are ordered by content and a single row is its own next document; an empty table
gives no rows; other columns are ignored. Texts are hashed whole, in blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from fleetlens.llm.common import load, query, stage
from fleetlens.llm.textvec import Block, blocks

WINDOW = 7
SMALLEST = 3
LENGTH = 64  # characters a signature has at most
SHORT = LENGTH // 4  # a signature below this is made from thinned cuts of the next smaller block size
LEVELS = 30  # block sizes 3 x 2 ** k
COMMON = 4
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", dtype=np.uint8)
#: By level, where the range of the hash ends that cuts; nothing cuts at the last one.
_BOUNDS = np.array([2 ** 32 // (SMALLEST << k) for k in range(LEVELS)] + [0], dtype=np.uint32)
_ROLL = [np.uint32(pow(0x01000193, WINDOW - j, 1 << 32)) for j in range(WINDOW)]


def levels(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Level k (block size 3 x 2 ** k) of each text and whether it is thinned; ``counts[text, k]`` cuts at level k, never rising.

    The smallest block size whose chunks fit into a signature. Repetitive texts may have hardly any
    cut there and far too many one level below: then the level below is thinned.
    """
    k = (counts >= LENGTH).sum(axis=1)
    thin = (k > 0) & (np.take_along_axis(counts, k[:, None], 1)[:, 0] + 1 < SHORT)
    return k - thin, thin


def thinned(values: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text with too many cuts: the hash value up to which cuts count, and that of these every 2nd, 4th, ... is kept.

    The value is the ``SHORT``-th lowest: in repeated lines one cut a line is left, so that it does not
    matter at which line the count begins.
    """
    order = np.lexsort((values, doc))
    first = np.searchsorted(doc[order], np.arange(n))
    some = np.bincount(doc, minlength=n) >= SHORT
    bound = np.zeros(n, dtype=np.uint32)
    bound[some] = values[order][first[some] + SHORT - 1]
    left = np.bincount(doc[values <= bound[doc]], minlength=n)
    return bound, 1 << np.ceil(np.log2(np.maximum((left + 1) / LENGTH, 1.0))).astype(np.int64)


def signatures(texts: list[bytes]) -> list[str]:
    """Fingerprints of a block of texts."""
    b = Block(texts)
    size = b.end - b.start
    # rolling hash of the WINDOW bytes up to each place, finalised to 32 bits
    padded = np.concatenate([np.zeros(WINDOW - 1, np.uint8), b.buf]).astype(np.uint32)
    roll = np.zeros(len(b.buf), dtype=np.uint32)
    for j, factor in enumerate(_ROLL):
        roll += padded[j:j + len(b.buf)] * factor
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        roll ^= roll >> np.uint32(shift)
        roll *= np.uint32(factor)
    roll ^= roll >> np.uint32(16)
    # windows that leave the text never end one
    outside = (b.start[:, None] + np.arange(WINDOW - 1)).ravel()
    roll[outside[outside < len(roll)]] = 0xFFFFFFFF
    roll[b.end[b.end < len(roll)]] = 0xFFFFFFFF
    cuts = np.flatnonzero(roll < _BOUNDS[0])
    of = np.searchsorted(b.end, cuts, side="right")
    level = len(_BOUNDS) - 1 - np.searchsorted(_BOUNDS[::-1], roll[cuts], side="right")  # the coarsest one that cuts here
    at_level = np.bincount(of * (LEVELS + 1) + level, minlength=b.n * (LEVELS + 1)).reshape(b.n, LEVELS + 1)
    chosen, thin = levels(np.cumsum(at_level[:, ::-1], axis=1)[:, ::-1])
    many = thin[of] & (level >= chosen[of])
    bound, every = thinned(roll[cuts[many]], of[many], b.n)
    block = (SMALLEST << chosen) * every
    out = []
    for times in (1, 2):
        # twice the block size is the next level, or every other cut where cuts are thinned
        ends_it = np.where(thin[of], many & (roll[cuts] <= bound[of]), level >= chosen[of] + times - 1)
        cut, doc = cuts[ends_it], of[ends_it]
        first = np.searchsorted(doc, np.arange(b.n))
        step = np.where(thin, every * times, 1)[doc]
        keep = (np.arange(len(cut)) - first[doc]) % step == step - 1  # at most LENGTH - 1 of a text; the last character is for the rest
        ends = np.concatenate([cut[keep] + 1, b.end[size > 0]])
        docs = np.concatenate([doc[keep], np.flatnonzero(size > 0)])
        order = np.lexsort((ends, docs))
        ends, docs = ends[order], docs[order]
        starts = b.start[docs].copy()
        same = docs[1:] == docs[:-1]
        starts[1:][same] = ends[:-1][same]
        some = ends > starts
        starts, ends, docs = starts[some], ends[some], docs[some]
        char = ALPHABET[(b.range_hash(starts, ends) >> np.uint64(58)).astype(np.int64)].tobytes().decode()
        edge = np.searchsorted(docs, np.arange(b.n + 1))
        out.append([char[x:y] for x, y in zip(edge, edge[1:])])
    return [f"{n}:{x}:{y}" for n, x, y in zip(block, *out)]


def fingerprints(texts) -> list[str]:
    return [s for part in blocks(texts) for s in signatures(part)]


_CODE = np.zeros(256, dtype=np.int64)
_CODE[ALPHABET] = np.arange(len(ALPHABET))


def _codes(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(s) for s in strings], dtype=np.int64)
    out = np.full((len(strings), LENGTH), -1, dtype=np.int64)
    flat = _CODE[np.frombuffer("".join(strings).encode(), dtype=np.uint8)]
    row = np.repeat(np.arange(len(strings)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out, size


def edit_distances(a: list[str], b: list[str]) -> np.ndarray:
    """Levenshtein distance of each pair: Myers' bit-parallel recurrence, all pairs at once."""
    x, m = _codes(a)
    y, n = _codes(b)
    pairs = np.arange(len(a))
    one = np.uint64(1)
    peq = np.zeros((len(a), len(ALPHABET) + 1), dtype=np.uint64)
    for i in range(int(m.max(initial=0))):
        has = m > i
        peq[pairs[has], x[has, i]] |= one << np.uint64(i)
    vp, vn = np.full(len(a), ~np.uint64(0)), np.zeros(len(a), dtype=np.uint64)
    score = m.copy()
    top = np.maximum(m - 1, 0).astype(np.uint64)
    for j in range(int(n.max(initial=0))):
        go = n > j
        eq = peq[pairs, y[:, j]]
        xv = eq | vn
        xh = (((eq & vp) + vp) ^ vp) | eq
        hp = vn | ~(xh | vp)
        hn = vp & xh
        step = ((hp >> top) & one).astype(np.int64) - ((hn >> top) & one).astype(np.int64)
        score = np.where(go & (m > 0), score + step, score)
        hp = (hp << one) | one
        hn = hn << one
        vp = np.where(go, hn | ~(xv | hp), vp)
        vn = np.where(go, hp & xv, vn)
    return np.where(m == 0, n, score)


def _alike(a: list[str], b: list[str]) -> np.ndarray:
    size = np.array([max(len(x), len(y), 1) for x, y in zip(a, b)])
    out = 1 - edit_distances(a, b) / size
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y and (out[i] <= 0 or not {x[k:k + COMMON] for k in range(len(x) - COMMON + 1)} & {y[k:k + COMMON] for k in range(len(y) - COMMON + 1)}):
            out[i] = 0.0
    return np.clip(out, 0.0, 1.0)


def likeness(a: list[str], b: list[str]) -> np.ndarray:
    """0..1 for each pair of fingerprints; block sizes must be equal or one twice the other."""
    left, right, where = [], [], []
    for i, (x, y) in enumerate(zip(a, b)):
        (p, x1, x2), (q, y1, y2) = x.split(":"), y.split(":")
        p, q = int(p), int(q)
        for ok, s, t in ((p == q, x1, y1), (p == q, x2, y2), (p == 2 * q, x1, y2), (q == 2 * p, x2, y1)):
            if ok and s and t:
                left.append(s)
                right.append(t)
                where.append(i)
    out = np.zeros(len(a))
    if where:
        np.maximum.at(out, np.array(where), _alike(left, right))
    return np.where([x == y for x, y in zip(a, b)], 1.0, out)


def fingerprinted(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row."""
    import pandas as pd
    mark = F.pandas_udf(lambda t: pd.Series(fingerprints(t)), "string")
    return docs.select("doc_id", mark("text").alias("fingerprint"))


def _half(text: str, after: str) -> str:
    """``text`` whose last half (code points, rounded down) is taken from the start of ``after``."""
    n = len(text) // 2
    return text[:len(text) - n] + after[:n]


RESULT = (("n_chars", "long"), ("edited_sha256", "string"), ("fingerprint", "string"), ("edited_fingerprint", "string"),
          ("near_edited", "double"), ("near_next", "double"))
_ARROW = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}


def _results(texts: list[str], after: list[str], own: list[str], next_own: list[str]) -> list[pa.Array]:
    changed = [_half(t, a) for t, a in zip(texts, after)]
    marks = fingerprints(changed)
    values = ([len(t) for t in texts], [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
              own, marks, likeness(own, marks), likeness(own, next_own))
    return [pa.array(v, _ARROW[k]) for v, (_, k) in zip(values, RESULT)]


def edited(docs: DataFrame) -> DataFrame:
    """Every row's fingerprint beside that of its edited text and of the next document.

    The next document is the next row by ascending doc_id (nulls last, then by content);
    after the last row comes the first. One range shuffle orders the rows; a partition
    holds all its rows' next ones but its last row's, which is the next partition's first.
    That row pair per partition is stored and finished in a second, small step.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    fields = [f"{n} {k}" for n, k in RESULT]
    schema = f"doc_id {id_type}, {', '.join(fields)}, part int, head string, tail string"
    names = ["doc_id", *[n for n, _ in RESULT], "part", "head", "tail"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        head, held, ids = None, None, None  # first text; last row so far: (text, fingerprint), its id
        for batch in batches:
            texts = batch.column("text").to_pylist()
            if not texts:
                continue
            head = texts[0] if head is None else head
            marks = fingerprints(texts)
            doc_id = batch.column("doc_id")
            if held is not None:
                texts, marks = [held[0], *texts], [held[1], *marks]
                doc_id = pa.concat_arrays([ids, doc_id])
            n = len(texts) - 1
            if n:
                empty = [pa.nulls(n, t) for t in (pa.int32(), pa.string(), pa.string())]
                yield pa.RecordBatch.from_arrays([doc_id.slice(0, n), *_results(texts[:-1], texts[1:], marks[:-1], marks[1:]), *empty], names=names)
            held, ids = (texts[-1], marks[-1]), doc_id.slice(n, 1)
        if held is not None:
            blank = [pa.nulls(1, _ARROW[k]) for _, k in RESULT]
            yield pa.RecordBatch.from_arrays([ids, *blank, pa.array([TaskContext.get().partitionId()], pa.int32()),
                                              pa.array([head], pa.string()), pa.array([held[0]], pa.string())], names=names)

    done = stage(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(walk, schema), "fingerprint-rows")
    edge = done.where("part IS NOT NULL")
    follow = (edge.select("part", F.lead("part").over(W.orderBy("part")).alias("next"), F.min("part").over(W.partitionBy()).alias("least"))
              .select("part", F.coalesce("next", "least").alias("next")))  # one row per task of the ordered stage
    heads = edge.select(F.col("part").alias("next"), F.col("head").alias("after"))
    pairs = edge.select("doc_id", "part", "tail").join(follow, "part").join(heads, "next").select("doc_id", "tail", "after")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, after = batch.column("tail").to_pylist(), batch.column("after").to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *_results(text, after, fingerprints(text), fingerprints(after))], names=names[:7])

    last = pairs.mapInArrow(finish, f"doc_id {id_type}, {', '.join(fields)}")
    return done.where("part IS NULL").select(names[:7]).unionByName(last)


@query("op10_fingerprints")
def op10_fingerprints(spark, sf_dir):
    """Fingerprints of every text and of its edited text, and their likeness."""
    return edited(load(spark, sf_dir, "documents"))
