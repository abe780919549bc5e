"""Best-fit packing of tokenised documents into fixed-length sequences by linear grouping.

1. Every document is tokenised once; pieces (at most ``capacity`` tokens) are stored
   without their ids. Only a longer document is cut; its first piece takes the remainder.
2. The histogram of piece lengths (at most ``capacity`` numbers, however large the corpus)
   goes to the driver, where the plan is made: large lengths are rounded up within
   ``groups`` groups of equal cardinality, the few-size cutting-stock programme is solved
   by column generation, actual lengths are substituted for the rounded ones, and what is
   left (rounding remainders and small lengths) is placed best-fit, longest first. Bins that
   rounding leaves with waste are dissolved and solved again. All of it works on runs of equal
   bins, so its cost depends on ``capacity`` and ``groups`` only.
3. Pieces get their rank within their length (salted, so a hot length is split) and look
   up sequence and offset in the plan: a few thousand runs, bounded like the histogram.

Defined results: a null or empty text is one piece that holds the end id alone; repeated
rows are packed each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from fleetlens.llm.common import load, query, stage
from fleetlens.llm.textvec import slices

CAPACITY = 1024
END_ID = 2
VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
GROUPS = 60
ROUNDS = 4
WASTE = 3  # ids free in a bin that a round keeps
SMALL = 1 / 16
ROWS_PER_RANK_GROUP = 100_000


class Encoder:
    """Ids of whole texts as little-endian uint32 bytes.

    ``ranks`` is the same vocabulary in the form of the faster encoder; its ids are equal
    (tested). Text that spells the special token is left to the tokenizer file itself.
    """

    def __init__(self, path: str, ranks: str | None = None):
        from tokenizers import Tokenizer
        whole = Tokenizer.from_file(path)
        self.exact = lambda text: whole.encode(text, add_special_tokens=False).ids
        self.encode = self.exact
        self.special = tuple(t.content for t in whole.get_added_tokens_decoder().values())
        if ranks:
            import public_tokenizers
            import tiktoken
            with open(ranks, "rb") as f:
                merges = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f)}
            self.encode = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={}).encode_ordinary


def token_bytes(text: str | None, encoder: Encoder) -> bytes:
    text = text or ""
    encode = encoder.exact if any(t in text for t in encoder.special) else encoder.encode
    return np.array(encode(text), dtype="<u4").tobytes()


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids; the first takes the remainder."""
    first = n if n <= capacity else n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, vocabulary: str | None = None, ranks: str | None = None, capacity: int = CAPACITY,
           end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and the ids, if asked for).

    ``vocabulary`` is a tokenizer file, ``ranks`` (optional) the same vocabulary as merge ranks.
    """
    if vocabulary is None:
        import public_tokenizers
        vocabulary, ranks = public_tokenizers.path(VOCABULARY), public_tokenizers.path(RANKS)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, ranks)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in slices(batches):
            rows, out = [], []
            for row, text in enumerate(batch.column("text")):
                ids = token_bytes(text.as_py(), encoder) + end
                for k, (start, n) in enumerate(cut(len(ids) // 4, capacity)):
                    part = ids[4 * start:4 * (start + n)]
                    rows.append(row)
                    out.append((k, start, n, zlib.crc32(part)) + ((np.frombuffer(part, "<u4").astype("int64"),) if with_ids else ()))
            cols = [batch.column("doc_id").take(pa.array(rows, pa.int64()))]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            cols += [pa.array([r[i] for r in out], kinds[i]) for i in range(4 + with_ids)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:5 + with_ids])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Fractional optimum of the cutting-stock programme by column generation.

    ``sizes`` distinct, ``demand`` > 0. Returns (items of each size, bins) per basic pattern.
    The pricing step is an unbounded knapsack over the capacity, the master a revised simplex.
    """
    m = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1 / np.diag(basis))
    bins = inverse @ demand
    for _ in range(60 * m):
        dual = inverse.sum(axis=0)
        best, take = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for k in np.argsort(-dual / sizes):  # one more copy of size k at a time, over all capacities at once
            size, value = int(sizes[k]), dual[k]
            for _ in range(capacity // size if value > 1e-12 else 0):
                more = best[:-size] + value
                up = more > best[size:] + 1e-12
                if not up.any():
                    break
                best[size:][up] = more[up]
                take[size:][up] = k
        if best[capacity] <= 1 + 1e-7:
            break
        column, c = np.zeros(m), capacity
        while take[c] >= 0:
            column[take[c]] += 1
            c -= int(sizes[take[c]])
        step = inverse @ column
        up = step > 1e-9
        ratio = np.full(m, np.inf)
        ratio[up] = bins[up] / step[up]
        out = int(ratio.argmin())
        pivot = inverse[out] / step[out]
        inverse = inverse - np.outer(step, pivot)
        inverse[out] = pivot
        bins = bins - step * ratio[out]
        bins[out] = ratio[out]
        basis[:, out] = column
    return [(basis[:, j].round().astype(int), float(bins[j])) for j in range(m) if bins[j] > 0]


class _Runs:
    """Runs of pieces, longest first: (length, count left), dealt out in order."""

    def __init__(self, runs: list[tuple[int, int]]):
        self.runs = runs[::-1]

    def take(self, n: int) -> list[tuple[int, int]]:
        out = []
        while n and self.runs:
            length, count = self.runs.pop()
            got = min(n, count)
            out.append((length, got))
            if count > got:
                self.runs.append((length, count - got))
            n -= got
        return out


def linear_grouping(left: dict[int, int], capacity: int, groups: int, small: float) -> list[list]:
    """Blocks [free, bins, lengths in order of offset] of the programme's whole bins for the large lengths.

    Groups of equal cardinality are rounded up to their longest length; actual lengths, longest
    first, then take the places of the rounded ones. Runs of equal bins are one block.
    """
    large = sorted((k for k in left if left[k] and k > small * capacity), reverse=True)
    total = sum(left[k] for k in large)
    grouped, seen, last = [], 0, -1
    for k in large:  # equal lengths stay together
        at = min(groups - 1, seen * groups // total)
        if at != last:
            grouped.append([])
            last = at
        grouped[-1].append((k, left[k]))
        seen += left[k]
    if not grouped:
        return []
    sizes = np.array([g[0][0] for g in grouped])
    demand = np.array([sum(n for _, n in g) for g in grouped], dtype=float)
    supply, blocks = [_Runs(list(g)) for g in grouped], []
    for items, bins in sorted(configurations(sizes, demand, capacity), key=lambda x: -x[1]):
        bins = int(bins + 1e-6)
        slots = [supply[g].take(bins) for g in range(len(sizes)) for _ in range(items[g])]
        slots = [s for s in slots if s]
        if not slots or not bins:
            continue
        edges = sorted({0, *[int(e) for s in slots for e in np.cumsum([n for _, n in s])]})
        ends = [(np.cumsum([n for _, n in s]), s) for s in slots]
        for a, b in zip(edges, edges[1:]):
            held = [s[i][0] for e, s in ends if (i := int(np.searchsorted(e, a, side="right"))) < len(s)]
            blocks.append([capacity - sum(held), b - a, held])
    return blocks


def without(left: dict[int, int], blocks: list[list]) -> dict[int, int]:
    out = dict(left)
    for _, bins, held in blocks:
        for length in held:
            out[length] -= bins
    return out


def best_fit(left: dict[int, int], blocks: list[list], capacity: int) -> list[list]:
    """``blocks`` and what is left, longest first, each into the fullest bins that take it."""
    free: dict[int, list[list]] = {}
    for b in blocks:
        free.setdefault(b[0], []).append(b)
    keys = sorted(free)

    def put(block: list) -> None:
        if block[0] not in free:
            bisect.insort(keys, block[0])
            free[block[0]] = []
        free[block[0]].append(block)

    for length in sorted((k for k, v in left.items() if v), reverse=True):
        n = left[length]
        while n:
            at = bisect.bisect_left(keys, length)
            if at < len(keys):
                room = keys[at]
                block = free[room].pop()
                if not free[room]:
                    del free[room]
                    keys.pop(at)
                used = min(n, block[1])
                if block[1] > used:
                    put([room, block[1] - used, list(block[2])])
                put([room - length, used, block[2] + [length]])
                n -= used
            else:
                each = capacity // length
                bins, used = (n // each, each) if n >= each else (1, n)
                put([capacity - used * length, bins, [length] * used])
                n -= bins * used
    return [b for k in keys for b in free[k]]


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, small: float = SMALL, rounds: int = ROUNDS) -> pd.DataFrame:
    """Place ``counts[length]`` pieces of each length; rows are runs of equal slots.

    Each round solves the programme for the pieces that are left; its bins that are full but for
    ``WASTE`` ids stay, the others are dissolved for the next round, whose groups follow what is
    left. Every round's bins (all of them, those that stay, or those without waste) are completed
    best-fit, longest first; the plan with the fewest sequences is taken. The programme is solved
    for every corpus, best fit only completes it; the rounds end when no plan can be better by a
    thousandth.

    Columns length, first (rank of the run's first piece within its length), count,
    sequence (of the first piece; the next rank goes to the next sequence), offset.
    """
    left: dict[int, int] = {k: v for k, v in counts.items() if v}
    full = left.pop(capacity, 0)
    kept: list[list] = [[0, full, [capacity]]] if full else []
    least = full + -(-sum(k * v for k, v in left.items()) // capacity)

    def bins(blocks: list[list]) -> int:
        return sum(b[1] for b in blocks)

    best = None
    for _ in range(rounds):
        blocks = linear_grouping(left, capacity, groups, small)
        stay, tight = ([b for b in blocks if b[0] <= waste] for waste in (WASTE, 0))
        plans = [best_fit(without(left, x), kept + x, capacity) for x in (blocks, stay, tight)]
        best = min(plans if best is None else [best, *plans], key=bins)
        left, kept = without(left, stay), kept + stay
        if not stay or bins(best) * 1000 <= least * 1001:
            break
    rows, rank, sequence = [], {k: 0 for k in counts}, 0
    for _, n, held in best:
        offset = 0
        for length in held:
            rows.append((length, rank[length], n, sequence, offset))
            rank[length] += n
            offset += length
        sequence += n
    return pd.DataFrame(rows, columns=["length", "first", "count", "sequence", "offset"], dtype="int64")


def pack(stored: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS, small: float = SMALL) -> DataFrame:
    """Add sequence_id and offset to stored pieces (read twice: pass a stored table)."""
    counts = {int(r["length"]): int(r["n"]) for r in stored.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = plan(counts, capacity, groups, small).sort_values(["length", "first"])
    # a piece's (length, rank) is one long: length in the high bits
    start = (slots["length"].to_numpy() << 48) | slots["first"].to_numpy()
    sequence, offset, first = (slots[c].to_numpy() for c in ("sequence", "offset", "first"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(start, (length.to_numpy() << 48) | rank.to_numpy(), side="right") - 1
        return pd.DataFrame({"sequence_id": sequence[at] + rank.to_numpy() - first[at], "offset": offset[at]})

    salts = 16 * (1 + sum(counts.values()) // (16 * ROWS_PER_RANK_GROUP))
    salted = stored.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    before = (salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
              .withColumn("_before", F.sum("_n").over(W.partitionBy("length").orderBy("_salt")) - F.col("_n")).drop("_n"))
    within = W.partitionBy("length", "_salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = salted.withColumn("_row", F.row_number().over(within) - 1).join(before, ["length", "_salt"])
    ranked = ranked.withColumn("_place", place(F.col("length"), F.col("_row") + F.col("_before")))
    return ranked.select(*stored.columns, "_place.sequence_id", "_place.offset")


def pack_documents(docs: DataFrame, vocabulary: str | None = None, ranks: str | None = None, capacity: int = CAPACITY,
                   end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(stage(pieces(docs, vocabulary, ranks, capacity, end_id, with_ids), "pack-pieces"), capacity)


@query("op8_best_fit_packing")
def op8_best_fit_packing(spark, sf_dir):
    """Pack the whole ``documents`` table into sequences of 1,024 ids."""
    return pack_documents(load(spark, sf_dir, "documents"))
