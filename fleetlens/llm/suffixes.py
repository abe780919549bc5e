"""Removal of repeated 400-byte strings by suffix arrays over content-defined groups.

A 400-byte window belongs to the least (by hash) of the grams in it, its anchor; equal windows
have equal anchors, so windows are dealt out by anchor and every group is complete. The run of
a text's windows with one anchor is a segment. Segments of an anchor that occurs once need no
further look; equal segments are counted, not compared. For each anchor with different
segments a suffix array of these is built, with its common-prefix lengths; a stack scan over
the intervals of common prefixes reports every maximal repeat (a prefix that cannot be extended
to the left, as its occurrences are preceded by different bytes) with all its occurrences.

Hot groups are split by content before they are compared: an anchor with over ``SPLIT``
different segments is cut into runs of 16 windows, grouped by the bytes that all 16 share; if
such a group is still larger, into single windows.

Defined results: a null text counts as empty; texts of under ``length`` bytes lose nothing; a
text that occurs twice is removed whole (the rows' texts are compared, repeated rows included);
an empty table gives no rows; other columns are ignored. Matches never cross documents.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetlens.llm.common import load, query, stage
from fleetlens.llm.minhash import _by_group
from fleetlens.llm.textvec import Block, _P_INV, blocks, mix, powers, slices

LENGTH = 400
GRAM = 128
SPLIT = 512
RUN = 16
SALTS = 64


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours: running minima of blocks from both sides."""
    n = len(x) - width + 1
    pad = -len(x) % width
    full = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, width)
    right = np.minimum.accumulate(full, axis=1).ravel()
    left = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(left[:n], right[width - 1:width - 1 + n])


def segments(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Text number, start, windows, place of the anchor, anchor hash and content hash of all segments."""
    b = Block(texts)
    empty = tuple(np.zeros(0, np.int64) for _ in range(6))
    if len(b.buf) < length:
        return empty
    n = len(b.buf) - gram + 1
    b.range_hash(np.zeros(0, np.int64), np.zeros(0, np.int64))  # makes the prefix sums
    h = mix((b._prefix[gram:] - b._prefix[:n]) * powers(_P_INV, len(b.buf) + 1)[:n])
    place = np.uint64((1 << 30) - 1)
    best = sliding_min((h & ~place) | np.arange(n, dtype=np.uint64), length - gram + 1)
    valid = np.zeros(len(best) + 1, dtype=np.int8)
    long_ = b.end - b.start >= length
    np.add.at(valid, b.start[long_], 1)
    np.add.at(valid, b.end[long_] - length + 1, -1)
    s = np.flatnonzero(np.cumsum(valid[:-1]))
    if not len(s):
        return empty
    anchor = (best[s] & place).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (s[1:] != s[:-1] + 1)]))
    wins = np.diff(np.append(first, len(s)))
    start, anchor = s[first], anchor[first]
    doc = np.searchsorted(b.end, start, side="right")
    content = b.range_hash(start, start + wins + length - 1) ^ (anchor - start).astype(np.uint64)
    return doc, start - b.start[doc], wins, anchor - start, h[anchor].view(np.int64), content.view(np.int64)


def suffix_array(strings: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order of all suffixes by their first ``depth`` bytes at least (prefix doubling), neighbours'
    common-prefix lengths (entry i: suffixes i - 1 and i), and string and offset of every suffix."""
    size = np.array([len(x) for x in strings])
    of = np.repeat(np.arange(len(strings)), size + 1)
    offset = np.arange(len(of)) - np.repeat(np.cumsum(size + 1) - size - 1, size + 1)
    text = np.frombuffer(b"\0".join(strings) + b"\0", dtype=np.uint8).astype(np.int64) + len(strings)
    ends = np.cumsum(size + 1) - 1
    text[ends] = np.arange(len(strings))  # every string ends in a sign of its own
    base = int(text.max(initial=0)) + 2
    step = 1
    while base ** (step + 1) < 1 << 62 and step < depth:  # so many signs fit in one number: the first ranking sorts by all of them
        step += 1
    key = np.zeros(len(text), dtype=np.int64)
    for j in range(step):
        key *= base
        key[:len(text) - j] += text[j:] + 1
    ranks: list[tuple[int, np.ndarray]] = [(1, text)]
    while True:
        order = np.argsort(key)
        sorted_ = key[order]
        rank = np.empty_like(key)
        rank[order] = np.cumsum(np.concatenate([[0], sorted_[1:] != sorted_[:-1]]))
        ranks.append((step, rank))
        if step >= depth or rank[order[-1]] == len(rank) - 1:
            break
        key = rank * (int(rank.max()) + 2)
        key[:-step] += rank[step:] + 1
        step *= 2
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(len(a), dtype=np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        width, rank = ranks[k]
        for _ in range(2 if k == len(ranks) - 1 else 1 if k > 1 else ranks[1][0] if k == 0 else 2):
            ok = np.flatnonzero((a < len(rank)) & (b < len(rank)))
            same = ok[rank[a[ok]] == rank[b[ok]]]
            common[same] += width
            a[same] += width
            b[same] += width
    return order, np.concatenate([[0], common]), of, offset


def stretches(strings: list[bytes], length: int) -> list[tuple[int, int, int]]:
    """(string, start, end) of the parts that can hold a repeat: around windows whose hash occurs twice."""
    b = Block(strings)
    size = np.maximum(b.end - b.start - length + 1, 0)
    of = np.repeat(np.arange(len(strings)), size)
    at = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + b.start[of]
    if not len(at):
        return []
    _, which, count = np.unique(b.range_hash(at, at + length), return_inverse=True, return_counts=True)
    twice = count[which] > 1
    at, of = at[twice], of[twice]
    cut = np.flatnonzero((np.diff(at) > length) | (np.diff(of) != 0))
    first, last = np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(at) - 1]])
    if not len(at):
        return []
    start = at[first] - b.start[of[first]]
    return list(zip(of[first].tolist(), start.tolist(), (at[last] - b.start[of[last]] + length).tolist()))


def maximal_repeats(strings: list[bytes], length: int = LENGTH) -> list[tuple[int, list[tuple[int, int]]]]:
    """(common length, [(string, offset), ...]) of every left-diverse repeat of at least ``length`` bytes.

    Scans the intervals of the suffix array with a stack; an interval's occurrences are all
    suffixes in it. Lengths over ``length`` are exact while strings are under twice that.
    """
    # a window whose hash is alone has no equal: only the stretches around the others are sorted
    kept = stretches(strings, length)
    if not kept:
        return []
    cut = [strings[s][a:b] for s, a, b in kept]
    order, common, of, offset = suffix_array(cut, max(map(len, cut)))
    # suffixes that share at least ``length`` bytes with a neighbour
    far = np.append(common >= length, False)
    sel = np.flatnonzero(far[:-1] | far[1:])
    of, offset, order = of[order[sel]], offset[order[sel]], order[sel]
    signs = np.frombuffer(b"\0".join(cut) + b"\0", dtype=np.uint8).astype(np.int64)
    before = np.where(offset > 0, signs[order - 1], -1 - of)  # a stretch's start is preceded by nothing that its equals share
    change = np.cumsum(np.concatenate([[0], np.diff(before) != 0])).tolist()
    lcp = np.where(far[sel + 1], np.append(common, 0)[sel + 1], 0).tolist()
    strs = [kept[i][0] for i in of.tolist()]
    offs = (offset + np.array([a for _, a, _ in kept])[of]).tolist()
    out: list[tuple[int, list[tuple[int, int]]]] = []
    stack: list[tuple[int, int]] = []  # (common length, first suffix)
    for i, n in enumerate(lcp):
        first = i
        while stack and stack[-1][0] > n:
            height, first = stack.pop()
            if change[i] != change[first]:  # preceded by different bytes
                out.append((height, list(zip(strs[first:i + 1], offs[first:i + 1]))))
        if n and (not stack or stack[-1][0] < n):
            stack.append((n, first))
    return out


def occurrences(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """tid, doc_id, start, wins, at, anchor, seg of every segment of every row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column("doc_id")
            done = 0
            for part in blocks(batch.column("text").to_pylist()):
                doc, start, wins, at, anchor, seg = segments(part, length, gram)
                key = pa.array([hashlib.md5(t).digest() for t in part], pa.binary())
                cols = [key.take(pa.array(doc)), ids.take(pa.array(doc + done)), pa.array(start), pa.array(wins.astype(np.int32)),
                        pa.array(at.astype(np.int32)), pa.array(anchor), pa.array(seg)]
                yield pa.RecordBatch.from_arrays(cols, names=["tid", "doc_id", "start", "wins", "at", "anchor", "seg"])
                done += len(part)

    return docs.select("doc_id", "text").mapInArrow(run, f"tid binary, doc_id {id_type}, start long, wins int, at int, anchor long, seg long")


def packed_texts(docs: DataFrame) -> DataFrame:
    """doc_id, tid and the compressed text of every row: what the joins by content move."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raw = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([hashlib.md5(t).digest() for t in raw], pa.binary()),
                                              pa.array([zlib.compress(t, 1) for t in raw], pa.binary())], names=["doc_id", "tid", "packed"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, tid binary, packed binary")


def _several(groups: Iterator[pd.DataFrame], size: int = 1 << 18) -> Iterator[pd.DataFrame]:
    """Small groups put together for one suffix array: equal windows never lie in two groups."""
    held, total = [], 0
    for g in groups:
        held.append(g)
        total += g["bytes"].str.len().sum()
        if total >= size:
            yield pd.concat(held, ignore_index=True)
            held, total = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def _compared(units: DataFrame, length: int) -> DataFrame:
    """anchor, seg, lo, hi: repeated windows of each unit, found in the suffix array of its group.

    ``units``: group, anchor, seg, skip (windows of the segment before the unit) and bytes.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _several(_by_group(batches, "group")):
            anchor, seg, skip = g["anchor"].tolist(), g["seg"].tolist(), g["skip"].tolist()
            longest: dict[tuple[int, int], int] = {}
            for size, where in maximal_repeats(g["bytes"].tolist(), length):
                for at in where:
                    if size > longest.get(at, 0):
                        longest[at] = size
            runs: list[list[int]] = []  # (unit, first window, end): the union of a unit's occurrences
            for (i, o), size in sorted(longest.items()):
                if runs and runs[-1][0] == i and o <= runs[-1][2]:
                    runs[-1][2] = max(runs[-1][2], o + size - length + 1)
                else:
                    runs.append([i, o, o + size - length + 1])
            if runs:
                cols = [[anchor[i] for i, _, _ in runs], [seg[i] for i, _, _ in runs], [skip[i] + a for i, a, _ in runs], [skip[i] + b for i, _, b in runs]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["anchor", "seg", "lo", "hi"])

    return (units.select("group", "anchor", "seg", "skip", "bytes").repartition("group").sortWithinPartitions("group")
            .mapInArrow(run, "anchor long, seg long, lo long, hi long"))


def _cut(units: DataFrame, run_length: int, length: int) -> DataFrame:
    """Units cut into runs of at most ``run_length`` windows, aligned to the anchor.

    group: hash of anchor, place of the run and the bytes that all its windows share, so equal
    windows stay together; sub: hash of the run itself.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            cols = [batch.column(c).to_pylist() for c in ("anchor", "seg", "n", "at", "bytes")]
            for anchor, seg, n, at, raw in zip(*cols):
                j, wins = 0, len(raw) - length + 1
                while j < wins:
                    q = (at - j) // run_length
                    end = min(wins, at - q * run_length + 1)  # the run's last window starts at the anchor less q * run_length
                    core = raw[at - q * run_length:at - q * run_length - run_length + 1 + length]
                    part = raw[j:end - 1 + length]
                    out.append((_h(f"{anchor}:{q}:".encode() + core), _h(f"{end - j}:{(at - j) % run_length}:".encode() + part), anchor, seg, n, j, end))
                    j = end
            kinds = [pa.int64()] * 7
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)],
                                             names=["group", "sub", "anchor", "seg", "n", "lo", "hi"])

    return units.select("anchor", "seg", "n", "at", "bytes").mapInArrow(run, "group long, sub long, anchor long, seg long, n long, lo long, hi long")


def _h(b: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(b, digest_size=8).digest(), "little", signed=True)


def _hot(units: DataFrame, length: int, split: int) -> DataFrame:
    """anchor, seg, found (intervals): repeated windows of the segments of hot anchors, whose runs of windows are grouped by what they share."""
    runs = stage(_cut(units, RUN, length), "suffix-runs")
    subs = runs.groupBy("group", "sub").agg(F.sum("n").alias("k"), F.min(F.struct("anchor", "seg", "lo", "hi")).alias("one"))
    per = subs.groupBy("group").agg(F.count("*").alias("d"), F.sum("k").alias("total")).where("total > 1")
    subs = stage(subs.join(per, "group"), "suffix-subs")
    whole = runs.join(subs.where("k > 1").select("group", "sub"), ["group", "sub"]).select("anchor", "seg", F.array(F.struct("lo", "hi")).alias("found"))
    open_ = subs.where("d > 1").select("group", "sub", "d", "one.*")
    # a run is known by its group and hash from here on, in the place of anchor and segment
    fetched = open_.join(units.select("anchor", "seg", "at", "bytes"), ["anchor", "seg"]).select(
        F.col("group").alias("anchor"), F.col("sub").alias("seg"), "d", (F.col("at") - F.col("lo")).cast("int").alias("at"),
        F.expr(f"substring(bytes, int(lo) + 1, int(hi - lo) + {length - 1})").alias("bytes"))
    fetched = stage(fetched, "suffix-open").withColumn("group", F.col("anchor"))
    zero = F.lit(0).cast("long")
    compared = _compared(fetched.where(F.col("d") <= split).withColumn("skip", zero), length)
    # what is left of a group that is still large: single windows, equal ones counted
    single = _cut(fetched.where(F.col("d") > split).withColumn("n", zero + 1), 1, length)
    single = stage(single, "suffix-windows")
    twice = single.groupBy("group", "sub").agg(F.count("*").alias("k")).where("k > 1").select("group", "sub")
    alone = single.join(twice, ["group", "sub"]).select("anchor", "seg", "lo", "hi")
    # from the run's representative to all segments that hold an equal run: one row for each of these
    reps = _intervals(compared.union(alone).select("anchor", "seg", F.array(F.struct("lo", "hi")).alias("found"))).select(
        F.col("anchor").alias("group"), F.col("seg").alias("sub"), "found")
    back = runs.join(reps, ["group", "sub"]).select("anchor", "seg", F.transform("found", lambda x: F.struct(
        (x["lo"] + F.col("lo")).alias("lo"), (x["hi"] + F.col("lo")).alias("hi"))).alias("found"))
    return whole.union(back)


def _intervals(rows: DataFrame) -> DataFrame:
    """One row per anchor and segment: the union of its intervals (bounded by the windows of a segment), sorted and apart."""
    def add(done, x):
        last = F.element_at(done, -1)
        longer = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["lo"].alias("lo"), F.greatest(last["hi"], x["hi"]).alias("hi"))))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["hi"] >= x["lo"]), longer).otherwise(F.concat(done, F.array(x)))

    none = F.array().cast("array<struct<lo:bigint,hi:bigint>>")
    sets = rows.select("anchor", "seg", F.explode("found").alias("x")).groupBy("anchor", "seg").agg(F.sort_array(F.collect_set("x")).alias("x"))
    return sets.select("anchor", "seg", F.aggregate("x", none, add).alias("found"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, split: int = SPLIT) -> DataFrame:
    """tid, whole (the text occurs twice) and spans (bytes start and end, sorted, overlapping) of every text that loses bytes."""
    place = ["anchor", "seg", "tid", "start", "wins", "at"]
    found = stage(occurrences(docs, length, gram).groupBy(*place).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")), "suffix-segments")
    # an anchor of many segments is spread: joins by anchor also take the salts that occur with it
    salt = F.pmod("seg", F.lit(SALTS)).cast("int")
    salted = found.withColumn("salt", salt)
    twice = (salted.groupBy("anchor", "salt").agg(F.sum("copies").alias("_k")).groupBy("anchor").agg(F.sum("_k").alias("_k"), F.collect_list("salt").alias("_salts"))
             .where("_k > 1").select("anchor", F.explode("_salts").alias("salt")))
    seen = stage(salted.join(twice, ["anchor", "salt"]).drop("salt"), "suffix-repeated")
    per_seg = seen.groupBy("anchor", "seg").agg(F.count("*").alias("n"), F.min(F.struct("tid", "start", "wins", "at", "doc_id")).alias("one"))
    per_seg = stage(per_seg.withColumn("salt", salt), "suffix-counted")
    per_salt = per_seg.groupBy("anchor", "salt").agg(F.count("*").alias("d"), F.min("n").alias("least"), F.max("n").alias("most"))
    per_anchor = (per_salt.groupBy("anchor").agg(F.sum("d").alias("d"), F.min("least").alias("least"), F.max("most").alias("most"), F.collect_list("salt").alias("salts"))
                  .where("d > 1 OR most > 1").withColumn("salt", F.explode("salts")).drop("salts"))
    segs = stage(per_seg.join(per_anchor, ["anchor", "salt"]).drop("salt"), "suffix-distinct")

    # the bytes of one occurrence of each segment that must be compared
    wanted = (segs.where("d > 1 AND least = 1").select("anchor", "seg", "n", "d", "one.*").groupBy("tid", F.col("doc_id").alias("_id"))
              .agg(F.collect_list(F.struct("anchor", "seg", "n", "d", "start", "wins", "at")).alias("wanted")))
    packed = packed_texts(docs)
    sources = packed.join(wanted, (packed["tid"] == wanted["tid"]) & packed["doc_id"].eqNullSafe(wanted["_id"])).select(packed["tid"], "packed", "wanted")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "seg", "n", "d", "at", "bytes"]
        for batch in batches:
            rows = []
            for raw, want in zip(batch.column("packed"), batch.column("wanted").to_pylist()):
                text = zlib.decompress(raw.as_py())
                rows += [(w["anchor"], w["seg"], w["n"], w["d"], w["at"], text[w["start"]:w["start"] + w["wins"] + length - 1]) for w in want]
            kinds = [pa.int64()] * 4 + [pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    units = sources.mapInArrow(fetch, "anchor long, seg long, n long, d long, at int, bytes binary")
    units = stage(units.dropDuplicates(["anchor", "seg"]), "suffix-units")
    small = units.where(F.col("d") <= split).withColumn("group", F.col("anchor")).withColumn("skip", F.lit(0).cast("long"))
    equal = segs.where("n > 1").select("anchor", "seg", F.array(F.struct(F.lit(0).cast("long").alias("lo"), F.col("one.wins").cast("long").alias("hi"))).alias("found"))
    compared = _compared(small, length).select("anchor", "seg", F.array(F.struct("lo", "hi")).alias("found"))
    repeated = _intervals(equal.union(compared).union(_hot(units.where(F.col("d") > split), length, split)))
    repeated = stage(repeated, "suffix-windows-repeated")
    copied = seen.where("copies > 1").select("tid").distinct().select("tid", F.lit(True).alias("whole"))
    placed = seen.join(repeated, ["anchor", "seg"]).select("tid", F.transform("found", lambda x: F.struct(
        (F.col("start") + x["lo"]).alias("s"), (F.col("start") + x["hi"] + (length - 1)).alias("e"))).alias("spans"))
    spans = placed.groupBy("tid").agg(F.sort_array(F.flatten(F.collect_set("spans"))).alias("spans"))
    return spans.join(copied, "tid", "full").select("tid", F.coalesce("whole", F.lit(False)).alias("whole"), "spans")


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for x in spans or ():
        if out and x["s"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], x["e"])
        else:
            out.append([x["s"], x["e"]])
    return [tuple(x) for x in out]


def deduplicated(docs: DataFrame, length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the bytes kept, if asked for)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    spans = stage(repeated_spans(docs, length), "suffix-spans")
    rows = packed_texts(docs).join(spans, "tid", "left").select("doc_id", "packed", "whole", "spans")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw, whole, spans in zip(batch.column("packed"), batch.column("whole").to_pylist(), batch.column("spans").to_pylist()):
                text = zlib.decompress(raw.as_py())
                gone = [(0, len(text))] if whole else merged(spans)
                at, kept = 0, []
                for s, e in gone:
                    kept.append(text[at:s])
                    at = e
                left = b"".join(kept) + text[at:]
                out.append((len(text), len(text) - len(left), len(gone), hashlib.sha256(left).hexdigest(), left))
            kinds = [pa.int64()] * 3 + [pa.string()] + [pa.binary()] * with_text
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]], names=names)

    return rows.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text)


@query("op6_suffix_dedup")
def op6_suffix_dedup(spark, sf_dir):
    """Repeated 400-byte strings removed from every whole text of ``documents``."""
    return deduplicated(load(spark, sf_dir, "documents"))
