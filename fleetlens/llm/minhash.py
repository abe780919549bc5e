"""Near-duplicate documents by consistent weighted sampling over TF-IDF shingles.

A document is the weighted set of its five-word shingles, weight = count x idf. Document
frequencies come from a count-min sketch over all documents (two rows of 2 ** 20 counters,
so it has one size whatever the corpus); idf falls from 1 to 1/2 as the share of documents
rises from 1/256 to 1. Improved consistent weighted sampling draws 64 samples, banded by
four. Documents that share a band are candidates; each link is decided by the exact
weighted Jaccard similarity of the whole texts. Classes are the components of the links.

Equal texts are collapsed first. A candidate group is never expanded into its pairs:

1. every text is compared with its most promising hub (the candidate in the fullest
   buckets), in chunks of at most a few hundred members, and classes are formed;
2. buckets that still hold several classes are split into blocks, block pairs are sifted
   by their samples and what may link is compared exactly.

Defined results: a null text counts as empty; texts without any word are copies of equal
texts only; fewer than five words make one shingle; the class id is the smallest non-null
doc_id of the class (null if there is none); repeated rows are copies of each other; an
empty table gives no rows; other columns are ignored by ``classes`` and kept by
``keep_one``, where rows that tie in everything are one row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from fleetlens.llm.common import fresh, load, query, stage
from fleetlens.llm.graph import components
from fleetlens.llm.textvec import Block, blocks, mix, shingles, slices

WORDS = 5
SIMILAR = 0.8
SAMPLES, ROWS = 64, 4
SKETCH_BITS = 20
RARE = 256  # a shingle in at most 1/256 of the documents has full weight
SIFT = 36  # equal samples that a pair needs to be compared: 5 standard deviations under 0.8
CHUNK = 256
SLICES = 32
_M = np.uint64((1 << SKETCH_BITS) - 1)


def doc_shingles(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of a block: 44-bit hash, text number and count, by text and hash."""
    b = Block(texts)
    start, end, doc = b.words()
    h, d = shingles(b.range_hash(start, end), doc, b.n, words)
    key = np.sort((d.astype(np.uint64) << np.uint64(44)) | (h >> np.uint64(20)))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(key)))
    key = key[first]
    return key & np.uint64((1 << 44) - 1), (key >> np.uint64(44)).astype(np.int64), count


def lowered(texts) -> Iterator[list[bytes]]:
    return blocks(t.lower() if isinstance(t, str) else t for t in texts)


def frequency_sketch(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Count-min sketch (2 x 2 ** SKETCH_BITS) of shingle document frequencies, and the row count."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        table, rows = np.zeros((2, 1 << SKETCH_BITS), dtype=np.int64), 0
        for batch in slices(batches):
            rows += batch.num_rows
            for part in lowered(batch.column(0).to_pylist()):
                h, _, _ = doc_shingles(part)
                for i in (0, 1):
                    table[i] += np.bincount(((h >> np.uint64(20 * i)) & _M).astype(np.int64), minlength=1 << SKETCH_BITS)
        if rows:
            parts = [zlib.compress(x.tobytes(), 1) for x in table.reshape(2 * SLICES, -1)]
            n = len(parts)
            yield pa.RecordBatch.from_arrays([pa.array(range(n), pa.int32()), pa.array([TaskContext.get().partitionId()] * n, pa.int32()),
                                              pa.array(parts, pa.binary()), pa.array([rows] * n, pa.int64())], names=["slice", "task", "counts", "rows"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(x), dtype=np.int64) for x in pdf["counts"])
        return pd.DataFrame({"slice": pdf["slice"][:1].to_numpy(), "task": pdf["task"][:1].to_numpy() // 64,
                             "counts": [zlib.compress(total.tobytes(), 1)], "rows": [pdf["rows"].sum()]})

    kind = "slice int, task int, counts binary, rows long"
    sums = docs.select("text").mapInArrow(count, kind)
    for _ in range(2):  # in two steps, so that no task gets the slices of all others at once
        sums = sums.groupBy("slice", (F.col("task") / 64).cast("int").alias("task_group")).applyInPandas(lambda pdf: add(pdf), kind)
    # a merged slice may remain in a few parts where there are over 64 ** 2 tasks; their sum is bounded by 2 x SLICES arrays
    table, rows = np.zeros((2 * SLICES, (1 << SKETCH_BITS) // SLICES), dtype=np.int64), 0
    for r in sums.toLocalIterator():
        table[r["slice"]] += np.frombuffer(zlib.decompress(bytes(r["counts"])), dtype=np.int64)
        rows += r["rows"] if r["slice"] == 0 else 0
    return table.reshape(2, -1), rows


def idf_tables(table: np.ndarray, rows: int) -> np.ndarray:
    """Weight per sketch counter; a shingle's weight is the larger of its two."""
    share = np.clip(table / max(rows, 1), 1 / RARE, 1.0)
    return (0.5 - 0.5 * np.log(share) / np.log(RARE)).astype(np.float32)


def idf(tables: np.ndarray, h: np.ndarray) -> np.ndarray:
    return np.maximum(tables[0][(h & _M).astype(np.int64)], tables[1][((h >> np.uint64(20)) & _M).astype(np.int64)])


_SEEDS = mix(np.arange(1, 2 * SAMPLES + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_U32, _21, _32 = np.float32(2.0 ** -32), np.float32(2.0 ** -21), np.uint64(32)


def samples(h: np.ndarray, weight: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Improved consistent weighted samples (32-bit tags), one row per text that starts at ``first``.

    For sample k and shingle x: r, c ~ Gamma(2, 1) and beta ~ U(0, 1) from hashes of (k, x);
    t = floor(ln w / r + beta); the sample is the (x, t) of the least ln c - r (t - beta + 1).
    """
    out = np.empty((len(first), SAMPLES), dtype=np.uint32)
    lw = np.log(weight.astype(np.float32))
    step = 1 << 16
    best = np.empty(len(h), dtype=np.uint64)
    m21 = np.uint64((1 << 21) - 1)
    for k in range(SAMPLES):
        for a in range(0, len(h), step):
            z = mix(h[a:a + step] ^ _SEEDS[2 * k])
            y = z * np.uint64(0x2545F4914F6CDD1D)
            y ^= y >> _32
            y *= np.uint64(0x9FB21C651E98DF25)
            u1 = ((z & m21).astype(np.float32) + np.float32(0.5)) * _21
            u2 = (((z >> np.uint64(21)) & m21).astype(np.float32) + np.float32(0.5)) * _21
            beta = (z >> np.uint64(42)).astype(np.float32) * np.float32(2.0 ** -22)
            u3 = ((y >> _32).astype(np.float32) + np.float32(0.5)) * _U32
            u4 = ((y & np.uint64(0xFFFFFFFF)).astype(np.float32) + np.float32(0.5)) * _U32
            r = -np.log(u1 * u2)
            np.maximum(r, np.float32(1e-6), out=r)
            c = np.log(np.maximum(-np.log(np.minimum(u3 * u4, np.float32(0.9999999))), np.float32(1e-30)))
            t = np.floor(lw[a:a + step] / r + beta)
            la = c - r * (t - beta + np.float32(1))
            bits = la.view(np.int32)
            order = (bits ^ ((bits >> 31) & np.int32(0x7FFFFFFF))).astype(np.int64) + (1 << 31)
            tag = (z ^ (t.astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) >> _32
            best[a:a + step] = (order.astype(np.uint64) << _32) | tag
        out[:, k] = (np.minimum.reduceat(best, first) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return out


def bands(sample: np.ndarray) -> np.ndarray:
    """Hash of every run of ROWS samples, told apart by its place."""
    s = sample.reshape(len(sample), SAMPLES // ROWS, ROWS).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, s.shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), s.shape[:2]).copy()
    for i in range(ROWS):
        h = mix(h ^ s[:, :, i]) * np.uint64(0xD1342543DE82EF95)
    return mix(h).view(np.int64)


def _starts(doc: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)


def signatures(docs: DataFrame, tables) -> DataFrame:
    """doc_id, tid (content key), sample (binary, null without words) and bands of every row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").dictionary_encode()
            index, distinct = texts.indices, texts.dictionary.to_pylist()
            sign: list[bytes | None] = []
            band: list[np.ndarray | None] = []
            for part in lowered(distinct):
                h, doc, n = doc_shingles(part)
                first = _starts(doc)
                got: list[tuple] = [(None, None)] * len(part)
                if len(h):
                    s = samples(h, idf(tables.value, h) * n, first)
                    for d, x, y in zip(doc[first], s, bands(s)):
                        got[d] = (x.tobytes(), y)
                sign += [x for x, _ in got]
                band += [y for _, y in got]
            cols = [batch.column("doc_id"), batch.column("tid"), pa.array(sign, pa.binary()).take(index), pa.array(band, pa.list_(pa.int64())).take(index)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "tid", "sample", "bands"])

    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select("doc_id", "text", content_key(F.col("text")).alias("tid"))
    return keyed.mapInArrow(run, f"doc_id {id_type}, tid binary, sample binary, bands array<long>")


def content_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def similar_pairs(texts: list[str], tables: np.ndarray, least: float = SIMILAR) -> list[tuple[int, int]]:
    """Pairs (i < j) of one group's texts whose weighted Jaccard similarity is at least ``least``."""
    feats = [doc_shingles(part) for part in blocks((t.lower() for t in texts), 1 << 62)]
    h, doc, n = feats[0]
    w = idf(tables, h).astype(np.float64)
    total = np.bincount(doc, w * n, minlength=len(texts))
    # a shingle that occurs n times is n set members of its weight
    copies = np.repeat(np.arange(len(h)), n)
    turn = np.arange(len(copies)) - np.repeat(np.cumsum(n) - n, n)
    member = mix(h[copies] + turn.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(member, kind="stable")
    member, of, w = member[order], doc[copies][order], w[copies][order]
    first = _starts(member)
    size = np.diff(np.append(first, len(member)))
    shared = size > 1
    column = np.repeat(np.where(shared, np.cumsum(shared) - 1, -1), size)
    keep = column >= 0
    column, of, w = column[keep], of[keep], w[keep]
    both = np.zeros((len(texts), len(texts)))
    width = 2048
    cuts = np.searchsorted(column, np.arange(0, int(shared.sum()) + width, width))
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            m = np.zeros((len(texts), int(column[b - 1] - column[a]) + 1))
            m[of[a:b], column[a:b] - column[a]] = np.sqrt(w[a:b])
            both += m @ m.T
    union = total[:, None] + total[None, :] - both
    i, j = np.nonzero(np.triu(both >= least * union - 1e-9 * union, 1) & (union > 0))
    return list(zip(i.tolist(), j.tolist()))


def forest(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A spanning forest of ``pairs``: the same components with fewer links."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    out = []
    for i, j in pairs:
        a, b = top(i), top(j)
        if a != b:
            up[a] = b
            out.append((i, j))
    return out


def _by_group(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pd.DataFrame]:
    """Rows sorted by ``key`` as one frame per key, whatever the batch borders."""
    rest: pd.DataFrame | None = None
    for batch in batches:
        pdf = batch.to_pandas()
        if rest is not None:
            pdf = pd.concat([rest, pdf], ignore_index=True)
        if pdf.empty:
            continue
        last = pdf[key].iloc[-1]
        done = pdf[pdf[key] != last]
        rest = pdf[pdf[key] == last]
        for _, g in done.groupby(key, sort=False):
            yield g
    if rest is not None and len(rest):
        yield rest


def linked(members: DataFrame, texts: DataFrame, tables) -> DataFrame:
    """Links (u, v) among the texts of each group; ``members`` has group and nid (both long).

    Groups are bounded by their makers. Only a spanning forest of each group's links leaves it.
    """
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _by_group(batches, "group"):
            g = g.drop_duplicates("nid")
            nid = g["nid"].tolist()
            if len(nid) < 2:
                continue
            found = forest(similar_pairs(g["text"].tolist(), tables.value))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([nid[p[k]] for p in found], pa.int64()) for k in (0, 1)], names=["u", "v"])

    rows = members.join(texts, "nid").select("group", "nid", "text")
    return rows.repartition("group").sortWithinPartitions("group").mapInArrow(compare, "u long, v long")


def _equal_samples(a: pd.Series, b: pd.Series) -> np.ndarray:
    if not len(a):
        return np.zeros(0, np.int32)
    x, y = (np.frombuffer(b"".join(s), dtype=np.uint32).reshape(-1, SAMPLES) for s in (a, b))
    return (x == y).sum(axis=1).astype(np.int32)


def node_id(tid: Column) -> Column:
    """64-bit number of a text: what buckets, links and classes are kept by."""
    return F.xxhash64(tid)


def links(signed: DataFrame, docs: DataFrame, tables) -> DataFrame:
    """Links (u, v) between different texts by number. ``signed`` is the stored table of ``signatures``."""
    distinct = stage(signed.groupBy("tid").agg(F.min("doc_id").alias("doc_id"), F.first("sample").alias("sample"), F.first("bands").alias("bands"))
                     .where("bands IS NOT NULL").withColumn("nid", node_id(F.col("tid"))), "minhash-texts")
    banded = distinct.select("nid", F.explode("bands").alias("bucket"))
    full = banded.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(F.xxhash64("nid") % (1 << 50)).alias("who")).where("n > 1")
    inside = stage(banded.join(full, "bucket"), "minhash-buckets")

    # only texts in some bucket with others are ever compared: one row of each
    score = stage(inside.groupBy("nid").agg(F.sum("n").alias("score")), "minhash-scores")
    wanted = distinct.join(score, "nid").select("tid", "nid", F.col("doc_id").alias("_id"))
    keyed = docs.select(F.col("doc_id").alias("_id"), "text", content_key(F.col("text")).alias("tid"))
    texts = keyed.join(wanted, (keyed["tid"] == wanted["tid"]) & keyed["_id"].eqNullSafe(wanted["_id"])).select("nid", "text")
    texts = stage(texts, "minhash-candidates")  # rows equal in id and text stay: comparisons drop them by number
    sign = distinct.select("nid", "sample")

    # 1. each text and its hub: the bucket mate that sits in the fullest buckets
    hubs = (inside.join(score, "nid").groupBy("bucket").agg(F.max(F.struct("score", F.col("nid").alias("hub"))).alias("h"))
            .select("bucket", "h.score", "h.hub"))
    pairs = inside.join(hubs, "bucket").where("nid <> hub").select("nid", "hub", "score").distinct()
    equal = F.pandas_udf(lambda a, b: pd.Series(_equal_samples(a, b)), "int")
    near = (pairs.join(sign, "nid").join(sign.select(F.col("nid").alias("hub"), F.col("sample").alias("hub_sample")), "hub")
            .withColumn("same", equal("sample", "hub_sample")).where(F.col("same") >= SIFT)
            .groupBy("nid").agg(F.max(F.struct("same", "score", "hub")).alias("h")).select("nid", "h.hub"))
    near = stage(near, "minhash-hubs")
    chunks = near.groupBy("hub").agg((F.count("*") / F.lit(CHUNK) + 1).cast("int").alias("chunks"))
    dealt = near.join(chunks, "hub").withColumn("chunk", F.pmod(F.xxhash64("nid"), F.col("chunks")).cast("int"))
    group = F.xxhash64("hub", "chunk").alias("group")
    members = dealt.select(group, "nid").union(
        chunks.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(group, F.col("hub").alias("nid")))
    found = stage(linked(members, texts, tables), "minhash-links")

    # 2. buckets that hold several classes yet; of buckets with the same members, one
    label = components(found)
    open_ = (inside.join(label.withColumnRenamed("node", "nid"), "nid", "left")
             .withColumn("label", F.coalesce("label", "nid")))
    open_ = stage(open_, "minhash-open")
    sizes = open_.groupBy("bucket", "n", "who", "label").agg(F.count("*").alias("k"))
    several = (sizes.groupBy("bucket", "n", "who").agg(F.count("*").alias("classes"), F.max(F.struct("k", "label")).alias("main"))
               .where("classes > 1"))
    several = several.groupBy("n", "who").agg(F.min(F.struct("bucket", F.col("main.label").alias("main"))).alias("one"))
    several = several.select("one.bucket", "one.main", (F.col("n") / F.lit(CHUNK) + 1).cast("int").alias("blocks"))
    rows = (open_.join(several, "bucket").withColumn("block", F.pmod(F.xxhash64("nid"), F.col("blocks")).cast("int"))
            .withColumn("minor", F.col("label") != F.col("main")))
    # block pair (i, j): what the main class has in block i meets the rest in block j, and the rest among itself
    spread = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = F.when(F.col("minor"), F.xxhash64("bucket", "other", "block")).otherwise(F.xxhash64("bucket", "block", "other"))
    # and the rest of two different blocks: that pair's own group
    among = F.when(F.col("minor") & (F.col("other") != F.col("block")),
                   F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other"), F.lit(-1)))
    spread = spread.select("nid", "label", F.explode(F.array_compact(F.array(group, among))).alias("group"))

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _by_group(batches, "group"):
            x = np.frombuffer(b"".join(g["sample"]), dtype=np.uint32).reshape(len(g), SAMPLES)
            label = pd.factorize(g["label"])[0]
            hit = np.zeros(len(g), dtype=bool)
            for i in range(len(g) - 1):
                near = ((x[i + 1:] == x[i]).sum(axis=1) >= SIFT) & (label[i + 1:] != label[i])
                hit[i] |= near.any()
                hit[i + 1:] |= near
            if hit.any():
                got = g[hit]
                yield pa.RecordBatch.from_arrays([pa.array(got["group"], pa.int64()), pa.array(got["nid"], pa.int64())], names=["group", "nid"])

    sifted = (spread.join(sign, "nid").select("group", "nid", "label", "sample")
              .repartition("group").sortWithinPartitions("group").mapInArrow(sift, "group long, nid long"))
    more = linked(stage(sifted, "minhash-sifted"), texts, tables)
    return stage(found.union(more), "minhash-links")


def text_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows: doc_id, tid, nid), (classes of the texts in links: nid, label)."""
    table, rows = frequency_sketch(docs)
    tables = docs.sparkSession.sparkContext.broadcast(idf_tables(table, rows))  # 8 MB, fixed
    signed = stage(signatures(docs, tables), "minhash-signatures")
    label = components(links(signed, docs, tables)).withColumnRenamed("node", "nid")
    return signed.select("doc_id", "tid", node_id(F.col("tid")).alias("nid")), label


def classes(docs: DataFrame) -> DataFrame:
    """doc_id and class_id of every row, and whether it is the one its class keeps."""
    rows, label = text_classes(docs)
    per_text = rows.groupBy("nid").agg(F.min("doc_id").alias("first"))
    per_text = per_text.join(label, "nid", "left").withColumn("label", F.coalesce("label", "nid"))
    per_class = per_text.groupBy("label").agg(F.min("first").alias("class_id"))
    of_text = per_text.join(per_class, "label").select("nid", "class_id")
    return (rows.join(of_text, "nid")
            .select("doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept")))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per class, that of the smallest doc_id (then row hash), all columns kept.

    The winners are found on keys alone; the texts move once, in the join with the winners,
    whose partitioning also serves the choice among rows that are equal in everything.
    """
    rows, label = text_classes(docs)
    tid, row, at = fresh(docs, "mh_tid", "mh_row", "mh_at")
    hashed = [f.name for f in docs.schema.fields if not isinstance(f.dataType, T.MapType)]
    keyed = docs.withColumns({tid: content_key(F.col("text")), row: F.xxhash64(*[F.col(f"`{c}`") for c in hashed])})
    best = F.min(F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", row, tid)).alias("w")
    winners = keyed.groupBy(node_id(F.col(tid)).alias("nid")).agg(best).join(label, "nid", "left")
    winners = winners.groupBy(F.coalesce("label", "nid").alias("label")).agg(F.min("w").alias("w"))
    kept = keyed.join(winners.select(F.col(f"w.{tid}").alias(tid), F.col(f"w.{row}").alias(row)), [tid, row])
    first = F.row_number().over(Window.partitionBy(tid, row).orderBy(F.lit(0)))
    return kept.withColumn(at, first).where(F.col(at) == 1).select(*docs.columns)


@query("op1_minhash_dedup")
def op1_minhash_dedup(spark, sf_dir):
    """Near-duplicate class of every row of ``documents``."""
    return classes(load(spark, sf_dir, "documents"))
