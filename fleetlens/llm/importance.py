"""Importance resampling of a corpus towards a target text collection, by hashed n-grams.

Features are the runs of one to three words of a text, hashed into buckets. The gain of a bucket is
the log of its smoothed share in the target over its share in the corpus; a document's weight is
the sum of its features' gains. Documents are drawn without replacement by the highest weight plus
Gumbel noise, which is a draw in proportion to exp(weight / 1000).

Tasks work on blocks of texts: the block's texts are joined with a separator that no word holds,
one regex pass over the block finds all words, a binary search of the words' places in the texts'
offsets tells which text each lies in, and n-grams that reach over a text's end are masked before
the buckets are counted. Counts of both collections are sums over all their texts; only these
(``buckets`` numbers each) reach the driver. The draw is a range-partitioned sort of id and score:
ranges are counted, and each rank is the rank in its range plus the rows of the ranges before.

Defined results: a null text has no words; a text without words has weight 0; a null id draws the
noise of the empty id and sorts first among equal scores; rows of equal id and score are ranked in
input order; an empty corpus gives no rows, an empty target a gain against no counts. Other columns
are ignored by ``ranked`` on scored rows without them and kept by ``resample``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from fleetlens.llm.common import fresh, load, query, stage
from fleetlens.llm.textvec import blocks, slices

BUCKETS = 10_000
LONGEST = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
SEPARATOR = b"\n"
_WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").finditer


class Features:
    """Buckets of all n-grams of a block of UTF-8 texts, and the text that each lies in."""

    def __init__(self, texts: list[bytes], buckets: int = BUCKETS, longest: int = LONGEST):
        joined = SEPARATOR.join(texts).lower()  # bytes: A-Z only
        offsets = np.cumsum([0] + [len(t) + len(SEPARATOR) for t in texts[:-1]]) if texts else np.zeros(0, np.int64)
        found = [(m.start(), m.group()) for m in _WORDS(joined)]
        doc = np.searchsorted(offsets, np.fromiter((s for s, _ in found), np.int64, len(found)), side="right") - 1
        self.words = np.bincount(doc, minlength=len(texts))
        words = [w for _, w in found]
        after = [b" " + w for w in words]  # a crc goes on where that of the shorter run ended
        sums, bucket, of = [crc32(w) for w in words], [], []
        for n in range(1, longest + 1):
            if n > 1:
                sums = list(map(crc32, after[n - 1:], sums))
            within = doc[n - 1:] == doc[:len(doc) - n + 1]
            bucket.append((np.array(sums[:len(within)], dtype=np.int64) % buckets)[within])
            of.append(doc[:len(within)][within])
        self.bucket, self.doc = np.concatenate(bucket), np.concatenate(of)
        self.count = np.bincount(self.doc, minlength=len(texts))

    def weights(self, gains: np.ndarray) -> np.ndarray:
        """Sum of the gains of each text's features; exact, as long as it is under 2^53."""
        return np.bincount(self.doc, weights=gains[self.bucket].astype(float), minlength=len(self.count)).astype(np.int64)


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """Features in each bucket, over all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in slices(batches):
            for part in blocks(batch.column("text").to_pylist()):
                total += np.bincount(Features(part, buckets, longest).bucket, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    for r in docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log of a bucket's smoothed share in the target over that in the corpus, rounded down."""
    s_all, t_all, k = float(corpus.sum()), float(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + k) / ((s + 1.0) * (t_all + k)))) for s, t in zip(corpus.tolist(), target.tolist())], dtype=np.int64)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths from the id's hash, rounded down."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(u))).cast("long")


def scored(docs: DataFrame, table: np.ndarray, keep: list[str], longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """The columns ``keep`` of every row with n_words, n_features, weight and score (names made free of clashes)."""
    names = fresh(docs.select(*keep), "n_words", "n_features", "weight")
    source = docs.select(*[F.col(c) for c in keep], *([] if "text" in keep else [F.col("text")]))
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep] + [f"{n} long" for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for part in blocks(batch.column("text").to_pylist()):
                f = Features(part, len(table), longest)
                out.append(np.vstack([f.words, f.count, f.weights(table)]))
            if out:
                cols = [pa.array(c) for c in np.hstack(out).astype(np.int64)]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *cols], names=[*keep, *names])

    rows = source.mapInArrow(run, schema)
    return rows.withColumn(fresh(rows, "score")[0], F.col(names[2]) + noise(F.col("doc_id"), seed))


def ranked(rows: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """``rows`` (doc_id, n_words, score and others; a stored table) with ``rank``: 1, 2, 3 ... of the drawn ones, null elsewhere.

    Drawn are the floor(percent * N / 100) highest scores of the N rows with ``least_words`` words,
    ties to the smaller id. No task has more than one range of the sorted rows.
    """
    fits = F.coalesce(F.col("n_words") >= least_words, F.lit(False))
    placed = rows.withColumn("_place", F.monotonically_increasing_id())
    order = [F.col("score").desc(), F.col("doc_id").asc(), F.col("_place").asc()]
    inside = stage(placed.where(fits).repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "importance-ranges")
    sizes = inside.groupBy("_range").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(W.orderBy("_range")) - F.col("_n")).drop("_n")  # one row per range
    wanted = inside.count() * percent // 100
    rank = F.row_number().over(W.partitionBy("_range").orderBy(*order)) + F.col("_before")
    inside = inside.join(F.broadcast(before), "_range").withColumn("rank", rank.cast("long"))
    inside = inside.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    return inside.select(*rows.columns, "rank").union(rows.where(~fits).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             buckets: int = BUCKETS, longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """The drawn documents themselves: all columns of ``docs`` and ``draw_rank``.

    Ids and scores are ranked alone; texts under the lowest drawn score are filtered out of the
    stored rows before the join that gives the others their rank, so that few texts are moved.
    """
    table = gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest))
    names = [f"_c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names).withColumns({"doc_id": F.col(names[docs.columns.index("doc_id")]), "text": F.col(names[docs.columns.index("text")])})
    keep = ["doc_id", *[n for n, c in zip(names, docs.columns) if c != "doc_id"]]
    stored = stage(scored(plain, table, keep, longest, seed).withColumn("_row", F.monotonically_increasing_id()), "importance-rows")
    drawn = ranked(stage(stored.select("doc_id", "n_words", "score", "_row"), "importance-scores"), least_words, percent)
    drawn = stage(drawn.where("rank IS NOT NULL").select("_row", "score", F.col("rank").alias("draw_rank")), "importance-drawn")
    lowest = drawn.agg(F.min("score").alias("s")).first()["s"]
    back = stored.where(F.col("score") >= F.lit(lowest)).join(drawn.select("_row", "draw_rank"), "_row")
    return back.select(*[F.col("doc_id" if c == "doc_id" else n).alias(c) for n, c in zip(names, docs.columns)], "draw_rank")


@query("op13_importance_resampling")
def op13_importance_resampling(spark, sf_dir):
    """Weight, score and draw of every row of ``documents`` towards ``benchmark``."""
    docs = load(spark, sf_dir, "documents")
    table = gains(bucket_counts(docs), bucket_counts(load(spark, sf_dir, "benchmark")))
    rows = stage(scored(docs, table, ["doc_id"]), "importance-scored")
    return ranked(rows).select("doc_id", "n_features", "weight", "score", "rank")
