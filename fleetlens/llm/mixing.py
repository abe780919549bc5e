"""Mixing sources to target weights with hash-threshold histograms (DataFrame functions only).

Every row gets a hash key (nine hex digits of the md5 of its id). Tokens are summed by
(source, bucket of the key); the running sum over a source's buckets finds the bucket in
which its budget ends; only the rows of that boundary bucket are summed again by the next
digits. Three nested levels of 4,096 buckets fix one threshold key per source, and a row
is taken if its key lies below it: a filter, no sort of the rows.

Defined results: a null text has size 0 and a null source is a source of its own, ranked
last; rows of equal id share a key, so they are taken together; an empty table gives an
empty result; a table without any word gives targets of 0. Other columns are ignored by
``mix_plan`` and kept by ``apply_mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from fleetlens.llm.common import fresh, load, query, stage

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEAT = 2
DIGITS, LEVELS = 3, 3
SALTS = 64


def word_count(text: Column) -> Column:
    """Number of runs of anything but ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def hash_key(doc_id: Column) -> Column:
    return F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, DIGITS * LEVELS)


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and hash key of every row."""
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), hash_key(F.col("doc_id")).alias("key"))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Per source: its size and its target.

    Weights are dealt to the sources in code-point order (null last), repeating. A target
    stops at ``max_repeat`` times the source's size and the excess goes to the others by
    weight; that fixed point is ``min(cap, level * weight)`` for one common level, found by
    a running sum over the sources in order of cap / weight. One row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    per = per.withColumn("rank", rank).withColumn("w", w).withColumn("cap", F.col("source_size") * float(max_repeat))
    per = per.withColumn("ratio", F.col("cap") / F.col("w"))
    before = W.orderBy("ratio", "rank").rowsBetween(W.unboundedPreceding, -1)
    every = W.orderBy("ratio", "rank").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    per = (per.withColumn("level", (F.sum("source_size").over(every) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                          / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))))
    fits = F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "rank", "level"))
    per = per.withColumn("level", F.coalesce(F.min(fits).over(every)["level"], F.lit(float("inf"))))
    return per.select("source", "source_size", F.least("cap", F.col("level") * F.col("w")).alias("target"))


def mix_plan(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Per source: source_size, target, ``base`` whole passes and the threshold key ``below``.

    ``sizes`` has doc_id, source, size, key and is read once per level: pass a stored table.
    A source's rows are taken ``base`` times, and once more if their key is below ``below``.
    """
    goal = stage(targets(sizes, weights, share, max_repeat), "mix-targets")
    base = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    state = (goal.withColumn("base", base.cast("int"))
             .withColumn("rest", F.col("target") - F.col("base") * F.col("source_size"))
             .withColumn("prefix", F.lit("")))
    for level in range(LEVELS):
        digits = (level + 1) * DIGITS
        at = state.select(F.col("source").alias("_s"), "prefix", "rest")
        inside = (sizes.where("size > 0").join(at, F.col("source").eqNullSafe(F.col("_s")))
                  .where(F.substring("key", 1, level * DIGITS) == F.col("prefix") if level else F.lit(True)))
        hist = inside.groupBy("source", F.substring("key", 1, digits).alias("bucket")).agg(
            F.sum("size").alias("n"), F.first("rest").alias("rest"))
        run = F.sum("n").over(W.partitionBy("source").orderBy("bucket"))
        edge = (hist.withColumn("run", run).where(F.col("run") > F.col("rest"))
                .groupBy(F.col("source").alias("_s")).agg(F.min(F.struct("bucket", "run", "n")).alias("e")))
        state = (state.join(edge, F.col("source").eqNullSafe(F.col("_s")), "left")
                 .withColumn("prefix", F.coalesce(F.col("e.bucket"), F.rpad("prefix", digits, "0")))
                 .withColumn("rest", F.coalesce(F.col("rest") - (F.col("e.run") - F.col("e.n")), F.col("rest")))
                 .withColumn("edge_n", F.coalesce(F.col("e.n"), F.lit(0)))
                 .drop("_s", "e"))
        if level < LEVELS - 1:
            state = stage(state, "mix-level")
    # the last boundary bucket is taken if that brings the source nearer to its target
    below = F.when(F.col("edge_n") - F.col("rest") < F.col("rest"), F.concat("prefix", F.lit("~"))).otherwise(F.col("prefix"))
    return state.select("source", "source_size", "target", "base", below.alias("below"))


def _with_plan(rows: DataFrame, plan: DataFrame, salt: Column) -> DataFrame:
    """Join each row with its source's plan; a hot source is spread over ``SALTS`` keys."""
    s, n = fresh(rows, "mix_source", "mix_salt")
    plan = plan.withColumnRenamed("source", s).withColumn(n, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(plan, F.col("source").eqNullSafe(F.col(s)) & (salt == F.col(n))).drop(s, n)


def passes(base: Column, key: Column, below: Column) -> Column:
    return base + (key < below).cast("int")


def mixed(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row."""
    return (_with_plan(sizes, plan, F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int"))
            .select("doc_id", "size", "source_size", "target",
                    (passes(F.col("base"), F.col("key"), F.col("below")) * F.col("size")).cast("long").alias("taken")))


def apply_mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, all columns kept."""
    plan = mix_plan(stage(sized(docs), "mix-sizes"), weights, share, max_repeat)
    b, k, n = fresh(docs, "mix_base", "mix_below", "mix_n")
    plan = plan.select("source", F.col("base").alias(b), F.col("below").alias(k))
    key = hash_key(F.col("doc_id"))
    joined = _with_plan(docs, plan, F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int"))
    times = passes(F.col(b), key, F.col(k))
    return joined.withColumn(n, F.explode(F.array_repeat(F.lit(1), times))).select(*docs.columns)


SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                  substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 9) AS key FROM documents),
p AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk FROM p),
w AS (SELECT *, CASE rk % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS w, source_size * 2::DOUBLE AS cap FROM r),
l AS (SELECT *, cap / w AS ratio,
        (sum(source_size) OVER () * 1.5::DOUBLE
         - coalesce(sum(cap) OVER (ORDER BY cap / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lv FROM w),
t AS (SELECT source, source_size, least(cap, (SELECT lv FROM l WHERE lv <= ratio ORDER BY ratio, rk LIMIT 1) * w) AS target FROM l),
g AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::INT AS base FROM t),
h AS (SELECT d.source, d.key, sum(size) AS n, any_value(target - base * source_size) AS rest
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source WHERE size > 0 GROUP BY ALL),
c AS (SELECT *, sum(n) OVER (PARTITION BY source ORDER BY key) AS run FROM h),
e AS (SELECT source, min(key) AS key, min_by(run, key) AS run, min_by(n, key) AS n, any_value(rest) AS rest FROM c WHERE run > rest GROUP BY source),
th AS (SELECT source, CASE WHEN n - (rest - (run - n)) < rest - (run - n) THEN key || '~' ELSE key END AS below FROM e)
SELECT d.doc_id, d.size, g.source_size, g.target,
       ((g.base + CASE WHEN d.key < coalesce(th.below, '000000000') THEN 1 ELSE 0 END) * d.size)::BIGINT AS taken
FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source LEFT JOIN th ON d.source IS NOT DISTINCT FROM th.source
"""


@query("op5_mix_sources", SQL)
def op5_mix_sources(spark, sf_dir):
    """Words each document gives to the mix; whole ``documents`` table."""
    sizes = stage(sized(load(spark, sf_dir, "documents")), "mix-sizes")
    return mixed(sizes, mix_plan(sizes))
