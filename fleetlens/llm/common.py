"""Shared helpers of the training-data operators: registry, table access, staged tables."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetlens.session import checkpoint_dir

# functions that run in tasks travel whole: workers need not have this package on their path
cloudpickle.register_pickle_by_value(sys.modules[__package__])

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` as query ``name``; ``sql`` is its DuckDB equivalent."""
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Hand rows to Python in batches of at most ``BATCH_ROWS``.

    A batch is held several times over (by the JVM, by Arrow, as objects); with documents of
    some kilobytes, and a few of many, Spark's default of 10,000 rows takes hundreds of MB.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` does, survives lost executors (the folder is
    shared), and keeps columnar pruning for later readers.
    """
    bounded_batches(df.sparkSession)
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that do not clash (case-insensitively) with those of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def text_key(col="text"):
    """128-bit content key of a text (null counts as empty): two independently seeded hashes."""
    t = F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))
    return F.struct(F.xxhash64(t).alias("a"), F.xxhash64(F.lit(7919), t).alias("b"))
