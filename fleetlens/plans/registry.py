"""Query registry: ``queries()`` and ``oracle_sql()`` of ``__spark_entry__`` are built from it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T

from fleetlens.functions.columns import quantize

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def finalize(df: DataFrame) -> DataFrame:
    """Drop internal columns and quantise doubles (the oracle applies the same rule)."""
    cols = []
    for f in df.schema.fields:
        if f.name.startswith("_"):
            continue
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append((quantize(f.name) + 0.0).alias(f.name))
        else:
            cols.append(f.name)
    return df.select(*cols)


def register(name: str, sql: str | None = None):
    """Register a query under ``name``; ``sql`` is its DuckDB oracle (None = rows-only check)."""
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finalize(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco
