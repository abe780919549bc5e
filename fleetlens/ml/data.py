"""Labelled vectors for the model experiments: the driver's ``embeddings`` table, binary target ``label = 0``."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetlens.sources.tables import load


def labelled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, x array<double>, y 0/1) with y = 1 for the minority class ``label = 0``."""
    e = load(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"),
                    F.transform("embedding", lambda v: v.cast("double")).alias("x"),
                    (F.col("label") == 0).cast("int").alias("y"))


def dim_stats(df: DataFrame, col: str = "x") -> DataFrame:
    """Per-dimension mean and population std (one row per dimension; map-side combined)."""
    p = df.select(F.posexplode(col).alias("d", "v"))
    return p.groupBy("d").agg(F.avg("v").alias("mu"), F.stddev_pop("v").alias("sd"))


def standardize(df: DataFrame, col: str = "x", out: str = "z") -> DataFrame:
    """(x - mean) / population std per dimension (std 0 -> 1), fitted on ``df`` itself.

    The statistics have one entry per dimension, a bound fixed by the feature width, so they are
    gathered as two arrays and applied with ``zip_with`` (no join, no UDF).
    """
    s = dim_stats(df, col).agg(F.sort_array(F.collect_list(F.struct("d", "mu", "sd"))).alias("s"))
    row = s.first()["s"]
    mus = F.array(*[F.lit(float(r["mu"])) for r in row])
    sds = F.array(*[F.lit(float(r["sd"]) if r["sd"] and r["sd"] > 1e-12 else 1.0) for r in row])
    z = F.zip_with(F.zip_with(col, mus, lambda v, m: v - m), sds, lambda v, s_: v / s_)
    return df.withColumn(out, z)


def with_vector(df: DataFrame, col: str = "z", out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(col))
