"""Distance-alert cleaning and statistical scoring (noise runs, joint IQR outliers, min-max).

All per-event steps are Window expressions over ``EVENT_PART`` ordered by
(``SecTimeSegment``, ``ppe_n``), so they reuse the interval join's partitioning and share one sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from fleetlens.operators.interval_join import EVENT_PART

ORDER = ("SecTimeSegment", "ppe_n")
REQUIRED = ("TripEventID", "ppeDistanceforwardV", "ppeSpeedforwardV", "ppeSpeed")


def _ordered() -> Window:
    return Window.partitionBy(*EVENT_PART).orderBy(*ORDER)


def require_columns(df: DataFrame, cols=REQUIRED) -> None:
    """Check the schema (no job): all columns the cleaning needs must be there."""
    absent = sorted(set(cols) - set(df.columns))
    if absent:
        raise ValueError(f"distance-alert samples lack {', '.join(absent)}")


def remove_noise(df: DataFrame, run: int = 2, extend: int = 2, max_speed: float = 230) -> DataFrame:
    """Drop sensor-noise stretches.

    A sample is noisy when the forward vehicle reads speed 0 (or above ``max_speed``) and distance
    0 while the own speed is positive. Where ``run`` consecutive samples are noisy, the sample
    ending the run and the next ``extend`` samples are dropped (so the first noisy sample stays).
    """
    require_columns(df)
    w = _ordered()
    fs, fd, sp = F.col("ppeSpeedforwardV"), F.col("ppeDistanceforwardV"), F.col("ppeSpeed")
    z = F.coalesce(((fs == 0) | (fs > max_speed)) & (fd == 0) & (sp > 0), F.lit(False))
    out = df.withColumn("_z", z.cast("int"))
    out = out.withColumn("_block", F.when(F.sum("_z").over(w.rowsBetween(-(run - 1), 0)) == run, 1)
                         .otherwise(0))
    out = out.withColumn("_rm", F.max("_block").over(w.rowsBetween(-extend, 0)))
    return out.where(F.col("_rm") == 0).drop("_z", "_block", "_rm")


def drop_joint_outliers(df: DataFrame, cols=("ppeSpeedforwardV", "ppeDistanceforwardV"), k: float = 1.5) -> DataFrame:
    """Drop samples that are IQR outliers (exact linear quantiles) in *all* of ``cols``."""
    w = Window.partitionBy(*EVENT_PART)
    flags = []
    for c in cols:
        q1 = F.percentile(F.col(c), F.lit(0.25)).over(w)
        q3 = F.percentile(F.col(c), F.lit(0.75)).over(w)
        iqr = q3 - q1
        flags.append((F.col(c) < q1 - k * iqr) | (F.col(c) > q3 + k * iqr))
    both = flags[0]
    for f in flags[1:]:
        both = both & f
    return df.withColumn("_out", F.coalesce(both, F.lit(False))).where(~F.col("_out")).drop("_out")


def minmax(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """Per-event min-max scaling ``{source: target}``; a zero range gives null."""
    w = Window.partitionBy(*EVENT_PART)
    out = df
    for src, dst in cols.items():
        lo, hi = F.min(src).over(w), F.max(src).over(w)
        out = out.withColumn(dst, F.try_divide(F.col(src) - lo, hi - lo))
    return out


def da_normalize(clean: DataFrame) -> DataFrame:
    out = minmax(clean, {"ppeDistanceforwardV": "normalized_distance", "ppeSpeed": "normalized_speed_current",
                         "ppeSpeedforwardV": "normalized_speed_forward"})
    return out.withColumn("inverted_normalized_distance", 1 - F.col("normalized_distance"))


def distance_score(normalized: DataFrame, weights=(0.7, 0.2, 0.1)) -> DataFrame:
    """One row per event: weighted means (and stds) of the normalised signals; null score drops."""
    keys = [*EVENT_PART, "TripEventGuid", "DriverID", "CreatedDate", "batch_start"]
    sig = ("inverted_normalized_distance", "normalized_speed_current", "normalized_speed_forward")
    aggs = []
    for s in sig:
        aggs += [F.avg(s).alias(f"{s}_mean"), F.stddev_samp(s).alias(f"{s}_std")]
    g = normalized.groupBy(*keys).agg(*aggs)
    score = (F.col(f"{sig[0]}_mean") * weights[0] + F.col(f"{sig[1]}_mean") * weights[1]
             + F.col(f"{sig[2]}_mean") * weights[2])
    return g.withColumn("score", score).where(F.col("score").isNotNull())


def da_clean(src: DataFrame) -> DataFrame:
    return drop_joint_outliers(remove_noise(src))
