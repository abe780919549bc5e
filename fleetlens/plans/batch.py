"""One processing batch: every family scored for a half-open ``CreatedDate`` window."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from fleetlens.plans.families import cmb_job, da_job, ecs_job, esprsp_job, nonsevere_job, overspeed_job
from fleetlens.sources.family import Telemetry, in_batch

FAMILIES = {"overspeed": overspeed_job, "nonsevere": nonsevere_job, "distance": da_job, "curve": ecs_job,
            "collision": cmb_job, "stability": esprsp_job}
DAY = "day"  # partition column of stored samples: the date of their Timestamp
HALF_WIDTH = dt.timedelta(seconds=11)  # no family looks further from its event


def samples_near(samples: DataFrame, trips: DataFrame) -> DataFrame:
    """The samples in the time range of ``trips`` plus the widest half-width.

    The range comes from the events' own first and last time (one row), so the restriction is a
    comparison with constants and reaches the scan; of a table partitioned by ``day`` only the
    folders of its dates are read.
    """
    first, last = trips.agg(F.min("Timestamp"), F.max("Timestamp")).first()
    if first is None:
        return samples.where(F.lit(False))
    lo, hi = F.lit(first - HALF_WIDTH), F.lit(last + HALF_WIDTH + dt.timedelta(seconds=1))
    near = samples.where((F.col("Timestamp") >= lo) & (F.col("Timestamp") <= hi))
    return near.where(F.col(DAY).between(F.to_date(lo), F.to_date(hi))) if DAY in samples.columns else near


def batch_telemetry(t: Telemetry, begin: dt.datetime, end: dt.datetime) -> Telemetry:
    """The tables restricted to the events created in [begin, end) and the samples around them.

    Both restrictions reach the scans: with tables partitioned by date, a 30-minute run reads
    that date's files only.
    """
    trips = in_batch(t.trips, begin, end)
    return replace(t, trips=trips, samples=samples_near(t.samples, trips))


def run_batch(t: Telemetry, begin: dt.datetime, end: dt.datetime, families=tuple(FAMILIES)) -> dict[str, tuple[DataFrame, DataFrame]]:
    """(importance, labels) per family for one batch; ``begin`` and ``end`` on batch borders."""
    part = batch_telemetry(t, begin, end)
    return {name: FAMILIES[name](part) for name in families}
