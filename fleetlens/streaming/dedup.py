"""Streaming min-gap dedup (T4): a sorted buffer per shard of vehicles, released by event-time timeouts.

State per shard (vehicles by hash, ``SHARDS`` of them): the events that the watermark has not passed
yet, and the time of the last kept event of each vehicle. A call from Spark into Python and its state
cost milliseconds, whatever the rows, so a shard takes all its vehicles in one call. A timeout at the
earliest buffered event fires when the watermark passes it; all events up to the watermark are then
final, so they are sorted by (time, id) and folded against their vehicle's last kept time. Events may
therefore arrive in any order within the slack of the source; the result equals the batch fold. Events
beyond the slack are set aside by the caller (``on_time``), not dropped.
"""

from __future__ import annotations

import sys
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from fleetlens.sources.ordered import CHUNK, on_time, read_ordered, stage_by_time
from fleetlens.streaming.join import drain

OUT_SCHEMA = "CompanyID long, VehicleID string, TripEventID string, event_us long"
FOLD_SCHEMA = "CompanyID string, VehicleID string, TripEventID string, event_us long"
STATE_SCHEMA = """kept_company array<string>, kept_vehicle array<string>, kept_us array<long>,
    company array<string>, vehicle array<string>, times array<long>, ids array<string>"""
SHARDS = 4096

# Ship the fold by value: Python workers need only pandas, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def min_gap_fold(gap_us: int):
    """Keep an event when it is more than ``gap_us`` after its vehicle's last kept event; for all vehicles of a shard."""

    def fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        *kept, company, vehicle, times, ids = state.get if state.exists else ([],) * 7
        last = dict(zip(zip(*kept[:2]), kept[2]))
        held = list(zip(times, company, vehicle, ids))
        if not state.hasTimedOut:
            for f in frames:
                held += zip(f["event_us"].tolist(), f["CompanyID"], f["VehicleID"], f["TripEventID"])
        held.sort(key=lambda r: (r[0], r[3] is not None, r[3]))
        passed = state.getCurrentWatermarkMs() * 1000
        final = bisect_left(held, passed, key=lambda r: r[0])
        keep = []
        for us, company, vehicle, event in held[:final]:
            before = last.get((company, vehicle))
            if before is None or us - before > gap_us:
                keep.append((company, vehicle, event, us))
                last[company, vehicle] = us
        rest = held[final:]
        times, company, vehicle, ids = (list(c) for c in zip(*rest)) if rest else ([],) * 4
        state.update(([c for c, _ in last], [v for _, v in last], list(last.values()), company, vehicle, times, ids))
        if rest:  # be called when the watermark has passed the earliest
            state.setTimeoutTimestamp(times[0] // 1000 + 1)
        if keep:
            yield pd.DataFrame(keep, columns=["CompanyID", "VehicleID", "TripEventID", "event_us"])

    return fold


def stage_arrivals(trips: DataFrame, path: str, arrival, width_s: int, slack_s: int, ts: str = "Timestamp") -> None:
    """Stage trip events in chunks of their arrival time, and a last chunk with one marker row (null
    vehicle) whose time moves the watermark past every event; a live stream needs no marker."""
    stage_by_time(trips, path, arrival, width_s)
    end = _latest_s(trips, arrival, ts)
    if end is not None:
        at = ((end + 4 * slack_s) // width_s + 2) * width_s
        marker = trips.sparkSession.range(1).select(*[
            (F.timestamp_seconds(F.lit(at)) if c == ts else F.lit(None)).cast(trips.schema[c].dataType).alias(c) for c in trips.columns])
        marker.withColumn(CHUNK, F.lit(at)).write.mode("append").partitionBy(CHUNK).parquet(path)


def _latest_s(trips: DataFrame, arrival, ts: str) -> int | None:
    """Latest arrival or event time in epoch seconds."""
    us = F.greatest(F.max(F.unix_micros(arrival)), F.max(F.unix_micros(ts)))
    end = trips.agg(us.alias("us")).first()["us"]
    return None if end is None else end // 1_000_000


def run_dedup_stream(spark: SparkSession, trips: str, run: str, gap_s: float, width_s: int, slack_s: int,
                     ts: str = "Timestamp", shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """(kept events, events set aside as too late) of a folder of arrival chunks (see ``sources.ordered``).

    ``shards`` is the number of state rows that the vehicles share: a change needs a new checkpoint, results are the same."""
    stream = read_ordered(spark, trips, progress=f"{run}/progress-dedup")
    events = (stream.where(on_time(ts, width_s, slack_s)).withWatermark(ts, f"{2 * slack_s} seconds")
              .select(F.pmod(F.xxhash64("CompanyID", "VehicleID"), F.lit(shards)).alias("shard"), F.col("CompanyID").cast("string").alias("CompanyID"),
                      "VehicleID", "TripEventID", ts, F.unix_micros(ts).alias("event_us")))
    kept = (events.groupBy("shard").applyInPandasWithState(
        min_gap_fold(int(gap_s * 1_000_000)), FOLD_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout)
        .withColumn("CompanyID", F.col("CompanyID").cast("long")))
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:  # a query takes its settings when it starts; the session keeps its own
        drain(spark, kept.where("TripEventID IS NOT NULL"), f"{run}/kept", f"{run}/checkpoint-dedup")
    finally:
        spark.conf.set(provider, before)
    stored = spark.read.parquet(trips).withColumn(CHUNK, F.col(CHUNK).cast("long"))
    return spark.read.schema(OUT_SCHEMA).parquet(f"{run}/kept"), stored.where(~on_time(ts, width_s, slack_s))
