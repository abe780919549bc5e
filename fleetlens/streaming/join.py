"""Stream-stream interval join of trip events with sensor samples (T3).

Two ordered streams share a timeline and advance together, a chunk a micro-batch. A micro-batch joins
its events with its samples, and each with what earlier micro-batches left of the other side, by the
interval join on (CompanyID, VehicleID, _bucket) plus the strict or inclusive time range. What is kept
for later is bounded by the range and the slack around the chunk's end, not by the chunk: a state
store per row would hold all samples of a chunk, most of which meet no event.

``run_join_stream`` also keeps the rows that come too late, so that every input row is either joined
or set aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleetlens.operators.interval_join import interval_join
from fleetlens.session import start_with_partitions
from fleetlens.sources.ordered import CHUNK, on_time, read_chunks, read_ordered, stored_schema


def stream_interval_join(events: DataFrame, samples: DataFrame, old_events: DataFrame, old_samples: DataFrame, lo_s: int, hi_s: int,
                         inclusive: bool = False, event_ts: str = "EventTimeStamp", sample_ts: str = "ppeTimeStamp") -> DataFrame:
    """The pairs that a micro-batch adds: its rows with each other and with the other side's rows kept from before."""
    both = [new.withColumn(flag, F.lit(False)).unionByName(old.withColumn(flag, F.lit(True)))
            for new, old, flag in ((events, old_events, "_old_event"), (samples, old_samples, "_old_sample"))]
    joined = interval_join(*both, lo_s, hi_s, inclusive, event_ts=event_ts, sample_ts=sample_ts)
    return joined.where(~(F.col("_old_event") & F.col("_old_sample"))).drop("_old_event", "_old_sample")


def needed_later(ts: str, end_s: int, slack_s: int, reach_s: int) -> Column:
    """Rows that can meet a row of a later chunk: those start at ``end_s``, less the slack; ``reach_s``
    is how far a row may lie before the one it meets."""
    return F.col(ts) >= F.timestamp_seconds(F.lit(end_s - slack_s - reach_s))  # a constant: reaches the scan


def drain(spark: SparkSession, stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Run ``stream`` into parquet at ``sink`` until its sources have no more chunks."""
    writer = (stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
              .outputMode("append").trigger(processingTime="0 seconds"))
    q = start_with_partitions(spark, writer)
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def run_join_stream(spark: SparkSession, events: str, samples: str, run: str, lo_s: int, hi_s: int, width_s: int, slack_s: int,
                    event_ts: str = "EventTimeStamp", sample_ts: str = "ppeTimeStamp") -> tuple[DataFrame, DataFrame]:
    """Join two folders of time chunks (see ``sources.ordered``): (joined rows, rows set aside by side).

    Rows up to ``slack_s`` beside their chunk take part, and none of these is dropped. Each micro-batch
    writes its pairs and what it keeps to folders of its own, overwritten when it is replayed.
    """
    timeline = [events, samples]
    sides = {"events": (events, event_ts, hi_s), "samples": (samples, sample_ts, -lo_s)}
    schemas = {name: stored_schema(spark, path) for name, (path, _, _) in sides.items()}
    kept = lambda name, batch_id: f"{run}/kept-{name}/batch_id={batch_id}"

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        rows = batch.collect()  # the names of a few chunks
        end = max((r[CHUNK] for r in rows), default=0) + width_s
        new, old = {}, {}
        for name, (path, ts, _) in sides.items():
            df = read_chunks(spark, path, schemas[name], [r[CHUNK] for r in rows if r["side"] == name])
            new[name] = df.where(on_time(ts, width_s, slack_s)).drop(CHUNK)
            old[name] = (spark.read.schema(new[name].schema).parquet(kept(name, batch_id - 1)) if batch_id
                         else spark.createDataFrame([], new[name].schema))
        joined = stream_interval_join(new["events"], new["samples"], old["events"], old["samples"], lo_s, hi_s,
                                      event_ts=event_ts, sample_ts=sample_ts)
        joined.write.mode("overwrite").parquet(f"{run}/joined/batch_id={batch_id}")
        for name, (_, ts, reach_s) in sides.items():
            later = new[name].unionByName(old[name]).where(needed_later(ts, end, slack_s, reach_s))
            later.write.mode("overwrite").parquet(kept(name, batch_id))

    names = [read_ordered(spark, path, timeline, f"{run}/progress-{name}", names=True).select(F.lit(name).alias("side"), CHUNK)
             for name, (path, _, _) in sides.items()]
    q = (names[0].unionByName(names[1]).writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", f"{run}/checkpoint-joined").trigger(processingTime="0 seconds").start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    aside = None
    for name, path, ts in (("events", events, event_ts), ("samples", samples, sample_ts)):
        stored = spark.read.parquet(path).withColumn(CHUNK, F.col(CHUNK).cast("long"))
        late = stored.where(~on_time(ts, width_s, slack_s)).select(
            F.lit(name).alias("side"), "CompanyID", "VehicleID", F.col(ts).alias("at"), CHUNK)
        aside = late if aside is None else aside.unionByName(late)
    return spark.read.parquet(f"{run}/joined").drop("batch_id"), aside
