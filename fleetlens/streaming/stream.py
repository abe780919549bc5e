"""Incremental scoring with Structured Streaming.

* T1 periodic run: ``trigger(availableNow=True)`` (catch up and stop) or ``processingTime``; the
  checkpoint, not a wall clock, remembers which input files are done.
* T2 batch key: ``batch_start`` = 30-minute window of ``CreatedDate``, a column of both outputs.
* T3 series join: each micro-batch of new trip events is joined with the samples in the batch's
  own time range (stream-static, bucketed interval join), so late-arriving events still meet
  their samples and a micro-batch never scans the whole sample table.
* T5 idempotent sink: importance and label rows go to ``<sink>/importance`` and ``<sink>/labels``,
  one folder per micro-batch, overwritten when it is replayed; with ``targets`` each micro-batch is
  also merged into partitioned tables (only the partitions it touches, once per batch id);
  ``merge_outputs`` upserts everything into whole tables instead.
* T6 late data: rows more than ``late_minutes`` older than the newest row of all earlier
  micro-batches are scored like any other and also stored in ``<sink>/late``; every micro-batch
  leaves its row count, late count and time span in ``<sink>/progress``.
"""

from __future__ import annotations

from collections.abc import Callable

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetlens.functions.columns import batch_start
from fleetlens.operators.sinks import merge_partitions
from fleetlens.plans.batch import DAY, samples_near
from fleetlens.sources.family import Telemetry


EVENTS_PER_FILE = 2_000_000


def stage_chunks(trips: DataFrame, path: str, minutes: int = 24 * 60) -> str:
    """Write trip events as file chunks (one folder per ``minutes`` of CreatedDate) to feed a file stream.

    Each task writes a range of CreatedDate of about ``EVENTS_PER_FILE`` events, so that a chunk has
    the files that its rows need. A file per chunk and scan task would make many times the
    micro-batches, and each of these reads the samples.
    """
    tasks = max(1, -(-trips.count() // EVENTS_PER_FILE))
    chunk = F.date_format(F.window("CreatedDate", f"{minutes} minutes").start, "yyyyMMddHHmm")
    ordered = trips.repartitionByRange(tasks, "CreatedDate")
    ordered.withColumn("chunk", chunk).write.mode("overwrite").partitionBy("chunk").parquet(path)
    return path


def stage_samples(samples: DataFrame, path: str) -> DataFrame:
    """``samples`` stored by date, so that a micro-batch reads its own dates only (see ``samples_near``)."""
    samples.withColumn(DAY, F.to_date("Timestamp")).write.partitionBy(DAY).parquet(path)
    schema = samples.withColumn(DAY, F.to_date("Timestamp")).schema
    return samples.sparkSession.read.schema(schema).parquet(path)


def run_stream(spark: SparkSession, trips_dir: str, telemetry: Telemetry, sink: str, checkpoint: str,
               job: Callable[[Telemetry], tuple[DataFrame, DataFrame]], available_now: bool = True,
               files_per_trigger: int = 4, late_minutes: int = 45, targets: dict[str, tuple] | None = None):
    """Score trip events as they land in ``trips_dir`` and write importance and label rows under ``sink``.

    ``job`` is any family job ``Telemetry -> (importance, labels)``; the micro-batch replaces the
    trip table of ``telemetry`` while samples, dimensions and prior scores stay tables. ``targets``
    maps ``importance`` / ``labels`` to (table folder, merge function, date column of its rows).
    """
    schema = spark.read.parquet(trips_dir).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(trips_dir)
    root = sink.rstrip("/")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.drop("chunk").persist()
        try:
            out = lambda name, df: df.write.mode("overwrite").parquet(f"{root}/{name}/batch_id={batch_id}")
            newest = _newest_before(spark, f"{root}/progress", batch_id)
            late = batch.where(F.lit(False)) if newest is None else batch.where(
                F.col("CreatedDate") < F.lit(newest) - F.expr(f"INTERVAL {int(late_minutes)} MINUTES"))
            out("late", late)
            span = batch.agg(F.count(F.lit(1)).alias("events"), F.min("CreatedDate").alias("oldest"), F.max("CreatedDate").alias("newest"))
            t = replace(telemetry, trips=batch, samples=samples_near(telemetry.samples, batch))
            key = batch.select("CompanyID", "TripEventID", batch_start("CreatedDate").alias("batch_start"))
            scored = {name: df.join(key, ["CompanyID", "TripEventID"]).select(*df.columns, "batch_start")
                      for name, df in zip(("importance", "labels"), job(t))}
            both = _as_one(scored)  # one job: the exchange of the samples is made once for both
            both.write.mode("overwrite").parquet(f"{root}/scored/batch_id={batch_id}")
            rows = spark.read.schema(both.schema).parquet(f"{root}/scored/batch_id={batch_id}")
            for name in scored:
                out(name, rows.where(F.col("output") == name).select(f"{name}.*"))
            for name, (base, merge, date_col) in (targets or {}).items():
                stored = spark.read.parquet(f"{root}/{name}/batch_id={batch_id}").drop("batch_start")
                merge_partitions(spark, base, stored, merge, date_col, batch_id)
            out("progress", span.withColumn("late", F.lit(late.count())))
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 minutes")
    return writer.start()


def _as_one(frames: dict[str, DataFrame]) -> DataFrame:
    """The rows of several frames, each in the column of its frame's name; ``output`` says which."""
    out = None
    for name, df in frames.items():
        cols = [F.struct(*df.columns).alias(n) if n == name else F.lit(None).cast(other.select(F.struct(*other.columns)).schema[0].dataType).alias(n)
                for n, other in frames.items()]
        rows = df.select(F.lit(name).alias("output"), *cols)
        out = rows if out is None else out.unionByName(rows)
    return out


def _newest_before(spark: SparkSession, progress: str, batch_id: int):
    """Newest CreatedDate of the micro-batches before ``batch_id`` (a replay sees the same), or None."""
    if batch_id == 0:
        return None
    seen = spark.read.parquet(progress).where(F.col("batch_id") < batch_id)
    return seen.agg(F.max("newest")).first()[0]


def outputs(spark: SparkSession, sink: str, name: str) -> DataFrame:
    """Stored rows of ``importance``, ``labels``, ``late`` or ``progress``, with their batch_id."""
    return spark.read.parquet(f"{sink.rstrip('/')}/{name}")


def merge_outputs(spark: SparkSession, sink: str, extra: DataFrame, classes: DataFrame, types: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both targets after upserting everything the stream has written; of a key's rows the last micro-batch wins."""
    from fleetlens.operators.sinks import upsert_classification, upsert_importance

    def last(name: str, keys: list[str]) -> DataFrame:
        rows = outputs(spark, sink, name).drop("batch_start")
        rest = [c for c in rows.columns if c not in (*keys, "batch_id")]
        best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("batch_id")).alias("r"))
        return best.select(*keys, "r.*")

    importance = last("importance", ["CompanyID", "VehicleID", "TripEventID", "TripEventGuid"])
    labels = last("labels", ["CompanyID", "VehicleID", "TripEventID"])
    return upsert_importance(extra, importance), upsert_classification(classes, labels, types)
