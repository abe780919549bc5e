"""Telemetry tables derived deterministically from the driver's ``events`` table.

One trip event per ``events`` row and 84 sensor samples (4 Hz, -10.00 s to +10.75 s)
around it. Every expression is a narrow projection or an ``explode`` of a fixed
84-element sequence, so derivation is embarrassingly parallel and scales with ``events``.
The same recipe is written in DuckDB SQL in ``fleetlens.plans.oracle``.

Session time zone must be UTC for the timestamps to agree with the DuckDB view.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleetlens.schema import CLASSIFIED_BY, LABEL_HIGH, LABEL_LOW, LABEL_MID, ROSTER_SETTING
from fleetlens.sources.tables import load

EVENTS_PER_TASK = 50_000

_EVENT_ID_SQL = ("""case event_type when 'click' then -1879048190 when 'view' then 1048576
    when 'purchase' then 1
    when 'error' then case event_id % 3 when 0 then 32 when 1 then 1024 else 4096 end
    else case event_id % 2 when 0 then 32768 else 131072 end end""")


def trip_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``TripEvent``: one committed event per ``events`` row (helper ``n`` = event_id)."""
    ev = load(spark, sf_dir, "events").select(
        "event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), F.expr(_EVENT_ID_SQL).alias("EventID"))
    return ev.select(
        (F.lit(1) + F.col("user_id") % 5).alias("CompanyID"),
        F.concat(F.lit("V"), F.col("user_id").cast("string")).alias("VehicleID"),
        F.when(F.col("event_id") % 97 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("D"), (F.col("user_id") % 40).cast("string"))).alias("DriverID"),
        F.when(F.col("event_id") % 53 == 0, F.lit(None).cast("bigint"))
        .otherwise(F.col("user_id") * 100 + F.col("event_id") % 7).alias("TripID"),
        F.concat(F.format_string("%08x", F.col("EventID")), F.lit("_"),
                 F.col("event_id").cast("string")).alias("TripEventID"),
        F.concat(F.lit("g"), F.col("event_id").cast("string")).alias("TripEventGuid"),
        "EventID",
        F.col("event_id").alias("n"),
        F.date_trunc("second", "ts").alias("Timestamp"),
        (F.col("ts") + F.expr("INTERVAL 90 SECONDS")).alias("CreatedDate"),
        (F.col("event_id") % 4 == 0).alias("SevereEvent"),
        (F.lit(60) + (F.col("event_id") * 37) % 90).cast("double").alias("Speed"),
        F.when(F.col("event_id") % 13 == 0, F.lit(None).cast("double"))
        .when(F.col("event_id") % 11 == 0, F.lit(0.0))
        .otherwise((F.lit(40) + (F.col("event_id") * 17) % 90).cast("double")).alias("SpeedLimit"),
    )


def _sample_values(n: Column, k: Column) -> list[Column]:
    speed = F.when(n % 10 == 3, F.lit(80)).otherwise(F.greatest(
        F.lit(0),
        F.lit(90) + (n * 7 + k * 13) % 23 + F.when(n % 9 == 4, 40).otherwise(0)
        - F.when(k >= 40, (k - 40) * (n % 4)).otherwise(0)))
    braking = (F.when(n % 7 == 6, 10).when(n % 14 == 5, 80).when((n + k) % 5 < 3, 0)
               .otherwise((n * 31 + k * 17) % 100 - 50)).cast("double") / 200
    fwd_speed = (F.when((n % 8 == 2) & (k % 41 == 5), 200).when((n + k) % 17 < 3, 0)
                 .when((n + k) % 29 == 0, 255).otherwise(80 + (n * 3 + k * 7) % 31))
    fwd_dist = (F.when((n % 8 == 2) & (k % 41 == 5), 120).when((n + k) % 17 < 4, 0)
                .when(n % 6 == 1, F.when(k % 20 == 7, 75).otherwise(2 + (n + k) % 5))
                .when(n % 6 == 5, 70 + (n + k) % 5).otherwise(15 + (n * 5 + k * 3) % 40))
    return [
        speed.cast("double").alias("Speed"),
        braking.alias("BrakingForce"),
        (((n * 19 + k * 23) % 100 - 50).cast("double") / 100).alias("TurningForce"),
        (((n * 11 + k * 5) % 60 - 30).cast("double") / 10).alias("Curvature"),
        fwd_speed.cast("double").alias("SpeedForwardVehicle"),
        fwd_dist.cast("double").alias("DistanceForwardVehicle"),
        F.when((n * 3 + k) % 19 < 4, 1).otherwise(0).alias("Abs"),
        ((n + k * 3) % 100).cast("double").alias("BrakePercentage"),
    ]


def pre_post_events(spark: SparkSession, sf_dir: str, trips: DataFrame | None = None) -> DataFrame:
    """``PrePostEvent``: 84 samples per trip event, keyed only by company, vehicle and time.

    ``n`` is kept as the sample's source id (a tie-breaker for ordering), never as a join key.
    """
    te = trips if trips is not None else trip_events(spark, sf_dir)
    te = te.select("CompanyID", "VehicleID", "n", "Timestamp")
    # A scan task holds millions of events; spread them before the 84x expansion, at most about
    # EVENTS_PER_TASK a task, so that tasks do not grow with the table and every core has some.
    tasks = max(spark.sparkContext.defaultParallelism, -(-te.count() // EVENTS_PER_TASK))
    if te.rdd.getNumPartitions() < tasks:
        te = te.repartition(tasks)
    x = te.select("CompanyID", "VehicleID", "n", "Timestamp",
                  F.explode(F.sequence(F.lit(0), F.lit(83))).alias("k"))
    n, k = F.col("n"), F.col("k")
    return x.select(
        "CompanyID", "VehicleID", "n",
        (k % 4 + 1).alias("SequenceID"),
        F.expr("timestampadd(SECOND, cast(floor((k - 40) / 4) as int), Timestamp)").alias("Timestamp"),
        *_sample_values(n, k),
    )


def event_dim(spark: SparkSession, sf_dir: str, trips: DataFrame | None = None) -> DataFrame:
    """``Event`` dimension: one name per event type present in the data."""
    te = trips if trips is not None else trip_events(spark, sf_dir)
    return te.select("EventID").distinct().select(
        "EventID", F.concat(F.lit("E"), F.col("EventID").cast("string")).alias("EventName"))


def trip_event_extra(spark: SparkSession, sf_dir: str, trips: DataFrame | None = None) -> DataFrame:
    """``TripEventExtra``: prior scores for events with n % 10 in (0, 1)."""
    te = trips if trips is not None else trip_events(spark, sf_dir)
    n = F.col("n")
    return te.where((n % 10).isin(0, 1)).select(
        "CompanyID", "VehicleID", "TripEventID", "TripEventGuid", "CreatedDate",
        F.when(n % 10 == 0, F.lit(None).cast("double")).when(n % 20 == 1, F.lit(0.0))
        .otherwise((n % 100).cast("double") / 100).alias("ImportanceScore"))


def event_classification_type(spark: SparkSession, sf_dir: str, trips: DataFrame | None = None) -> DataFrame:
    """``EventClassificationType``: three labels per company, Type 1..3."""
    te = trips if trips is not None else trip_events(spark, sf_dir)
    kinds = F.array(*[F.struct(F.lit(i + 1).alias("Type"), F.lit(name).alias("Name"))
                      for i, name in enumerate((LABEL_LOW, LABEL_MID, LABEL_HIGH))])
    return (te.select("CompanyID").distinct()
            .select("CompanyID", F.explode(kinds).alias("t"))
            .select("CompanyID", "t.Type", "t.Name"))


def event_classification(spark: SparkSession, sf_dir: str, trips: DataFrame | None = None) -> DataFrame:
    """``EventClassification``: existing labels for three in four events (Type 1 + n % 3)."""
    te = trips if trips is not None else trip_events(spark, sf_dir)
    n = F.col("n")
    return te.where(n % 4 != 3).select(
        "CompanyID", "VehicleID", "DriverID", "TripEventID",
        (F.lit(1) + n % 3).cast("int").alias("Classification"),
        F.col("CreatedDate").alias("Timestamp"), F.lit(CLASSIFIED_BY).alias("By"))


def company_settings(spark: SparkSession, sf_dir: str, trips: DataFrame | None = None) -> DataFrame:
    """``CompanySettings``: the auto-classification switch; off for company 5."""
    te = trips if trips is not None else trip_events(spark, sf_dir)
    return te.select("CompanyID").distinct().select(
        "CompanyID", F.lit(ROSTER_SETTING).alias("Name"),
        F.when(F.col("CompanyID") == 5, F.lit('{"enabled": false}'))
        .otherwise(F.lit('{"enabled": true}')).alias("Data"))


def company(spark: SparkSession, sf_dir: str, trips: DataFrame | None = None) -> DataFrame:
    """``Company``: report shard 60 + CompanyID."""
    te = trips if trips is not None else trip_events(spark, sf_dir)
    return te.select("CompanyID").distinct().select(
        "CompanyID", (F.lit(60) + F.col("CompanyID")).cast("int").alias("ReportShardID"))


def shard_server(spark: SparkSession, sf_dir: str, trips: DataFrame | None = None) -> DataFrame:
    """Shard -> server mapping; shard 64 is deliberately unmapped."""
    return (company(spark, sf_dir, trips).where(F.col("CompanyID") != 4)
            .select(F.col("ReportShardID").alias("ShardID"),
                    F.when(F.col("ReportShardID") % 2 == 0, F.lit("server-b"))
                    .otherwise(F.lit("server-a")).alias("Server")))
