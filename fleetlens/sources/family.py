"""Per-family source frames (trip events x sensor samples), for all companies and batches at once.

The scored system reads one company and one 30-minute ``CreatedDate`` batch per job; here
``CompanyID`` and ``batch_start`` are columns, so one plan serves every company and batch and
"per run" computations key on ``(CompanyID, batch_start)``. ``in_batch`` restricts a frame to a
single live batch when a job should only see the latest window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetlens.functions.columns import batch_start
from fleetlens.operators.interval_join import interval_join
from fleetlens.schema import (CMB_EVENT_IDS, DA_EVENT_ID, ECS_EVENT_ID, ESPRSP_EVENT_IDS,
                              KMH_TO_MPH, OVERSPEED_EVENT_ID)
from fleetlens.sources import fixtures


@dataclass
class Telemetry:
    """The input tables of one dataset."""
    trips: DataFrame
    samples: DataFrame
    event_dim: DataFrame
    extra: DataFrame

    @classmethod
    def derive(cls, spark: SparkSession, sf_dir: str) -> "Telemetry":
        trips = fixtures.trip_events(spark, sf_dir)
        return cls(trips=trips,
                   samples=fixtures.pre_post_events(spark, sf_dir, trips),
                   event_dim=fixtures.event_dim(spark, sf_dir, trips),
                   extra=fixtures.trip_event_extra(spark, sf_dir, trips))


def in_batch(df: DataFrame, begin, end, col: str = "CreatedDate") -> DataFrame:
    """Half-open batch predicate ``begin <= col < end`` (pushed to the scan)."""
    return df.where((F.col(col) >= F.lit(begin)) & (F.col(col) < F.lit(end)))


def with_event_dim(trips: DataFrame, dim: DataFrame) -> DataFrame:
    """Inner join with the event-type dimension (events of unknown type drop out).

    The dimension is the catalogue of event types; Spark broadcasts it where its size allows.
    """
    return trips.join(dim, "EventID", "inner")


def unscored(trips: DataFrame, extra: DataFrame, zero_is_unscored: bool = False) -> DataFrame:
    """Events without a prior importance score (null; or 0 as well when ``zero_is_unscored``).

    Written as an anti join against the scored keys, which equals the left join + null filter
    because the score table holds one row per key (it is maintained by upsert).
    """
    scored = extra.where(F.col("ImportanceScore").isNotNull())
    if zero_is_unscored:
        scored = scored.where(F.col("ImportanceScore") != 0)
    return trips.join(scored.select("CompanyID", "VehicleID", "TripEventID"),
                      ["CompanyID", "VehicleID", "TripEventID"], "left_anti")


def _event_cols(te: DataFrame, *extra_cols) -> DataFrame:
    return te.select(
        "CompanyID", "VehicleID", "TripID", "CreatedDate", "TripEventID", "TripEventGuid", "DriverID",
        "EventID", "SevereEvent", F.col("Timestamp").alias("EventTimeStamp"), "n",
        batch_start("CreatedDate").alias("batch_start"), *extra_cols)


def _sample_cols(samples: DataFrame, *cols) -> DataFrame:
    return samples.select("CompanyID", "VehicleID", F.col("Timestamp").alias("ppeTimeStamp"),
                          "SequenceID", F.col("n").alias("ppe_n"), *cols)


#: Family -> (event types, seconds before and after the event, whether the ends belong to the range).
RANGES = {"overspeed": ((OVERSPEED_EVENT_ID,), 9, 11, False), "da": ((DA_EVENT_ID,), -10, 10, False),
          "ecs": ((ECS_EVENT_ID,), -10, 10, False), "cmb": (CMB_EVENT_IDS, -11, 11, False), "esprsp": (ESPRSP_EVENT_IDS, -10, 10, True)}


def _family_events(t: Telemetry, family: str) -> DataFrame:
    """The events of a family before the join, with their raw speeds."""
    te = t.trips.where(F.col("EventID").isin(*RANGES[family][0]))
    if family in ("overspeed", "da", "ecs"):
        te = with_event_dim(te, t.event_dim)
    else:
        te = te.withColumn("EventName", F.lit(None).cast("string"))
    if family in ("da", "ecs"):
        te = unscored(te, t.extra, zero_is_unscored=family == "ecs")
    return _event_cols(te, "EventName", F.col("Speed").alias("teSpeed"), "SpeedLimit")


def _series(t: Telemetry, family: str, values: tuple[str, ...]) -> DataFrame:
    """Events of a family with the samples in its range; sample values are named ``ppe<value>``."""
    _, lo, hi, inclusive = RANGES[family]
    sm = _sample_cols(t.samples, *[F.col(v).alias(f"ppe{v}") for v in values])
    return interval_join(_family_events(t, family), sm, lo, hi, inclusive)


def overspeed_source(t: Telemetry) -> DataFrame:
    """Overspeed events with the samples strictly between +9 s and +11 s (speeds in mph)."""
    return _series(t, "overspeed", ("Speed",)).withColumns({
        "tespeedmph": F.col("teSpeed") * F.lit(KMH_TO_MPH), "speedlimitmph": F.round(F.col("SpeedLimit") * F.lit(KMH_TO_MPH), 0),
        "ppespeedmph": F.round(F.col("ppeSpeed") * F.lit(KMH_TO_MPH), 2)}).drop("teSpeed", "SpeedLimit", "ppeSpeed")


def nonsevere_source(t: Telemetry) -> DataFrame:
    """Non-severe overspeed events, no series (fallback scoring path)."""
    te = t.trips.where((F.col("EventID") == OVERSPEED_EVENT_ID) & ~F.col("SevereEvent"))
    return _event_cols(te, (F.col("Speed") * F.lit(KMH_TO_MPH)).alias("tespeedmph"),
                       F.round(F.col("SpeedLimit") * F.lit(KMH_TO_MPH), 0).alias("speedlimitmph"))


def da_source(t: Telemetry) -> DataFrame:
    """Unscored distance alerts with samples strictly within (-10 s, +10 s)."""
    return (_series(t, "da", ("Speed", "SpeedForwardVehicle", "DistanceForwardVehicle"))
            .withColumnsRenamed({"ppeSpeedForwardVehicle": "ppeSpeedforwardV", "ppeDistanceForwardVehicle": "ppeDistanceforwardV"}))


def ecs_source(t: Telemetry) -> DataFrame:
    """Curve-speed events unscored (null or 0) with samples strictly within (-10 s, +10 s)."""
    return _series(t, "ecs", ("Speed", "TurningForce", "Curvature", "BrakingForce"))


_BRAKE_VALUES = ("Speed", "BrakingForce", "TurningForce", "Curvature", "BrakePercentage")


def _brake_samples(t: Telemetry, with_abs: bool) -> DataFrame:
    return _sample_cols(t.samples, *[F.col(v).alias(f"ppe{v}") for v in _BRAKE_VALUES + ("Abs", "DistanceForwardVehicle") * with_abs])


def cmb_source(t: Telemetry) -> DataFrame:
    """Collision-mitigation / forward-collision / excessive-brake events, samples within (-11 s, +11 s)."""
    return _series(t, "cmb", _BRAKE_VALUES).withColumn("isSevere", F.lit(0)).drop("EventName", "SpeedLimit")


def esprsp_source(t: Telemetry) -> DataFrame:
    """ESP / RSP brake events with samples in the closed interval [-10 s, +10 s]."""
    return (_series(t, "esprsp", (*_BRAKE_VALUES, "Abs", "DistanceForwardVehicle"))
            .withColumn("isSevere", F.lit(0)).drop("EventName", "SpeedLimit"))
