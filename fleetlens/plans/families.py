"""End-to-end family jobs: source -> clean / features -> score -> (importance, labels).

Each returns two DataFrames for all companies and batches; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetlens.functions.columns import curve_cmb, curve_ecs, curve_esprsp, event_code
from fleetlens.operators.dedup import min_gap_dedup
from fleetlens.operators.distance import da_clean, da_normalize, distance_score
from fleetlens.operators.interval_join import EVENT_PART
from fleetlens.operators.outputs import to_outputs
from fleetlens.operators.overspeed import nonsevere_outputs, overspeed_clean, overspeed_outputs
from fleetlens.operators.scoring import pseudo_probability
from fleetlens.operators.signal import event_signal_features
from fleetlens.schema import DEDUP_GAP_SECONDS
from fleetlens.sources.family import (Telemetry, cmb_source, da_source, ecs_source, esprsp_source,
                                      nonsevere_source, overspeed_source)

RUN_VEHICLE = ["CompanyID", "batch_start", "VehicleID"]


def as_date(c: str = "CreatedDate") -> Column:
    return F.date_format(F.col(c), "yyyy-MM-dd")


def overspeed_job(t: Telemetry) -> tuple[DataFrame, DataFrame]:
    return overspeed_outputs(overspeed_clean(overspeed_source(t)))


def nonsevere_job(t: Telemetry) -> tuple[DataFrame, DataFrame]:
    return nonsevere_outputs(nonsevere_source(t))


def da_scored(t: Telemetry) -> DataFrame:
    return distance_score(da_normalize(da_clean(da_source(t))))


def da_job(t: Telemetry) -> tuple[DataFrame, DataFrame]:
    return to_outputs(da_scored(t), F.col("score"), F.col("score") * 100, positive_only=False,
                      created=as_date())


ECS_KEYS = [*EVENT_PART, "TripEventGuid", "DriverID", "CreatedDate", "batch_start", "n"]


def ecs_dedup(src: DataFrame) -> DataFrame:
    return min_gap_dedup(src, RUN_VEHICLE, "EventTimeStamp", gap_s=DEDUP_GAP_SECONDS, bounded_scope=True)


def ecs_events(t: Telemetry, dedup: bool = True) -> DataFrame:
    return ecs_dedup(ecs_source(t)) if dedup else ecs_source(t)


def ecs_features(t: Telemetry, dedup: bool = True) -> DataFrame:
    return event_signal_features(ecs_events(t, dedup), ECS_KEYS)


def ecs_scored(feats: DataFrame, probability=None) -> DataFrame:
    """Probability and curve score of every feature row whose six keys are all present."""
    scored = (probability(feats) if probability is not None
              else feats.withColumn("probability", pseudo_probability()))
    keys = ["CompanyID", "VehicleID", "DriverID", "TripEventID", "TripEventGuid", "CreatedDate"]
    return scored.dropna(subset=keys).withColumn("score", curve_ecs("probability"))


def ecs_job(t: Telemetry, probability=None) -> tuple[DataFrame, DataFrame]:
    """ECS scoring; ``probability`` maps the feature frame to one with a ``probability`` column
    (a fitted model, see ``fleetlens.ml.models.score_with``); default: the deterministic stand-in."""
    scored = ecs_scored(ecs_features(t), probability)
    return to_outputs(scored, F.col("score") / 100, F.col("score"), positive_only=False, created=as_date())


def _ml_job(features: DataFrame, dropped, required: str, curve, probability=None) -> tuple[DataFrame, DataFrame]:
    """Shared tail of the CMB and ESP-RSP jobs: drop list, null filter, probability, curve, outputs."""
    df = features.drop(*dropped).where(F.col(required).isNotNull())
    scored = (probability(df) if probability is not None
              else df.withColumn("probability", pseudo_probability()))
    scored = scored.withColumn("score", curve(F.col("probability"), event_code("TripEventID")))
    return to_outputs(scored, F.col("score") / 100, F.col("score"), positive_only=True)


def cmb_job(t: Telemetry, probability=None) -> tuple[DataFrame, DataFrame]:
    from fleetlens.operators.features import CMB_DROPPED, event_features
    return _ml_job(event_features(cmb_source(t)), CMB_DROPPED, "AbsDiffBrakingForcestd", curve_cmb, probability)


def esprsp_job(t: Telemetry, probability=None) -> tuple[DataFrame, DataFrame]:
    from fleetlens.operators.features import ESP_DROPPED, event_features
    return _ml_job(event_features(esprsp_source(t)), ESP_DROPPED, "DeltaSpeedBeforeZeromax", curve_esprsp, probability)
