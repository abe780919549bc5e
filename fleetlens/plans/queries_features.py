"""Registered queries: brake / collision features (single operators and full vectors) and curves."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.operators.features import FEATURES, event_features, event_values, with_deltas
from fleetlens.plans import oracle as O
from fleetlens.plans.families import cmb_job, esprsp_job
from fleetlens.plans.queries_core import CMB_SRC, ESP_SRC, imp_sql, lab_sql
from fleetlens.plans.registry import register
from fleetlens.sources.family import Telemetry, cmb_source, esprsp_source

_BASE = (O.TRIP_EVENT, O.PRE_POST_EVENT)
_KEYS = "CompanyID, VehicleID, DriverID, TripEventID, TripEventGuid, CreatedDate"
_W = "PARTITION BY CompanyID, TripEventID ORDER BY SecTimeSegment, ppe_n"


def _f0(with_abs: bool) -> str:
    rise = (",\n  CASE WHEN ppeAbs = 1 AND NOT coalesce(lag(ppeAbs) OVER w = 1, FALSE) THEN 1 ELSE 0 END AS abs_rise"
            if with_abs else "")
    return f"""f0 AS (SELECT *, abs(ppeTurningForce) AS AbsValTurningForce, abs(ppeBrakingForce) AS AbsValBrakingForce,
  lag(ppeTurningForce) OVER w AS PrevTF, lag(ppeTurningForce, 2) OVER w AS PrevPrevTF,
  abs(ppeSpeed - 0.5 * (lag(ppeSpeed) OVER w + lead(ppeSpeed) OVER w)) AS CenterDifferenceDeviation,
  abs(ppeTurningForce - lag(ppeTurningForce) OVER w) AS AbsVal_TF_Moving_Delta,
  abs(ppeBrakingForce - lag(ppeBrakingForce) OVER w) AS AbsDiffBrakingForce,
  abs(ppeSpeed - lag(ppeSpeed) OVER w) AS SpeedChange,
  abs(lag(ppeTurningForce) OVER w - 0.5 * (ppeTurningForce + lag(ppeTurningForce, 2) OVER w)) AS TFCenterDeviation,
  abs(lag(ppeBrakingForce) OVER w - 0.5 * (ppeBrakingForce + lag(ppeBrakingForce, 2) OVER w)) AS BFCenterDeviation{rise}
  FROM src WHERE TripID IS NOT NULL AND CompanyID IS NOT NULL AND VehicleID IS NOT NULL AND DriverID IS NOT NULL
    AND TripEventID IS NOT NULL AND TripEventGuid IS NOT NULL AND CreatedDate IS NOT NULL
  WINDOW w AS ({_W}))"""


_ORD = "(SecTimeSegment, ppe_n)"


def _phase(cond: str) -> str:
    f = f"FILTER (WHERE {cond} AND ppeSpeed IS NOT NULL)"
    return f"(arg_min(ppeSpeed, {_ORD}) {f} - arg_max(ppeSpeed, {_ORD}) {f})"


def _ev(with_abs: bool) -> str:
    absc = ", sum(abs_rise) AS abscount" if with_abs else ""
    return f"""ev0 AS (SELECT CompanyID, TripEventID,
  {_phase('SecTimeSegment < 0')} AS DeltaSpeedBeforeZero, {_phase('SecTimeSegment >= 0')} AS DeltaSpeedAfterZero,
  arg_max_null(ppeSpeed, {_ORD}) / nullif(arg_min_null(ppeSpeed, {_ORD}), 0) AS EndSpeedOverStartSpeed,
  abs(arg_max_null(ppeSpeed, {_ORD}) - arg_min_null(ppeSpeed, {_ORD})) AS SpeedChangeEnds,
  least(min(SecTimeSegment) FILTER (WHERE AbsValBrakingForce > 0.1),
        CASE WHEN count(*) FILTER (WHERE AbsValBrakingForce <= 0.1) > 0 THEN 10.0e0 END) AS Min_First_SecTimeSegment,
  greatest(max(SecTimeSegment) FILTER (WHERE AbsValBrakingForce > 0.1),
        CASE WHEN count(*) FILTER (WHERE AbsValBrakingForce <= 0.1) > 0 THEN -10.0e0 END) AS Max_Last_SecTimeSegment,
  count(AbsValBrakingForce) AS AfterZeroBrakeOnCount, count(*) FILTER (WHERE AbsValBrakingForce > 0.1) AS BrakeOnCount,
  max(AbsValTurningForce) AS Max_AbsValTurningForce, max(AbsValBrakingForce) AS Max_AbsValBrakingForce,
  arg_max(ppeSpeed, {_ORD}) FILTER (WHERE ppeSpeed IS NOT NULL) AS Last_PPESpeed,
  coalesce(sum(CenterDifferenceDeviation), 0.0e0) AS Sum_CenterDifferenceDeviation,
  max(CenterDifferenceDeviation) AS Max_CenterDifferenceDeviation,
  coalesce(sum(TFCenterDeviation), 0.0e0) AS Sum_TFCenterDeviation, max(TFCenterDeviation) AS Max_TFCenterDeviation,
  coalesce(sum(BFCenterDeviation), 0.0e0) AS Sum_BFCenterDeviation, max(BFCenterDeviation) AS Max_BFCenterDeviation,
  count(*) FILTER (WHERE SecTimeSegment >= 0 AND SpeedChange > 0) AS SIC{absc}
  FROM f0 GROUP BY ALL),
ev AS (SELECT *, DeltaSpeedBeforeZero / (0.001 + DeltaSpeedAfterZero) AS DeltaSpeedRatio FROM ev0)"""


def _feat(with_abs: bool) -> str:
    extra_row = ", ppeAbs, ppeDistanceForwardVehicle" if with_abs else ""
    absl = ", cast(coalesce(any_value(e.abscount), 0) AS double) AS abscountlast" if with_abs else ""
    return f"""r AS (SELECT DISTINCT {_KEYS}, batch_start, n, EventID, isSevere, ppeTimeStamp, TimeSegment, SecTimeSegment,
    ppeSpeed, ppeBrakingForce, ppeTurningForce, ppeCurvature, ppeBrakePercentage, PrevTF, PrevPrevTF,
    CenterDifferenceDeviation, AbsVal_TF_Moving_Delta, AbsDiffBrakingForce, SpeedChange{extra_row}
  FROM f0 WHERE SecTimeSegment >= 0 AND SpeedChange > 0),
feat AS (SELECT r.CompanyID, r.VehicleID, r.DriverID, r.TripEventID, r.TripEventGuid, r.CreatedDate, r.batch_start, r.n, r.EventID,
  avg(AbsVal_TF_Moving_Delta) AS AbsVal_TF_Moving_Deltamean, coalesce(sum(AbsVal_TF_Moving_Delta), 0.0e0) AS AbsVal_TF_Moving_Deltasum,
  stddev_samp(AbsVal_TF_Moving_Delta) AS AbsVal_TF_Moving_Deltastd, min(ppeSpeed) AS ppeSpeedmin,
  avg(AbsDiffBrakingForce) AS AbsDiffBrakingForcemean, coalesce(sum(AbsDiffBrakingForce), 0.0e0) AS AbsDiffBrakingForcesum,
  stddev_samp(AbsDiffBrakingForce) AS AbsDiffBrakingForcestd, max(AbsDiffBrakingForce) AS AbsDiffBrakingForcemax,
  max(SpeedChange) AS SpeedChangemax, any_value(e.DeltaSpeedBeforeZero) AS DeltaSpeedBeforeZeromax,
  any_value(e.DeltaSpeedAfterZero) AS DeltaSpeedAfterZeromax, any_value(e.DeltaSpeedRatio) AS DeltaSpeedRatiomax,
  any_value(e.Max_Last_SecTimeSegment) AS Max_Last_SecTimeSegmentmax, any_value(e.AfterZeroBrakeOnCount) AS AfterZeroBrakeOnCountfirst,
  any_value(e.Sum_CenterDifferenceDeviation) AS Sum_CenterDifferenceDeviationmax,
  any_value(e.Max_CenterDifferenceDeviation) AS Max_CenterDifferenceDeviationmax,
  any_value(e.Max_CenterDifferenceDeviation) AS Max_CenterDifferenceDeviationfirst,
  any_value(e.Sum_TFCenterDeviation) AS Sum_TFCenterDeviationmax, any_value(e.EndSpeedOverStartSpeed) AS EndSpeedOverStartSpeedmin,
  any_value(e.SIC) AS SICmax, any_value(e.Max_AbsValTurningForce) AS Max_AbsValTurningForcefirst,
  any_value(e.Max_AbsValBrakingForce) AS Max_AbsValBrakingForcefirst, any_value(e.Max_TFCenterDeviation) AS Max_TFCenterDeviationmax,
  any_value(e.Sum_BFCenterDeviation) AS Sum_BFCenterDeviationmax, any_value(e.Max_BFCenterDeviation) AS Max_BFCenterDeviationmax,
  r.TripEventID AS TripEventIDlast, any_value(r.isSevere) AS isSeverefirst{absl}
  FROM r JOIN ev e ON r.CompanyID = e.CompanyID AND r.TripEventID = e.TripEventID
  GROUP BY r.CompanyID, r.VehicleID, r.DriverID, r.TripEventID, r.TripEventGuid, r.CreatedDate, r.batch_start, r.n, r.EventID)"""


CMB_FEAT_CTES = (*_BASE, CMB_SRC, _f0(False), _ev(False), _feat(False))
ESP_FEAT_CTES = (*_BASE, ESP_SRC, _f0(True), _ev(True), _feat(True))
_FEAT_OUT = f"{_KEYS}, " + ", ".join(f"{O.q4(c)} AS {c}" if c not in ("AfterZeroBrakeOnCountfirst", "SICmax") else c
                                     for c in FEATURES) + ", TripEventIDlast, isSeverefirst"


@register("cmb_features", O.with_ctes(*CMB_FEAT_CTES) + f"SELECT {_FEAT_OUT} FROM feat")
def q_cmb_features(spark, sf_dir):
    """CMB / FCW / EB per-event feature vector (25 features)."""
    f = event_features(cmb_source(Telemetry.derive(spark, sf_dir)))
    return f.select(*_KEYS.split(", "), *FEATURES, "TripEventIDlast", "isSeverefirst")


@register("esprsp_features", O.with_ctes(*ESP_FEAT_CTES) + f"SELECT {_FEAT_OUT}, {O.q4('abscountlast')} AS abscountlast FROM feat")
def q_esprsp_features(spark, sf_dir):
    """ESP / RSP per-event feature vector (25 features + ABS run count)."""
    f = event_features(esprsp_source(Telemetry.derive(spark, sf_dir)))
    return f.select(*_KEYS.split(", "), *FEATURES, "TripEventIDlast", "isSeverefirst", "abscountlast")


# ---- single operators over the CMB source (per row or per event)
_ROW = "CompanyID, TripEventID, ppe_n, SecTimeSegment"
_LAG_OUT = "PrevTF, PrevPrevTF, AbsVal_TF_Moving_Delta, AbsDiffBrakingForce, SpeedChange"


@register("lag_deltas", O.with_ctes(*_BASE, CMB_SRC, _f0(False)) + f"SELECT {_ROW}, "
          + ", ".join(f"{O.q4(c)} AS {c}" for c in _LAG_OUT.split(", ")) + " FROM f0")
def q_lag_deltas(spark, sf_dir):
    """Guarded lag-1 / lag-2 values and absolute deltas per sample (same event only)."""
    return with_deltas(cmb_source(Telemetry.derive(spark, sf_dir))).select(*_ROW.split(", "), *_LAG_OUT.split(", "))


def _event_key(name: str, cols: list[str], doc: str, esp: bool = False) -> None:
    ctes = ESP_FEAT_CTES[:-1] if esp else CMB_FEAT_CTES[:-1]
    sel = ", ".join(c if c in ("AfterZeroBrakeOnCount", "BrakeOnCount", "SIC", "abscount") else f"{O.q4(c)} AS {c}"
                    for c in cols)
    sql = O.with_ctes(*ctes) + f"SELECT CompanyID, TripEventID, {sel} FROM ev"

    def run(spark, sf_dir):
        t = Telemetry.derive(spark, sf_dir)
        src = esprsp_source(t) if esp else cmb_source(t)
        return event_values(src).select("CompanyID", "TripEventID", *cols)
    run.__doc__ = doc
    register(name, sql)(run)


_event_key("center_deviation", ["Sum_CenterDifferenceDeviation", "Max_CenterDifferenceDeviation"],
           "Sum / max of |speed - mean(prev, next)| per event.")
_event_key("turn_irregularity", ["Sum_TFCenterDeviation", "Max_TFCenterDeviation"],
           "Sum / max of the trailing centred turning-force deviation per event.")
_event_key("brake_irregularity", ["Sum_BFCenterDeviation", "Max_BFCenterDeviation"],
           "Sum / max of the trailing centred braking-force deviation per event.")
_event_key("speed_ratio", ["DeltaSpeedBeforeZero", "DeltaSpeedAfterZero", "DeltaSpeedRatio"],
           "First-minus-last non-null speed before and after 0 s, and their ratio.")
_event_key("speed_change", ["SpeedChangeEnds", "EndSpeedOverStartSpeed"],
           "Positional end-to-end speed change and end/start ratio (null when start is 0).")
_event_key("speed_change_count", ["SIC"], "Samples at or after 0 s whose speed changed (per event).")
_event_key("brake_interval", ["Min_First_SecTimeSegment", "Max_Last_SecTimeSegment"],
           "First / last braking second (|BF| > 0.1), widened to 10 / -10 when any sample is off the brake.")
_event_key("brake_count", ["AfterZeroBrakeOnCount", "BrakeOnCount"],
           "Non-null braking samples (the feature as defined) and the true brake-on count.")
_event_key("event_extrema", ["Max_AbsValTurningForce", "Max_AbsValBrakingForce", "Last_PPESpeed"],
           "Per-event max |TF|, max |BF| and last non-null speed.")
_event_key("abs_run_count", ["abscount"], "Runs of consecutive ABS-active samples per ESP/RSP event.", esp=True)


# ---- curves (stand-in probability; a fitted model plugs into cmb_job / esprsp_job)
_HEX = "cast(('0x' || split_part(TripEventID, '_', 1)[-8:])::bigint AS bigint)"
_P = "cast((n * 37) % 101 AS double) / 100.0"
CMB_CURVE = f"""cmbs AS (SELECT *, CASE WHEN p < 0.6 THEN 1 + (p * 100 - 0) * 39.0e0 / 60.0e0
    WHEN code = 32 THEN 50 + (p * 100 - 60) * 45.0e0 / 40.0e0 ELSE 70 + (p * 100 - 60) * 25.0e0 / 40.0e0 END AS score
  FROM (SELECT *, {_P} AS p, {_HEX} AS code FROM feat WHERE AbsDiffBrakingForcestd IS NOT NULL))"""
ESP_CURVE = f"""esps AS (SELECT *, CASE WHEN code = 32768 THEN 70 + (p * 100 - 0) * 25.0e0 / 100.0e0
    WHEN code = 131072 AND p >= 0.6 THEN 50 + (p * 100 - 60) * 45.0e0 / 40.0e0
    WHEN code = 131072 AND p < 0.6 THEN 0 + (p * 100 - 0) * 50.0e0 / 60.0e0 END AS score
  FROM (SELECT *, {_P} AS p, {_HEX} AS code FROM feat WHERE DeltaSpeedBeforeZeromax IS NOT NULL))"""


@register("cmb_curve", O.with_ctes(*CMB_FEAT_CTES, CMB_CURVE) + imp_sql("cmbs", "score / 100"))
def q_cmb_curve(spark, sf_dir):
    """CMB importance: collision curve over the (stand-in) probability, by event code, / 100."""
    return cmb_job(Telemetry.derive(spark, sf_dir))[0]


@register("cmb_labels", O.with_ctes(*CMB_FEAT_CTES, CMB_CURVE) + lab_sql("cmbs", "score", "score > 0"))
def q_cmb_labels(spark, sf_dir):
    """CMB classification rows for positive curve scores."""
    return cmb_job(Telemetry.derive(spark, sf_dir))[1]


@register("esprsp_curve", O.with_ctes(*ESP_FEAT_CTES, ESP_CURVE) + imp_sql("esps", "score / 100"))
def q_esprsp_curve(spark, sf_dir):
    """ESP / RSP importance: stability-brake curve by event code, / 100."""
    return esprsp_job(Telemetry.derive(spark, sf_dir))[0]


@register("esprsp_labels", O.with_ctes(*ESP_FEAT_CTES, ESP_CURVE) + lab_sql("esps", "score", "score > 0"))
def q_esprsp_labels(spark, sf_dir):
    """ESP / RSP classification rows for positive curve scores."""
    return esprsp_job(Telemetry.derive(spark, sf_dir))[1]
