"""Registered queries: signal statistics, Haar features, batch z-score and ECS scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.operators.interval_join import EVENT_PART
from fleetlens.operators.scoring import batch_zscore
from fleetlens.operators.signal import ECS_FEATURES, STAT_COLS, event_signal_features
from fleetlens.plans import oracle as O
from fleetlens.plans.families import ecs_features, ecs_job
from fleetlens.plans.queries_core import ECS_CTES, imp_sql, lab_sql
from fleetlens.plans.queries_da import dedup_sql
from fleetlens.plans.registry import register
from fleetlens.sources.family import Telemetry, ecs_source

_X = {c: f"round_even({c} * 10000, 0)::BIGINT" for c in STAT_COLS}


def _spread(x: str) -> str:
    return f"cast(count({x}) * sum({x} * {x}) - sum({x}) * sum({x}) AS double)"


def _stat(c: str, s: str) -> str:
    x = _X[c]
    return {"mean": f"cast(sum({x}) AS double) / (cast(count({c}) AS double) * 10000.0e0)",
            "std": f"CASE WHEN count({c}) > 1 THEN sqrt({_spread(x)} / cast(count({c}) * (count({c}) - 1) AS double)) / 10000.0e0 END"}.get(s, f"{s}({c})")


_HAAR_UNITS = {"ca2": "20000.0e0", "cd2": "20000.0e0", "cd1": f"{2 ** 0.5 * 10000!r}::DOUBLE"}


def _haar(c: str, s: str) -> str:
    unit = _HAAR_UNITS[c]
    return {"mean": f"cast(sum({c}) AS double) / (cast(count({c}) AS double) * {unit})",
            "std": f"sqrt({_spread(c)}) / (cast(count({c}) AS double) * {unit})"}.get(s, f"cast({s}({c}) AS double) / {unit}")


_S = ("mean", "std", "max", "min")
_STATS_SQL = ", ".join(f"{O.q4(_stat(c, s))} AS {c}_{s}" for c in STAT_COLS for s in _S)
_HAAR_CTE = """h0 AS (SELECT *, row_number() OVER w - 1 AS rn,
    hx + coalesce(lead(hx, 1) OVER w, hx) AS ca1_all, hx - coalesce(lead(hx, 1) OVER w, hx) AS cd1_all
  FROM (SELECT *, round_even(ppeTurningForce * 10000, 0)::BIGINT AS hx FROM {src})
  WINDOW w AS (PARTITION BY CompanyID, TripEventID ORDER BY SecTimeSegment, ppe_n)),
h1 AS (SELECT *, CASE WHEN rn % 2 = 0 THEN cd1_all END AS cd1,
    CASE WHEN rn % 4 = 0 THEN ca1_all + coalesce(lead(ca1_all, 2) OVER w, ca1_all) END AS ca2,
    CASE WHEN rn % 4 = 0 THEN ca1_all - coalesce(lead(ca1_all, 2) OVER w, ca1_all) END AS cd2
  FROM h0 WINDOW w AS (PARTITION BY CompanyID, TripEventID ORDER BY SecTimeSegment, ppe_n))"""
_HAAR_SQL = ", ".join(f"{O.q4(_haar(c, s))} AS wavelet_coeff_{s}_{i}" for i, c in enumerate(("ca2", "cd2", "cd1")) for s in _S)


@register("signal_stats", O.with_ctes(*ECS_CTES) + f"SELECT CompanyID, TripEventID, {_STATS_SQL} FROM src GROUP BY ALL")
def q_signal_stats(spark, sf_dir):
    """Mean / sample std / max / min of speed, turning force, curvature and braking force per event."""
    feats = event_signal_features(ecs_source(Telemetry.derive(spark, sf_dir)), [*EVENT_PART])
    return feats.select("CompanyID", "TripEventID", *[f"{c}_{s}" for c in STAT_COLS for s in ("mean", "std", "max", "min")])


@register("haar_features", O.with_ctes(*ECS_CTES, _HAAR_CTE.format(src="src"))
          + f"SELECT CompanyID, TripEventID, {_HAAR_SQL} FROM h1 GROUP BY ALL")
def q_haar_features(spark, sf_dir):
    """Two-level Haar (db1) statistics of the turning force per event (0=cA2, 1=cD2, 2=cD1)."""
    feats = event_signal_features(ecs_source(Telemetry.derive(spark, sf_dir)), [*EVENT_PART])
    return feats.select("CompanyID", "TripEventID", *[c for c in ECS_FEATURES if c.startswith("wavelet")])


_RAW_STATS = ", ".join(f"{_stat(c, s)} AS {c}_{s}" for c in STAT_COLS for s in _S)
_RAW_HAAR = ", ".join(f"{_haar(c, s)} AS wavelet_coeff_{s}_{i}" for i, c in enumerate(("ca2", "cd2", "cd1")) for s in _S)
ECS_DEDUP = "ecs_kept_src AS (SELECT s.* FROM src s SEMI JOIN kept k USING (CompanyID, batch_start, VehicleID, TripEventID))"
ECS_FEATS = f"""feats AS (SELECT CompanyID, VehicleID, TripEventID, TripEventGuid, DriverID, CreatedDate, batch_start, n,
  {_RAW_STATS}, {_RAW_HAAR} FROM h1 GROUP BY ALL)"""


def _z(c: str) -> str:
    f = f"round_even({c} * 1e8, 0)::HUGEINT"
    n, total = f"(count({c}) OVER s)", f"(sum({f}) OVER s)"
    spread = f"cast({n} * (sum({f} * {f}) OVER s) - {total} * {total} AS double)"
    centred = f"cast({n} * {f} - {total} AS double)"
    return f"(CASE WHEN {spread} = 0 THEN {centred} / (cast({n} AS double) * 1e8) ELSE {centred} / sqrt({spread}) END) AS {c}"


_ECS_BASE = ("WITH RECURSIVE " + ",\n".join([*ECS_CTES, dedup_sql("src", "CompanyID, batch_start, VehicleID", "EventTimeStamp", 60),
                                            ECS_DEDUP, _HAAR_CTE.format(src="ecs_kept_src"), ECS_FEATS]))


@register("batch_zscore", _ECS_BASE + ",\nz AS (SELECT CompanyID, TripEventID, " + ", ".join(_z(c) for c in ECS_FEATURES)
          + " FROM feats WINDOW s AS (PARTITION BY CompanyID, batch_start))\nSELECT CompanyID, TripEventID, "
          + ", ".join(f"{O.q4(c)} AS {c}" for c in ECS_FEATURES) + " FROM z")
def q_batch_zscore(spark, sf_dir):
    """The 28 ECS model inputs standardised per (company, 30-min run) with population std."""
    feats = ecs_features(Telemetry.derive(spark, sf_dir))
    return batch_zscore(feats, ECS_FEATURES).select("CompanyID", "TripEventID", *ECS_FEATURES)


_ECS_SCORED = (",\necs_scored AS (SELECT *, CASE WHEN p >= 0.7 THEN 50 + (p * 100 - 70) * 45.0e0 / 30.0e0 "
               "ELSE 1 + (p * 100 - 1) * 39.0e0 / 70.0e0 END AS score FROM (SELECT *, cast((n * 37) % 101 AS double) / 100.0 AS p "
               "FROM feats WHERE DriverID IS NOT NULL))\n")
_DATE = "strftime(CreatedDate, '%Y-%m-%d')"


@register("ecs_scores", _ECS_BASE + _ECS_SCORED + imp_sql("ecs_scored", "score / 100", created=_DATE))
def q_ecs_scores(spark, sf_dir):
    """Curve-speed importance (dedup 60 s per vehicle and run, stand-in probability, curve / 100)."""
    return ecs_job(Telemetry.derive(spark, sf_dir))[0]


@register("ecs_labels", _ECS_BASE + _ECS_SCORED + lab_sql("ecs_scored", "score", created=_DATE))
def q_ecs_labels(spark, sf_dir):
    """Curve-speed classification rows (band of the 0..100 curve value)."""
    return ecs_job(Telemetry.derive(spark, sf_dir))[1]
