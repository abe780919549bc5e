"""Registered queries: min-gap dedup and the distance-alert family."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.operators.dedup import kept_events
from fleetlens.operators.distance import da_normalize, drop_joint_outliers, remove_noise
from fleetlens.plans import oracle as O
from fleetlens.plans.families import da_job
from fleetlens.plans.queries_core import DA_CTES, imp_sql, lab_sql
from fleetlens.plans.registry import register
from fleetlens.sources import fixtures
from fleetlens.sources.family import Telemetry, da_source

GAP_6H = 6 * 3600


def dedup_sql(src: str, keys: str, ts: str, gap_s: int, name: str = "kept") -> str:
    """Recursive-CTE greedy fold (one step per event, per key group)."""
    on = " AND ".join(f"o.{k.strip()} = r.{k.strip()}" for k in keys.split(","))
    okeys = ", ".join(f"o.{k.strip()}" for k in keys.split(","))
    return f"""dd AS (SELECT DISTINCT {keys}, TripEventID, epoch_us({ts}) AS us FROM {src}),
ddo AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY us, TripEventID) AS rn FROM dd),
rec AS (
  SELECT {keys}, rn, us AS last_us, TripEventID, TRUE AS kept FROM ddo WHERE rn = 1
  UNION ALL
  SELECT {okeys}, o.rn, CASE WHEN o.us - r.last_us > {gap_s * 1_000_000} THEN o.us ELSE r.last_us END,
    o.TripEventID, o.us - r.last_us > {gap_s * 1_000_000}
  FROM rec r JOIN ddo o ON {on} AND o.rn = r.rn + 1),
{name} AS (SELECT {keys}, TripEventID FROM rec WHERE kept)"""


@register("min_gap_dedup", "WITH RECURSIVE " + ",\n".join([O.TRIP_EVENT, dedup_sql("trip_event", "CompanyID, VehicleID", "Timestamp", GAP_6H)])
          + "\nSELECT * FROM kept")
def q_min_gap_dedup(spark, sf_dir):
    """Events kept by the greedy 'more than 6 h after the last kept event' rule, per vehicle."""
    te = fixtures.trip_events(spark, sf_dir)
    return kept_events(te, ["CompanyID", "VehicleID"], "Timestamp", gap_s=GAP_6H)


_W = "PARTITION BY CompanyID, TripEventID ORDER BY SecTimeSegment, ppe_n"
NOISE = f"""noise AS (SELECT *, CASE WHEN coalesce((ppeSpeedforwardV = 0 OR ppeSpeedforwardV > 230)
    AND ppeDistanceforwardV = 0 AND ppeSpeed > 0, FALSE) THEN 1 ELSE 0 END AS z FROM src),
blk AS (SELECT *, CASE WHEN sum(z) OVER ({_W} ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) = 2 THEN 1 ELSE 0 END AS blk FROM noise),
rmv AS (SELECT *, max(blk) OVER ({_W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rmv FROM blk),
clean1 AS (SELECT * EXCLUDE (z, blk, rmv) FROM rmv WHERE rmv = 0)"""
IQR = """iqr AS (SELECT *, quantile_cont(ppeSpeedforwardV, 0.25) OVER e AS s1, quantile_cont(ppeSpeedforwardV, 0.75) OVER e AS s3,
    quantile_cont(ppeDistanceforwardV, 0.25) OVER e AS d1, quantile_cont(ppeDistanceforwardV, 0.75) OVER e AS d3
  FROM clean1 WINDOW e AS (PARTITION BY CompanyID, TripEventID)),
clean2 AS (SELECT * EXCLUDE (s1, s3, d1, d3) FROM iqr WHERE NOT coalesce(
  (ppeSpeedforwardV < s1 - 1.5 * (s3 - s1) OR ppeSpeedforwardV > s3 + 1.5 * (s3 - s1))
  AND (ppeDistanceforwardV < d1 - 1.5 * (d3 - d1) OR ppeDistanceforwardV > d3 + 1.5 * (d3 - d1)), FALSE))"""


def _mm(c: str) -> str:
    return f"({c} - min({c}) OVER e) / nullif(max({c}) OVER e - min({c}) OVER e, 0)"


NORM = f"""norm AS (SELECT *, 1 - normalized_distance AS inverted_normalized_distance FROM (
  SELECT *, {_mm('ppeDistanceforwardV')} AS normalized_distance, {_mm('ppeSpeed')} AS normalized_speed_current,
    {_mm('ppeSpeedforwardV')} AS normalized_speed_forward FROM clean2 WINDOW e AS (PARTITION BY CompanyID, TripEventID)))"""
DA_SCORED = """dascored AS (SELECT * FROM (SELECT CompanyID, VehicleID, TripEventID, TripEventGuid, DriverID, CreatedDate,
    avg(inverted_normalized_distance) * 0.7 + avg(normalized_speed_current) * 0.2 + avg(normalized_speed_forward) * 0.1 AS score
  FROM norm GROUP BY ALL) WHERE score IS NOT NULL)"""
_ROWS = "CompanyID, TripEventID, ppe_n, SequenceID, SecTimeSegment"
_DA_ALL = (*DA_CTES, NOISE, IQR, NORM, DA_SCORED)
_DATE = "strftime(CreatedDate, '%Y-%m-%d')"


@register("remove_noise", O.with_ctes(*DA_CTES, NOISE) + f"SELECT {_ROWS} FROM clean1")
def q_remove_noise(spark, sf_dir):
    """Distance-alert samples left after dropping forward-sensor noise runs."""
    return remove_noise(da_source(Telemetry.derive(spark, sf_dir))).select(*_ROWS.split(", "))


@register("iqr_outliers", O.with_ctes(*DA_CTES, NOISE, IQR) + f"SELECT {_ROWS} FROM clean2")
def q_iqr_outliers(spark, sf_dir):
    """Samples left after also dropping rows that are IQR outliers in both forward signals."""
    return drop_joint_outliers(remove_noise(da_source(Telemetry.derive(spark, sf_dir)))).select(*_ROWS.split(", "))


_NORM_OUT = "inverted_normalized_distance, normalized_speed_current, normalized_speed_forward"


@register("minmax_normalize", O.with_ctes(*DA_CTES, NOISE, IQR, NORM) + f"SELECT {_ROWS}, "
          + ", ".join(f"{O.q4(c)} AS {c}" for c in _NORM_OUT.split(", ")) + " FROM norm")
def q_minmax_normalize(spark, sf_dir):
    """Per-event min-max scaled distance (inverted), own speed and forward speed."""
    src = da_source(Telemetry.derive(spark, sf_dir))
    return da_normalize(drop_joint_outliers(remove_noise(src))).select(*_ROWS.split(", "), *_NORM_OUT.split(", "))


@register("da_scores", O.with_ctes(*_DA_ALL) + imp_sql("dascored", created=_DATE))
def q_da_scores(spark, sf_dir):
    """Distance-alert importance rows (0.7/0.2/0.1 weighted normalised means)."""
    return da_job(Telemetry.derive(spark, sf_dir))[0]


@register("da_labels", O.with_ctes(*_DA_ALL) + lab_sql("dascored", "score * 100", created=_DATE))
def q_da_labels(spark, sf_dir):
    """Distance-alert classification rows (band of score x 100, gaps give null)."""
    return da_job(Telemetry.derive(spark, sf_dir))[1]


@register("stream_dedup", "WITH RECURSIVE " + ",\n".join([O.TRIP_EVENT, dedup_sql("trip_event", "CompanyID, VehicleID", "Timestamp", GAP_6H)])
          + "\nSELECT * FROM kept")
def q_stream_dedup(spark, sf_dir):
    """Min-gap dedup (6 h) as a Structured Streaming query: events arrive up to ten minutes out of
    order, wait in keyed state and are folded when the watermark has passed; equals the batch result."""
    import uuid

    from fleetlens.session import checkpoint_dir
    from fleetlens.streaming.dedup import run_dedup_stream, stage_arrivals

    te = fixtures.trip_events(spark, sf_dir).select("CompanyID", "VehicleID", "TripEventID", "Timestamp", "n")
    run = f"{checkpoint_dir(spark).rstrip('/')}/dedup-stream-{uuid.uuid4().hex}"
    arrival = F.expr("Timestamp + make_interval(0, 0, 0, 0, 0, cast((n * 7919) % 11 AS int), 0)")
    stage_arrivals(te, f"{run}/trips", arrival, 7 * 86_400, 660)
    kept, _ = run_dedup_stream(spark, f"{run}/trips", run, GAP_6H, 7 * 86_400, 660)
    return kept.select("CompanyID", "VehicleID", "TripEventID")
