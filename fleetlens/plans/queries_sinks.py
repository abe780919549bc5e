"""Registered queries: upserts, preview, run counters, weekly report, repeat-event scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.operators.repeat import driver_events, repeat_candidates, repeat_carry, repeat_counts, repeat_labels
from fleetlens.operators.report import weekly_report
from fleetlens.operators.routing import company_roster
from fleetlens.operators.sinks import one_per_key, preview, run_counters, upsert_classification, upsert_importance
from fleetlens.plans import oracle as O
from fleetlens.plans import queries_da, queries_features  # noqa: F401  (their oracles are merged below)
from fleetlens.plans.families import cmb_job, da_job, ecs_events, ecs_features, ecs_job, ecs_scored, esprsp_job, nonsevere_job, overspeed_job
from fleetlens.plans.queries_core import _OSE_ALL, BAND_SQL
from fleetlens.plans.queries_signal import _ECS_BASE, _ECS_SCORED
from fleetlens.plans.registry import ORACLE, register
from fleetlens.sources import fixtures
from fleetlens.sources.family import Telemetry, ecs_source

_KEYS4 = ["CompanyID", "VehicleID", "TripEventID", "TripEventGuid"]
_SCORES = ("overspeed_scores", "nonsevere_scores", "da_scores", "ecs_scores", "cmb_curve", "esprsp_curve")
_LABELS = ("overspeed_labels", "nonsevere_labels", "da_labels", "ecs_labels", "cmb_labels", "esprsp_labels")


def _all_families(t: Telemetry, part: int) -> list:
    """Importance (part 0) or label (part 1) rows of the six families; text dates become timestamps."""
    when = "CreatedDate" if part == 0 else "Timestamp"
    jobs = (overspeed_job, nonsevere_job, da_job, ecs_job, cmb_job, esprsp_job)
    return [(d := job(t)[part]).withColumn(when, F.col(when).cast("timestamp")) for job in jobs]


def _candidates(names, cols: str, when: str) -> str:
    """Rows of the families' own oracles with their priority (earlier families win a key)."""
    return " UNION ALL ".join(f"SELECT {cols.replace(when, f'cast({when} AS timestamp) AS {when}')}, {i} AS prio FROM ({ORACLE[n]}) q{i}"
                              for i, n in enumerate(names))


def _pick(c: str) -> str:
    return f"CASE WHEN t.t_hit THEN t.{c} ELSE s.{c} END AS {c}"


_IMP = "CompanyID, VehicleID, TripEventID, TripEventGuid, CreatedDate, importancescore"
_UPSERT_IMP = (O.with_ctes(O.TRIP_EVENT, O.TRIP_EVENT_EXTRA) + f""",
cand AS ({_candidates(_SCORES, _IMP, "CreatedDate")}),
srcu AS (SELECT CompanyID, VehicleID, TripEventID, TripEventGuid, arg_min_null(CreatedDate, prio) AS CreatedDate,
  arg_min_null(importancescore, prio) AS ImportanceScore, TRUE AS s_hit FROM cand GROUP BY ALL)
SELECT {_pick('CompanyID')}, {_pick('VehicleID')}, {_pick('TripEventID')}, {_pick('TripEventGuid')}, {_pick('CreatedDate')},
  {O.q4('CASE WHEN s.s_hit THEN s.ImportanceScore ELSE t.ImportanceScore END')} AS ImportanceScore
FROM (SELECT *, TRUE AS t_hit FROM trip_event_extra) t FULL OUTER JOIN srcu s
  ON t.CompanyID = s.CompanyID AND t.VehicleID = s.VehicleID AND t.TripEventID = s.TripEventID
  AND lower(t.TripEventGuid) = lower(s.TripEventGuid)""")


@register("upsert_importance", _UPSERT_IMP)
def q_upsert_importance(spark, sf_dir):
    """TripEventExtra after merging the scores of all six families (series path wins over the fallback path)."""
    t = Telemetry.derive(spark, sf_dir)
    return upsert_importance(t.extra, one_per_key(_all_families(t, 0), _KEYS4))


@register("stream_upsert", _UPSERT_IMP.replace(_candidates(_SCORES, _IMP, "CreatedDate"), _candidates(_SCORES[:1], _IMP, "CreatedDate")))
def q_stream_upsert(spark, sf_dir):
    """TripEventExtra, partitioned by company and date, after a stream of overspeed scores: every
    micro-batch is merged in foreachBatch and touches its own partitions only."""
    import uuid

    from fleetlens.operators.sinks import read_partitioned, write_partitioned
    from fleetlens.session import checkpoint_dir
    from fleetlens.streaming.stream import run_stream, stage_chunks

    t = Telemetry.derive(spark, sf_dir)
    run = f"{checkpoint_dir(spark).rstrip('/')}/upsert-stream-{uuid.uuid4().hex}"
    write_partitioned(t.extra, f"{run}/extra", "CreatedDate")
    stage_chunks(t.trips, f"{run}/trips", minutes=7 * 24 * 60)
    run_stream(spark, f"{run}/trips", t, f"{run}/sink", f"{run}/checkpoint", overspeed_job, files_per_trigger=16,
               targets={"importance": (f"{run}/extra", upsert_importance, "CreatedDate")}).awaitTermination()
    return read_partitioned(spark, f"{run}/extra").select(*t.extra.columns)


_UPSERT_CLS = (O.with_ctes(O.TRIP_EVENT, O.EVENT_CLASSIFICATION, O.EVENT_CLASSIFICATION_TYPE) + f""",
lab AS ({_candidates(_LABELS, 'CompanyID, VehicleID, DriverID, TripEventID, ClassificationName, Timestamp, "By"', "Timestamp")}),
one AS (SELECT CompanyID, VehicleID, TripEventID, arg_min_null(DriverID, prio) AS DriverID, arg_min_null(ClassificationName, prio) AS ClassificationName,
  arg_min_null(Timestamp, prio) AS Timestamp, arg_min_null("By", prio) AS "By" FROM lab GROUP BY ALL),
srcc AS (SELECT l.CompanyID, l.VehicleID, l.DriverID, l.TripEventID, ty.Type AS Classification, l.Timestamp, l."By", TRUE AS s_hit
  FROM one l JOIN event_classification_type ty ON l.CompanyID = ty.CompanyID AND l.ClassificationName = ty.Name)
SELECT {_pick('CompanyID')}, {_pick('VehicleID')}, {_pick('DriverID')}, {_pick('TripEventID')},
  CASE WHEN s.s_hit THEN s.Classification ELSE t.Classification END AS Classification,
  CASE WHEN s.s_hit THEN s.Timestamp ELSE t.Timestamp END AS Timestamp,
  CASE WHEN s.s_hit THEN s."By" ELSE t."By" END AS "By"
FROM (SELECT *, TRUE AS t_hit FROM event_classification) t FULL OUTER JOIN srcc s
  ON t.CompanyID = s.CompanyID AND t.VehicleID = s.VehicleID AND t.TripEventID = s.TripEventID""")


@register("upsert_classification", _UPSERT_CLS)
def q_upsert_classification(spark, sf_dir):
    """EventClassification after merging the labels of all six families (name -> type per company)."""
    t = Telemetry.derive(spark, sf_dir)
    labels = one_per_key(_all_families(t, 1), ["CompanyID", "VehicleID", "TripEventID"])
    return upsert_classification(fixtures.event_classification(spark, sf_dir, t.trips), labels,
                                 fixtures.event_classification_type(spark, sf_dir, t.trips))


def _json(pairs: list[tuple[str, str]]) -> str:
    return "'{' || " + " || ',' || ".join(f"'\"{k}\":' || {v}" for k, v in pairs) + " || '}'"


_JSON_ROW = _json([("CompanyID", "CompanyID"), ("VehicleID", "to_json(VehicleID)"), ("TripEventID", "to_json(TripEventID)"),
                   ("TripEventGuid", "to_json(TripEventGuid)"), ("CreatedDate", "strftime(CreatedDate, '\"%Y-%m-%dT%H:%M:%S.%gZ\"')"),
                   ("importancescore", "importancescore::varchar")])
_PREVIEW = (O.with_ctes(*_OSE_ALL, O.COMPANY, O.COMPANY_SETTINGS) + f""", r AS (SELECT *, score AS importancescore,
  row_number() OVER (PARTITION BY CompanyID ORDER BY TripEventID) AS rn FROM scored),
rows5 AS (SELECT CompanyID, string_agg({_JSON_ROW}, ',' ORDER BY rn) AS data FROM r WHERE rn <= 5 GROUP BY CompanyID)
SELECT r5.CompanyID, '{{"header":["' || r5.CompanyID || '","telemetry_shard' || c.ReportShardID || '","' || c.ReportShardID || '"],"data":[' || r5.data || ']}}' AS preview
FROM rows5 r5 JOIN company_settings s ON r5.CompanyID = s.CompanyID AND s.Data LIKE '%true%' JOIN company c ON r5.CompanyID = c.CompanyID""")


@register("preview_json", _PREVIEW)
def q_preview_json(spark, sf_dir):
    """Per company: JSON header (CompanyID, DatabaseName, ShardID) + first 5 overspeed importance rows."""
    t = Telemetry.derive(spark, sf_dir)
    roster = company_roster(fixtures.company_settings(spark, sf_dir, t.trips), fixtures.company(spark, sf_dir, t.trips))
    return preview(overspeed_job(t)[0], roster)


_COUNTERS = _ECS_BASE + _ECS_SCORED.rstrip("\n") + """
SELECT CompanyID, batch_start, count(DISTINCT TripEventID) AS events, 'read' AS stage FROM src GROUP BY ALL
UNION ALL SELECT CompanyID, batch_start, count(DISTINCT TripEventID), 'deduped' FROM ecs_kept_src GROUP BY ALL
UNION ALL SELECT CompanyID, batch_start, count(DISTINCT TripEventID), 'featured' FROM feats GROUP BY ALL
UNION ALL SELECT CompanyID, batch_start, count(DISTINCT TripEventID), 'scored' FROM ecs_scored GROUP BY ALL"""


@register("run_counters", _COUNTERS)
def q_run_counters(spark, sf_dir):
    """Events read, kept by dedup, featured and scored per company and run (ECS), each stage counted on its own frame."""
    t = Telemetry.derive(spark, sf_dir)
    return run_counters({"read": ecs_source(t), "deduped": ecs_events(t), "featured": (f := ecs_features(t)),
                         "scored": ecs_scored(f)})


def _counts_sql(ctes: str, family: str, stages: dict[str, str]) -> str:
    counted = " UNION ALL ".join(f"SELECT '{family}' AS family, CompanyID, {'batch_start' if frm != 'scored' else _BUCKET} AS batch_start, '{stage}' AS stage, "
                                 f"count(DISTINCT TripEventID) AS events FROM {frm} GROUP BY ALL" for stage, frm in stages.items())
    return f"SELECT * FROM ({ctes}\n{counted})"


_BUCKET = O.BATCH.format(c="CreatedDate")
_FAMILY_COUNTERS = " UNION ALL ".join([
    _counts_sql(O.with_ctes(*_OSE_ALL), "overspeed", {"read": "src", "cleaned": "clean", "scored": "scored"}),
    _counts_sql(O.with_ctes(*queries_features.CMB_FEAT_CTES, queries_features.CMB_CURVE), "cmb", {"read": "src", "featured": "feat", "scored": "cmbs"}),
    _counts_sql(_ECS_BASE + _ECS_SCORED.rstrip("\n").replace("ecs_scored AS", "ecs_scores_ AS"), "ecs", {"read": "src", "deduped": "ecs_kept_src", "featured": "feats", "scored": "ecs_scores_"})])


@register("family_counters", _FAMILY_COUNTERS)
def q_family_counters(spark, sf_dir):
    """Events per stage, company and run of the overspeed, collision and curve-speed jobs. What is stored
    has a few rows per event (joined overspeed samples, feature rows); the wide joined samples of the other
    families are not written and shuffled again, their first stages need only the samples' keys and times."""
    from fleetlens.operators.features import CMB_DROPPED, event_features
    from fleetlens.operators.overspeed import overspeed_clean, overspeed_scores
    from fleetlens.plans.families import ecs_dedup
    from fleetlens.operators.signal import event_signal_features
    from fleetlens.plans.families import ECS_KEYS
    from fleetlens.session import stored
    from fleetlens.sources.family import cmb_source, overspeed_source

    t = Telemetry.derive(spark, sf_dir)
    read = {"overspeed": stored(overspeed_source(t)), "cmb": cmb_source(t), "ecs": ecs_source(t)}
    clean = overspeed_clean(read["overspeed"])
    cmb = stored(event_features(read["cmb"]))
    kept = ecs_dedup(read["ecs"])
    feats = stored(event_signal_features(kept, ECS_KEYS))
    stages = {"overspeed": {"read": read["overspeed"], "cleaned": clean, "scored": overspeed_scores(clean)},
              "cmb": {"read": read["cmb"], "featured": cmb, "scored": cmb.drop(*CMB_DROPPED).where(F.col("AbsDiffBrakingForcestd").isNotNull())},
              "ecs": {"read": read["ecs"], "deduped": kept, "featured": feats, "scored": ecs_scored(feats)}}
    out = None
    for family, frames in stages.items():
        part = run_counters(frames).withColumn("family", F.lit(family))
        out = part if out is None else out.unionByName(part)
    return out


def _raw_events(te):
    """Trip events as the text an upstream system sends, with faults planted by row number."""
    n = F.col("n")
    return te.select(
        F.when(n % 47 == 0, F.lit("x7")).otherwise(F.col("CompanyID").cast("string")).alias("CompanyID"),
        F.when(n % 37 == 0, F.lit(None).cast("string")).when(n % 59 == 0, F.lit(" ")).otherwise(F.col("VehicleID")).alias("VehicleID"),
        F.when(n % 31 == 0, F.concat(F.lit("zz"), F.col("TripEventID"))).otherwise(F.col("TripEventID")).alias("TripEventID"),
        "TripEventGuid", F.col("Timestamp").cast("string").alias("Timestamp"),
        F.when(n % 41 == 0, F.lit("2024-13-45")).when(n % 29 == 0, F.lit("1999-01-01 00:00:00")).otherwise(F.col("CreatedDate").cast("string")).alias("CreatedDate"),
        F.when(n % 43 == 0, F.lit("fast")).otherwise(F.col("Speed").cast("string")).alias("Speed"), "n")


@register("quarantine_rows", O.with_ctes(O.TRIP_EVENT) + """SELECT n, reasons FROM (SELECT n, concat_ws(', ',
  CASE WHEN n % 29 = 0 AND n % 41 <> 0 THEN 'created before event' END,
  CASE WHEN n % 47 = 0 THEN 'malformed CompanyID' END, CASE WHEN n % 41 = 0 THEN 'malformed CreatedDate' END,
  CASE WHEN n % 43 = 0 THEN 'malformed Speed' END, CASE WHEN n % 31 = 0 THEN 'malformed TripEventID' END,
  CASE WHEN n % 37 = 0 OR n % 59 = 0 THEN 'missing VehicleID' END) AS reasons FROM trip_event) WHERE reasons <> ''""")
def q_quarantine_rows(spark, sf_dir):
    """Rows of the incoming trip events that go into quarantine, with their reasons."""
    from fleetlens.operators.quarantine import split_rows
    bad = split_rows(_raw_events(fixtures.trip_events(spark, sf_dir)))[1]
    return bad.select("n", F.concat_ws(", ", "reasons").alias("reasons"))


_WEEKLY = O.with_ctes(O.TRIP_EVENT, O.EVENT_DIM, O.TRIP_EVENT_EXTRA, O.EVENT_CLASSIFICATION, O.EVENT_CLASSIFICATION_TYPE) + """
SELECT x.CompanyID, cast(x.CreatedDate AS date) - cast(dayofweek(x.CreatedDate) AS integer) + 7 AS week_end,
  e.Name AS "Group", d.EventName, count(*) AS Count
FROM trip_event_extra x JOIN trip_event t ON x.CompanyID = t.CompanyID AND x.TripEventID = t.TripEventID
LEFT JOIN event_dim d ON t.EventID = d.EventID
JOIN event_classification c ON x.CompanyID = c.CompanyID AND x.TripEventID = c.TripEventID
JOIN event_classification_type e ON c.CompanyID = e.CompanyID AND c.Classification = e.Type
WHERE e.Name IN ('Pre-Grouped (Low)', 'Pre-Grouped (Mid)', 'Pre-Grouped (High)') AND t.EventID IS NOT NULL
GROUP BY ALL"""


@register("weekly_report", _WEEKLY)
def q_weekly_report(spark, sf_dir):
    """Weekly counts by label group and event name, per company and Sunday-ending week."""
    t = Telemetry.derive(spark, sf_dir)
    return weekly_report(t.extra, t.trips, t.event_dim, fixtures.event_classification(spark, sf_dir, t.trips),
                         fixtures.event_classification_type(spark, sf_dir, t.trips))


_DEV = """dev AS (SELECT t.CompanyID, t.VehicleID, t.DriverID, t.TripEventID, t.TripEventGuid, t.CreatedDate,
  t.Timestamp AS EventTimeStamp, cast(t.Timestamp AS date) AS day, coalesce(x.ImportanceScore, 0.0e0) AS importancescore
  FROM trip_event t LEFT JOIN trip_event_extra x ON t.CompanyID = x.CompanyID AND t.VehicleID = x.VehicleID
    AND t.TripEventID = x.TripEventID WHERE t.DriverID IS NOT NULL AND t.DriverID <> ''),
carry AS (SELECT *, CASE WHEN coalesce(lag(importancescore) OVER w <> 0 AND importancescore = 0
    AND date_diff('day', lag(day) OVER w, day) < 7, FALSE) THEN least(lag(importancescore) OVER w + 0.05e0, 1.0e0)
  ELSE 0.0e0 END AS newimportancescore FROM dev
  WINDOW w AS (PARTITION BY CompanyID, DriverID ORDER BY day, EventTimeStamp, TripEventID)),
cand AS (SELECT * EXCLUDE (newimportancescore, cnt) FROM (SELECT *, count(*) OVER (PARTITION BY CompanyID, DriverID) AS cnt
  FROM carry WHERE importancescore = 0 AND newimportancescore = 0) WHERE cnt >= 3)"""
_REP_BASE = O.with_ctes(O.TRIP_EVENT, O.TRIP_EVENT_EXTRA, _DEV)
_EV_OUT = "CompanyID, VehicleID, DriverID, TripEventID, TripEventGuid, CreatedDate"


@register("repeat_carry", _REP_BASE + f"SELECT {_EV_OUT}, {O.q4('newimportancescore')} AS importancescore FROM carry WHERE newimportancescore <> 0")
def q_repeat_carry(spark, sf_dir):
    """Events that inherit the driver's previous score + 0.05 (within 7 days, capped at 1)."""
    t = Telemetry.derive(spark, sf_dir)
    return repeat_carry(driver_events(t.trips, t.extra))


@register("repeat_driver_filter", _REP_BASE + f"SELECT {_EV_OUT}, EventTimeStamp, importancescore FROM cand")
def q_repeat_driver_filter(spark, sf_dir):
    """Unscored, not-carried events of drivers with more than two of them."""
    t = Telemetry.derive(spark, sf_dir)
    return repeat_candidates(driver_events(t.trips, t.extra))


_RC = f""",
rc0 AS (SELECT *, coalesce(date_diff('day', lag(day, 2) OVER w, day) <= 7, FALSE) AS hit,
  coalesce(date_diff('day', lag(day) OVER w, day) > 7, FALSE) AS rst
  FROM cand WINDOW w AS (PARTITION BY CompanyID, DriverID ORDER BY EventTimeStamp, TripEventID)),
rc1 AS (SELECT *, sum(CASE WHEN rst THEN 1 ELSE 0 END) OVER (PARTITION BY CompanyID, DriverID ORDER BY EventTimeStamp, TripEventID
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg FROM rc0),
rc2 AS (SELECT *, CASE WHEN hit THEN cast(sum(CASE WHEN hit THEN 1 ELSE 0 END) OVER (PARTITION BY CompanyID, DriverID, seg
  ORDER BY EventTimeStamp, TripEventID ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bigint) ELSE 0 END AS cnt FROM rc1),
pos AS (SELECT * FROM rc2 WHERE cnt > 0),
bnd AS (SELECT CompanyID, min(cnt) AS lo, max(cnt) AS hi FROM pos GROUP BY ALL),
scd AS (SELECT *, CASE WHEN lo = hi THEN 1.0e0 ELSE 0.7e0 + (cnt - lo) * 0.3e0 / (hi - lo) END AS score FROM pos JOIN bnd USING (CompanyID))
"""


def _labels_sql(frm: str, score: str) -> str:
    return (f"SELECT CompanyID, VehicleID, DriverID, TripEventID, {BAND_SQL.format(s=score)} AS ClassificationName, "
            f"CreatedDate AS Timestamp, 'AER Classification' AS \"By\" FROM {frm}")


@register("repeat_carry_labels", _REP_BASE + _labels_sql("carry WHERE newimportancescore <> 0", "newimportancescore * 100"))
def q_repeat_carry_labels(spark, sf_dir):
    """Classification rows of the carried-over scores."""
    t = Telemetry.derive(spark, sf_dir)
    return repeat_labels(repeat_carry(driver_events(t.trips, t.extra)))


@register("repeat_count_labels", _REP_BASE.rstrip("\n") + _RC + _labels_sql("scd", "score * 100"))
def q_repeat_count_labels(spark, sf_dir):
    """Classification rows of the 3-in-7-days scores."""
    t = Telemetry.derive(spark, sf_dir)
    return repeat_labels(repeat_counts(repeat_candidates(driver_events(t.trips, t.extra))))


@register("repeat_count", _REP_BASE.rstrip("\n") + _RC
          + f"SELECT {_EV_OUT}, cnt AS repeat_count, {O.q4('score')} AS importancescore FROM scd")
def q_repeat_count(spark, sf_dir):
    """Running 3-in-7-days counts per driver, normalised to 0.7..1.0 per company."""
    t = Telemetry.derive(spark, sf_dir)
    return repeat_counts(repeat_candidates(driver_events(t.trips, t.extra)))
