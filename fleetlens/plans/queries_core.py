"""Registered queries: sources, batch keys, roster/routing and the overspeed families."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.functions.columns import batch_start, label_band, snap_limit
from fleetlens.operators.overspeed import nonsevere_outputs, overspeed_clean, overspeed_outputs
from fleetlens.operators.routing import company_roster, route_shards
from fleetlens.plans import oracle as O
from fleetlens.plans.registry import register
from fleetlens.schema import LABEL_HIGH, LABEL_LOW, LABEL_MID
from fleetlens.sources import fixtures
from fleetlens.sources.family import (Telemetry, cmb_source, da_source, ecs_source, esprsp_source,
                                      nonsevere_source, overspeed_source)

_EV = "CompanyID, VehicleID, TripID, CreatedDate, TripEventID, TripEventGuid, DriverID, EventTimeStamp, batch_start"
_SM = "ppeTimeStamp, SequenceID, ppe_n, TimeSegment, SecTimeSegment"
_BASE = (O.TRIP_EVENT, O.PRE_POST_EVENT)
_DIMMED = "dimmed AS (SELECT t.*, d.EventName FROM trip_event t JOIN event_dim d USING (EventID))"


def _cols(s: str) -> list[str]:
    return [c.strip() for c in s.split(",")]


# ---------------------------------------------------------------- sources
OSE_SRC = O.interval_join_sql(
    "src", "t.EventID = -1879048190",
    "t.EventName, t.Speed * 0.6213711922 AS tespeedmph, round(t.SpeedLimit * 0.6213711922, 0) AS speedlimitmph",
    "round(p.Speed * 0.6213711922, 2) AS ppespeedmph", 9, 11, from_events="dimmed")
_OSE_OUT = f"{_EV}, EventName, tespeedmph, speedlimitmph, ppespeedmph, {_SM}"


@register("overspeed_source", O.with_ctes(*_BASE, O.EVENT_DIM, _DIMMED, OSE_SRC)
          + f"SELECT {_OSE_OUT.replace('tespeedmph', O.q4('tespeedmph') + ' AS tespeedmph')} FROM src")
def q_overspeed_source(spark, sf_dir):
    """Overspeed events joined with samples in (+9 s, +11 s), speeds in mph."""
    return overspeed_source(Telemetry.derive(spark, sf_dir)).select(*_cols(_OSE_OUT))


NS_OUT = "CompanyID, VehicleID, TripID, CreatedDate, TripEventID, TripEventGuid, DriverID, EventTimeStamp, batch_start, tespeedmph, speedlimitmph"
NS_SRC = f"""nsrc AS (SELECT CompanyID, VehicleID, TripID, CreatedDate, TripEventID, TripEventGuid, DriverID,
  Timestamp AS EventTimeStamp, {O.BATCH.format(c='CreatedDate')} AS batch_start,
  Speed * 0.6213711922 AS tespeedmph, round(SpeedLimit * 0.6213711922, 0) AS speedlimitmph
  FROM trip_event WHERE EventID = -1879048190 AND NOT SevereEvent)"""


@register("nonsevere_source", O.with_ctes(O.TRIP_EVENT, NS_SRC)
          + f"SELECT {NS_OUT.replace('tespeedmph', O.q4('tespeedmph') + ' AS tespeedmph')} FROM nsrc")
def q_nonsevere_source(spark, sf_dir):
    """Non-severe overspeed events (fact only, no series)."""
    return nonsevere_source(Telemetry.derive(spark, sf_dir)).select(*_cols(NS_OUT))


_UNSCORED_DA = """da_events AS (SELECT t.* FROM dimmed t WHERE t.EventID = 1048576 AND NOT EXISTS (
  SELECT 1 FROM trip_event_extra x WHERE x.CompanyID = t.CompanyID AND x.VehicleID = t.VehicleID
    AND x.TripEventID = t.TripEventID AND x.ImportanceScore IS NOT NULL))"""
DA_SRC = O.interval_join_sql(
    "src", "TRUE", "t.EventName, t.Speed AS teSpeed",
    "p.Speed AS ppeSpeed, p.SpeedForwardVehicle AS ppeSpeedforwardV, p.DistanceForwardVehicle AS ppeDistanceforwardV",
    -10, 10, from_events="da_events")
DA_CTES = (*_BASE, O.EVENT_DIM, O.TRIP_EVENT_EXTRA, _DIMMED, _UNSCORED_DA, DA_SRC)
_DA_OUT = f"{_EV}, EventName, teSpeed, ppeSpeed, ppeSpeedforwardV, ppeDistanceforwardV, {_SM}"


@register("da_source", O.with_ctes(*DA_CTES) + f"SELECT {_DA_OUT} FROM src")
def q_da_source(spark, sf_dir):
    """Unscored distance alerts with samples in (-10 s, +10 s)."""
    return da_source(Telemetry.derive(spark, sf_dir)).select(*_cols(_DA_OUT))


_UNSCORED_ECS = """ecs_events AS (SELECT t.* FROM dimmed t WHERE t.EventID = 1 AND NOT EXISTS (
  SELECT 1 FROM trip_event_extra x WHERE x.CompanyID = t.CompanyID AND x.VehicleID = t.VehicleID
    AND x.TripEventID = t.TripEventID AND x.ImportanceScore IS NOT NULL AND x.ImportanceScore <> 0))"""
ECS_SRC = O.interval_join_sql(
    "src", "TRUE", "t.EventName, t.Speed AS teSpeed",
    "p.Speed AS ppeSpeed, p.TurningForce AS ppeTurningForce, p.Curvature AS ppeCurvature, p.BrakingForce AS ppeBrakingForce",
    -10, 10, from_events="ecs_events")
ECS_CTES = (*_BASE, O.EVENT_DIM, O.TRIP_EVENT_EXTRA, _DIMMED, _UNSCORED_ECS, ECS_SRC)
_ECS_OUT = f"{_EV}, EventName, teSpeed, ppeSpeed, ppeTurningForce, ppeCurvature, ppeBrakingForce, {_SM}"


@register("ecs_source", O.with_ctes(*ECS_CTES) + f"SELECT {_ECS_OUT} FROM src")
def q_ecs_source(spark, sf_dir):
    """Curve-speed events unscored (null or 0) with samples in (-10 s, +10 s)."""
    return ecs_source(Telemetry.derive(spark, sf_dir)).select(*_cols(_ECS_OUT))


_BRAKE = ("p.Speed AS ppeSpeed, p.BrakingForce AS ppeBrakingForce, p.TurningForce AS ppeTurningForce, "
          "p.Curvature AS ppeCurvature, p.BrakePercentage AS ppeBrakePercentage")
CMB_SRC = O.interval_join_sql("src", "t.EventID IN (32, 4096, 1024)", "t.Speed AS teSpeed, 0 AS isSevere",
                              _BRAKE, -11, 11)
ESP_SRC = O.interval_join_sql("src", "t.EventID IN (131072, 32768)", "t.Speed AS teSpeed, 0 AS isSevere",
                              _BRAKE + ", p.Abs AS ppeAbs, p.DistanceForwardVehicle AS ppeDistanceForwardVehicle", -10, 10, inclusive=True)
_CMB_OUT = f"{_EV}, teSpeed, isSevere, ppeSpeed, ppeBrakingForce, ppeTurningForce, ppeCurvature, ppeBrakePercentage, {_SM}"
_ESP_OUT = _CMB_OUT + ", ppeAbs, ppeDistanceForwardVehicle"


@register("cmb_source", O.with_ctes(*_BASE, CMB_SRC) + f"SELECT {_CMB_OUT} FROM src")
def q_cmb_source(spark, sf_dir):
    """Collision / forward-collision / excessive-brake events with samples in (-11 s, +11 s)."""
    return cmb_source(Telemetry.derive(spark, sf_dir)).select(*_cols(_CMB_OUT))


@register("esprsp_source", O.with_ctes(*_BASE, ESP_SRC) + f"SELECT {_ESP_OUT} FROM src")
def q_esprsp_source(spark, sf_dir):
    """ESP / RSP brake events with samples in [-10 s, +10 s] (inclusive)."""
    return esprsp_source(Telemetry.derive(spark, sf_dir)).select(*_cols(_ESP_OUT))


@register("sec_time_segment", O.with_ctes(*_BASE, CMB_SRC) + """
SELECT CompanyID, TripEventID, cast(trunc(SecTimeSegment) AS bigint) AS sec, count(*) AS samples,
  min(TimeSegment) AS first_segment, max(TimeSegment) AS last_segment, sum(SecTimeSegment) AS sum_segment
FROM src GROUP BY ALL""")
def q_sec_time_segment(spark, sf_dir):
    """Per event and whole second: samples and the T-SQL style time segments (CMB window)."""
    src = cmb_source(Telemetry.derive(spark, sf_dir))
    return (src.groupBy("CompanyID", "TripEventID", F.col("SecTimeSegment").cast("bigint").alias("sec"))
            .agg(F.count(F.lit(1)).alias("samples"), F.min("TimeSegment").alias("first_segment"),
                 F.max("TimeSegment").alias("last_segment"), F.sum("SecTimeSegment").alias("sum_segment")))


@register("batch_windows", O.with_ctes(O.TRIP_EVENT) + f"""
SELECT CompanyID, {O.BATCH.format(c='CreatedDate')} AS batch_start,
  {O.BATCH.format(c='CreatedDate')} + INTERVAL 30 MINUTE AS batch_end,
  count(*) AS events, count(DISTINCT VehicleID) AS vehicles
FROM trip_event GROUP BY ALL""")
def q_batch_windows(spark, sf_dir):
    """Half-open 30-minute CreatedDate batches per company (the run scope key)."""
    te = fixtures.trip_events(spark, sf_dir)
    return (te.groupBy("CompanyID", batch_start("CreatedDate").alias("batch_start"))
            .agg(F.count(F.lit(1)).alias("events"), F.countDistinct("VehicleID").alias("vehicles"))
            .withColumn("batch_end", F.col("batch_start") + F.expr("INTERVAL 30 MINUTES")))


# ---------------------------------------------------------------- overspeed
SNAP_SQL = "CASE WHEN {x} % 5 <= 2 THEN {x} - {x} % 5 ELSE {x} + (5 - {x} % 5) END"


@register("speed_limit_snap", O.with_ctes(O.TRIP_EVENT) + f"""
SELECT TripEventID, lim AS speedlimitmph, {SNAP_SQL.format(x='lim')} AS snapped
FROM (SELECT TripEventID, round(SpeedLimit * 0.6213711922, 0) AS lim FROM trip_event)""")
def q_speed_limit_snap(spark, sf_dir):
    """Speed limit in mph snapped to a multiple of 5 (remainder <= 2 down, else up)."""
    te = fixtures.trip_events(spark, sf_dir)
    lim = F.round(F.col("SpeedLimit") * F.lit(0.6213711922), 0)
    return te.select("TripEventID", lim.alias("speedlimitmph"), snap_limit(lim).alias("snapped"))


OSE_CLEAN = f"""clean AS (SELECT * FROM (
  SELECT * EXCLUDE (speedlimitmph), lim AS speedlimitmph,
    CASE WHEN ppespeedmph < lim THEN 0.0e0 ELSE ppespeedmph - lim END AS speedoverlimitmph
  FROM (SELECT *, {SNAP_SQL.format(x='speedlimitmph')} AS lim FROM src))
  WHERE NOT coalesce(speedoverlimitmph = 0 OR speedlimitmph = 0 OR (speedoverlimitmph > 25 AND speedlimitmph < 40), FALSE))"""
_CLEAN_OUT = "CompanyID, VehicleID, DriverID, TripEventID, TripEventGuid, CreatedDate, ppe_n, SequenceID, speedlimitmph, speedoverlimitmph"


@register("overspeed_clean", O.with_ctes(*_BASE, O.EVENT_DIM, _DIMMED, OSE_SRC, OSE_CLEAN)
          + f"SELECT {_CLEAN_OUT.replace('speedoverlimitmph', O.q4('speedoverlimitmph') + ' AS speedoverlimitmph')} FROM clean")
def q_overspeed_clean(spark, sf_dir):
    """Valid over-limit samples of overspeed events (series path)."""
    return overspeed_clean(overspeed_source(Telemetry.derive(spark, sf_dir))).select(*_cols(_CLEAN_OUT))


def _ose_curve(o: str) -> str:
    r = lambda e: f"round_even(({e}) * 100, 0) / 100"
    return (f"CASE WHEN {o} >= 15 THEN {r(f'0.95e0 + (0.05e0 / 19.00e0) * ({o} - 15)')} "
            f"WHEN {o} >= 10 THEN {r(f'0.7e0 + (0.24e0 / 4.99e0) * ({o} - 10)')} "
            f"WHEN {o} >= 5 THEN {r(f'0.5e0 + (0.19e0 / 4.99e0) * ({o} - 5)')} ELSE 0.0e0 END")


BAND_SQL = ("CASE WHEN {s} >= 1 AND {s} <= 39 THEN 'Pre-Grouped (Low)' WHEN {s} >= 40 AND {s} <= 69 "
            "THEN 'Pre-Grouped (Mid)' WHEN {s} >= 70 AND {s} <= 100 THEN 'Pre-Grouped (High)' END")
OSE_SCORED = f"""scored AS (SELECT *, {_ose_curve('speedoverlimitmph')} AS score FROM (
  SELECT CompanyID, VehicleID, TripEventID, TripEventGuid, DriverID, CreatedDate, max(speedoverlimitmph) AS speedoverlimitmph
  FROM clean GROUP BY ALL) WHERE speedoverlimitmph IS NOT NULL)"""
IMP_OUT = "CompanyID, VehicleID, TripEventID, TripEventGuid, CreatedDate, {imp} AS importancescore"
LAB_OUT = ("CompanyID, VehicleID, DriverID, TripEventID, " + "{band} AS ClassificationName, "
           "{created} AS Timestamp, 'AER Classification' AS \"By\"")


def imp_sql(frm: str, imp: str = "score", created: str = "CreatedDate") -> str:
    return "SELECT " + IMP_OUT.format(imp=O.q4(imp)).replace("CreatedDate,", f"{created} AS CreatedDate,", 1) + f" FROM {frm}"


def lab_sql(frm: str, label_score: str, where: str | None = None, created: str = "CreatedDate") -> str:
    w = f" WHERE {where}" if where else ""
    return "SELECT " + LAB_OUT.format(band=BAND_SQL.format(s=label_score), created=created) + f" FROM {frm}{w}"


_OSE_ALL = (*_BASE, O.EVENT_DIM, _DIMMED, OSE_SRC, OSE_CLEAN, OSE_SCORED)


@register("overspeed_scores", O.with_ctes(*_OSE_ALL) + imp_sql("scored"))
def q_overspeed_scores(spark, sf_dir):
    """Importance rows of overspeed events (max over-limit sample per event, rule curve)."""
    return overspeed_outputs(overspeed_clean(overspeed_source(Telemetry.derive(spark, sf_dir))))[0]


@register("overspeed_labels", O.with_ctes(*_OSE_ALL) + lab_sql("scored", "score * 100", "score > 0"))
def q_overspeed_labels(spark, sf_dir):
    """Classification rows of overspeed events with a positive score."""
    return overspeed_outputs(overspeed_clean(overspeed_source(Telemetry.derive(spark, sf_dir))))[1]


def _ns_over(te: str, lim: str) -> str:
    return (f"CASE WHEN {lim} = 0 THEN (CASE WHEN {te} > 65 THEN {te} - 65 WHEN {te} > 55 THEN {te} - 55 ELSE 0.0e0 END) "
            f"ELSE (CASE WHEN {te} > {lim} THEN {te} - {lim} ELSE 0.0e0 END) END")


NS_SCORED = f"""nscored AS (SELECT *, CASE WHEN over > 0 THEN round_even((0.1e0 + (0.3e0 / 15) * (over - 0)) * 100, 0) / 100
  ELSE 0.0e0 END AS score FROM (SELECT *, {_ns_over('tespeedmph', 'lim')} AS over FROM (
  SELECT *, {SNAP_SQL.format(x='speedlimitmph')} AS lim FROM nsrc)))"""


@register("nonsevere_scores", O.with_ctes(O.TRIP_EVENT, NS_SRC, NS_SCORED) + imp_sql("nscored"))
def q_nonsevere_scores(spark, sf_dir):
    """Importance rows of non-severe overspeed events (fallback path, linear curve)."""
    return nonsevere_outputs(nonsevere_source(Telemetry.derive(spark, sf_dir)))[0]


@register("nonsevere_labels", O.with_ctes(O.TRIP_EVENT, NS_SRC, NS_SCORED) + lab_sql("nscored", "score * 100", "score > 0"))
def q_nonsevere_labels(spark, sf_dir):
    """Classification rows of non-severe overspeed events with a positive score."""
    return nonsevere_outputs(nonsevere_source(Telemetry.derive(spark, sf_dir)))[1]


@register("classify_bands", O.with_ctes(O.TRIP_EVENT) + f"""
SELECT TripEventID, s AS score, {BAND_SQL.format(s='s')} AS ClassificationName
FROM (SELECT TripEventID, cast((n * 37) % 1010 AS double) / 10 AS s FROM trip_event)""")
def q_classify_bands(spark, sf_dir):
    """Inclusive label bands on a 0..100.9 score spread (exercises every gap)."""
    te = fixtures.trip_events(spark, sf_dir)
    s = ((F.col("n") * 37) % 1010).cast("double") / 10
    return te.select("TripEventID", s.alias("score"), label_band(s).alias("ClassificationName"))


@register("classify_bands_contiguous", O.with_ctes(O.TRIP_EVENT) + f"""
SELECT TripEventID, s AS score, CASE WHEN s >= 1 AND s < 40 THEN '{LABEL_LOW}' WHEN s >= 40 AND s < 70 THEN '{LABEL_MID}'
  WHEN s >= 70 AND s <= 100 THEN '{LABEL_HIGH}' END AS ClassificationName
FROM (SELECT TripEventID, cast((n * 37) % 1010 AS double) / 10 AS s FROM trip_event)""")
def q_classify_bands_contiguous(spark, sf_dir):
    """The same scores with bands that reach up to the next one, so that no score from 1 to 100 is without a label."""
    te = fixtures.trip_events(spark, sf_dir)
    s = ((F.col("n") * 37) % 1010).cast("double") / 10
    return te.select("TripEventID", s.alias("score"), label_band(s, "contiguous").alias("ClassificationName"))


# ---------------------------------------------------------------- roster and routing
@register("company_roster", O.with_ctes(O.TRIP_EVENT, O.COMPANY, O.COMPANY_SETTINGS) + """
SELECT c.CompanyID, concat('telemetry_shard', cast(cc.ReportShardID AS varchar)) AS DatabaseName, cc.ReportShardID AS ShardID
FROM company_settings c JOIN company cc ON c.CompanyID = cc.CompanyID
WHERE c.Name = 'AutoEventClassification' AND c.Data LIKE '%true%'""")
def q_company_roster(spark, sf_dir):
    """Companies with auto classification switched on, with their shard database."""
    te = fixtures.trip_events(spark, sf_dir)
    return company_roster(fixtures.company_settings(spark, sf_dir, te), fixtures.company(spark, sf_dir, te))


@register("shard_routing", O.with_ctes(O.TRIP_EVENT, O.COMPANY, O.COMPANY_SETTINGS, O.SHARD_SERVER) + """
SELECT r.*, s.Server FROM (
  SELECT c.CompanyID, concat('telemetry_shard', cast(cc.ReportShardID AS varchar)) AS DatabaseName, cc.ReportShardID AS ShardID
  FROM company_settings c JOIN company cc ON c.CompanyID = cc.CompanyID
  WHERE c.Name = 'AutoEventClassification' AND c.Data LIKE '%true%') r LEFT JOIN shard_server s ON r.ShardID = s.ShardID""")
def q_shard_routing(spark, sf_dir):
    """Roster with the server of each shard; ``Server`` is null for unmapped shards (skipped)."""
    te = fixtures.trip_events(spark, sf_dir)
    roster = company_roster(fixtures.company_settings(spark, sf_dir, te), fixtures.company(spark, sf_dir, te))
    return route_shards(roster, fixtures.shard_server(spark, sf_dir, te))


# ---------------------------------------------------------------- streaming
def _streamed(spark, sf_dir, name: str):
    """Overspeed outputs computed incrementally: trip events land as daily file chunks and samples as a
    table partitioned by date, a Structured Streaming query (availableNow) scores each micro-batch with
    the samples of its dates and writes it idempotently by batch id; the union of the sink equals the
    batch result."""
    import uuid
    from dataclasses import replace

    from fleetlens.plans.families import overspeed_job
    from fleetlens.session import checkpoint_dir
    from fleetlens.streaming.stream import outputs, run_stream, stage_chunks, stage_samples

    t = Telemetry.derive(spark, sf_dir)
    run = f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    stage_chunks(t.trips, f"{run}/trips")
    read = ("CompanyID", "VehicleID", "n", "SequenceID", "Timestamp", "Speed")  # what the overspeed job takes of a sample
    t = replace(t, samples=stage_samples(t.samples.select(*read), f"{run}/samples"))
    q = run_stream(spark, f"{run}/trips", t, f"{run}/sink", f"{run}/checkpoint", overspeed_job)
    q.awaitTermination()
    return outputs(spark, f"{run}/sink", name).drop("batch_id")


@register("stream_scores", O.with_ctes(*_OSE_ALL) + imp_sql("scored"))
def q_stream_scores(spark, sf_dir):
    """Overspeed importance computed incrementally (see ``_streamed``)."""
    return _streamed(spark, sf_dir, "importance").drop("batch_start")


@register("stream_labels", O.with_ctes(*_OSE_ALL) + f"""SELECT l.*, {O.BATCH.format(c='t.CreatedDate')} AS batch_start
FROM ({lab_sql("scored", "score * 100", "score > 0")}) l JOIN trip_event t ON l.CompanyID = t.CompanyID AND l.TripEventID = t.TripEventID""")
def q_stream_labels(spark, sf_dir):
    """Overspeed labels computed incrementally, with their 30-minute batch key (see ``_streamed``)."""
    return _streamed(spark, sf_dir, "labels")


_DAY = 86_400


@register("stream_join", O.with_ctes(*_BASE, CMB_SRC) + f"SELECT {_CMB_OUT} FROM src")
def q_stream_join(spark, sf_dir):
    """CMB source rows from a stream-stream interval join: trip events and samples arrive as weekly
    chunks on two ordered streams that advance together, joined by vehicle, time bucket and range."""
    import uuid

    from fleetlens.session import checkpoint_dir
    from fleetlens.sources.family import _brake_samples, _event_cols
    from fleetlens.sources.ordered import stage_by_time
    from fleetlens.streaming.join import run_join_stream

    t = Telemetry.derive(spark, sf_dir)
    run = f"{checkpoint_dir(spark).rstrip('/')}/join-stream-{uuid.uuid4().hex}"
    ev = _event_cols(t.trips.where(F.col("EventID").isin(32, 4096, 1024)), F.col("Speed").alias("teSpeed"),
                     F.lit(0).alias("isSevere"))
    stage_by_time(ev, f"{run}/events", "EventTimeStamp", 7 * _DAY)
    stage_by_time(_brake_samples(t, False), f"{run}/samples", "ppeTimeStamp", 7 * _DAY)
    joined, _ = run_join_stream(spark, f"{run}/events", f"{run}/samples", run, -11, 11, width_s=7 * _DAY, slack_s=120)
    return joined.select(*_cols(_CMB_OUT))


@register("stream_late", O.with_ctes(O.TRIP_EVENT) + f"""SELECT TripEventID, chunk, slack FROM (
  SELECT TripEventID, epoch(Timestamp) AS event_s, 600 AS slack, cast(floor(epoch(CreatedDate + to_days(CASE WHEN n % 50 = 0 THEN 1 ELSE 0 END)) / {_DAY}) * {_DAY} AS BIGINT) AS chunk
  FROM trip_event) WHERE event_s < chunk - slack OR event_s >= chunk + {_DAY} + slack""")
def q_stream_late(spark, sf_dir):
    """Trip events that arrive too late for the streams (each fiftieth is delivered a day late): the rows
    set aside, none lost, with the daily chunk they came in and the slack in seconds."""
    import uuid

    from fleetlens.session import checkpoint_dir
    from fleetlens.sources.ordered import on_time, read_ordered, stage_by_time
    from fleetlens.streaming.join import drain

    te = fixtures.trip_events(spark, sf_dir).select("TripEventID", "Timestamp", "CreatedDate", "n")
    run = f"{checkpoint_dir(spark).rstrip('/')}/late-stream-{uuid.uuid4().hex}"
    arrival = F.expr("CreatedDate + make_interval(0, 0, 0, CASE WHEN n % 50 = 0 THEN 1 ELSE 0 END)")
    stage_by_time(te, f"{run}/events", arrival, _DAY)
    late = read_ordered(spark, f"{run}/events").where(~on_time("Timestamp", _DAY, 600))
    drain(spark, late, f"{run}/late", f"{run}/checkpoint")
    return spark.read.schema(late.schema).parquet(f"{run}/late").select("TripEventID", "chunk", F.lit(600).alias("slack"))
