"""End-to-end checks on the driver's sf0.001 tables: oracle agreement, join plans, stream = batch."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from fleetlens_helpers import SF_SMOKE, rows
from fleetlens.operators.interval_join import interval_join, naive_interval_join, near_events
from fleetlens.sources.family import Telemetry, _brake_samples, _event_cols

TABLES = ["events", "embeddings", "documents", "pages", "labels"]
FAST_ORACLE = [k for k in E.oracle_sql() if k not in ("stream_scores",)]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (int, float)):
        return round(float(v), 6) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(str(_norm(r[i])) for i in order) for r in rows)


@pytest.mark.parametrize("name", FAST_ORACLE)
def test_query_matches_duckdb(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMOKE)
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(ocols)
    assert _canon(sdf.columns, [tuple(r) for r in sdf.collect()]) == _canon(ocols, cur.fetchall())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"CompanyID", "VehicleID", "TripEventID", "TripEventGuid", "CreatedDate", "importancescore"}
    assert df.count() >= 0


def test_every_query_has_a_callable():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 55


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_bucketed_join_equals_vehicle_join(spark, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        _bucketed_join_equals_vehicle_join(spark)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _bucketed_join_equals_vehicle_join(spark):
    t = Telemetry.derive(spark, SF_SMOKE)
    ev = _event_cols(t.trips.where(F.col("EventID").isin(32, 4096, 1024)))
    sm = _brake_samples(t, False)
    cols = ["TripEventID", "ppe_n", "SequenceID", "SecTimeSegment"]
    a = interval_join(ev, sm, -11, 11).select(*cols)
    b = naive_interval_join(ev, sm, -11, 11).select(*cols[:-1])
    assert a.count() == b.count() and a.drop("SecTimeSegment").exceptAll(b).count() == 0


def test_interval_bounds_strict_vs_inclusive(spark):
    t = Telemetry.derive(spark, SF_SMOKE)
    ev = _event_cols(t.trips)
    sm = _brake_samples(t, False)
    strict = interval_join(ev, sm, -10, 10).where(F.col("SecTimeSegment") == -10.0).count()
    incl = interval_join(ev, sm, -10, 10, inclusive=True).where(F.col("SecTimeSegment") == -10.0).count()
    assert strict == 0 and incl > 0


def test_join_plan_has_one_shape_and_no_job(spark):
    t = Telemetry.derive(spark, SF_SMOKE)
    ev = _event_cols(t.trips)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "building the join")
    joined = interval_join(ev, _brake_samples(t, False), -11, 11)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup("plan-only")) == 0
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_bucket" in plan and "Cross" not in plan and "rightHint" not in plan


@pytest.mark.parametrize("lo, hi, inclusive", [(9, 11, False), (-11, 11, False), (-10, 10, True), (3, 3, True)])
def test_only_samples_near_an_event_are_shuffled(spark, lo, hi, inclusive):
    """Samples of other vehicles and times do not reach the join's exchange; its rows are those of the plain join."""
    import datetime as dt

    at = lambda s: None if s is None else dt.datetime(1969, 12, 31, 23, 50) + dt.timedelta(seconds=s)
    events = [(1, "V1", "a", at(0)), (1, "V1", "a", at(0)), (1, "V2", "b", at(1000)), (2, "V1", "c", at(600)), (None, "V1", "d", at(5)), (1, None, "e", at(5)), (1, "V1", "f", None)]
    samples = [(c, v, at(s), 1 + s % 4, i) for i, (c, v, s) in enumerate((c, v, s) for c in (1, 2, None) for v in ("V1", "V2", None) for s in range(-600, 3000))]
    samples += [(1, "V1", None, 1, -1), (1, "V1", at(10), 3, -2)]
    ev = spark.createDataFrame(events, "CompanyID long, VehicleID string, TripEventID string, EventTimeStamp timestamp")
    sm = spark.createDataFrame(samples, "CompanyID long, VehicleID string, ppeTimeStamp timestamp, SequenceID long, ppe_n long")
    cols = ["TripEventID", "ppeTimeStamp", "ppe_n"]
    joined = interval_join(ev, sm, lo, hi, inclusive)
    want = rows(naive_interval_join(ev, sm, lo, hi, inclusive), *cols)
    assert rows(joined, *cols) == want and len(want) > 0
    passed = near_events(sm, ev, lo, hi, "EventTimeStamp", "ppeTimeStamp", ("CompanyID", "VehicleID")).count()
    assert passed < 1000  # of 32,402; at most two cells of 88 s around each of five events, and rows without a time
    plan = joined._jdf.queryExecution().executedPlan().toString().splitlines()
    exchange = [i for i, x in enumerate(plan) if "Exchange hashpartitioning" in x and "_bucket" in x]
    assert len(exchange) == 2 and "BroadcastHashJoin" in "".join(plan[exchange[1]:])


@pytest.mark.parametrize("query", ["brake_count", "remove_noise", "ecs_source"])
def test_samples_are_never_broadcast(spark, query):
    """A small events file explodes into many samples: their join is shuffled, with the events as the hash table."""
    joins = [x for x in E.queries()[query](spark, SF_SMOKE)._jdf.queryExecution().executedPlan().toString().splitlines() if "Join " in x and "_bucket" in x]
    assert len(joins) == 1 and "ShuffledHashJoin" in joins[0] and "BuildLeft" in joins[0]


@pytest.mark.parametrize("query", [
    "batch_zscore", "brake_irregularity", "center_deviation", "da_scores", "ecs_labels", "ecs_scores", "esprsp_labels", "event_extrema",
    "minmax_normalize", "preview_json", "signal_stats", "speed_change", "speed_change_count", "speed_ratio"])
def test_no_query_broadcasts_its_samples(spark, query):
    plan = E.queries()[query](spark, SF_SMOKE)._jdf.queryExecution().executedPlan().toString().splitlines()
    joins = [x for x in plan if "Join " in x and "_bucket" in x]
    assert joins and all("ShuffledHashJoin" in x and "BuildLeft" in x for x in joins)


@pytest.mark.parametrize("query", ["batch_run_scores", "ecs_model_scores", "family_counters", "run_counters", "stream_upsert"])
def test_no_job_of_a_query_broadcasts_its_samples(spark, monkeypatch, tmp_path, query):
    """The joins of frames that are stored or scored by micro-batch are not in the query's last plan: each is looked at where it is made."""
    import datetime as dt

    from fleetlens.sources import family
    kinds = ("click", "view", "purchase", "error", "error", "other", "other")
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=5 * i), i % 4, kinds[i % 7], 1.0, None) for i in range(70)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    plans = []

    def watched(*args, **kwargs):
        plans.append((out := interval_join(*args, **kwargs))._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(family, "interval_join", watched)
    assert E.queries()[query](spark, str(tmp_path)).count() > 0
    joins = [x for plan in plans for x in plan.splitlines() if "Join " in x and "_bucket" in x]
    assert len(joins) == len(plans) > 0 and all("ShuffledHashJoin" in x and "BuildLeft" in x for x in joins)


def test_family_counters_store_no_joined_samples(spark, monkeypatch):
    """Of the collision and curve-speed families only the feature rows are stored, one per event."""
    from fleetlens import session
    rows_of = []
    monkeypatch.setattr(session, "stored", lambda df: (rows_of.append((df.columns, df.groupBy("CompanyID", "TripEventID").count().agg(F.max("count")).first()[0])), df)[1])
    E.queries()["family_counters"](spark, SF_SMOKE)
    assert [("ppespeedmph" in cols, per_event <= (8 if "ppespeedmph" in cols else 1)) for cols, per_event in rows_of] == [(True, True), (False, True), (False, True)]


def test_sample_tasks_do_not_grow_with_the_table(spark, monkeypatch):
    from fleetlens.sources import fixtures
    monkeypatch.setattr(fixtures, "EVENTS_PER_TASK", 20)
    trips = fixtures.trip_events(spark, SF_SMOKE)
    samples = fixtures.pre_post_events(spark, SF_SMOKE, trips)
    assert samples.rdd.getNumPartitions() >= trips.count() / 20 and samples.count() == 84 * trips.count()


def test_stream_equals_batch(spark):
    q = E.queries()
    a = q["stream_scores"](spark, SF_SMOKE)
    b = q["overspeed_scores"](spark, SF_SMOKE)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_upsert_is_idempotent(spark):
    from fleetlens.operators.sinks import upsert_importance
    from fleetlens.plans.families import overspeed_job
    t = Telemetry.derive(spark, SF_SMOKE)
    src = overspeed_job(t)[0]
    once = upsert_importance(t.extra, src).cache()
    twice = upsert_importance(once, src)
    assert once.count() == twice.count() and once.exceptAll(twice).count() == 0


def test_weekly_report_single_week_matches_all_weeks(spark):
    import datetime as dt

    from fleetlens.operators.report import weekly_report
    from fleetlens.sources import fixtures
    t = Telemetry.derive(spark, SF_SMOKE)
    args = (t.extra, t.trips, t.event_dim, fixtures.event_classification(spark, SF_SMOKE, t.trips),
            fixtures.event_classification_type(spark, SF_SMOKE, t.trips))
    week = weekly_report(*args, as_of="2024-01-24")  # Wednesday -> window [Jan 14, Jan 21)
    allw = weekly_report(*args).where(F.col("week_end") == F.lit(dt.date(2024, 1, 21)))
    assert week.count() > 0 and week.exceptAll(allw).count() == 0 and allw.exceptAll(week).count() == 0


def test_versioned_table_reads_latest(spark, tmp_path):
    from fleetlens.operators.sinks import latest_version, save_version
    base = str(tmp_path / "extra")
    save_version(spark.createDataFrame([(1, 0.5)], "k int, s double"), base, "1")
    save_version(spark.createDataFrame([(1, 0.7), (2, 0.1)], "k int, s double"), base, "2")
    got = sorted(tuple(r) for r in latest_version(spark, base).collect())
    assert got == [(1, 0.7), (2, 0.1)]


def test_stream_outputs_merge_to_the_batch_result(spark, tmp_path):
    from fleetlens.operators.sinks import upsert_classification, upsert_importance
    from fleetlens.plans.families import overspeed_job
    from fleetlens.sources import fixtures
    from fleetlens.streaming.stream import merge_outputs, outputs, run_stream, stage_chunks
    t = Telemetry.derive(spark, SF_SMOKE)
    sink = str(tmp_path / "sink")
    stage_chunks(t.trips, str(tmp_path / "trips"), minutes=7 * 24 * 60)
    run_stream(spark, str(tmp_path / "trips"), t, sink, str(tmp_path / "ckpt"), overspeed_job, files_per_trigger=2).awaitTermination()
    progress = outputs(spark, sink, "progress").agg(F.sum("events"), F.sum("late")).first()
    assert progress[0] == t.trips.count()
    assert progress[1] == outputs(spark, sink, "late").count()
    classes = fixtures.event_classification(spark, SF_SMOKE, t.trips)
    types = fixtures.event_classification_type(spark, SF_SMOKE, t.trips)
    importance, labels = overspeed_job(t)
    got = merge_outputs(spark, sink, t.extra, classes, types)
    want = (upsert_importance(t.extra, importance), upsert_classification(classes, labels, types))
    for a, b in zip(got, want):
        assert a.count() == b.count() and a.select(*b.columns).exceptAll(b).count() == 0


def test_batch_run_reads_only_its_dates(spark, tmp_path):
    """With tables partitioned by date, a batch's filters reach both scans."""
    import datetime as dt

    from fleetlens.plans.batch import batch_telemetry
    t = Telemetry.derive(spark, SF_SMOKE)
    for name, df in (("trips", t.trips), ("samples", t.samples)):
        df.withColumn("day", F.to_date("Timestamp")).write.partitionBy("day").parquet(str(tmp_path / name))
    stored = Telemetry(trips=spark.read.parquet(str(tmp_path / "trips")), samples=spark.read.parquet(str(tmp_path / "samples")),
                       event_dim=t.event_dim, extra=t.extra)
    begin = dt.datetime(2024, 1, 20)
    part = batch_telemetry(stored, begin, begin + dt.timedelta(minutes=30))
    for df, col in ((part.trips, "CreatedDate"), (part.samples, "Timestamp")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        pushed = plan[plan.index("PushedFilters"):].split("]")[0] if "PushedFilters" in plan else "LocalTableScan"
        assert f"GreaterThanOrEqual({col}" in pushed and "LessThan" in pushed or "LocalTableScan" in plan
