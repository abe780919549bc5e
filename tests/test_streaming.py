"""Ordered chunks, the stream-stream join and the streaming dedup under disordered arrival."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fleetlens.operators.interval_join import interval_join
from fleetlens.sources.ordered import CHUNK, on_time, read_ordered, stage_by_time
from fleetlens.streaming.dedup import run_dedup_stream, stage_arrivals
from fleetlens.streaming.join import drain, run_join_stream

T0 = dt.datetime(2024, 3, 4)
DAY = 86_400


def at(s):
    return T0 + dt.timedelta(seconds=s)


def write_chunk_by_chunk(df, path, ts, width_s, seed):
    """The files of the chunks written in a shuffled order, as back-fills and second waves of tasks do."""
    from fleetlens.sources.ordered import chunk_start
    staged = df.withColumn(CHUNK, chunk_start(ts, width_s))
    names = [r[0] for r in staged.select(CHUNK).distinct().collect()]
    random.Random(seed).shuffle(names)
    for name in names:
        staged.where(F.col(CHUNK) == name).repartition(3).write.mode("append").partitionBy(CHUNK).parquet(path)


@pytest.fixture(scope="module")
def tables(spark):
    r = random.Random(4)
    events = [(1, f"V{r.randrange(3)}", f"e{i}", at(r.randrange(6 * DAY) if i % 10 else (i // 10 % 5 + 1) * DAY - 3)) for i in range(60)]
    samples = [(1, v, t + dt.timedelta(seconds=k), 1) for _, v, _, t in events for k in range(-12, 13)]
    ev = spark.createDataFrame(events, "CompanyID int, VehicleID string, TripEventID string, EventTimeStamp timestamp")
    sm = spark.createDataFrame(samples, "CompanyID int, VehicleID string, ppeTimeStamp timestamp, SequenceID int")
    return ev.cache(), sm.cache()


@pytest.mark.parametrize("seed", range(3))
def test_join_loses_nothing_in_any_file_order(spark, tables, tmp_path, seed):
    ev, sm = tables
    write_chunk_by_chunk(ev.where("EventTimeStamp < '2024-03-06' OR EventTimeStamp >= '2024-03-07'"), str(tmp_path / "e"), "EventTimeStamp", DAY, seed)
    write_chunk_by_chunk(sm, str(tmp_path / "s"), "ppeTimeStamp", DAY, seed + 10)
    joined, aside = run_join_stream(spark, str(tmp_path / "e"), str(tmp_path / "s"), str(tmp_path), -11, 11, DAY, 60)
    cols = ["TripEventID", "ppeTimeStamp", "SecTimeSegment"]
    want = interval_join(ev.where("EventTimeStamp < '2024-03-06' OR EventTimeStamp >= '2024-03-07'"), sm.withColumn("ppe_n", F.lit(0)), -11, 11)
    assert sorted(map(tuple, joined.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    assert aside.count() == 0


def test_late_rows_are_set_aside_and_the_rest_joins(spark, tables, tmp_path):
    ev, sm = tables
    late = F.col("TripEventID").isin("e3", "e7")
    arrival = F.when(late, F.col("EventTimeStamp") + F.expr("INTERVAL 2 DAYS")).otherwise(F.col("EventTimeStamp"))
    stage_by_time(ev, str(tmp_path / "e"), arrival, DAY)
    stage_by_time(sm, str(tmp_path / "s"), "ppeTimeStamp", DAY)
    joined, aside = run_join_stream(spark, str(tmp_path / "e"), str(tmp_path / "s"), str(tmp_path), -11, 11, DAY, 60)
    assert [r["side"] for r in aside.collect()] == ["events"] * 2
    want = interval_join(ev.where(~late), sm.withColumn("ppe_n", F.lit(0)), -11, 11)
    assert joined.count() == want.count()


def test_a_restarted_stream_goes_on_after_its_last_chunk(spark, tmp_path):
    rows = spark.createDataFrame([(i, at(i * DAY)) for i in range(4)], "n int, ts timestamp")
    run = {"sink": str(tmp_path / "sink"), "checkpoint": str(tmp_path / "ck")}
    stage_by_time(rows.where("n IN (0, 2)"), str(tmp_path / "in"), "ts", DAY)
    drain(spark, read_ordered(spark, str(tmp_path / "in"), progress=str(tmp_path / "progress")), **run)
    rows.where("n = 3").withColumn(CHUNK, F.lit(int((T0 - dt.datetime(1970, 1, 1)).total_seconds()) + 3 * DAY)).write.mode("append").partitionBy(CHUNK).parquet(str(tmp_path / "in"))
    drain(spark, read_ordered(spark, str(tmp_path / "in"), progress=str(tmp_path / "progress")), **run)
    assert sorted(r["n"] for r in spark.read.parquet(run["sink"]).collect()) == [0, 2, 3]


def test_dedup_of_disordered_arrival_equals_the_fold(spark, tmp_path):
    r = random.Random(8)
    rows = [(v % 2, f"V{v}", f"t{v}-{i}", at(r.randrange(3 * DAY // 60) * 60)) for v in range(4) for i in range(60)]
    trips = spark.createDataFrame(rows, "CompanyID long, VehicleID string, TripEventID string, Timestamp timestamp")
    jitter = F.timestamp_seconds(F.unix_timestamp("Timestamp") + F.pmod(F.hash("TripEventID"), F.lit(600)))
    late = F.col("TripEventID") == "t1-5"
    stage_arrivals(trips, str(tmp_path / "in"), F.when(late, F.col("Timestamp") + F.expr("INTERVAL 5 DAYS")).otherwise(jitter), DAY, 660)
    kept, aside = run_dedup_stream(spark, str(tmp_path / "in"), str(tmp_path), 3600, DAY, 660)
    want = set()
    for v in range(4):
        last = None
        for _, _, i, t in sorted((x for x in rows if x[1] == f"V{v}" and x[2] != "t1-5"), key=lambda x: (x[3], x[2])):
            if last is None or (t - last).total_seconds() > 3600:
                want.add(i)
                last = t
    assert {x["TripEventID"] for x in kept.collect()} == want
    assert [x["TripEventID"] for x in aside.collect()] == ["t1-5"]


@pytest.mark.parametrize("shards", [1, 3])
def test_vehicles_that_share_a_shard_are_folded_apart(spark, tmp_path, shards):
    """A few calls serve many vehicles; a vehicle name of two companies and null keys stay apart too."""
    r = random.Random(9)
    rows = [(c, v, f"t{c}-{v}-{i}", at(r.randrange(3 * DAY // 60) * 60)) for c in (1, 2, None) for v in ("V1", "V2", "V3") for i in range(30)]
    trips = spark.createDataFrame(rows, "CompanyID long, VehicleID string, TripEventID string, Timestamp timestamp")
    stage_arrivals(trips, str(tmp_path / "in"), F.timestamp_seconds(F.unix_timestamp("Timestamp") + F.pmod(F.hash("TripEventID"), F.lit(600))), DAY, 660)
    kept, _ = run_dedup_stream(spark, str(tmp_path / "in"), str(tmp_path), 3600, DAY, 660, shards=shards)
    want, last = set(), {}
    for c, v, i, t in sorted(rows, key=lambda x: (x[3], x[2])):
        if (c, v) not in last or (t - last[c, v]).total_seconds() > 3600:
            want.add((c, v, i))
            last[c, v] = t
    assert {tuple(x)[:3] for x in kept.collect()} == want
    assert dict(kept.dtypes)["CompanyID"] == "bigint"


def test_rows_on_time_lie_within_the_slack(spark):
    base = int((T0 - dt.datetime(1970, 1, 1)).total_seconds())
    df = spark.createDataFrame([(base, at(s)) for s in (-61, -60, 0, DAY + 59, DAY + 60)], "chunk long, ts timestamp")
    assert [r[0] for r in df.select(on_time("ts", DAY, 60)).collect()] == [False, True, True, True, False]


def test_join_keeps_only_rows_that_can_meet_a_later_chunk(spark, tables, tmp_path):
    """What a micro-batch leaves for the next one is bounded by the range and the slack, not by the chunk."""
    ev, sm = tables
    stage_by_time(ev, str(tmp_path / "e"), "EventTimeStamp", DAY)
    stage_by_time(sm, str(tmp_path / "s"), "ppeTimeStamp", DAY)
    run_join_stream(spark, str(tmp_path / "e"), str(tmp_path / "s"), str(tmp_path), -11, 11, DAY, 60)
    base = int((T0 - dt.datetime(1970, 1, 1)).total_seconds())
    for side, ts, df in (("events", "EventTimeStamp", ev), ("samples", "ppeTimeStamp", sm)):
        kept = spark.read.parquet(str(tmp_path / f"kept-{side}"))
        assert 0 < kept.count() < df.count() / 3
        left = kept.select(F.pmod(F.lit(base) - F.unix_timestamp(ts), F.lit(DAY)).alias("left"), "batch_id").collect()
        assert all(r["left"] <= 60 + 11 or r["left"] >= DAY - 60 for r in left)


def test_chunks_have_the_files_that_their_rows_need(spark, tmp_path, monkeypatch):
    """Their number does not grow with the tasks of the scan: each four files are a micro-batch."""
    from fleetlens.streaming import stream

    trips = spark.createDataFrame([(i, at(i * 600)) for i in range(1000)], "n int, CreatedDate timestamp").repartition(7)
    files = lambda path: [(f.parent.name, f.name) for f in path.glob("*/*.parquet")]
    stream.stage_chunks(trips, str(tmp_path / "a"))
    assert len(files(tmp_path / "a")) == 7 and spark.read.parquet(str(tmp_path / "a")).count() == 1000
    monkeypatch.setattr(stream, "EVENTS_PER_FILE", 100)
    stream.stage_chunks(trips, str(tmp_path / "b"))
    assert 10 <= len(files(tmp_path / "b")) <= 17 and spark.read.parquet(str(tmp_path / "b")).count() == 1000


def test_a_micro_batch_reads_the_samples_of_its_dates_only(spark, tables, tmp_path):
    from fleetlens.plans.batch import samples_near
    from fleetlens.streaming.stream import stage_samples

    ev, sm = tables
    sm, trips = (df.withColumnRenamed(c, "Timestamp") for df, c in ((sm, "ppeTimeStamp"), (ev, "EventTimeStamp")))
    part = trips.where("Timestamp < '2024-03-05'")
    near = samples_near(stage_samples(sm, str(tmp_path / "s")), part)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert near.select("Timestamp").distinct().count() == samples_near(sm, part).select("Timestamp").distinct().count() > 0
