"""Hand-written golden cases for the per-event operators (FIXTURES.md section 4)."""

import datetime as dt
import math

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from fleetlens_helpers import rows
from fleetlens.operators.dedup import kept_events, kept_events_fold
from fleetlens.operators.distance import distance_score, da_normalize, drop_joint_outliers, remove_noise
from fleetlens.operators.features import event_features, event_values
from fleetlens.operators.overspeed import nonsevere_clean, overspeed_scores
from fleetlens.operators.scoring import batch_zscore
from fleetlens.operators.signal import event_signal_features

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)
EV = "CompanyID int, VehicleID string, _bucket long, TripEventID string"


def _samples(spark, values: dict, event="e1", extra_schema=""):
    """One event whose samples are given column-wise; SecTimeSegment = -1, -0.75, ... by default."""
    n = len(next(iter(values.values())))
    secs = values.pop("SecTimeSegment", [i * 0.25 - 1 for i in range(n)])
    cols = list(values)
    data = [(1, "V1", 0, event, float(secs[i]), i, *[values[c][i] for c in cols]) for i in range(n)]
    schema = f"{EV}, SecTimeSegment double, ppe_n long, " + ", ".join(
        f"{c} {'int' if c == 'ppeAbs' else 'double'}" for c in cols)
    return spark.createDataFrame(data, schema)


def test_min_gap_greedy_golden(spark):
    ts = [0, 60, 61, 100, 122]
    df = spark.createDataFrame([(1, "V", f"e{s}", T0 + dt.timedelta(seconds=s)) for s in ts],
                               "CompanyID int, VehicleID string, TripEventID string, ts timestamp")
    kept = rows(kept_events(df, ["CompanyID", "VehicleID"], "ts", gap_s=60), "TripEventID")
    assert kept == [("e0",), ("e122",), ("e61",)]


def _greedy(times, gap):
    kept, last = [], None
    for t in sorted(times):
        if last is None or t - last > gap:
            kept.append(t)
            last = t
    return kept


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=3000), min_size=1, max_size=40, unique=True))
def test_min_gap_matches_sequential_loop(spark, times):
    df = spark.createDataFrame([(1, "V", f"e{t}", T0 + dt.timedelta(seconds=t)) for t in times],
                               "CompanyID int, VehicleID string, TripEventID string, ts timestamp")
    got = sorted(int(r["TripEventID"][1:]) for r in kept_events(df, ["CompanyID", "VehicleID"], "ts", gap_s=60).collect())
    assert got == _greedy(times, 60)
    fold = sorted(int(r["TripEventID"][1:]) for r in kept_events_fold(df, ["CompanyID", "VehicleID"], "ts", gap_s=60).collect())
    assert fold == got
    levels = sorted(int(r["TripEventID"][1:]) for r in kept_events(df, ["CompanyID", "VehicleID"], "ts", gap_s=60, gaps=1, fan_bits=1).collect())
    assert levels == got


def test_min_gap_of_dense_sparse_and_broken_timelines(spark):
    import random

    rng = random.Random(4)
    keys = {"dense": [i * 7 for i in range(3000)], "phases": [i * 60 for i in range(900)] + [i * 60 + 1 for i in range(900)],
            "sparse": [rng.randrange(10 ** 7) for _ in range(200)], "before 1970": [-10 ** 9 + rng.randrange(9000) for _ in range(900)],
            "bursts": [b * 5000 + rng.randrange(400) for b in range(40) for _ in range(30)]}
    data = [(k, f"{t}#{c}", t * 1_000_000) for k, ts in keys.items() for t in ts for c in range(rng.choice((1, 1, 2)))]
    data += [(None, "x", 0), ("dense", None, 0), ("dense", "no time", None)]
    df = spark.createDataFrame(data, "k string, id string, us long").select("k", "id", F.timestamp_micros("us").alias("ts"))
    want = sorted((k, t) for k, ts in keys.items() for t in _greedy(set(ts), 60))
    for gaps, fan_bits in ((8, 6), (1, 1), (3, 2)):
        got = [(r["k"], r["id"]) for r in kept_events(df, ["k"], "ts", "id", 60, gaps=gaps, fan_bits=fan_bits).collect()]
        assert sorted((k, int(i.split("#")[0])) for k, i in got) == want
        assert all(i.endswith("#0") for _, i in got)
    assert kept_events(df.where("false"), ["k"], "ts", "id", 60).count() == 0


def test_noise_run_drops_two_after_first(spark):
    flags = [0, 1, 1, 0, 0, 0, 0]
    df = _samples(spark, {"ppeSpeedforwardV": [0.0 if f else 50.0 for f in flags],
                          "ppeDistanceforwardV": [0.0 if f else 20.0 for f in flags],
                          "ppeSpeed": [60.0] * 7})
    kept = [r["ppe_n"] for r in remove_noise(df.withColumn("TripEventID", F.lit("e1"))).orderBy("ppe_n").collect()]
    assert kept == [0, 1, 5, 6]  # 1-based positions 3, 4, 5 dropped; first noisy sample kept


def test_outlier_in_one_signal_only_is_kept(spark):
    fs = [50.0, 51.0, 52.0, 50.0, 51.0, 500.0]
    fd = [20.0, 21.0, 20.0, 22.0, 21.0, 21.0]
    df = _samples(spark, {"ppeSpeedforwardV": fs, "ppeDistanceforwardV": fd, "ppeSpeed": [60.0] * 6})
    assert drop_joint_outliers(df).count() == 6
    fd2 = fd[:-1] + [900.0]
    df2 = _samples(spark, {"ppeSpeedforwardV": fs, "ppeDistanceforwardV": fd2, "ppeSpeed": [60.0] * 6})
    assert drop_joint_outliers(df2).count() == 5


def test_constant_distance_gives_no_da_score(spark):
    df = _samples(spark, {"ppeSpeedforwardV": [50.0, 60.0, 55.0], "ppeDistanceforwardV": [20.0, 20.0, 20.0],
                          "ppeSpeed": [60.0, 61.0, 62.0]})
    df = df.withColumns({"TripEventGuid": F.lit("g"), "DriverID": F.lit("D"), "CreatedDate": F.lit(T0),
                         "batch_start": F.lit(T0)})
    assert distance_score(da_normalize(df)).count() == 0


def test_haar_odd_length_and_stats(spark):
    df = _samples(spark, {"ppeTurningForce": [1.0, 2.0, 3.0], "ppeSpeed": [1.0] * 3, "ppeCurvature": [0.0] * 3,
                          "ppeBrakingForce": [0.0] * 3})
    f = event_signal_features(df, ["CompanyID", "VehicleID", "_bucket", "TripEventID"]).first()
    r2 = math.sqrt(2)
    assert f["wavelet_coeff_mean_0"] == pytest.approx(4.5)
    assert f["wavelet_coeff_mean_1"] == pytest.approx(-1.5)
    assert f["wavelet_coeff_min_2"] == pytest.approx(-1 / r2) and f["wavelet_coeff_max_2"] == pytest.approx(0.0)
    assert f["wavelet_coeff_std_0"] == 0.0


def test_haar_energy_preserved_even_length(spark):
    x = [0.3, -0.1, 0.25, 0.4, -0.2, 0.05, 0.15, 0.1]
    df = _samples(spark, {"ppeTurningForce": x, "ppeSpeed": [1.0] * 8, "ppeCurvature": [0.0] * 8,
                          "ppeBrakingForce": [0.0] * 8})
    from fleetlens.operators.signal import HAAR_UNITS, with_haar
    h = with_haar(df).agg(*[F.sum((F.col(c) / unit) ** 2).alias(c[1:]) for c, unit in HAAR_UNITS.items()]).first()
    assert h["cd1"] + h["ca2"] + h["cd2"] == pytest.approx(sum(v * v for v in x))


def test_zscore_population_and_constant(spark):
    df = spark.createDataFrame([(1, T0, 1.0, 5.0), (1, T0, 2.0, 5.0), (1, T0, 4.0, 5.0)],
                               "CompanyID int, batch_start timestamp, a double, c double")
    out = sorted(tuple(r) for r in batch_zscore(df, ["a", "c"]).select("a", "c").collect())
    sd = math.sqrt(((1 - 7 / 3) ** 2 + (2 - 7 / 3) ** 2 + (4 - 7 / 3) ** 2) / 3)
    assert sd == pytest.approx(1.2472, abs=1e-4)
    assert out[0][0] == pytest.approx((1 - 7 / 3) / sd) and all(c == 0.0 for _, c in out)


def _brake_event(spark, bf, speed=None, driver="D1", abs_=None):
    n = len(bf)
    secs = [float(s) for s in range(-5, -5 + n)]
    data = {"SecTimeSegment": secs, "ppeBrakingForce": bf, "ppeSpeed": speed or [50.0 + (i % 3) for i in range(n)],
            "ppeTurningForce": [0.1 * i for i in range(n)], "ppeCurvature": [0.0] * n, "ppeBrakePercentage": [0.0] * n}
    if abs_ is not None:
        data["ppeAbs"] = abs_
    df = _samples(spark, data)
    return df.withColumns({"TripEventGuid": F.lit("g1"), "DriverID": F.lit(driver), "CreatedDate": F.lit(T0),
                           "TripID": F.lit(7).cast("long"), "batch_start": F.lit(T0), "n": F.lit(1).cast("long"),
                           "EventID": F.lit(32), "isSevere": F.lit(0), "ppeTimeStamp": F.lit(T0),
                           "TimeSegment": F.col("SecTimeSegment").cast("string")})


def test_brake_interval_golden(spark):
    bf = [0.0, 0.0, 0.0, 0.5, 0.0, 0.0, 0.0, 0.0, 0.5, 0.0]  # on at -2 and +3
    v = event_values(_brake_event(spark, bf)).first()
    assert (v["Min_First_SecTimeSegment"], v["Max_Last_SecTimeSegment"]) == (-2.0, 3.0)
    never = event_values(_brake_event(spark, [0.0] * 10)).first()
    assert (never["Min_First_SecTimeSegment"], never["Max_Last_SecTimeSegment"]) == (10.0, -10.0)
    assert never["AfterZeroBrakeOnCount"] == 10 and never["BrakeOnCount"] == 0


def test_abs_runs(spark):
    v = event_values(_brake_event(spark, [0.0] * 8, abs_=[0, 1, 1, 0, 1, 0, 1, 1])).first()
    assert v["abscount"] == 3


def test_features_read_an_event_in_one_aggregate(spark):
    """Full rows that repeat count once, per-event values count every sample, and no window frame spans the event."""
    once = _brake_event(spark, [0.2, 0.0] * 5)
    src = once.unionByName(once).unionByName(once.where("SecTimeSegment > 1"))
    plan = event_features(src)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "unboundedfollowing" not in plan.split("HashAggregate")[-1].lower()
    assert event_values(src).first()["AfterZeroBrakeOnCount"] == 23
    row = event_features(once.unionByName(once.withColumn("TripEventID", F.lit("e2")))).orderBy("TripEventID").collect()
    assert len(row) == 2 and row[0]["AbsDiffBrakingForcesum"] == row[1]["AbsDiffBrakingForcesum"] == pytest.approx(1.0)
    other = once.withColumns({"TripEventGuid": F.lit("g2"), "ppe_n": F.col("ppe_n") + 1000})
    two = event_values(once.unionByName(other)).collect()  # one event id, two guids: both rows see the whole event
    assert [r["AfterZeroBrakeOnCount"] for r in two] == [20, 20]


def test_feature_row_needs_driver_and_post_event_change(spark):
    assert event_features(_brake_event(spark, [0.2] * 10, driver=None)).count() == 0
    assert event_features(_brake_event(spark, [0.2] * 10, speed=[60.0] * 10)).count() == 0
    assert event_features(_brake_event(spark, [0.2] * 10)).count() == 1


def test_overspeed_tie_and_null_limit(spark):
    df = spark.createDataFrame(
        [(1, "V", 0, "a", "g", "D", T0, T0, 12.0), (1, "V", 0, "a", "g", "D", T0, T0, 12.0),
         (1, "V", 0, "b", "g", "D", T0, T0, None)],
        f"{EV}, TripEventGuid string, DriverID string, CreatedDate timestamp, batch_start timestamp, speedoverlimitmph double")
    got = overspeed_scores(df).collect()
    assert [(r["TripEventID"], r["score"]) for r in got] == [("a", 0.8)]  # 0.7 + 0.24/4.99 * 2 = 0.796


def test_nonsevere_fallback_rules(spark):
    df = spark.createDataFrame([(70.0, 0.0), (60.0, 0.0), (50.0, 0.0), (70.0, None), (70.0, 63.0)],
                               "tespeedmph double, speedlimitmph double")
    got = [r["speedoverlimitmph"] for r in nonsevere_clean(df).collect()]
    assert got == [5.0, 5.0, 0.0, 0.0, 5.0]


def _repeat_loop(times_days):
    """Running 3-in-7-days count by date with reset after a 7-day gap (the rule, written as a loop)."""
    ts = [int(t) for t in sorted(times_days)]
    out, count = [], 0
    for i, t in enumerate(ts):
        score = 0
        if i >= 2 and t - ts[i - 2] <= 7:
            count += 1
            score = count
        elif i > 0 and t - ts[i - 1] > 7:
            count = 0
        out.append(score)
    return ts, out


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=24 * 60), min_size=3, max_size=30, unique=True))
def test_repeat_counts_blocked_scan_matches_loop(spark, hours):
    from fleetlens.operators.repeat import repeat_counts
    days = [h / 8.0 for h in hours]  # spread over ~180 days, gaps above and below 7 days
    data = [(1, "V", "D", f"e{i:03d}", "g", T0, dt.datetime(2024, 1, 1) + dt.timedelta(days=d)) for i, d in enumerate(sorted(days))]
    cand = spark.createDataFrame(data, "CompanyID int, VehicleID string, DriverID string, TripEventID string, "
                                       "TripEventGuid string, CreatedDate timestamp, EventTimeStamp timestamp")
    got = {r["TripEventID"]: r["repeat_count"] for r in repeat_counts(cand).collect()}
    _, want = _repeat_loop(sorted(days))
    want_pos = {f"e{i:03d}": c for i, c in enumerate(want) if c > 0}
    assert got == want_pos


def test_repeat_counts_are_by_calendar_date(spark):
    """Day 1 at 01:00, day 4, day 8 at 23:00: seven dates apart, so the third event counts."""
    from fleetlens.operators.repeat import repeat_counts
    at = [dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 4), dt.datetime(2024, 1, 8, 23)]
    data = [(1, "V", "D", f"e{i}", "g", T0, t) for i, t in enumerate(at)]
    cand = spark.createDataFrame(data, "CompanyID int, VehicleID string, DriverID string, TripEventID string, "
                                       "TripEventGuid string, CreatedDate timestamp, EventTimeStamp timestamp")
    assert [(r["TripEventID"], r["repeat_count"]) for r in repeat_counts(cand).collect()] == [("e2", 1)]


def test_upsert_stops_on_duplicate_keys(spark):
    from fleetlens.operators.sinks import resolve_labels, upsert
    target = spark.createDataFrame([(1, "a", 0.5)], "id int, g string, v double")
    twice = spark.createDataFrame([(2, "b", 0.1), (2, "B", 0.2)], "id int, g string, v double")
    merged = upsert(target, twice, ["id", "g"], {"v": "v"}, casefold=("g",))
    assert "raise_error" in merged._jdf.queryExecution().optimizedPlan().toString()
    with pytest.raises(Exception, match="more than one row"):
        merged.select("v").collect()
    nulls = spark.createDataFrame([(None, "b", 0.1), (None, "b", 0.2)], "id int, g string, v double")
    assert upsert(target, nulls, ["id", "g"], {"v": "v"}).count() == 3
    labels = spark.createDataFrame([(1, "V", "D", "e", "L", T0, "x")], "CompanyID int, VehicleID string, DriverID string, "
                                   "TripEventID string, ClassificationName string, Timestamp timestamp, By string")
    types = spark.createDataFrame([(1, 1, "L"), (1, 2, "L")], "CompanyID int, Type int, Name string")
    with pytest.raises(Exception, match="more than one row"):
        resolve_labels(labels, types).collect()


def test_missing_columns_are_all_named(spark):
    from fleetlens.operators.distance import REQUIRED, require_columns
    full = spark.createDataFrame([(0,) * len(REQUIRED)], ", ".join(f"{c} int" for c in REQUIRED))
    require_columns(full)
    first, second = sorted(REQUIRED)[:2]
    with pytest.raises(ValueError, match=f"{first}, {second}"):
        require_columns(full.drop(first, second))


def test_routing_misses_are_kept_apart(spark):
    from fleetlens.operators.routing import split_routed
    routed = spark.createDataFrame([(1, "server-a"), (2, None)], "CompanyID int, Server string")
    hit, miss = split_routed(routed)
    assert [r[0] for r in hit.collect()] == [1] and [r[0] for r in miss.collect()] == [2]


def test_constant_column_rule_and_null_flag(spark):
    from fleetlens.operators.scoring import batch_zscore, scope_stats
    rows = [(1, 1e9 + i * 1e-3, 5.0, None if i == 2 else 1.0) for i in range(4)]
    df = spark.createDataFrame(rows, "CompanyID int, big double, same double, holes double")
    got = batch_zscore(df, ["big", "same", "holes"], scope=("CompanyID",), had_null="had_null").orderBy("had_null", "big").collect()
    assert [r["had_null"] for r in got] == [False, False, False, True]
    assert max(abs(r["big"]) for r in got) > 1  # varies by a 1e-12 part of its mean: no constant
    assert {r["same"] for r in got} == {0.0}
    fitted = scope_stats(spark.createDataFrame([(1, 0.0), (1, 2.0)], "CompanyID int, big double"), ["big"], ("CompanyID",))
    assert batch_zscore(df.limit(1), ["big"], ("CompanyID",), fitted=fitted).first()["big"] == pytest.approx(1e9 - 1)


def test_statistics_have_the_same_bits_in_any_order(spark):
    from fleetlens.operators.scoring import batch_zscore
    from fleetlens.operators.signal import ECS_FEATURES, event_signal_features
    n = 40
    x = {"ppeTurningForce": [((i * 23) % 100 - 50) / 100 for i in range(n)], "ppeSpeed": [float(80 + i * 13 % 23) for i in range(n)],
         "ppeCurvature": [((i * 5) % 60 - 30) / 10 for i in range(n)], "ppeBrakingForce": [0.05] * n}
    one = _samples(spark, x)
    events = one.unionByName(one.withColumn("TripEventID", F.lit("other")).withColumn("ppeSpeed", F.col("ppeSpeed") + 0.3))
    seen = set()
    for partitions in (1, 8, 200):
        shuffled = events.orderBy(F.rand(partitions)).repartition(partitions)
        feats = event_signal_features(shuffled).withColumn("scope", F.lit(1))
        z = batch_zscore(feats, ECS_FEATURES, scope=("scope",)).orderBy("TripEventID").select(*ECS_FEATURES)
        seen.add(tuple(map(tuple, feats.orderBy("TripEventID").select(*ECS_FEATURES).collect())) + tuple(map(tuple, z.collect())))
    assert len(seen) == 1
    first = next(iter(seen))[0]
    assert first[ECS_FEATURES.index("ppeBrakingForce_std")] == 0.0 and first[ECS_FEATURES.index("ppeBrakingForce_mean")] == 0.05
