"""Golden values for the scalar column functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetlens.functions.columns import (curve_cmb, curve_ecs, curve_esprsp, curve_nonsevere, curve_overspeed,
                                         event_code, label_band, seconds_between, snap_limit, week_end)
from fleetlens.schema import LABEL_HIGH, LABEL_LOW, LABEL_MID


def _one(spark, expr, value, typ="double"):
    if typ == "double" and value is not None:
        value = float(value)
    return spark.createDataFrame([(value,)], f"v {typ}").select(expr(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("lim,want", [(62, 60), (63, 65), (65, 65), (67, 65), (68, 70), (None, None)])
def test_snap_limit(spark, lim, want):
    assert _one(spark, snap_limit, lim) == want


@pytest.mark.parametrize("over,want", [(4.99, 0.0), (5, 0.5), (9.99, 0.69), (10, 0.7), (15, 0.95), (34, 1.0), (40, 1.02)])
def test_overspeed_curve(spark, over, want):
    assert _one(spark, curve_overspeed, over) == pytest.approx(want)


def test_nonsevere_curve_uncapped(spark):
    assert _one(spark, curve_nonsevere, 0.0) == 0.0
    assert _one(spark, curve_nonsevere, 50.0) == pytest.approx(1.1)


@pytest.mark.parametrize("score,want", [(0.5, None), (1, "Pre-Grouped (Low)"), (39, "Pre-Grouped (Low)"),
                                        (39.5, None), (40, "Pre-Grouped (Mid)"), (69.5, None),
                                        (70, "Pre-Grouped (High)"), (100, "Pre-Grouped (High)"), (100.5, None)])
def test_label_band_gaps(spark, score, want):
    assert _one(spark, label_band, score) == want


@pytest.mark.parametrize("score,want", [(0.99, None), (1.0, LABEL_LOW), (39.5, LABEL_LOW), (40.0, LABEL_MID), (69.9, LABEL_MID), (70.0, LABEL_HIGH),
                                        (100.0, LABEL_HIGH), (100.1, None), (None, None)])
def test_label_band_contiguous(spark, score, want):
    got = _one(spark, lambda c: label_band(c, "contiguous"), score)
    assert got == want and (score is None or _one(spark, label_band, score) in (want, None))



def test_event_code_unsigned(spark):
    assert _one(spark, event_code, "90000002_17", "string") == 2415919106
    assert _one(spark, event_code, "00008000_5", "string") == 32768


def test_ml_curves(spark):
    df = spark.createDataFrame([(0.7, 32), (0.69, 32), (0.6, 32), (0.6, 1024), (0.3, 131072), (0.5, 32768), (0.5, 7)],
                               "p double, code long")
    out = df.select(curve_ecs("p").alias("e"), curve_cmb("p", "code").alias("c"), curve_esprsp("p", "code").alias("s")).collect()
    assert out[0]["e"] == pytest.approx(50.0)
    assert out[1]["e"] == pytest.approx(1 + 68 * 39 / 70)
    assert out[2]["c"] == pytest.approx(50.0) and out[3]["c"] == pytest.approx(70.0)
    assert out[4]["s"] == pytest.approx(25.0) and out[5]["s"] == pytest.approx(82.5) and out[6]["s"] is None


def test_seconds_between_counts_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0, 900000), dt.datetime(2024, 1, 1, 0, 0, 1, 100000))],
                               "a timestamp, b timestamp")
    assert df.select(seconds_between("a", "b").alias("d")).first()["d"] == 1


def test_week_end_sunday(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 21),), (dt.date(2024, 1, 24),)], "d date")
    got = [r["w"] for r in df.select(week_end("d").alias("w")).collect()]
    assert got == [dt.date(2024, 1, 21), dt.date(2024, 1, 21)]
