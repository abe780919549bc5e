"""Driver-behaviour features of brake / collision events (CMB and ESP-RSP families).

One ordered Window per event (``EVENT_PART`` by ``SecTimeSegment``, ``ppe_n``) carries every
neighbour-based column (lag / lead deltas, centred and trailing deviations, rising edges); one hash
aggregate then makes the per-event values and the features, so a single sort serves all of them and
the interval join's partitioning is reused (no shuffle after the join).

Row sets, as in the scored system:
* per-event values (phase first/last speeds, brake interval, counts, extrema, deviation sums)
  use *all* samples of the event;
* the final aggregate runs over the samples at or after 0 s whose speed changed from the
  previous sample (full-row distinct first); events without such a sample produce no row.
Events with a null DriverID or TripID are dropped (they never reach the feature frame).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetlens.operators.interval_join import EVENT_PART

ORDER = ("SecTimeSegment", "ppe_n")
EVENT_KEYS = ["CompanyID", "VehicleID", "DriverID", "TripEventID", "TripEventGuid", "CreatedDate"]

# ---- fixed values: model input names and drop lists, in output order
FEATURES = (
    "AbsVal_TF_Moving_Deltamean", "AbsVal_TF_Moving_Deltasum", "AbsVal_TF_Moving_Deltastd", "ppeSpeedmin",
    "AbsDiffBrakingForcemean", "AbsDiffBrakingForcesum", "AbsDiffBrakingForcestd", "AbsDiffBrakingForcemax",
    "SpeedChangemax", "DeltaSpeedBeforeZeromax", "DeltaSpeedAfterZeromax", "DeltaSpeedRatiomax",
    "Max_Last_SecTimeSegmentmax", "AfterZeroBrakeOnCountfirst", "Sum_CenterDifferenceDeviationmax",
    "Max_CenterDifferenceDeviationmax", "Max_CenterDifferenceDeviationfirst", "Sum_TFCenterDeviationmax",
    "EndSpeedOverStartSpeedmin", "SICmax", "Max_AbsValTurningForcefirst", "Max_AbsValBrakingForcefirst",
    "Max_TFCenterDeviationmax", "Sum_BFCenterDeviationmax", "Max_BFCenterDeviationmax",
)
# model inputs after each family's drop list
CMB_DROPPED = ("DeltaSpeedAfterZeromax", "DeltaSpeedBeforeZeromax", "AbsVal_TF_Moving_Deltasum",
               "DeltaSpeedRatiomax", "EndSpeedOverStartSpeedmin", "ppeSpeedmin")
ESP_DROPPED = ("DeltaSpeedRatiomax", "EndSpeedOverStartSpeedmin", "AfterZeroBrakeOnCountfirst")
CMB_MODEL_INPUTS = tuple(f for f in FEATURES if f not in CMB_DROPPED)
ESP_MODEL_INPUTS = tuple(f for f in FEATURES + ("abscountlast",) if f not in ESP_DROPPED)

# ----

# columns that make a sample row distinct inside one event (besides the event keys)
_ROW_COLS = ["ppeTimeStamp", "TimeSegment", "SecTimeSegment", "ppeSpeed", "ppeBrakingForce", "ppeTurningForce",
             "ppeCurvature", "ppeBrakePercentage", "PrevTF", "PrevPrevTF", "CenterDifferenceDeviation",
             "AbsVal_TF_Moving_Delta", "AbsDiffBrakingForce", "SpeedChange"]


def _w() -> Window:
    return Window.partitionBy(*EVENT_PART).orderBy(*ORDER)


def with_deltas(src: DataFrame) -> DataFrame:
    """Row-level neighbour columns (W1-W4); null where the neighbour is outside the event."""
    keep = F.col("TripID").isNotNull()
    for k in EVENT_KEYS:
        keep = keep & F.col(k).isNotNull()
    df = src.where(keep)
    w = _w()
    sp, tf, bf = F.col("ppeSpeed"), F.col("ppeTurningForce"), F.col("ppeBrakingForce")
    lag = lambda c, k=1: F.lag(c, k).over(w)
    cols = {
        "AbsValTurningForce": F.abs(tf),
        "AbsValBrakingForce": F.abs(bf),
        "PrevTF": lag("ppeTurningForce"),
        "PrevPrevTF": lag("ppeTurningForce", 2),
        "CenterDifferenceDeviation": F.abs(sp - F.lit(0.5) * (lag("ppeSpeed") + F.lead("ppeSpeed").over(w))),
        "AbsVal_TF_Moving_Delta": F.abs(tf - lag("ppeTurningForce")),
        "AbsDiffBrakingForce": F.abs(bf - lag("ppeBrakingForce")),
        "SpeedChange": F.abs(sp - lag("ppeSpeed")),
        "TFCenterDeviation": F.abs(lag("ppeTurningForce") - F.lit(0.5) * (tf + lag("ppeTurningForce", 2))),
        "BFCenterDeviation": F.abs(lag("ppeBrakingForce") - F.lit(0.5) * (bf + lag("ppeBrakingForce", 2))),
    }
    if "ppeAbs" in src.columns:
        cols["_abs_rise"] = F.when((F.col("ppeAbs") == 1) & ~F.coalesce(lag("ppeAbs") == 1, F.lit(False)), 1).otherwise(0)
    return df.withColumns(cols)


def _phase(name: str, x: str, cond: Column) -> dict[str, tuple]:
    """First and last ``x`` where ``cond``, each with its row number: (aggregate, how it is merged)."""
    rn = F.when(cond & F.col(x).isNotNull(), F.col("_rn")) if cond is not None else F.col("_rn")
    return {f"_{name}_first": (F.min_by(F.col(x), rn), lambda c: F.min_by(c, f"_{name}_lo")),
            f"_{name}_last": (F.max_by(F.col(x), rn), lambda c: F.max_by(c, f"_{name}_hi")),
            f"_{name}_lo": (F.min(rn), F.min), f"_{name}_hi": (F.max(rn), F.max)}


def _event_parts(with_abs: bool) -> dict[str, tuple]:
    """Aggregates of an event's samples, each with the function that merges it: name -> (aggregate, merge)."""
    sec, absbf = F.col("SecTimeSegment"), F.col("AbsValBrakingForce")
    out = {
        **_phase("before", "ppeSpeed", sec < 0), **_phase("after", "ppeSpeed", sec >= 0),
        **_phase("any", "ppeSpeed", F.lit(True)), **_phase("ends", "ppeSpeed", None),
        "_on_first": (F.min(F.when(absbf > 0.1, sec)), F.min), "_on_last": (F.max(F.when(absbf > 0.1, sec)), F.max),
        "_any_off": (F.max(F.when(absbf <= 0.1, 1)), F.max),
        "AfterZeroBrakeOnCount": (F.count(absbf), F.sum),
        "BrakeOnCount": (F.count(F.when(absbf > 0.1, 1)), F.sum),
        "Max_AbsValTurningForce": (F.max("AbsValTurningForce"), F.max),
        "Max_AbsValBrakingForce": (F.max("AbsValBrakingForce"), F.max),
        "Sum_CenterDifferenceDeviation": (F.sum("CenterDifferenceDeviation"), F.sum),
        "Max_CenterDifferenceDeviation": (F.max("CenterDifferenceDeviation"), F.max),
        "Sum_TFCenterDeviation": (F.sum("TFCenterDeviation"), F.sum),
        "Max_TFCenterDeviation": (F.max("TFCenterDeviation"), F.max),
        "Sum_BFCenterDeviation": (F.sum("BFCenterDeviation"), F.sum),
        "Max_BFCenterDeviation": (F.max("BFCenterDeviation"), F.max),
        "SIC": (F.count(F.when((sec >= 0) & (F.col("SpeedChange") > 0), 1)), F.sum),
    }
    return out | ({"abscount": (F.sum("_abs_rise"), F.sum)} if with_abs else {})


def _per_event(rows: DataFrame, keys: list[str], others: dict[str, Column] | None = None) -> DataFrame:
    """One row per ``keys`` (which start with ``EVENT_PART``): the per-event values (A2-A8, A17), and ``others``.

    The samples of an event are read once, in one hash aggregate whose buffers are numbers: first and
    last go by the row number. Rows that differ in the other keys share the values of their event,
    so the parts are merged per ``EVENT_PART``: a window over one row per event.
    """
    parts = _event_parts("_abs_rise" in rows.columns)
    one = rows.groupBy(*keys).agg(*[agg.alias(c) for c, (agg, _) in parts.items()], *[c.alias(n) for n, c in (others or {}).items()])
    event = Window.partitionBy(*EVENT_PART)
    out = one.withColumns({c: merge(c).over(event) for c, (_, merge) in parts.items()})
    cols = {
        "DeltaSpeedBeforeZero": F.col("_before_first") - F.col("_before_last"),
        "DeltaSpeedAfterZero": F.col("_after_first") - F.col("_after_last"),
        "EndSpeedOverStartSpeed": F.try_divide("_ends_last", "_ends_first"),
        "SpeedChangeEnds": F.abs(F.col("_ends_last") - F.col("_ends_first")),
        "Min_First_SecTimeSegment": F.least("_on_first", F.when(F.col("_any_off") == 1, F.lit(10.0))),
        "Max_Last_SecTimeSegment": F.greatest("_on_last", F.when(F.col("_any_off") == 1, F.lit(-10.0))),
        "Last_PPESpeed": F.col("_any_last"),
        **{c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("Sum_CenterDifferenceDeviation", "Sum_TFCenterDeviation", "Sum_BFCenterDeviation")},
    }
    out = out.withColumns(cols).drop(*[c for c in parts if c.startswith("_")])
    return out.withColumn("DeltaSpeedRatio", F.try_divide(F.col("DeltaSpeedBeforeZero"),
                                                          F.lit(0.001) + F.col("DeltaSpeedAfterZero")))


def _numbered(src: DataFrame) -> DataFrame:
    return with_deltas(src).withColumn("_rn", F.row_number().over(_w()))


def event_values(src: DataFrame) -> DataFrame:
    """One row per event with every per-event value (for inspection and the single-feature keys)."""
    return _per_event(_numbered(src), [*EVENT_PART, *[k for k in EVENT_KEYS if k not in EVENT_PART]])


def _repeats(rows: DataFrame, const: list[str], cols: list[str]) -> Column:
    """Whether an earlier row of the event has the same ``const`` and ``cols``.

    Equal rows have one ``SecTimeSegment``: only the earlier rows of that quarter second are looked at
    (a sample or two, more where a vehicle's events overlap), on the window's own order.
    """
    row = F.struct(*[F.col(c) for c in (*const, *cols) if c not in (*EVENT_PART, "SecTimeSegment")])
    tie = Window.partitionBy(*EVENT_PART, "SecTimeSegment").orderBy("ppe_n").rowsBetween(Window.unboundedPreceding, -1)
    return F.array_contains(F.collect_set(row).over(tie), row)


def event_features(src: DataFrame) -> DataFrame:
    """The per-event feature vector (25 features; ESP-RSP adds ``abscountlast``).

    Sums and extrema over the samples that moved count each full row once: what identifies a row are
    the event's constants, the sample's values and the lag columns, not the sample's source id.
    """
    rows = _numbered(src)
    has_abs = "_abs_rise" in rows.columns
    row_cols = [c for c in _ROW_COLS + ["ppeAbs", "ppeDistanceForwardVehicle"] if c in rows.columns]
    keys = [*EVENT_PART, *[k for k in EVENT_KEYS if k not in EVENT_PART], "batch_start", "n", "EventID"]
    rows = rows.withColumn("_again", _repeats(rows, [*keys, "isSevere"], row_cols))
    moved = (F.col("SecTimeSegment") >= 0) & (F.col("SpeedChange") > 0) & ~F.col("_again")
    of = lambda c: F.when(moved, F.col(c))
    others = {
        "_moved": F.count(F.when(moved, 1)),
        "AbsVal_TF_Moving_Deltamean": F.avg(of("AbsVal_TF_Moving_Delta")),
        "AbsVal_TF_Moving_Deltasum": F.coalesce(F.sum(of("AbsVal_TF_Moving_Delta")), F.lit(0.0)),
        "AbsVal_TF_Moving_Deltastd": F.stddev_samp(of("AbsVal_TF_Moving_Delta")),
        "ppeSpeedmin": F.min(of("ppeSpeed")),
        "AbsDiffBrakingForcemean": F.avg(of("AbsDiffBrakingForce")),
        "AbsDiffBrakingForcesum": F.coalesce(F.sum(of("AbsDiffBrakingForce")), F.lit(0.0)),
        "AbsDiffBrakingForcestd": F.stddev_samp(of("AbsDiffBrakingForce")),
        "AbsDiffBrakingForcemax": F.max(of("AbsDiffBrakingForce")),
        "SpeedChangemax": F.max(of("SpeedChange")),
        "isSeverefirst": F.min("isSevere"),
    }
    out = _per_event(rows, keys, others).where(F.col("_moved") > 0)
    values = {
        "DeltaSpeedBeforeZeromax": "DeltaSpeedBeforeZero", "DeltaSpeedAfterZeromax": "DeltaSpeedAfterZero",
        "DeltaSpeedRatiomax": "DeltaSpeedRatio", "Max_Last_SecTimeSegmentmax": "Max_Last_SecTimeSegment",
        "AfterZeroBrakeOnCountfirst": "AfterZeroBrakeOnCount", "Sum_CenterDifferenceDeviationmax": "Sum_CenterDifferenceDeviation",
        "Max_CenterDifferenceDeviationmax": "Max_CenterDifferenceDeviation", "Max_CenterDifferenceDeviationfirst": "Max_CenterDifferenceDeviation",
        "Sum_TFCenterDeviationmax": "Sum_TFCenterDeviation", "EndSpeedOverStartSpeedmin": "EndSpeedOverStartSpeed", "SICmax": "SIC",
        "Max_AbsValTurningForcefirst": "Max_AbsValTurningForce", "Max_AbsValBrakingForcefirst": "Max_AbsValBrakingForce",
        "Max_TFCenterDeviationmax": "Max_TFCenterDeviation", "Sum_BFCenterDeviationmax": "Sum_BFCenterDeviation",
        "Max_BFCenterDeviationmax": "Max_BFCenterDeviation",
    }
    own = [c for c in others if c not in ("_moved", "isSeverefirst")]
    last = [F.coalesce(F.col("abscount"), F.lit(0)).cast("double").alias("abscountlast")] if has_abs else []
    return out.select(*keys, *own, *[F.col(c).alias(n) for n, c in values.items()], "isSeverefirst", *last,
                      F.col("TripEventID").alias("TripEventIDlast"))
