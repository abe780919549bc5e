"""Column expressions: rounding, limit snapping, scoring curves, label bands, time keys.

All are built-in Spark expressions (inside whole-stage codegen); none is a UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fleetlens.schema import BATCH_MINUTES, LABEL_BANDS


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_even(x, digits: int = 2) -> Column:
    """NumPy-style rounding: half-to-even on the scaled binary value (``rint(x*10^d)/10^d``)."""
    scale = float(10 ** digits)
    return F.rint(_c(x) * F.lit(scale)) / F.lit(scale)


def quantize(x, digits: int = 4) -> Column:
    """Output quantisation used to compare doubles across engines (same rule as the oracle)."""
    return round_half_even(x, digits)


def snap_limit(x) -> Column:
    """Snap a speed limit to a multiple of 5: remainder <= 2 rounds down, else up. Null stays null."""
    x = _c(x)
    m = x % 5
    return F.when(m <= 2, x - m).otherwise(x + (F.lit(5) - m))


def label_band(score, bands: str = "gaps") -> Column:
    """Inclusive bands [1,39] Low, [40,69] Mid, [70,100] High; anything else (gaps too) is null.

    ``bands="contiguous"`` closes the gaps between bands: a band then reaches up to the next
    one (39.5 is Low); scores under 1 or over 100 stay null.
    """
    if bands not in ("gaps", "contiguous"):
        raise ValueError(f"bands is 'gaps' or 'contiguous', not {bands!r}")
    s = _c(score)
    expr = None
    starts = sorted(lo for lo, _, _ in LABEL_BANDS)
    for lo, hi, name in LABEL_BANDS:
        later = [x for x in starts if x > lo]
        below = s < later[0] if bands == "contiguous" and later else s <= hi
        cond = (s >= lo) & below
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(None).cast("string"))


def curve_overspeed(over) -> Column:
    """Overspeed curve on mph over the limit; each branch rounded to 2 places, uncapped."""
    o = _c(over)
    return (F.when(o >= 15, round_half_even(F.lit(0.95) + F.lit(0.05 / 19.00) * (o - 15)))
            .when(o >= 10, round_half_even(F.lit(0.7) + F.lit(0.24 / 4.99) * (o - 10)))
            .when(o >= 5, round_half_even(F.lit(0.5) + F.lit(0.19 / 4.99) * (o - 5)))
            .otherwise(F.lit(0.0)))


def curve_nonsevere(over) -> Column:
    """Non-severe overspeed curve: 0.1 + (0.3/15) * over for positive over, else 0."""
    o = _c(over)
    return F.when(o > 0, round_half_even(F.lit(0.1) + F.lit(0.3 / 15) * (o - 0))).otherwise(F.lit(0.0))


def curve_ecs(p) -> Column:
    """Curve speed: p >= .7 maps to [50, 95]; below to 1 + (100p - 1) * 39/70."""
    q = _c(p) * 100
    return (F.when(_c(p) >= 0.7, F.lit(50.0) + (q - 70) * F.lit(45.0) / F.lit(30.0))
            .otherwise(F.lit(1.0) + (q - 1) * F.lit(39.0) / F.lit(70.0)))


def event_code(trip_event_id) -> Column:
    """Event code: the 8 hex digits before the first ``_`` of a TripEventID, as unsigned."""
    digits = F.substring(F.substring_index(_c(trip_event_id), "_", 1), -8, 8)
    return F.conv(digits, 16, 10).cast("bigint")


def curve_cmb(p, code) -> Column:
    """Collision/brake curve: p < .6 -> [1, 40); code 32 -> 50..95; other codes -> 70..95."""
    p, code = _c(p), _c(code)
    q = p * 100
    return (F.when(p < 0.6, F.lit(1.0) + (q - 0) * F.lit(39.0) / F.lit(60.0))
            .when(code == 32, F.lit(50.0) + (q - 60) * F.lit(45.0) / F.lit(40.0))
            .otherwise(F.lit(70.0) + (q - 60) * F.lit(25.0) / F.lit(40.0)))


def curve_esprsp(p, code) -> Column:
    """Stability brake curve: code 32768 -> 70 + 25p; 131072 split at p = .6; other codes null."""
    p, code = _c(p), _c(code)
    q = p * 100
    return (F.when(code == 32768, F.lit(70.0) + (q - 0) * F.lit(25.0) / F.lit(100.0))
            .when((code == 131072) & (p >= 0.6), F.lit(50.0) + (q - 60) * F.lit(45.0) / F.lit(40.0))
            .when((code == 131072) & (p < 0.6), F.lit(0.0) + (q - 0) * F.lit(50.0) / F.lit(60.0))
            .otherwise(F.lit(None).cast("double")))


def batch_start(ts, minutes: int = BATCH_MINUTES) -> Column:
    """Start of the half-open processing batch ``[start, start + minutes)`` holding ``ts``."""
    return F.window(_c(ts), f"{minutes} minutes").start


def week_end(d) -> Column:
    """Most recent Sunday on or before date ``d`` (``d`` itself when it is a Sunday)."""
    d = F.to_date(_c(d))
    return F.date_sub(d, (F.dayofweek(d) - 1))


def seconds_between(a, b) -> Column:
    """Second boundaries crossed from ``a`` to ``b`` (T-SQL DATEDIFF(second) semantics)."""
    return (F.floor(F.unix_micros(_c(b)) / 1000000) - F.floor(F.unix_micros(_c(a)) / 1000000))
