"""Repeat-event scoring per driver (carry-over of recent scores, 3-in-7-days counts).

All look-backs are at most 7 calendar days (under 8 days of time), so a driver's timeline is
cut into 8-day blocks. Windows run per (driver, block); the first rows of a block read the
last rows of the previous block from a one-row-per-block summary (an older event is too far
away to change a rule), and running counts carry across blocks through the block summaries. No Window spans
a whole driver, so a driver with a large share of all events is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from fleetlens.functions.columns import label_band
from fleetlens.schema import CLASSIFIED_BY

DRIVER = ["CompanyID", "DriverID"]
BLOCK_US = 8 * 86_400_000_000


def driver_events(trips: DataFrame, extra: DataFrame) -> DataFrame:
    """Events with a driver, their prior importance (missing or null -> 0) and event day."""
    x = extra.select("CompanyID", "VehicleID", "TripEventID", F.col("ImportanceScore").alias("_prior"))
    te = trips.where(F.col("DriverID").isNotNull() & (F.col("DriverID") != ""))
    return (te.join(x, ["CompanyID", "VehicleID", "TripEventID"], "left")
            .select("CompanyID", "VehicleID", "DriverID", "TripEventID", "TripEventGuid", "CreatedDate",
                    F.col("Timestamp").alias("EventTimeStamp"), F.to_date("Timestamp").alias("_day"),
                    F.coalesce(F.col("_prior"), F.lit(0.0)).alias("importancescore")))


def blocked_lags(df: DataFrame, cols: list[str], n: int = 2, width_us: int = BLOCK_US) -> DataFrame:
    """Add ``_lag{k}_{c}`` (k = 1..n) per driver in (EventTimeStamp, TripEventID) order.

    Lags reach into the previous block only; a lag further back is null (callers only use
    look-backs shorter than ``width_us``). Also adds ``_blk`` and ``_pos`` (row within block).
    """
    d = df.withColumns({"_us": F.unix_micros("EventTimeStamp")})
    d = d.withColumn("_blk", F.floor(F.col("_us") / width_us))
    w = Window.partitionBy(*DRIVER, "_blk").orderBy("_us", "TripEventID")
    d = d.withColumn("_pos", F.row_number().over(w))
    # last n rows of every block, as arrays ordered oldest -> newest
    tail = (d.withColumn("_rev", F.row_number().over(Window.partitionBy(*DRIVER, "_blk")
                                                       .orderBy(F.col("_us").desc(), F.col("TripEventID").desc())))
            .where(F.col("_rev") <= n)
            .groupBy(*DRIVER, "_blk")
            .agg(F.sort_array(F.collect_list(F.struct((-F.col("_rev")).alias("_o"), *[F.col(c) for c in cols])))
                 .alias("_tail"))
            .select(*DRIVER, (F.col("_blk") + 1).alias("_blk"), "_tail"))
    d = d.join(tail, [*DRIVER, "_blk"], "left")
    out = {}
    for k in range(1, n + 1):
        for c in cols:
            inside = F.lag(c, k).over(w)
            # row at position p needs element (k - p) from the end of the previous block's tail
            from_prev = F.element_at(F.col("_tail"), F.size("_tail") - (k - F.col("_pos")))
            prev_val = F.when(F.col("_tail").isNotNull() & (F.size("_tail") - (k - F.col("_pos")) >= 1),
                              from_prev.getField(c))
            out[f"_lag{k}_{c}"] = F.when(F.col("_pos") > k, inside).otherwise(prev_val)
    return d.withColumns(out).drop("_tail")


def with_carry(ev: DataFrame, bump: float = 0.05, days: int = 7) -> DataFrame:
    """``newimportancescore``: previous score + ``bump`` (capped at 1) when the driver's previous
    event scored, this one did not, and they are fewer than ``days`` calendar days apart."""
    d = blocked_lags(ev, ["importancescore", "_day"], n=1)
    prev_s, prev_d = F.col("_lag1_importancescore"), F.col("_lag1__day")
    cond = (prev_s != 0) & (F.col("importancescore") == 0) & (F.datediff("_day", prev_d) < days)
    new = F.when(F.coalesce(cond, F.lit(False)), F.least(prev_s + bump, F.lit(1.0))).otherwise(F.lit(0.0))
    return d.withColumn("newimportancescore", new).drop("_lag1_importancescore", "_lag1__day", "_us", "_blk", "_pos")


def repeat_carry(ev: DataFrame) -> DataFrame:
    """Events whose score is carried over from the driver's previous event."""
    c = with_carry(ev).where(F.col("newimportancescore") != 0)
    return c.select("CompanyID", "VehicleID", "DriverID", "TripEventID", "TripEventGuid", "CreatedDate",
                    F.col("newimportancescore").alias("importancescore"))


def repeat_candidates(ev: DataFrame, min_events: int = 3) -> DataFrame:
    """Unscored, not-carried events of drivers with at least ``min_events`` of them."""
    c = with_carry(ev).where((F.col("importancescore") == 0) & (F.col("newimportancescore") == 0))
    counts = c.groupBy(*DRIVER).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_events)
    return c.join(counts.select(*DRIVER), DRIVER, "left_semi").drop("newimportancescore")


def repeat_counts(cand: DataFrame, days: int = 7, scope=("CompanyID",)) -> DataFrame:
    """3-events-in-``days`` running count per driver (reset after a gap over ``days``),
    normalised per scope to 0.7..1.0 over positive counts (all equal -> 1.0); positives only.

    Days are calendar dates: hit = at most ``days`` dates after the event two back; reset = more
    than ``days`` dates after the previous event (or no previous event). The count is the number
    of hits since the last reset; events of one date follow in order of (time, TripEventID).
    """
    d = blocked_lags(cand.withColumn("_date", F.to_date("EventTimeStamp")), ["_date"], n=2,
                     width_us=(days + 1) * 86_400_000_000)
    hit = F.coalesce(F.datediff("_date", "_lag2__date") <= days, F.lit(False))
    reset = F.col("_lag1__date").isNull() | (F.datediff("_date", "_lag1__date") > days)
    d = d.withColumns({"_hit": hit.cast("int"), "_reset": reset.cast("int")})
    w = Window.partitionBy(*DRIVER, "_blk").orderBy("_pos")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_lseg", F.sum("_reset").over(run))
    d = d.withColumn("_lhits", F.sum("_hit").over(Window.partitionBy(*DRIVER, "_blk", "_lseg").orderBy("_pos")
                                                 .rowsBetween(Window.unboundedPreceding, 0)))
    # block summaries: resets, hits after the block's last reset, all hits
    s = d.groupBy(*DRIVER, "_blk").agg(F.sum("_reset").alias("_nres"), F.sum("_hit").alias("_all"),
                                       F.max("_lseg").alias("_maxseg"))
    tails = d.join(s.select(*DRIVER, "_blk", "_maxseg"), [*DRIVER, "_blk"]).where(F.col("_lseg") == F.col("_maxseg")) \
        .groupBy(*DRIVER, "_blk").agg(F.sum("_hit").alias("_tailhits"))
    s = s.join(tails, [*DRIVER, "_blk"], "left")
    contrib = F.when(F.col("_nres") > 0, F.coalesce(F.col("_tailhits"), F.lit(0))).otherwise(F.col("_all"))
    sw = Window.partitionBy(*DRIVER).orderBy("_blk")
    s = s.withColumns({"_contrib": contrib,
                       "_grp": F.sum(F.when(F.col("_nres") > 0, 1).otherwise(0)).over(sw.rowsBetween(Window.unboundedPreceding, 0))})
    s = s.withColumn("_acc", F.sum("_contrib").over(Window.partitionBy(*DRIVER, "_grp").orderBy("_blk")
                                                      .rowsBetween(Window.unboundedPreceding, 0)))
    s = s.withColumn("_carry", F.coalesce(F.lag("_acc").over(sw), F.lit(0))).select(*DRIVER, "_blk", "_carry")
    d = d.join(s, [*DRIVER, "_blk"], "left")
    running = F.when(F.col("_lseg") == 0, F.col("_carry") + F.col("_lhits")).otherwise(F.col("_lhits"))
    df = d.withColumn("_count", F.when(F.col("_hit") == 1, running).otherwise(F.lit(0)).cast("bigint"))
    pos = df.where(F.col("_count") > 0)
    bounds = pos.groupBy(*scope).agg(F.min("_count").alias("_lo"), F.max("_count").alias("_hi"))
    out = pos.join(bounds, list(scope), "inner")
    score = F.when(F.col("_lo") == F.col("_hi"), F.lit(1.0)).otherwise(
        F.lit(0.7) + (F.col("_count") - F.col("_lo")) * F.lit(0.3) / (F.col("_hi") - F.col("_lo")))
    return out.select("CompanyID", "VehicleID", "DriverID", "TripEventID", "TripEventGuid", "CreatedDate",
                      F.col("_count").alias("repeat_count"), score.alias("importancescore"))


def repeat_labels(scored: DataFrame) -> DataFrame:
    """Classification rows of carried or counted scores (band of the score x 100)."""
    return scored.select("CompanyID", "VehicleID", "DriverID", "TripEventID",
                         label_band(F.col("importancescore") * 100).alias("ClassificationName"),
                         F.col("CreatedDate").alias("Timestamp"), F.lit(CLASSIFIED_BY).alias("By"))
