"""Weekly label report: counts by label group and event name per company and week."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetlens.functions.columns import week_end
from fleetlens.schema import LABEL_HIGH, LABEL_LOW, LABEL_MID


def report_week_end(created) -> F.Column:
    """End (exclusive, a Sunday) of the weekly report window that holds ``created``."""
    return F.date_add(week_end(created), 7)


def weekly_report(extra: DataFrame, events: DataFrame, dim: DataFrame, classes: DataFrame,
                  types: DataFrame, as_of=None) -> DataFrame:
    """Count scored events per (company, week, label group, event name).

    A report for date ``as_of`` covers ``[Sunday on/before as_of - 7 days, that Sunday)``; with
    ``as_of=None`` every week is reported (keyed by ``week_end``). The label filter and the
    non-null EventID make all joins but the event-name one inner; small dimensions are broadcast
    by Spark's size check.
    """
    x = extra.select("CompanyID", "TripEventID", "CreatedDate")
    if as_of is not None:
        end = week_end(F.lit(as_of))
        x = x.where((F.col("CreatedDate") >= F.date_sub(end, 7).cast("timestamp"))
                    & (F.col("CreatedDate") < end.cast("timestamp")))
    x = x.withColumn("week_end", report_week_end("CreatedDate"))
    t = events.select("CompanyID", "TripEventID", "EventID").where(F.col("EventID").isNotNull())
    c = classes.select("CompanyID", "TripEventID", "Classification")
    ty = types.where(F.col("Name").isin(LABEL_LOW, LABEL_MID, LABEL_HIGH)).select(
        "CompanyID", F.col("Type").alias("Classification"), F.col("Name").alias("Group"))
    j = (x.join(t, ["CompanyID", "TripEventID"], "inner")
         .join(dim, "EventID", "left")
         .join(c, ["CompanyID", "TripEventID"], "inner")
         .join(ty, ["CompanyID", "Classification"], "inner"))
    return j.groupBy("CompanyID", "week_end", "Group", "EventName").agg(F.count(F.lit(1)).alias("Count"))
