"""The two frames every family emits: importance rows and classification rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetlens.functions.columns import label_band
from fleetlens.schema import CLASSIFIED_BY


def to_outputs(scored: DataFrame, importance: Column, label_score: Column,
               positive_only: bool = True, created=None, bands: str = "gaps") -> tuple[DataFrame, DataFrame]:
    """Split a one-row-per-event frame into (importance, labels).

    ``importance`` is the value written as ``importancescore``; ``label_score`` is the value on
    the 0..100 scale that picks the band. With ``positive_only`` only events whose label score
    is above 0 get a classification row (the importance row is always written).
    ``created`` overrides the ``CreatedDate`` column (e.g. a date string); ``bands`` is that of
    ``label_band``.
    """
    created = F.col("CreatedDate") if created is None else created
    base = scored.withColumns({"importancescore": importance, "_label_score": label_score,
                               "_created": created})
    imp = base.select("CompanyID", "VehicleID", "TripEventID", "TripEventGuid",
                      F.col("_created").alias("CreatedDate"), "importancescore")
    lab = base.where(F.col("_label_score") > 0) if positive_only else base
    lab = lab.select("CompanyID", "VehicleID", "DriverID", "TripEventID",
                     label_band("_label_score", bands).alias("ClassificationName"),
                     F.col("_created").alias("Timestamp"), F.lit(CLASSIFIED_BY).alias("By"))
    return imp, lab
