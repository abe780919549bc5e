"""Company roster and shard -> server routing."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetlens.schema import ROSTER_SETTING


def company_roster(settings: DataFrame, company: DataFrame, database_prefix: str = "telemetry_shard") -> DataFrame:
    """Enabled companies, with the database of their shard (``database_prefix`` + id): setting ``AutoEventClassification`` whose data contains ``true``."""
    on = settings.where((F.col("Name") == ROSTER_SETTING) & F.col("Data").like("%true%"))
    return on.join(company, "CompanyID", "inner").select(
        "CompanyID", F.concat(F.lit(database_prefix), F.col("ReportShardID").cast("string")).alias("DatabaseName"),
        F.col("ReportShardID").alias("ShardID"))


def route_shards(roster: DataFrame, mapping: DataFrame) -> DataFrame:
    """Attach the server of each company's shard; a null ``Server`` marks a company to skip.

    The mapping has one row per shard id (hundreds at most), so Spark's size-checked broadcast
    applies; no hint is needed.
    """
    return roster.join(mapping, "ShardID", "left").select("CompanyID", "DatabaseName", "ShardID", "Server")


def split_routed(routed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(routed, misses) — misses are the quarantine of companies without a server."""
    return routed.where(F.col("Server").isNotNull()), routed.where(F.col("Server").isNull())
