"""Table loading: parquet by default, JDBC with partitioned reads when configured."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table of a dataset directory (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_jdbc(spark: SparkSession, url: str, table: str, partition_column: str,
              lower: int, upper: int, num_partitions: int, **options) -> DataFrame:
    """Partitioned JDBC read of a relational table.

    Credentials travel only through ``options`` (e.g. ``user``/``password``) and are
    never logged. ``partition_column`` should be a numeric, evenly spread column such as
    ``CompanyID`` so each task pulls one stride of the table.
    """
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("partitionColumn", partition_column).option("lowerBound", lower)
              .option("upperBound", upper).option("numPartitions", num_partitions))
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load()
