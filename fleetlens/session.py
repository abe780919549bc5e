"""Session construction for tests and benchmarks, and checkpoint-dir lookup.

Library code never creates a session: it receives one. ``local_session`` is for
tests and ``bench.py`` only. ``checkpoint_dir`` reads ``spark.checkpoint.dir``
from the running session (the shared folder on a cluster) and only sets a
scratch folder when the setting is absent, as in local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "fleetlens") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("FLEETLENS_DRIVER_MEM", "16g"))
        .config("spark.sql.files.maxPartitionBytes", str(64 * 1024 * 1024))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    Uses ``spark.checkpoint.dir`` when the session names one. Without it a scratch folder is made
    for a ``local`` master (tests on one machine); on a cluster, whose executors could not read
    such a folder, that is an error.
    """
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            return current
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="fleetlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir() or path


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: later readers prune columns and rows."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def start_with_partitions(spark: SparkSession, writer, partitions: int | None = None):
    """Start a streaming ``writer`` whose stateful operators use ``partitions`` state partitions.

    A streaming query snapshots the session configuration when it starts, so the shuffle
    partition count is set only for ``start()`` and the session's own value is restored at once.
    Default: the cluster's default parallelism (state stores per micro-batch = partitions).
    """
    key = "spark.sql.shuffle.partitions"
    want = str(partitions or spark.sparkContext.defaultParallelism)
    before = spark.conf.get(key)
    spark.conf.set(key, want)
    try:
        return writer.start()
    finally:
        spark.conf.set(key, before)
