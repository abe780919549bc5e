"""A streaming source that reads chunks of files in time order, whatever the order they were written in.

Spark's file stream takes files by modification time. When the files of an older chunk are written
after those of a newer one (more writing tasks than cores, a retry, a back-fill), the watermark is
past the older rows when they come, and stateful operators drop them without a trace. Here an offset
is the name of a chunk (its start in epoch seconds): every micro-batch takes one chunk, the earliest
that has not been read. Sources that are joined share a timeline, the chunks of all their folders,
so that they advance together even where one of them has no rows. A source opened with ``names``
yields the names of its chunks only; the micro-batch then reads their files with Spark's own reader.

Layout: ``<path>/chunk=<epoch seconds>/*.parquet``. The folder must be reachable by pyarrow (local
or shared file systems, hdfs, s3, gs, abfs). ``progress`` names a file that takes the last chunk
whose batch was committed; a restarted query goes on after it.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

CHUNK = "chunk"

# the source's classes run in Python workers that need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _file_system(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))


def _chunks(path: str) -> list[int]:
    from pyarrow import fs
    files, root = _file_system(path)
    found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted(int(f.base_name.split("=")[1]) for f in found if f.base_name.startswith(f"{CHUNK}="))


class ChunkFile(InputPartition):
    def __init__(self, path: str, chunk: int):
        super().__init__((path, chunk))
        self.path, self.chunk = path, chunk


class ChunkNames(InputPartition):
    def __init__(self, chunks: list[int]):
        super().__init__(tuple(chunks))
        self.chunks = chunks


class OrderedReader(DataSourceStreamReader):
    def __init__(self, schema, options: dict):
        self.schema = schema
        self.path = options["path"]
        self.timeline = [p for p in options.get("timeline", self.path).split(",") if p]
        self.progress = options.get("progress")
        self.names = options.get("names", "false") == "true"
        self.at: int | None = None

    def initialOffset(self) -> dict:
        return {"chunk": -1}

    def latestOffset(self) -> dict:
        """The next chunk of the timeline; the last one again when there is no more."""
        at = self._committed() if self.at is None else self.at
        later = [c for p in self.timeline for c in _chunks(p) if c > at]
        self.at = min(later, default=at)
        return {"chunk": self.at}

    def _committed(self) -> int:
        if self.progress:
            files, path = _file_system(self.progress)
            if files.get_file_info(path).is_file:
                with files.open_input_stream(path) as f:
                    return int(f.read())
        return -1

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if end["chunk"] < start["chunk"]:
            raise ValueError(f"{self.progress} is older than the query's checkpoint: chunk {start['chunk']} has been read already")
        self.at = max(end["chunk"], -1 if self.at is None else self.at)
        from pyarrow import fs
        files, root = _file_system(self.path)
        new = [chunk for chunk in _chunks(self.path) if start["chunk"] < chunk <= end["chunk"]]
        if self.names:
            return [ChunkNames(new)]
        out = []
        for chunk in new:
            inside = files.get_file_info(fs.FileSelector(f"{root}/{CHUNK}={chunk}", allow_not_found=True))
            out += [ChunkFile(f.path, chunk) for f in sorted(inside, key=lambda f: f.path) if f.is_file and f.base_name[0] not in "._"]
        return out

    def read(self, partition: InputPartition) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema
        target = to_arrow_schema(self.schema)
        if self.names:
            yield pa.RecordBatch.from_arrays([pa.array(partition.chunks, pa.int64())], schema=target)
            return
        files, _ = _file_system(self.path)
        with files.open_input_file(partition.path) as f:
            for batch in pq.ParquetFile(f).iter_batches(batch_size=10_000, use_threads=False):
                cols = [pa.array([partition.chunk] * batch.num_rows, pa.int64()) if c.name == CHUNK else batch.column(c.name) for c in target]
                yield pa.RecordBatch.from_arrays([x.cast(c.type) for x, c in zip(cols, target)], schema=target)

    def commit(self, end: dict) -> None:
        if self.progress:
            files, path = _file_system(self.progress)
            with files.open_output_stream(path) as f:
                f.write(str(end["chunk"]).encode())


class OrderedChunks(DataSource):
    @classmethod
    def name(cls) -> str:
        return "ordered_chunks"

    def streamReader(self, schema) -> OrderedReader:
        return OrderedReader(schema, dict(self.options))


def chunk_start(ts, width_s: int) -> Column:
    """Start, in epoch seconds, of the chunk that a timestamp belongs to."""
    return (F.floor(F.unix_micros(ts) / (width_s * 1_000_000)) * width_s).cast("long")


def stage_by_time(df: DataFrame, path: str, ts, width_s: int) -> None:
    """Write ``df`` in chunks of ``width_s`` seconds of ``ts`` (the time that decides when a row arrives)."""
    df.withColumn(CHUNK, chunk_start(ts, width_s)).write.partitionBy(CHUNK).parquet(path)


def read_ordered(spark: SparkSession, path: str, timeline: list[str] | None = None, progress: str | None = None,
                 names: bool = False) -> DataFrame:
    """Stream of a folder's rows, one chunk of the timeline a micro-batch, with the column ``chunk``.

    With ``names`` it has a row per chunk and that column alone; ``read_chunks`` gives the rows.
    Start the query with a processing-time trigger and end it with ``processAllAvailable``.
    """
    spark.dataSource.register(OrderedChunks)
    schema = f"{CHUNK} long" if names else stored_schema(spark, path)
    reader = spark.readStream.format("ordered_chunks").schema(schema).option("path", path).option("timeline", ",".join(timeline or [path]))
    reader = reader.option("names", "true") if names else reader
    return (reader.option("progress", progress) if progress else reader).load()


def stored_schema(spark: SparkSession, path: str) -> StructType:
    return spark.read.parquet(path).withColumn(CHUNK, F.col(CHUNK).cast("long")).schema


def read_chunks(spark: SparkSession, path: str, schema: StructType, chunks: list[int]) -> DataFrame:
    """The rows of some chunks of a folder, with the column ``chunk``."""
    if not chunks:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path.rstrip('/')}/{CHUNK}={c}" for c in chunks])


def on_time(ts: str, width_s: int, slack_s: int) -> Column:
    """Rows whose time lies in their chunk or at most ``slack_s`` beside it.

    With a watermark delay of twice the slack none of these is ever behind the watermark: the rows of
    earlier chunks end at most the slack after this chunk's start, so the watermark lies at most at
    the start less the slack. The other rows go to an output of their own.
    """
    seconds = F.unix_micros(ts) / 1_000_000
    return (seconds >= F.col(CHUNK) - slack_s) & (seconds < F.col(CHUNK) + width_s + slack_s)
