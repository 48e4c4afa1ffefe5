"""``spark.read.format("object_chunks")``: stored objects as a Python data source.

The request table is packed first, by the bytes to read, into one file a task
(:func:`stage_requests`). What the driver plans with is the list of these files;
the requests themselves are read by the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ackline.session import workspace
from ackline.sources.objects import (
    _ARROW_ROWS,
    _CHUNK_ROWS,
    CHUNK_BYTES,
    RANGE_CHUNKS,
    TASK_BYTES,
    _as_uri,
    _in_batches,
    _read_range,
    packed_ranges,
)

FORMAT = "object_chunks"


class RequestFile(InputPartition):
    """The requests of one task."""

    def __init__(self, path: str):
        self.path = path


class ObjectChunkReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        for name in ("root", "requests"):
            if not options.get(name):
                raise ValueError(f"{FORMAT} needs the option {name}")
        self.root = _as_uri(options["root"])
        self.requests = _as_uri(options["requests"])
        self.chunk_bytes = int(options.get("chunk_bytes") or options.get("chunkbytes") or CHUNK_BYTES)
        self.range_chunks = int(options.get("range_chunks") or options.get("rangechunks") or RANGE_CHUNKS)

    def partitions(self) -> list[RequestFile]:
        filesystem, base = fs.FileSystem.from_uri(self.requests)
        files = filesystem.get_file_info(fs.FileSelector(base))
        return [RequestFile(f.path) for f in files if f.path.endswith(".parquet")]

    def read(self, partition: RequestFile) -> Iterator[pa.RecordBatch]:
        requests, _ = fs.FileSystem.from_uri(self.requests)
        filesystem, base = fs.FileSystem.from_uri(self.root)
        wanted = (
            row
            for batch in pq.ParquetFile(requests.open_input_file(partition.path)).iter_batches()
            for row in batch.to_pylist()
        )
        chunks = (c for row in wanted for c in _read_range(filesystem, base, row, self.chunk_bytes, self.range_chunks))
        yield from _in_batches(chunks, _ARROW_ROWS, "data")


class ObjectChunks(DataSource):
    """Options: ``root``, ``requests`` (a folder of staged requests), ``chunk_bytes``, ``range_chunks``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return _CHUNK_ROWS

    def reader(self, schema) -> ObjectChunkReader:
        return ObjectChunkReader(self.options)


def stage_requests(
    requests: DataFrame,
    path: str,
    *,
    chunk_bytes: int = CHUNK_BYTES,
    range_chunks: int = RANGE_CHUNKS,
    task_bytes: int = TASK_BYTES,
) -> None:
    """Write the byte ranges of ``requests``, one file for about ``task_bytes`` to read."""
    packed_ranges(requests, chunk_bytes, range_chunks, task_bytes).write.parquet(path)


def load_object_chunks(
    requests: DataFrame,
    root: str,
    *,
    chunk_bytes: int = CHUNK_BYTES,
    range_chunks: int = RANGE_CHUNKS,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Stage ``requests`` in the shared folder and read them as the data source."""
    spark = requests.sparkSession
    spark.dataSource.register(ObjectChunks)
    staged = workspace(spark, "chunk-requests")
    stage_requests(requests, staged, chunk_bytes=chunk_bytes, range_chunks=range_chunks, task_bytes=task_bytes)
    reader = spark.read.format(FORMAT).option("root", root).option("requests", staged)
    return reader.option("chunk_bytes", chunk_bytes).option("range_chunks", range_chunks).load()
