"""Stored objects: ordered chunks of large ones, whole small ones.

Objects live under ``root/bucket/key`` on any file system pyarrow can open. Spark
spreads byte ranges over tasks; a task holds no more than one batch of chunks.
Buckets and keys come from payloads: names that would leave the root are refused.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple, Protocol
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ackline.params import positive
from ackline.plans.packing import packed_by_bytes
from ackline.schemas import OBJECT

CHUNK_BYTES = 1024 * 1024
RANGE_CHUNKS = 64
# Bytes a read task should move, and what opening an object costs in bytes.
TASK_BYTES = 256 * 1024 * 1024
OPEN_BYTES = 256 * 1024
# Rows are handed to Spark in batches of about this many bytes.
BATCH_BYTES = 4 * 1024 * 1024

_CHUNK_ROWS = (
    "kind string, bucket string, object_key string, chunk_index int, n_bytes bigint, data binary, read_error string"
)


def object_path(root: str, bucket: str, key: str) -> str:
    """The path of an object; ``ValueError`` for a name that is no place under the root."""
    if not bucket or "/" in bucket or not key or key.startswith("/"):
        raise ValueError("bucket and key do not name a place under the root")
    if "\0" in bucket + key or any(part in (".", "..") for part in (bucket, *key.split("/"))):
        raise ValueError("bucket and key do not name a place under the root")
    return f"{root.rstrip('/')}/{bucket}/{key}"


# What is wrong with one object must not end the job.
_ROW_ERRORS = (OSError, ValueError, TypeError, pa.ArrowException)


def _in_batches(rows: Iterator[dict], schema: pa.Schema, payload: str) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of about ``BATCH_BYTES`` of ``payload`` each."""
    held: list[dict] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row.get(payload) or b"") + 64
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def object_ranges(requests: DataFrame, chunk_bytes: int, range_chunks: int) -> DataFrame:
    """Cut every requested object into ranges of ``range_chunks`` chunks.

    The last range of an object reads one chunk past the announced size, so that
    verification sees a body that is longer, however long it is. An object
    without an announced size is one range that is read to its end.
    """
    positive("chunk_bytes", chunk_bytes)
    positive("range_chunks", range_chunks)
    width = chunk_bytes * range_chunks
    size = F.col("size").cast("long")
    last = F.greatest(F.ceil(size / F.lit(width)).cast("long") - 1, F.lit(0).cast("long"))
    return (
        requests.select(*OBJECT, size.alias("size"))
        .withColumn("_last", last)
        .withColumn("range", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last"))))
        .select(*OBJECT, "size", "range", (F.col("range") == F.col("_last")).alias("is_last"))
    )


def packed_ranges(
    requests: DataFrame, chunk_bytes: int, range_chunks: int, task_bytes: int, tasks: int | None = None
) -> DataFrame:
    """:func:`object_ranges` in partitions of about ``task_bytes`` to read."""
    width = chunk_bytes * range_chunks
    rest = F.greatest(F.coalesce("size", F.lit(0)) - F.col("range") * width, F.lit(0))
    ranges = object_ranges(requests, chunk_bytes, range_chunks)
    return packed_by_bytes(ranges, F.least(rest, F.lit(width)) + OPEN_BYTES, [*OBJECT, "range"], task_bytes, tasks=tasks)


def read_object_chunks(
    requests: DataFrame,
    root: str,
    *,
    chunk_bytes: int = CHUNK_BYTES,
    range_chunks: int = RANGE_CHUNKS,
    task_bytes: int = TASK_BYTES,
    read_tasks: int | None = None,
) -> DataFrame:
    """Read requested objects as ``chunk`` rows and one ``end`` row per object.

    Tasks read about ``task_bytes`` each, or there are ``read_tasks`` of them.
    ``chunk_index`` orders the chunks of an object across ranges. A range that
    cannot be read yields one row with ``read_error`` instead of failing the job.
    """
    ranges = packed_ranges(requests, chunk_bytes, range_chunks, task_bytes, read_tasks)
    uri = _as_uri(root)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = fs.FileSystem.from_uri(uri)
        wanted = (row for batch in batches for row in batch.to_pylist())
        chunks = (c for row in wanted for c in _read_range(filesystem, base, row, chunk_bytes, range_chunks))
        yield from _in_batches(chunks, _ARROW_ROWS, "data")

    return ranges.mapInArrow(read, _CHUNK_ROWS)


_ARROW_ROWS = pa.schema(
    [
        ("kind", pa.string()),
        ("bucket", pa.string()),
        ("object_key", pa.string()),
        ("chunk_index", pa.int32()),
        ("n_bytes", pa.int64()),
        ("data", pa.binary()),
        ("read_error", pa.string()),
    ]
)


def _read_range(filesystem, base: str, row: dict, chunk_bytes: int, range_chunks: int) -> Iterator[dict]:
    named = {"bucket": row["bucket"], "object_key": row["object_key"]}
    index = row["range"] * range_chunks
    stop = index + range_chunks
    if row["size"] is None:
        stop = math.inf
    elif row["is_last"]:
        stop = max(index, -(-max(row["size"], 0) // chunk_bytes)) + 1
    try:
        with filesystem.open_input_file(object_path(base, row["bucket"], row["object_key"])) as source:
            source.seek(index * chunk_bytes)
            while index < stop:
                data = source.read(chunk_bytes)
                if not data:
                    break
                yield {"kind": "chunk", **named, "chunk_index": index, "n_bytes": len(data), "data": data}
                index += 1
    except _ROW_ERRORS as error:
        yield {"kind": "chunk", **named, "chunk_index": index, "n_bytes": 0, "read_error": str(error)}
        return
    if row["is_last"]:
        yield {"kind": "end", **named, "chunk_index": index, "n_bytes": 0}


def _as_uri(root: str) -> str:
    if "://" in root or root.startswith("file:"):
        # Hadoop writes local paths as file:/x, pyarrow reads file:///x.
        return root if "://" in root else "file://" + root[len("file:"):]
    return "file://" + quote(root)


def fetch_small_objects(
    requests: DataFrame,
    root: str,
    *,
    max_bytes: int,
    task_bytes: int = TASK_BYTES,
    read_tasks: int | None = None,
) -> DataFrame:
    """Read objects of at most ``max_bytes`` whole: adds ``content`` and ``read_error``.

    Every request has a row. One announced or stored larger than the limit, or
    that cannot be read, has ``read_error``; larger objects are for
    :func:`read_object_chunks`. The request table, not a listing of the store on
    the driver, says what is read.
    """
    positive("max_bytes", max_bytes)
    wanted = requests.select(*OBJECT, F.col("size").cast("long").alias("size"))
    uri = _as_uri(root)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = fs.FileSystem.from_uri(uri)
        wanted_rows = (row for batch in batches for row in batch.to_pylist())
        found = ({**row, **_read_whole(filesystem, base, row, max_bytes)} for row in wanted_rows)
        yield from _in_batches(found, _ARROW_OBJECTS, "content")

    moved = F.when(F.col("size") <= max_bytes, F.greatest("size", F.lit(0))).otherwise(0) + OPEN_BYTES
    return packed_by_bytes(wanted, moved, OBJECT, task_bytes, tasks=read_tasks).mapInArrow(
        read, "bucket string, object_key string, size bigint, content binary, read_error string"
    )


_ARROW_OBJECTS = pa.schema(
    [
        ("bucket", pa.string()),
        ("object_key", pa.string()),
        ("size", pa.int64()),
        ("content", pa.binary()),
        ("read_error", pa.string()),
    ]
)


def _read_whole(filesystem, base: str, row: dict, max_bytes: int) -> dict:
    if row["size"] is not None and row["size"] > max_bytes:
        return {"read_error": f"announced size {row['size']} is over the limit of {max_bytes} bytes"}
    try:
        with filesystem.open_input_file(object_path(base, row["bucket"], row["object_key"])) as source:
            content = source.read(max_bytes + 1)
    except _ROW_ERRORS as error:
        return {"read_error": str(error)}
    if len(content) > max_bytes:
        return {"read_error": f"stored object exceeds {max_bytes} bytes"}
    return {"content": content}


class Response(NamedTuple):
    """What a store answers: headers (null if omitted) and the body in chunks."""

    content_length: int | None
    etag: str | None
    body: Iterator[bytes]


class Store(Protocol):
    """Where objects are read; it is sent to the executors."""

    def get(self, bucket: str, key: str, if_match: str | None) -> Response: ...


@functools.lru_cache(maxsize=8)
def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


@dataclass(frozen=True)
class FolderStore:
    """Objects as files under ``root/bucket/key`` on any file system pyarrow can open.

    With ``etag_suffix`` the file of that name beside an object holds its etag.
    A file system knows no conditions, so ``if_match`` is left to the caller.
    """

    root: str
    chunk_bytes: int = CHUNK_BYTES
    etag_suffix: str | None = None

    def get(self, bucket: str, key: str, if_match: str | None) -> Response:
        filesystem, base = _opened(_as_uri(self.root))
        path = object_path(base, bucket, key)
        found = filesystem.get_file_info(path)
        if found.type != fs.FileType.File:
            raise FileNotFoundError(f"no object {bucket}/{key}")
        return Response(found.size, self._etag(filesystem, path), self._chunks(filesystem, path))

    def _etag(self, filesystem: fs.FileSystem, path: str) -> str | None:
        if self.etag_suffix is None:
            return None
        beside = path + self.etag_suffix
        if filesystem.get_file_info(beside).type != fs.FileType.File:
            return None
        with filesystem.open_input_stream(beside) as source:
            return source.read().decode()

    def _chunks(self, filesystem: fs.FileSystem, path: str) -> Iterator[bytes]:
        with filesystem.open_input_stream(path) as source:
            while data := source.read(self.chunk_bytes):
                yield data


def write_objects(objects: DataFrame, root: str) -> None:
    """Store ``content`` of every row under ``root/bucket/object_key`` (used to build test stores)."""
    uri = _as_uri(root)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = fs.FileSystem.from_uri(uri)
        for batch in batches:
            for row in batch.to_pylist():
                path = object_path(base, row["bucket"], row["object_key"])
                filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
                with filesystem.open_output_stream(path) as sink:
                    sink.write(row["content"])
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]}, schema=pa.schema([("n", pa.int64())]))

    objects.select(*OBJECT, F.col("content").cast("binary").alias("content")).mapInArrow(
        write, "n bigint"
    ).write.format("noop").mode("overwrite").save()
