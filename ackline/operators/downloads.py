"""Verified downloads: from requests and a store to verdicts, summaries and completions.

A transfer reads one object from its first byte to its last and hands every chunk,
in order, to a consumer of the user's. It keeps what it needs to judge the
transfer as it goes: bytes so far, and a clock for the wait for the next chunk.
The first failure ends it. Transfers are packed into tasks by the bytes they
move; a task works off one object at a time and holds a chunk or two of it.

A task that is lost runs again, with new consumers, from the first byte: a
consumer's effects outside its result must bear repetition.
"""

from __future__ import annotations

import queue
import threading
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ackline.functions.metadata import decode_metadata
from ackline.functions.records import object_location
from ackline.operators.objects import REQUEST, distinct_requests, duration_text, verify_headers
from ackline.operators.processing import ObjectMetadata
from ackline.operators.records import fail, succeed
from ackline.params import MAX_OBJECT_SIZE, STREAM_IDLE_TIMEOUT_MS, positive
from ackline.plans.packing import packed_by_bytes
from ackline.schemas import OBJECT, TOKEN
from ackline.session import cut
from ackline.sources.objects import OPEN_BYTES, TASK_BYTES, Response, Store


class ChunkConsumer(Protocol):
    """Takes the chunks of one object in order; ``finish`` gives the result of a verified one."""

    def chunk(self, data: bytes) -> None: ...

    def finish(self) -> str | None: ...


ConsumerFactory = Callable[[ObjectMetadata], ChunkConsumer]


class Discard:
    """A consumer that keeps nothing."""

    def chunk(self, data: bytes) -> None:
        pass

    def finish(self) -> str | None:
        return None


class _Failure(Exception):
    def __init__(self, verdict: str, message: str):
        super().__init__(message)
        self.verdict = verdict


class _Reader:
    """Reads chunks ahead in a thread of its own, so that a wait for one can end."""

    def __init__(self, body: Iterator[bytes]):
        self.ready: queue.Queue = queue.Queue(maxsize=1)
        self.over = threading.Event()
        threading.Thread(target=self._run, args=(body,), daemon=True).start()

    def _run(self, body: Iterator[bytes]) -> None:
        try:
            for data in body:
                if not self._put(("chunk", data)):
                    return
            self._put(("end", None))
        except Exception as error:  # noqa: BLE001 - a store may raise anything
            self._put(("error", error))
        finally:
            close = getattr(body, "close", None)
            if close is not None:
                close()

    def _put(self, item: tuple) -> bool:
        while not self.over.is_set():
            try:
                self.ready.put(item, timeout=0.1)
                return True
            except queue.Full:
                continue
        return False

    def next(self, wait: float) -> tuple:
        return self.ready.get(timeout=max(wait, 0.0)) if wait > 0 else self.ready.get_nowait()


def _cause(error: Exception) -> str:
    return str(error) or type(error).__name__


def consume_body(
    body: Iterator[bytes], size: int, idle_timeout_ms: int, consume: Callable[[bytes], None]
) -> Iterator[int]:
    """Pass the chunks of ``body`` to ``consume``, yielding the bytes consumed after each.

    Ends normally if exactly ``size`` bytes came. Only the wait for a nonempty
    chunk, or for the end, counts against ``idle_timeout_ms``.
    """
    reader = _Reader(body)
    received = 0
    idle = idle_timeout_ms / 1000
    deadline = time.monotonic() + idle
    try:
        while True:
            try:
                kind, data = reader.next(deadline - time.monotonic())
            except queue.Empty:
                # Error texts, here and below.
                raise _Failure("stalled", f"S3 body made no progress for {duration_text(idle_timeout_ms)}") from None
            if kind == "error":
                raise _Failure("read_failed", f"failed to read S3 response body: {_cause(data)}")
            if kind == "end":
                break
            if not data:
                continue
            if received + len(data) > size:
                text = f"S3 body exceeded metadata size {size} after receiving {received + len(data)} bytes"
                raise _Failure("exceeded", text)
            try:
                consume(data)
            except Exception as error:  # noqa: BLE001 - user code may raise anything
                raise _Failure("consumer_error", f"object chunk consumer failed: {_cause(error)}") from error
            received += len(data)
            yield received
            deadline = time.monotonic() + idle
        if received != size:
            raise _Failure("truncated", f"S3 body size {received} does not match metadata size {size}")
    finally:
        reader.over.set()


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace('"', '\\"')
    return f'"{escaped}"'


def _check_headers(size: int, etag: str | None, response: Response) -> None:
    """The rules of ``objects.verify_headers`` on a live response."""
    length, got = response.content_length, response.etag
    if length is None:
        raise _Failure("length_omitted", "S3 response omitted Content-Length")
    if length < 0:
        raise _Failure("length_negative", "S3 response contained a negative Content-Length")
    if length != size:
        raise _Failure("length_differs", f"S3 Content-Length {length} does not match metadata size {size}")
    if etag is not None:
        if got is None:
            raise _Failure("etag_omitted", "S3 response omitted ETag")
        if got != etag:
            text = f"S3 ETag {_quoted(got)} does not match metadata ETag {_quoted(etag)}"
            raise _Failure("etag_differs", text)


def transfer(
    metadata: ObjectMetadata,
    store: Store,
    consumer: ConsumerFactory,
    *,
    idle_timeout_ms: int = STREAM_IDLE_TIMEOUT_MS,
    headers_checked: bool = False,
) -> dict:
    """Download one object: ``verdict, stage, message, streamed_bytes, response_etag, result``.

    ``stage`` names where it failed: ``get``, ``headers`` or ``body``. With
    ``headers_checked`` the store's own headers are not judged again.
    """
    location = f"s3://{metadata.bucket}/{metadata.key}"
    done = {"verdict": "ok", "stage": None, "message": None, "streamed_bytes": 0, "response_etag": None, "result": None}
    try:
        response = store.get(metadata.bucket, metadata.key, metadata.etag)
    except Exception as error:  # noqa: BLE001 - a store may raise anything
        text = f"S3 GetObject failed for {location}"
        return {**done, "verdict": "get_failed", "stage": "get", "message": text, "cause": _cause(error)}
    done["response_etag"] = response.etag
    try:
        if not headers_checked:
            _check_headers(metadata.size, metadata.etag, response)
    except _Failure as failure:
        text = f"S3 response validation failed for {location}: {failure}"
        return {**done, "verdict": failure.verdict, "stage": "headers", "message": text}
    try:
        try:
            sink = consumer(metadata)
        except Exception as error:  # noqa: BLE001
            raise _Failure("consumer_error", f"object chunk consumer failed: {_cause(error)}") from error
        for received in consume_body(response.body, metadata.size, idle_timeout_ms, sink.chunk):
            done["streamed_bytes"] = received
        try:
            done["result"] = sink.finish()
        except Exception as error:  # noqa: BLE001
            raise _Failure("consumer_error", f"object chunk consumer failed: {_cause(error)}") from error
    except _Failure as failure:
        text = f"S3 body streaming failed for {location}: {failure}"
        return {**done, "verdict": failure.verdict, "stage": "body", "message": text, "result": None}
    return done


_MADE = (
    "verdict string, stage string, message string, cause string, streamed_bytes bigint, response_etag string, result string"
)


def download_objects(
    requests: DataFrame,
    store: Store,
    consumer: ConsumerFactory = lambda metadata: Discard(),
    *,
    listing: DataFrame | None = None,
    idle_timeout_ms: int = STREAM_IDLE_TIMEOUT_MS,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Download every distinct request ``(bucket, object_key, size, etag)`` and judge it.

    Adds ``verdict, stage, message, cause, streamed_bytes, response_etag, result``.
    A verdict of ``ok`` says that the object was there, its headers and etag
    matched, every chunk was consumed and the bytes add up to ``size``; only then
    is ``result``, what the consumer's ``finish`` gave, not null. With a
    ``listing`` (``bucket, object_key, content_length, response_etag``) the
    headers are judged from it before anything is read, and objects that fail
    are not opened; without one they are the store's. Requests with a null size
    are refused as ``length_differs``; null names as ``get_failed``. What is
    wrong with one object does not end the job.
    """
    positive("idle_timeout_ms", idle_timeout_ms)
    positive("task_bytes", task_bytes)
    wanted = distinct_requests(requests).withColumn("size", F.col("size").cast("decimal(20,0)"))
    checked = listing is not None
    refused = None
    if checked:
        judged = cut(verify_headers(wanted, listing), "judged-headers")
        location = object_location(F.col("bucket"), F.col("object_key"))
        got = F.col("verdict") != "get_failed"
        text = F.when(got, F.concat(F.lit("S3 response validation failed for "), location, F.lit(": "), F.col("message")))
        refused = judged.filter("verdict <> 'ok'").select(
            *REQUEST,
            "verdict",
            F.when(got, "headers").otherwise("get").alias("stage"),
            F.coalesce(text, F.concat(F.lit("S3 GetObject failed for "), location)).alias("message"),
            F.when(~got, "not in the listing").alias("cause"),
            F.lit(0).cast("long").alias("streamed_bytes"),
            "response_etag",
            F.lit(None).cast("string").alias("result"),
        )
        wanted = judged.filter("verdict = 'ok'").select(*REQUEST, F.col("response_etag").alias("listed_etag"))
    else:
        wanted = wanted.withColumn("listed_etag", F.lit(None).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                size = -1 if row["size"] is None else int(row["size"])
                metadata = ObjectMetadata(row["bucket"], row["object_key"], size, row["etag"])
                made = transfer(metadata, store, consumer, idle_timeout_ms=idle_timeout_ms, headers_checked=checked)
                listed = row.pop("listed_etag")
                rows.append({**row, "cause": None, **made, **({"response_etag": listed} if checked else {})})
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    weight = F.coalesce(F.col("size").cast("long"), F.lit(0)) + OPEN_BYTES
    dealt = packed_by_bytes(wanted, weight, OBJECT, task_bytes)
    done = dealt.select(*REQUEST, "listed_etag").mapInArrow(
        run, f"bucket string, object_key string, size decimal(20,0), etag string, {_MADE}"
    )
    return done if refused is None else done.unionByName(refused)


_ARROW = pa.schema(
    [
        ("bucket", pa.string()),
        ("object_key", pa.string()),
        ("size", pa.decimal128(20, 0)),
        ("etag", pa.string()),
        ("verdict", pa.string()),
        ("stage", pa.string()),
        ("message", pa.string()),
        ("cause", pa.string()),
        ("streamed_bytes", pa.int64()),
        ("response_etag", pa.string()),
        ("result", pa.string()),
    ]
)


def download_completions(
    records: DataFrame,
    store: Store,
    consumer: ConsumerFactory = lambda metadata: Discard(),
    *,
    payload: str = "payload",
    listing: DataFrame | None = None,
    max_object_size: int = MAX_OBJECT_SIZE,
    idle_timeout_ms: int = STREAM_IDLE_TIMEOUT_MS,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """One completion per record: decode its metadata, download the object, hand its chunks to ``consumer``.

    Records carry the delivery token, ``seq`` and the metadata payload. An object
    that several records ask for alike is transferred once; the reason of a
    failure is the text of its first failed stage.
    """
    token = [*TOKEN, "seq"]
    decoded = cut(
        decode_metadata(records, payload, max_object_size=max_object_size).select(
            *token, *REQUEST, "error_code", "error_message"
        ),
        "decoded-metadata",
    )
    rejected = fail(decoded.filter("error_code is not null"), F.col("error_message"))
    accepted = decoded.filter("error_code is null").select(*token, *REQUEST)
    # Stored, so that no object is read a second time.
    made = cut(
        download_objects(
            accepted, store, consumer, listing=listing, idle_timeout_ms=idle_timeout_ms, task_bytes=task_bytes
        ),
        "downloads",
    )
    known = made.select(*[F.col(c).alias(f"_{c}") for c in REQUEST], "verdict", "message")
    same = [_equal(c) for c in REQUEST]
    judged = accepted.join(known, same).select(*token, "verdict", "message")
    good = succeed(judged.filter("verdict = 'ok'"))
    broken = fail(judged.filter("verdict <> 'ok'"), F.col("message"))
    parts = [df.select(*token, "outcome", "reason") for df in (rejected, broken, good)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _equal(name: str) -> Column:
    return F.col(name).eqNullSafe(F.col(f"_{name}")) if name == "etag" else F.col(name) == F.col(f"_{name}")
