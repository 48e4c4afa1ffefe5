"""Verification of object transfers against a listing and a chunk log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ackline.functions.metadata import decode_metadata
from ackline.functions.records import object_location
from ackline.operators.processing import Processor, run_object_processor
from ackline.operators.records import fail
from ackline.params import MAX_OBJECT_SIZE, STREAM_IDLE_TIMEOUT_MS, positive
from ackline.plans.scan import Running, prefix_scan
from ackline.schemas import OBJECT, TOKEN
from ackline.session import cut

REQUEST = [*OBJECT, "size", "etag"]
CHUNK_BLOCK_BITS = 16

# Rank of a failure among those of one chunk.
_STALL, _SIZE, _CONSUMER = 0, 1, 2


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _quoted(value: Column) -> Column:
    """A text in double quotes with inner quotes and backslashes escaped."""
    escaped = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), escaped, F.lit('"'))


def duration_text(milliseconds: int) -> str:
    """``20000`` -> ``20s``, ``1500`` -> ``1.5s``, ``20`` -> ``20ms``."""
    if milliseconds < 1000:
        return f"{milliseconds}ms"
    seconds, rest = divmod(milliseconds, 1000)
    return f"{seconds}s" if not rest else f"{seconds}.{rest:03d}".rstrip("0") + "s"


def distinct_requests(requests: DataFrame) -> DataFrame:
    """One row per object and expectation, however many records ask for it."""
    return requests.select(*REQUEST).distinct()


def verify_headers(requests: DataFrame, listing: DataFrame) -> DataFrame:
    """Judge the response of every request before its body; the first broken rule wins.

    ``requests``: ``bucket, object_key, size, etag`` (distinct). ``verdict``:
    ``get_failed`` (not listed), ``length_omitted``, ``length_negative``,
    ``length_differs``, ``etag_omitted``, ``etag_differs``, else ``ok``. Without
    an expected etag no condition is sent (``if_match`` null) and none is checked.
    """
    answers = listing.select(*OBJECT, "content_length", "response_etag", F.lit(True).alias("_listed"))
    joined = requests.select(*REQUEST).join(answers, OBJECT, "left")
    expected, got = F.col("etag"), F.col("response_etag")
    # Error texts.
    rules = [
        ("get_failed", F.col("_listed").isNull(), F.lit(None).cast("string")),
        ("length_omitted", F.col("content_length").isNull(), _text("S3 response omitted Content-Length")),
        (
            "length_negative",
            F.col("content_length") < 0,
            _text("S3 response contained a negative Content-Length"),
        ),
        (
            "length_differs",
            F.col("content_length") != F.col("size"),
            _text("S3 Content-Length ", F.col("content_length"), " does not match metadata size ", F.col("size")),
        ),
        ("etag_omitted", expected.isNotNull() & got.isNull(), _text("S3 response omitted ETag")),
        (
            "etag_differs",
            expected.isNotNull() & (got != expected),
            _text("S3 ETag ", _quoted(got), " does not match metadata ETag ", _quoted(expected)),
        ),
    ]
    first = F.coalesce(
        *[
            F.when(broken, F.struct(F.lit(code).alias("verdict"), text.alias("message")))
            for code, broken, text in rules
        ],
        F.struct(F.lit("ok").alias("verdict"), F.lit(None).cast("string").alias("message")),
    )
    return joined.select(
        *REQUEST, F.col("etag").alias("if_match"), "response_etag", first.alias("_first")
    ).select(*REQUEST, "if_match", "response_etag", "_first.*")


def _transfers(requests: DataFrame, chunks: DataFrame) -> DataFrame:
    """Nonempty chunk and end rows with running bytes, wait time and request size.

    Chunk rows are shuffled once, by object and chunk block. Request sizes reach
    them through the list of blocks, so an object with very many chunks is
    neither scanned nor joined in a single task.
    """
    block = "chunk_block"
    used = chunks.filter((F.col("kind") == "end") | (F.col("n_bytes") > 0)).select(
        "kind", *OBJECT, "chunk_index", "n_bytes", "arrived_ms", "consumed_ms", "consumer_error"
    )
    scanned = prefix_scan(
        used,
        "chunk_index",
        [
            Running("sum", F.when(F.col("kind") == "chunk", F.col("n_bytes")), "received"),
            Running("last", F.col("consumed_ms"), "_previous", exclusive=True),
        ],
        group=OBJECT,
        block_bits=(CHUNK_BLOCK_BITS,),
        keep_block=block,
    )
    blocks = used.select(*OBJECT, F.shiftright("chunk_index", CHUNK_BLOCK_BITS).cast("long").alias(block)).distinct()
    sized = blocks.join(requests.select(*REQUEST), OBJECT)
    return scanned.join(sized, [*OBJECT, block]).withColumn(
        "waited_ms", F.col("arrived_ms") - F.coalesce("_previous", F.lit(0))
    )


def _body_failures(idle_timeout_ms: int | None) -> list[tuple[str, int, Column, Column]]:
    """(code, rank, broken, message) per row of :func:`_transfers`."""
    chunk, end = F.col("kind") == "chunk", F.col("kind") == "end"
    received, size = F.col("received"), F.col("size")
    # Error texts.
    failures = [
        (
            "exceeded", _SIZE, chunk & (received > size),
            _text("S3 body exceeded metadata size ", size, " after receiving ", received, " bytes"),
        ),
        (
            "truncated", _SIZE, end & (received != size),
            _text("S3 body size ", received, " does not match metadata size ", size),
        ),
        (
            "consumer_error", _CONSUMER, chunk & F.col("consumer_error").isNotNull(),
            _text("object chunk consumer failed: ", F.col("consumer_error")),
        ),
    ]
    if idle_timeout_ms is not None:
        positive("idle_timeout_ms", idle_timeout_ms)
        text = _text(f"S3 body made no progress for {duration_text(idle_timeout_ms)}")
        failures.insert(0, ("stalled", _STALL, F.col("waited_ms") > idle_timeout_ms, text))
    return failures


def verify_body(
    requests: DataFrame, chunks: DataFrame, *, idle_timeout_ms: int | None = None
) -> DataFrame:
    """Judge the body of every request that has chunk rows.

    Empty chunks are skipped. A chunk that would pass ``size`` is refused before
    it is consumed (``exceeded``); the total at the end must equal ``size``
    (``truncated``); a consumer error stops the transfer (``consumer_error``).
    With ``idle_timeout_ms`` a wait beyond it is ``stalled``. The first failure
    by chunk wins. A log without an end row is ``incomplete``.
    ``streamed_bytes`` counts the chunks consumed before the failure.
    """
    none = F.lit(None).cast("string")
    first = F.coalesce(
        *[
            F.when(
                broken,
                F.struct(
                    F.col("chunk_index").alias("chunk_index"),
                    F.lit(rank).alias("rank"),
                    F.lit(code).alias("verdict"),
                    F.when(F.col("kind") == "chunk", F.col("received") - F.col("n_bytes"))
                    .otherwise(F.col("received"))
                    .alias("streamed_bytes"),
                    message.alias("message"),
                ),
            )
            for code, rank, broken, message in sorted(_body_failures(idle_timeout_ms), key=lambda f: f[1])
        ]
    )
    judged = (
        _transfers(requests, chunks)
        .withColumn("_failure", first)
        .groupBy(*REQUEST)
        .agg(
            F.min("_failure").alias("_failure"),
            F.max("received").alias("_received"),
            F.max(F.col("kind") == "end").alias("_ended"),
        )
    )
    failed = F.col("_failure").isNotNull()
    return judged.select(
        *REQUEST,
        F.when(failed, F.col("_failure.verdict"))
        .when(F.col("_ended"), "ok")
        .otherwise("incomplete")
        .alias("verdict"),
        F.when(failed, F.col("_failure.streamed_bytes")).otherwise(F.col("_received")).alias("streamed_bytes"),
        F.when(failed, F.col("_failure.message")).otherwise(none).alias("message"),
    )


def stalled_bodies(
    requests: DataFrame, chunks: DataFrame, *, idle_timeout_ms: int = STREAM_IDLE_TIMEOUT_MS
) -> DataFrame:
    """Waits beyond the idle timeout.

    A wait runs from the end of the previous chunk's consumption to the arrival
    of the next nonempty chunk or of the end; consumer time does not count and
    empty chunks do not interrupt it. A transfer that enforced the timeout would
    have stopped at its first one, as :func:`object_verdict` does.
    """
    positive("idle_timeout_ms", idle_timeout_ms)
    return (
        _transfers(requests, chunks)
        .filter(F.col("waited_ms") > idle_timeout_ms)
        .select(*OBJECT, "chunk_index", "kind", "waited_ms")
    )


def object_verdict(
    requests: DataFrame,
    listing: DataFrame,
    chunks: DataFrame,
    *,
    idle_timeout_ms: int = STREAM_IDLE_TIMEOUT_MS,
) -> DataFrame:
    """Verdict on every distinct request over all stages: get, headers, body.

    ``stage`` is ``get``, ``headers``, ``body`` or null for ``ok``; ``message``
    is the full failure text. A request with good headers and no chunk rows at
    all is ``incomplete``.
    """
    wanted = distinct_requests(requests)
    headers = verify_headers(wanted, listing).withColumnsRenamed(
        {"verdict": "_header", "message": "_header_message"}
    )
    # Bodies are judged per object and size: the etag plays no part in it.
    bodies = verify_body(
        wanted.select(*OBJECT, "size").distinct().withColumn("etag", F.lit(None).cast("string")),
        chunks,
        idle_timeout_ms=idle_timeout_ms,
    ).select(
        *OBJECT, "size", F.col("verdict").alias("_body"), F.col("message").alias("_body_message")
    )
    joined = headers.join(bodies, [*OBJECT, "size"], "left")
    location = object_location(F.col("bucket"), F.col("object_key"))
    bad_header = F.col("_header") != "ok"
    body = F.coalesce("_body", F.lit("incomplete"))
    # Error texts.
    message = (
        F.when(F.col("_header") == "get_failed", _text("S3 GetObject failed for ", location))
        .when(bad_header, _text("S3 response validation failed for ", location, ": ", F.col("_header_message")))
        .when(
            body != "ok",
            F.concat_ws(": ", _text("S3 body streaming failed for ", location), F.col("_body_message")),
        )
    )
    stage = (
        F.when(F.col("_header") == "get_failed", "get")
        .when(bad_header, "headers")
        .when(body != "ok", "body")
    )
    return joined.select(
        *REQUEST,
        "response_etag",
        F.when(bad_header, F.col("_header")).otherwise(body).alias("verdict"),
        stage.alias("stage"),
        message.alias("message"),
    )


def download_summary(verdicts: DataFrame) -> DataFrame:
    """Size and response etag of fully verified objects."""
    return verdicts.filter(F.col("verdict") == "ok").select(
        *OBJECT, "size", F.col("response_etag").alias("etag")
    )


def object_completions(
    records: DataFrame,
    listing: DataFrame,
    chunks: DataFrame,
    *,
    payload: str = "payload",
    processor: Processor | None = None,
    max_object_size: int = MAX_OBJECT_SIZE,
    idle_timeout_ms: int = STREAM_IDLE_TIMEOUT_MS,
    worker_count: int | None = None,
) -> DataFrame:
    """One completion per record: success only if decode, transfer and processor succeed.

    ``records`` carry the delivery token, ``seq`` and the metadata payload; the
    reason is the text of the first stage that failed. Decoded metadata and
    verdicts are stored on the way: several branches start from each.
    """
    token = [*TOKEN, "seq"]
    decoded = cut(
        decode_metadata(records, payload, max_object_size=max_object_size).select(
            *token, *REQUEST, "error_code", "error_message"
        ),
        "decoded-metadata",
    )
    rejected = fail(
        decoded.filter(F.col("error_code").isNotNull()), F.col("error_message")
    ).select(*token, "outcome", "reason")

    accepted = decoded.filter(F.col("error_code").isNull()).select(*token, *REQUEST)
    verdicts = object_verdict(accepted, listing, chunks, idle_timeout_ms=idle_timeout_ms).select(
        *[F.col(c).alias(f"_{c}") for c in REQUEST], "verdict", "message"
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) if c == "etag" else F.col(c) == F.col(f"_{c}") for c in REQUEST]
    # Many records may ask for one object; AQE splits such a skewed join. Stored,
    # so that user code runs over rows that are not computed twice.
    judged = cut(
        accepted.join(verdicts, same, "left").select(*token, *REQUEST, "verdict", "message"),
        "judged-objects",
    )
    broken = fail(judged.filter(F.col("verdict") != "ok"), F.col("message")).select(*token, "outcome", "reason")
    verified = judged.filter(F.col("verdict") == "ok").select(*token, *REQUEST)
    processed = run_object_processor(verified, processor, worker_count=worker_count)
    return rejected.unionByName(broken).unionByName(processed.select(*token, "outcome", "reason"))
