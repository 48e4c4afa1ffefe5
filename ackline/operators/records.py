"""Record envelope, guards, routing and completions of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ackline.functions import records as R
from ackline.functions.metadata import decode_metadata
from ackline.params import MAX_OBJECT_SIZE, MAX_PAYLOAD_BYTES, MEMORY_BUDGET_BYTES, U32_MAX, budgets


def record_envelope(messages: DataFrame) -> DataFrame:
    """Project messages in the Kafka source layout to the RECORD schema.

    Null key and payload stay null, headers stay an ordered list. ``seq`` is kept
    if the messages carry one and is null otherwise.
    """
    seq = F.col("seq") if "seq" in messages.columns else F.lit(None)
    return messages.select(
        "topic",
        F.col("partition").cast("int").alias("partition_id"),
        F.col("offset").cast("long").alias("record_offset"),
        seq.cast("long").alias("seq"),
        F.col("key").cast("binary").alias("rec_key"),
        F.col("value").cast("binary").alias("payload"),
        "headers",
        F.col("timestamp").alias("ts"),
    )


def with_accounted_bytes(records: DataFrame) -> DataFrame:
    """Add ``accounted_bytes``."""
    return records.withColumn(
        "accounted_bytes", R.accounted_bytes(F.col("rec_key"), F.col("payload"), F.col("headers"))
    )


def with_location(records: DataFrame) -> DataFrame:
    """Add ``location``, the text ``topic[partition] offset N``."""
    return records.withColumn("location", _location())


def _location() -> Column:
    return R.record_location(F.col("topic"), F.col("partition_id"), F.col("record_offset"))


def payload_guard(
    records: DataFrame,
    *,
    max_payload_bytes: int = MAX_PAYLOAD_BYTES,
    memory_budget_bytes: int = MEMORY_BUDGET_BYTES,
) -> DataFrame:
    """Add ``violation`` and ``message`` for records no budget could ever admit.

    First rule wins: payload over the payload limit, accounting over 32 bits,
    accounted bytes over the whole memory budget. Both columns are null for
    admissible records.
    """
    budgets(max_payload_bytes, memory_budget_bytes)
    sized = with_accounted_bytes(records).withColumn("payload_bytes", R.byte_length(F.col("payload")))
    too_long = F.col("payload_bytes") > max_payload_bytes
    overflow = F.col("accounted_bytes") > F.lit(U32_MAX)
    too_big = F.col("accounted_bytes") > memory_budget_bytes
    violation = (
        F.when(too_long, "payload_too_large")
        .when(overflow, "accounting_overflow")
        .when(too_big, "budget_exceeded")
    )
    # Error texts.
    message = (
        F.when(
            too_long,
            F.concat(
                F.lit("record "), _location(), F.lit(" has a "), F.col("payload_bytes").cast("string"),
                F.lit(f" byte payload, exceeding max_payload_bytes={max_payload_bytes}"),
            ),
        )
        .when(overflow, F.lit(f"record accounting exceeds {U32_MAX} bytes"))
        .when(
            too_big,
            F.concat(
                F.lit("record "), _location(), F.lit(" accounts for "), F.col("accounted_bytes").cast("string"),
                F.lit(f" bytes, exceeding the {memory_budget_bytes} byte ingress budget"),
            ),
        )
    )
    return sized.withColumns({"violation": violation, "message": message})


def fail_closed(df: DataFrame, broken: Column, message: Column) -> DataFrame:
    """Return ``df`` unchanged, failing the job at the first row where ``broken`` holds."""
    guard = F.when(F.coalesce(broken, F.lit(False)), F.raise_error(message)).otherwise(F.lit(True))
    return df.filter(guard)


def first_violation(df: DataFrame, violation: str = "violation", order: str = "seq") -> DataFrame:
    """The one row with the smallest ``order`` among rows with a violation."""
    columns = [c for c in df.columns if c != order]
    return (
        df.filter(F.col(violation).isNotNull())
        .agg(F.min(order).alias(order), F.min_by(F.struct(*columns), F.col(order)).alias("_first"))
        .filter(F.col(order).isNotNull())
        .select(order, "_first.*")
    )


def split_rejects(
    records: DataFrame, payload: str = "payload", *, max_object_size: int = MAX_OBJECT_SIZE
) -> tuple[DataFrame, DataFrame]:
    """Decode object metadata and split into (accepted, rejected).

    Rejected rows keep every column of the source record, so nothing is lost.
    Decoding is narrow and shuffle-free; each branch evaluates it on its own
    scan. To read the source once, write :func:`route_rejects` by ``status``.
    """
    decoded = decode_metadata(records, payload, max_object_size=max_object_size)
    errors = ["error_code", "error_field", "error_message"]
    accepted = decoded.filter(F.col("error_code").isNull()).drop(*errors)
    rejected = decoded.filter(F.col("error_code").isNotNull()).select(*records.columns, *errors)
    return accepted, with_reject_reason(rejected)


def route_rejects(
    records: DataFrame, payload: str = "payload", *, max_object_size: int = MAX_OBJECT_SIZE
) -> DataFrame:
    """One frame with ``status`` accepted or rejected, for a write partitioned by it."""
    decoded = decode_metadata(records, payload, max_object_size=max_object_size)
    status = F.when(F.col("error_code").isNull(), "accepted").otherwise("rejected")
    return with_reject_reason(decoded.withColumn("status", status))


def with_reject_reason(rejected: DataFrame) -> DataFrame:
    """Add ``failure``: the error text under its record location."""
    failure = F.concat(
        F.lit("metadata decode failed for "), _location(), F.lit(": "), F.col("error_message")
    )
    return rejected.withColumn("failure", failure)


def succeed(rows: DataFrame) -> DataFrame:
    """Complete every row with success."""
    return rows.withColumns({"outcome": F.lit("succeeded"), "reason": F.lit(None).cast("string")})


def fail(rows: DataFrame, reason: Column) -> DataFrame:
    """Complete every row with a failure, keeping the reason text."""
    return rows.withColumns({"outcome": F.lit("failed"), "reason": reason})


def discard(deliveries: DataFrame) -> DataFrame:
    """The sink that does nothing with the records: all of them succeed."""
    return succeed(deliveries.select("topic", "partition_id", "epoch", "record_offset", "seq"))
