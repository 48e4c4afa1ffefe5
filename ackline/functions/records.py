"""Record envelope expressions: accounted size and location texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ackline.params import RECORD_OVERHEAD_BYTES


def byte_length(value: Column) -> Column:
    """Bytes of a text or binary value; null counts 0."""
    return F.coalesce(F.octet_length(value).cast("long"), F.lit(0).cast("long"))


def header_bytes(headers: Column) -> Column:
    """Bytes of all header keys and values; null values count 0."""
    total = F.aggregate(
        headers,
        F.lit(0).cast("long"),
        lambda acc, h: acc + byte_length(h["key"]) + byte_length(h["value"]),
    )
    return F.coalesce(total, F.lit(0).cast("long"))


def accounted_bytes(key: Column, payload: Column, headers: Column) -> Column:
    """Bytes a record is charged for: fixed overhead + key + payload + headers."""
    return (
        F.lit(RECORD_OVERHEAD_BYTES).cast("long")
        + byte_length(key)
        + byte_length(payload)
        + header_bytes(headers)
    )


def partition_text(topic: Column, partition_id: Column) -> Column:
    """``topic[partition]``"""
    return F.concat(topic, F.lit("["), partition_id.cast("string"), F.lit("]"))


def record_location(topic: Column, partition_id: Column, record_offset: Column) -> Column:
    """``topic[partition] offset N``"""
    return F.concat(
        partition_text(topic, partition_id), F.lit(" offset "), record_offset.cast("string")
    )


def object_location(bucket: Column, object_key: Column) -> Column:
    """``s3://bucket/key``"""
    return F.concat(F.lit("s3://"), bucket, F.lit("/"), object_key)
