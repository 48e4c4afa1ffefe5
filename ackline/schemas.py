"""Schemas of the logs the operators read and write.

``seq`` is the position of an event in its log: a 64-bit integer, unique within
one log. ``offset`` and ``partition`` are reserved words in SQL dialects, hence
``record_offset`` and ``partition_id``.
"""

from __future__ import annotations

from pyspark.sql import types as T

_HEADER = T.StructType(
    [
        T.StructField("key", T.StringType(), False),
        T.StructField("value", T.BinaryType(), True),
    ]
)

RECORD = T.StructType(
    [
        T.StructField("topic", T.StringType(), False),
        T.StructField("partition_id", T.IntegerType(), False),
        T.StructField("record_offset", T.LongType(), False),
        T.StructField("seq", T.LongType(), True),
        T.StructField("rec_key", T.BinaryType(), True),
        T.StructField("payload", T.BinaryType(), True),
        T.StructField("headers", T.ArrayType(_HEADER, False), True),
        T.StructField("ts", T.TimestampType(), True),
    ]
)

DELIVERY = T.StructType(
    [
        T.StructField("topic", T.StringType(), False),
        T.StructField("partition_id", T.IntegerType(), False),
        T.StructField("epoch", T.LongType(), False),
        T.StructField("record_offset", T.LongType(), False),
        T.StructField("seq", T.LongType(), False),
        T.StructField("accounted_bytes", T.LongType(), True),
    ]
)

COMPLETION = T.StructType(
    [
        T.StructField("topic", T.StringType(), False),
        T.StructField("partition_id", T.IntegerType(), False),
        T.StructField("epoch", T.LongType(), False),
        T.StructField("record_offset", T.LongType(), False),
        T.StructField("seq", T.LongType(), False),
        T.StructField("ts", T.TimestampType(), True),
        T.StructField("outcome", T.StringType(), False),
        T.StructField("reason", T.StringType(), True),
    ]
)

ASSIGNMENT_EVENT = T.StructType(
    [
        T.StructField("seq", T.LongType(), False),
        T.StructField("event", T.StringType(), False),
        T.StructField("list_pos", T.IntegerType(), False),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition_id", T.IntegerType(), True),
        T.StructField("message", T.StringType(), True),
    ]
)

OBJECT_METADATA = T.StructType(
    [
        T.StructField("bucket", T.StringType(), False),
        T.StructField("object_key", T.StringType(), False),
        T.StructField("size", T.DecimalType(20, 0), False),
        T.StructField("etag", T.StringType(), True),
    ]
)

LISTING = T.StructType(
    [
        T.StructField("bucket", T.StringType(), False),
        T.StructField("object_key", T.StringType(), False),
        T.StructField("content_length", T.LongType(), True),
        T.StructField("response_etag", T.StringType(), True),
    ]
)

CHUNK = T.StructType(
    [
        T.StructField("kind", T.StringType(), False),
        T.StructField("bucket", T.StringType(), False),
        T.StructField("object_key", T.StringType(), False),
        T.StructField("chunk_index", T.IntegerType(), False),
        T.StructField("n_bytes", T.LongType(), False),
        T.StructField("arrived_ms", T.LongType(), True),
        T.StructField("consumed_ms", T.LongType(), True),
        T.StructField("consumer_error", T.StringType(), True),
    ]
)

# Keys used by nearly every operator.
PARTITION = ["topic", "partition_id"]
PROGRESS = [*PARTITION, "epoch"]
TOKEN = [*PROGRESS, "record_offset"]
OBJECT = ["bucket", "object_key"]

# The same keys for joins, groupings and windows: the most selective number comes
# first, so that sorts compare prefixes of it and rarely get to the topic text.
PROGRESS_KEYS = ["epoch", "partition_id", "topic"]
TOKEN_KEYS = ["record_offset", *PROGRESS_KEYS]
