"""What the operators of this subpackage share."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ackline import session

# A Python task sees at most this much text at a time (and one row at least).
BATCH_BYTES = 16 << 20


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on.

    Arrow batches are bounded by bytes, as single texts may be very long, and a
    skewed join is split even if an aggregate above it wants its partitioning.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")


def keep(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the cluster's shared folder and read back."""
    return session.cut(df, purpose)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType
) -> DataFrame:
    """Apply ``function`` to every Arrow batch of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return df.mapInArrow(run, schema)


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add ``value`` as a column that is computed once a row.

    Catalyst copies a projected expression into filters and later expressions
    that refer to it, where a lambda function would run it for every element.
    It does not copy what a generator puts out.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def shards(rows: int, per_shard: int) -> int:
    """How many tasks of about ``per_shard`` rows hold ``rows`` rows."""
    return max(1, math.ceil(rows / per_shard))


# A row is told from others by its id and the hash of its text; rows equal in both are copies.
KEY = ["doc", "print"]


def row_key(docs: DataFrame, text: str = "text") -> list[Column]:
    """The key of every row as ``KEY``; a null id is replaced by a second hash of the text."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.lit("no id"), F.col(text)))
    return [doc.alias(KEY[0]), F.xxhash64(F.col(text)).alias(KEY[1])]
