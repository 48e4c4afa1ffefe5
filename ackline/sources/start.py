"""Where a stream starts: its checkpoint is looked at before anything runs."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ackline.params import choice
from ackline.sources.kafka import kafka_options, stream_kafka

POLICIES = ("earliest", "latest", "error")


class Progress(NamedTuple):
    """Last micro-batch planned and last one committed in a checkpoint; null if none."""

    planned: int | None
    committed: int | None


class NoStartingPoint(ValueError):
    """The policy ``error`` and nothing that says where to start."""


def _last_batch(spark: SparkSession, folder: str) -> int | None:
    """The highest number among the files of a checkpoint log, on any file system Spark reads."""
    # Log files are named by batch; those compacted or being written are not plain numbers.
    files = spark.read.format("binaryFile").option("pathGlobFilter", "[0-9]*")
    try:
        names = files.load(folder).select(F.element_at(F.split("path", "/"), -1).alias("name"))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return names.filter(F.col("name").rlike("^[0-9]+$")).agg(F.max(F.col("name").cast("long"))).first()[0]


def checkpoint_progress(spark: SparkSession, checkpoint: str) -> Progress:
    """What the offset and commit logs below ``checkpoint`` say; nothing is changed."""
    root = checkpoint.rstrip("/")
    return Progress(_last_batch(spark, f"{root}/offsets"), _last_batch(spark, f"{root}/commits"))


def require_start(
    spark: SparkSession, checkpoint: str, *, auto_offset_reset: str, starting_offsets: str | None = None
) -> Progress:
    """Refuse to start under the policy ``error`` without a checkpoint that has planned a batch, or explicit offsets."""
    choice("auto_offset_reset", auto_offset_reset, POLICIES)
    found = checkpoint_progress(spark, checkpoint)
    if auto_offset_reset == "error" and found.planned is None and starting_offsets is None:
        raise NoStartingPoint(
            f"auto_offset_reset=error: {checkpoint} has no offsets of an earlier run and no starting_offsets are given"
        )
    return found


def subscribe(
    spark: SparkSession,
    checkpoint: str,
    bootstrap_servers: list[str],
    topics: list[str],
    *,
    auto_offset_reset: str,
    starting_offsets: str | None = None,
    **options,
) -> DataFrame:
    """A Kafka stream for a run with ``checkpoint``, started as the policy says."""
    found = require_start(spark, checkpoint, auto_offset_reset=auto_offset_reset, starting_offsets=starting_offsets)
    made = kafka_options(
        bootstrap_servers,
        topics,
        auto_offset_reset=auto_offset_reset,
        starting_offsets=starting_offsets,
        has_checkpoint=found.planned is not None,
        **options,
    )
    return stream_kafka(spark, made)
