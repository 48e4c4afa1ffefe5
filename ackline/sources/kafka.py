"""Kafka topics as RECORD frames and streams (needs the spark-sql-kafka connector)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ackline.operators.records import record_envelope
from ackline.params import MAX_PAYLOAD_BYTES, choice, names, positive


def kafka_options(
    bootstrap_servers: Sequence[str],
    topics: Sequence[str],
    *,
    client_id: str,
    auto_offset_reset: str,
    group_id: str | None = None,
    starting_offsets: str | None = None,
    has_checkpoint: bool = False,
    max_payload_bytes: int = MAX_PAYLOAD_BYTES,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Source options for a read-committed subscription.

    Progress lives in the checkpoint. ``auto_offset_reset`` is mandatory and
    decides where a run without one starts; ``error`` refuses to start unless
    there is a checkpoint or explicit ``starting_offsets`` (JSON).
    ``max_offsets_per_trigger`` bounds the intake of a micro-batch;
    ``min_partitions`` splits large topic partitions over more tasks.
    """
    choice("auto_offset_reset", auto_offset_reset, ("earliest", "latest", "error"))
    positive("max_payload_bytes", max_payload_bytes)
    options = {
        "kafka.bootstrap.servers": ",".join(names("bootstrap_servers", bootstrap_servers)),
        "subscribe": ",".join(names("topics", topics)),
        "kafka.client.id": names("client_id", [client_id])[0],
        "kafka.isolation.level": "read_committed",
        "kafka.allow.auto.create.topics": "false",
        "kafka.max.partition.fetch.bytes": str(max_payload_bytes),
        "includeHeaders": "true",
        "failOnDataLoss": "true",
    }
    if group_id is not None:
        options["groupIdPrefix"] = names("group_id", [group_id])[0]
    if starting_offsets is not None:
        options["startingOffsets"] = starting_offsets
    elif auto_offset_reset != "error":
        options["startingOffsets"] = auto_offset_reset
    elif not has_checkpoint:
        raise ValueError("auto_offset_reset=error needs a checkpoint or explicit starting_offsets")
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(positive("max_offsets_per_trigger", max_offsets_per_trigger))
    if min_partitions is not None:
        options["minPartitions"] = str(positive("min_partitions", min_partitions))
    return options


def stream_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Subscribe and project to the record envelope."""
    return record_envelope(spark.readStream.format("kafka").options(**options).load())


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Read a bounded range of the topics; ``latest`` has no meaning as a batch start."""
    batch = {k: v for k, v in options.items() if k != "maxOffsetsPerTrigger"}
    if batch.get("startingOffsets") == "latest":
        raise ValueError("a batch read cannot start at latest")
    return record_envelope(spark.read.format("kafka").options(**batch).load())
