"""Fail-closed streaming runs with a user sink.

Every micro-batch writes its deliveries and completions to an ack table before
it may fail. The table alone says what is safe, so a restart resumes each
partition at its first unacknowledged record.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ackline.functions.metadata import decode_metadata
from ackline.functions.records import record_location
from ackline.operators.acks import safe_offsets
from ackline.operators.processing import Processor, run_object_processor
from ackline.operators.records import discard, fail, payload_guard, with_accounted_bytes
from ackline.params import MAX_OBJECT_SIZE, MAX_PAYLOAD_BYTES, MEMORY_BUDGET_BYTES
from ackline.plans.joins import lookup_join
from ackline.schemas import PARTITION, TOKEN, TOKEN_KEYS

# A sink maps delivered records to one completion row per record:
# topic, partition_id, epoch, record_offset, outcome, reason.
# A record it does not answer stays unacknowledged and keeps its batch
# uncommitted; of several answers for one record a failure counts.
Sink = Callable[[DataFrame], DataFrame]

# ``answers`` is how many rows the sink gave for the record (0: none). A row
# without ``seq`` and with ``delivered`` false answers a record never delivered.
_ACKS = (
    "topic string, partition_id int, epoch bigint, record_offset bigint, seq bigint, ts timestamp, "
    "accounted_bytes bigint, outcome string, reason string, answers bigint, delivered boolean"
)
_ATTEMPTS = _ACKS + ", batch bigint, run bigint"


@dataclass(frozen=True)
class RunPaths:
    """Folders of a run, all below one root on storage every executor shares."""

    root: str

    @property
    def acks(self) -> str:
        return f"{self.root}/acks"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"


def read_acks(spark: SparkSession, paths: RunPaths) -> DataFrame:
    """The ack table of a started run; empty before its first batch.

    Partitioned by ``batch`` and ``run``, the epoch of the run that wrote it.
    """
    return spark.read.schema(_ATTEMPTS).parquet(paths.acks)


def committed_offsets(acks: DataFrame) -> DataFrame:
    """Safe next offset of every partition, over all attempts of all batches.

    A record delivered again after a failure is the same record: the earliest
    delivery and any success count.
    """
    one_epoch = acks.withColumn("epoch", F.lit(0).cast("long"))
    deliveries = one_epoch.filter("delivered").select(*TOKEN, F.lit(0).cast("long").alias("seq"))
    completions = one_epoch.filter(F.col("delivered") & F.col("outcome").isNotNull()).select(*TOKEN, F.lit(1).cast("long").alias("seq"), "outcome")
    return safe_offsets(deliveries, completions).select(
        *PARTITION, F.col("safe_next_offset").alias("committed_offset")
    )


def run_with_sink(
    records: DataFrame,
    sink: Sink,
    paths: RunPaths,
    *,
    epoch: int,
    max_payload_bytes: int = MAX_PAYLOAD_BYTES,
    memory_budget_bytes: int = MEMORY_BUDGET_BYTES,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Start a run over ``records`` (RECORD schema, streaming).

    ``epoch`` numbers the run and must not have been used before. A failed
    completion, a record no budget admits and a record the sink does not answer
    fail the query after the batch's acks are written; Spark then leaves the
    batch uncommitted and repeats it. ``trigger`` goes to ``DataStreamWriter.trigger``;
    by default the run stops at the end of input.
    """
    spark = records.sparkSession
    _refuse_used_run(spark, paths, epoch)
    _seed(spark, f"{paths.acks}/batch=-1/run=0")

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _run_batch(spark, batch, batch_id, sink, paths, epoch, max_payload_bytes, memory_budget_bytes)

    return (
        records.writeStream.foreachBatch(process)
        .option("checkpointLocation", paths.checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def object_sink(
    processor: Processor | None,
    *,
    max_object_size: int = MAX_OBJECT_SIZE,
    worker_count: int | None = None,
) -> Sink:
    """A sink that decodes object metadata and calls ``processor`` on each valid one.

    Records that do not decode fail with the error text and never reach it.
    """

    def sink(delivered: DataFrame) -> DataFrame:
        decoded = decode_metadata(delivered, max_object_size=max_object_size)
        rejected = fail(decoded.filter(F.col("error_code").isNotNull()), F.col("error_message"))
        accepted = decoded.filter(F.col("error_code").isNull())
        processed = run_object_processor(
            accepted.select(*TOKEN, "bucket", "object_key", "size", "etag"), processor, worker_count=worker_count
        )
        columns = [*TOKEN, "outcome", "reason"]
        return processed.select(*columns).unionByName(rejected.select(*columns))

    return sink


def run_with_object_processor(
    records: DataFrame,
    processor: Processor,
    paths: RunPaths,
    *,
    epoch: int,
    max_object_size: int = MAX_OBJECT_SIZE,
    worker_count: int | None = None,
    **limits: Any,
) -> StreamingQuery:
    """:func:`run_with_sink` with an :func:`object_sink`."""
    sink = object_sink(processor, max_object_size=max_object_size, worker_count=worker_count)
    return run_with_sink(records, sink, paths, epoch=epoch, **limits)


def run_discarding(records: DataFrame, paths: RunPaths, *, epoch: int, **limits: Any) -> StreamingQuery:
    """:func:`run_with_sink` with the sink that does nothing and succeeds."""
    return run_with_sink(records, discard, paths, epoch=epoch, **limits)


def _run_batch(
    spark: SparkSession,
    batch: DataFrame,
    batch_id: int,
    sink: Sink,
    paths: RunPaths,
    epoch: int,
    max_payload_bytes: int,
    memory_budget_bytes: int,
) -> None:
    # Only this batch's own attempts are listed and read.
    batch_path = f"{paths.acks}/batch={batch_id}"
    attempt_path = f"{batch_path}/run={epoch}"
    _seed(spark, f"{batch_path}/run=0")
    attempts = spark.read.schema(_ATTEMPTS).option("basePath", paths.acks).parquet(batch_path)
    earlier = attempts.filter(F.col("run") != epoch)
    resumed = lookup_join(
        batch, committed_offsets(earlier), PARTITION, "left", spread=["record_offset"]
    )
    todo = resumed.filter(
        F.col("committed_offset").isNull() | (F.col("record_offset") >= F.col("committed_offset"))
    ).select(batch.columns)
    # The sink and the ack write both read the batch: fetch it from the source once.
    guarded = payload_guard(
        todo.withColumn("epoch", F.lit(epoch).cast("long")),
        max_payload_bytes=max_payload_bytes,
        memory_budget_bytes=memory_budget_bytes,
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        admitted = guarded.filter(F.col("violation").isNull()).drop("violation", "message", "payload_bytes")
        refused = guarded.filter(F.col("violation").isNotNull()).select(
            *TOKEN, F.lit("failed").alias("outcome"), F.col("message").alias("reason")
        )
        outcomes = one_answer(sink(admitted).select(*TOKEN, "outcome", "reason").unionByName(refused))
        delivered = with_accounted_bytes(guarded).select(*TOKEN, "seq", "ts", "accounted_bytes", F.lit(True).alias("delivered"))
        (
            delivered.join(outcomes, TOKEN_KEYS, "full_outer")
            .withColumns({"answers": F.coalesce("answers", F.lit(0).cast("long")), "delivered": F.coalesce("delivered", F.lit(False))})
            .select(*TOKEN, "seq", "ts", "accounted_bytes", "outcome", "reason", "answers", "delivered")
            .write.mode("overwrite")
            .parquet(attempt_path)
        )
    finally:
        guarded.unpersist()
    _stop_on_failure(spark, attempt_path)


def _seed(spark: SparkSession, path: str) -> None:
    """An empty attempt, so that readers never meet a missing folder."""
    spark.createDataFrame([], _ACKS).write.mode("ignore").parquet(path)


def one_answer(outcomes: DataFrame) -> DataFrame:
    """One outcome per token, ``failed`` before ``succeeded``, with the number of answers."""
    best = F.min(F.struct("outcome", "reason")).alias("best")  # "failed" sorts first
    counted = outcomes.groupBy(*TOKEN).agg(best, F.count("*").alias("answers"))
    return counted.select(*TOKEN, "best.outcome", "best.reason", "answers")


def odd_answers(acks: DataFrame) -> DataFrame:
    """What the sink should not have answered: several times, or for records it was not given."""
    kind = F.when(~F.col("delivered"), "unknown_record").otherwise("several_answers")
    return acks.filter("not delivered or answers > 1").select(*TOKEN, "answers", kind.alias("kind"))


def _refuse_used_run(spark: SparkSession, paths: RunPaths, epoch: int) -> None:
    """A run number that has written acks before would overwrite its failed attempt."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{paths.acks}/batch=*/run={epoch}")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    if found is not None and len(found):
        raise ValueError(f"run {epoch} has written acks already: use a number not used before")


def _stop_on_failure(spark: SparkSession, attempt_path: str) -> None:
    """Raise for the first delivered record that failed or has no outcome."""
    location = record_location(F.col("topic"), F.col("partition_id"), F.col("record_offset"))
    # Fixed value: error text.
    failed = F.concat(
        F.lit("downstream processing failed for "), location, F.lit(": "), F.coalesce("reason", F.lit(""))
    )
    unanswered = F.concat(F.lit("the sink gave no outcome for "), location)
    text = F.when(F.col("outcome").isNull(), unanswered).otherwise(failed)
    first = (
        spark.read.schema(_ACKS)
        .parquet(attempt_path)
        .filter(F.col("delivered") & (F.col("outcome").isNull() | (F.col("outcome") == "failed")))
        .agg(F.min_by(text, F.struct("seq", *TOKEN)).alias("first"))
        .head()["first"]
    )
    if first is not None:
        raise RuntimeError(first)
