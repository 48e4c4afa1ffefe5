"""Periodic commits while a run goes on.

Every micro-batch of the ack log carries the snapshot of the one before on and
writes the offsets it stored, by commit interval. Folders are numbered by batch,
so a batch that is repeated after a failure overwrites what it had written.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ackline.operators import snapshots
from ackline.params import COMMIT_INTERVAL_MS, positive
from ackline.schemas import PROGRESS, PROGRESS_KEYS, TOKEN

_COMMITS = "topic string, partition_id int, epoch bigint, window_start timestamp, window_end timestamp, committed_offset bigint, batch bigint"


def ack_log(deliveries: DataFrame, completions: DataFrame) -> DataFrame:
    """Deliveries and completions in one log: token, ``seq``, ``kind``, ``ts``, ``accounted_bytes``, ``outcome``."""
    none = F.lit(None)
    delivered = deliveries.select(
        *TOKEN, "seq", F.lit("delivered").alias("kind"), none.cast("timestamp").alias("ts"), "accounted_bytes",
        none.cast("string").alias("outcome"),
    )
    completed = completions.select(
        *TOKEN, "seq", F.lit("completed").alias("kind"), F.col("ts").cast("timestamp").alias("ts"),
        none.cast("long").alias("accounted_bytes"), "outcome",
    )
    return delivered.unionByName(completed)


def stream_commits(
    log: DataFrame,
    intervals: Callable[[], DataFrame],
    root: str,
    *,
    interval_ms: int = COMMIT_INTERVAL_MS,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Start the run over a stream of :func:`ack_log`; batches come in the order of ``seq``.

    ``intervals`` gives the epoch intervals as known when a batch runs. What is
    below ``root``: ``snapshots``, ``commits`` (:func:`committed`) and the
    checkpoint.
    """
    positive("interval_ms", interval_ms)

    def process(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        last = snapshots.read(spark, f"{root}/snapshots/{number - 1}") if number else snapshots.empty(spark)
        deliveries = batch.filter("kind = 'delivered'").select(*TOKEN, "seq", "accounted_bytes")
        completions = batch.filter("kind = 'completed'").select(*TOKEN, "seq", "ts", "outcome")
        step = snapshots.advance(last, deliveries, completions, intervals(), f"{root}/snapshots/{number}")
        stored = snapshots.commits(step, interval_ms=interval_ms)
        stored.write.mode("overwrite").parquet(f"{root}/commits/batch={number}")

    return (
        log.writeStream.foreachBatch(process)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def committed(spark: SparkSession, root: str) -> DataFrame:
    """The commits of a run so far: an interval that several batches touched has the last offset of them."""
    rows = spark.read.schema(_COMMITS).parquet(f"{root}/commits")
    last = rows.groupBy("window_start", "window_end", *PROGRESS_KEYS).agg(F.max("committed_offset").alias("committed_offset"))
    return last.select(*PROGRESS, "window_start", "window_end", "committed_offset")
