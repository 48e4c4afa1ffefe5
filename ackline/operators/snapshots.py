"""The safe prefix carried on from its last stored snapshot, reading only new log rows.

A snapshot holds the safe offset of every epoch in force and the deliveries that
are not part of a prefix yet, each with the first success it has had. New log
rows are joined to these alone, so the work of a step follows what is new and
what is open, not the length of the log. Steps take the logs in the order of
``seq``, as they are written.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ackline.operators.acks import first_success_after
from ackline.operators.epochs import current_assignments, fence, known_at
from ackline.params import COMMIT_INTERVAL_MS, I64_MAX, positive
from ackline.plans.scan import Running, prefix_scan
from ackline.schemas import PROGRESS, PROGRESS_KEYS, TOKEN, TOKEN_KEYS
from ackline.session import cut

_OPEN = "topic string, partition_id int, epoch bigint, record_offset bigint, seq bigint, accounted_bytes bigint, success_seq bigint"
_SAFE = "topic string, partition_id int, epoch bigint, safe_next_offset bigint"
_ADVANCES = "topic string, partition_id int, epoch bigint, seq bigint, safe_next_offset bigint, ts timestamp"


@dataclass(frozen=True)
class Snapshot:
    """What one step leaves to the next, and the advances of the prefix it has seen."""

    open: DataFrame
    safe: DataFrame
    advances: DataFrame


def empty(spark: SparkSession) -> Snapshot:
    """The snapshot before the first log row."""
    return Snapshot(*(spark.createDataFrame([], schema) for schema in (_OPEN, _SAFE, _ADVANCES)))


def read(spark: SparkSession, path: str) -> Snapshot:
    parts = (spark.read.schema(s).parquet(f"{path}/{n}") for n, s in (("open", _OPEN), ("safe", _SAFE), ("advances", _ADVANCES)))
    return Snapshot(*parts)


def advance(last: Snapshot, deliveries: DataFrame, completions: DataFrame, intervals: DataFrame, path: str) -> Snapshot:
    """Take new accepted ``deliveries`` and ``completions`` into account and store the result at ``path``.

    Of ``intervals`` what was known at the last of the new rows counts. Epochs
    that were over by then leave the snapshot; a success of a record that is neither open nor new was
    counted before, or is stale, and changes nothing. A step that is repeated
    with the same input overwrites its own folder with the same result.
    """
    spark = deliveries.sparkSession
    upto = deliveries.select("seq").unionByName(completions.select("seq")).agg(F.max("seq")).first()[0]
    if upto is None:
        return _stored(spark, path, last.open, last.safe, last.advances.filter("false"))
    intervals = known_at(intervals, upto)
    new = deliveries.select(*TOKEN, "seq", "accounted_bytes", F.lit(None).cast("long").alias("success_seq"))
    known = last.open.unionByName(new).withColumnRenamed("success_seq", "_before")
    successes = completions.filter(F.col("outcome") == "succeeded").select(*TOKEN, "seq", "ts")
    # Stored: it is read more than once.
    live = cut(fence(successes, intervals).filter("is_current").drop("is_current"), "live-successes")
    merged = _merged(known, live)
    never = F.lit(I64_MAX)
    # All below what is open has succeeded earlier, so the running maximum may start here.
    scanned = prefix_scan(
        merged, "record_offset", [Running("max", F.coalesce("success_seq", never), "_popped")], group=PROGRESS_KEYS
    )
    scanned.write.mode("overwrite").parquet(f"{path}/positions")
    placed = spark.read.schema(scanned.schema).parquet(f"{path}/positions")
    current = current_assignments(intervals)

    popped = placed.filter((F.col("_popped") < never) & (F.col("record_offset") < never))
    moved = popped.groupBy(*PROGRESS_KEYS, F.col("_popped").alias("seq")).agg((F.max("record_offset") + 1).alias("safe_next_offset"))
    times = live.select(*PROGRESS, "seq", "ts")
    moved = moved.join(times, [*PROGRESS_KEYS, "seq"], "left").select(*PROGRESS, "seq", "safe_next_offset", "ts")
    safe = popped.groupBy(*PROGRESS_KEYS).agg((F.max("record_offset") + 1).alias("safe_next_offset")).select(*PROGRESS, "safe_next_offset")
    safe = last.safe.unionByName(safe).groupBy(*PROGRESS_KEYS).agg(F.max("safe_next_offset").alias("safe_next_offset"))
    still = placed.filter(F.col("_popped") == never).drop("_popped")

    open_ = still.join(current, PROGRESS, "left_semi").select(*TOKEN, "seq", "accounted_bytes", "success_seq")
    return _stored(spark, path, open_, safe.join(current, PROGRESS, "left_semi").select(*PROGRESS, "safe_next_offset"), moved)


def _merged(known: DataFrame, live: DataFrame) -> DataFrame:
    """``known`` deliveries with ``success_seq``: ``_before`` or the first of the ``live`` successes after them.

    Bytes and earlier successes go through the one join by token that finds
    them. Only rows of a repeated token, of which accepted deliveries have none,
    meet all finds of it in a join of their own.
    """
    whole = reduce(and_, [F.col(c).isNotNull() for c in TOKEN_KEYS])
    copies = F.when(whole, F.count(F.lit(1)).over(Window.partitionBy(*TOKEN_KEYS))).otherwise(F.lit(1))
    found = first_success_after(known.withColumn("_copies", copies), live.select(*TOKEN, "seq"))
    found = found.withColumnRenamed("success_seq", "_found")
    several = found.filter("_copies > 1")
    crossed = several.drop("_found").join(several.select(*TOKEN, "_found"), TOKEN_KEYS)
    rows = found.filter("_copies = 1").unionByName(crossed)
    return rows.select(*TOKEN, "seq", "accounted_bytes", F.coalesce("_before", "_found").alias("success_seq"))


def _stored(spark: SparkSession, path: str, open_: DataFrame, safe: DataFrame, advances: DataFrame) -> Snapshot:
    for name, df in (("open", open_), ("safe", safe), ("advances", advances)):
        df.write.mode("overwrite").parquet(f"{path}/{name}")
    return read(spark, path)


def safe_prefix(snapshot: Snapshot, intervals: DataFrame) -> DataFrame:
    """Next offset each current assignment may commit."""
    return snapshot.safe.join(current_assignments(intervals), PROGRESS, "left_semi")


def in_flight(snapshot: Snapshot, intervals: DataFrame) -> DataFrame:
    """Delivered but not succeeded, per current assignment."""
    waiting = snapshot.open.filter("success_seq is null").groupBy(*PROGRESS_KEYS).agg(
        F.count(F.lit(1)).alias("n_records"),
        F.sum("accounted_bytes").alias("n_bytes"),
        F.min("record_offset").alias("first_offset"),
    )
    return waiting.join(current_assignments(intervals), PROGRESS, "left_semi")


def commits(snapshot: Snapshot, *, interval_ms: int = COMMIT_INTERVAL_MS) -> DataFrame:
    """Highest offset the step stored in each commit interval it touched."""
    positive("interval_ms", interval_ms)
    window = F.window("ts", f"{interval_ms} milliseconds")
    return (
        snapshot.advances.groupBy(*PROGRESS_KEYS, window.alias("_w"))
        .agg(F.max("safe_next_offset").alias("committed_offset"))
        .select(*PROGRESS, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "committed_offset")
    )
