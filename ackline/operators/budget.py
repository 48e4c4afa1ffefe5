"""Queue and byte budgets over time, watermarks and pauses.

Input is a log of signed deltas: ``seq, event, queue_delta, bytes_delta``. A
record takes a queue slot from ``enqueued`` to ``dequeued`` and its bytes from
``enqueued`` to ``released``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ackline.params import (
    MEMORY_BUDGET_BYTES,
    PAUSE_HIGH_PERCENT,
    RESUME_LOW_PERCENT,
    U32_MAX,
    WORK_QUEUE_CAPACITY,
    positive,
    watermarks,
)
from ackline.plans.scan import Running, prefix_scan


def budget_occupancy(events: DataFrame) -> DataFrame:
    """Add ``queue_used`` and ``bytes_used`` after each event."""
    return prefix_scan(
        events,
        "seq",
        [
            Running("sum", F.col("queue_delta").cast("long"), "queue_used"),
            Running("sum", F.col("bytes_delta").cast("long"), "bytes_used"),
        ],
    )


def watermark_signals(
    occupancy: DataFrame,
    *,
    queue_total: int = WORK_QUEUE_CAPACITY,
    bytes_total: int = MEMORY_BUDGET_BYTES,
    pause_high_percent: int = PAUSE_HIGH_PERCENT,
    resume_low_percent: int = RESUME_LOW_PERCENT,
) -> DataFrame:
    """Add ``should_pause`` (either budget at the high mark) and ``should_resume`` (both at the low)."""
    positive("queue_total", queue_total)
    positive("bytes_total", bytes_total, U32_MAX)
    high, low = watermarks(pause_high_percent, resume_low_percent)
    queue, size = F.col("queue_used") * 100, F.col("bytes_used") * 100
    return occupancy.withColumns(
        {
            "should_pause": (queue >= queue_total * high) | (size >= bytes_total * high),
            "should_resume": (queue <= queue_total * low) & (size <= bytes_total * low),
        }
    )


def admission_blocked(
    occupancy: DataFrame,
    *,
    queue_total: int = WORK_QUEUE_CAPACITY,
    bytes_total: int = MEMORY_BUDGET_BYTES,
) -> DataFrame:
    """Add ``blocked``: at its arrival the record had no queue slot or no room for its bytes."""
    positive("queue_total", queue_total)
    positive("bytes_total", bytes_total, U32_MAX)
    no_slot = F.col("queue_used") - F.col("queue_delta") >= queue_total
    no_room = F.col("bytes_used") > bytes_total
    return occupancy.withColumn("blocked", (F.col("event") == "enqueued") & (no_slot | no_room))


def paused_state(
    events: DataFrame,
    *,
    queue_total: int = WORK_QUEUE_CAPACITY,
    bytes_total: int = MEMORY_BUDGET_BYTES,
    pause_high_percent: int = PAUSE_HIGH_PERCENT,
    resume_low_percent: int = RESUME_LOW_PERCENT,
) -> DataFrame:
    """Add occupancy, signals, ``blocked``, ``paused`` after each event and ``was_paused`` before.

    Intake runs at first, pauses at the high mark or when a record is blocked,
    and resumes when both budgets are at the low mark; in between it stays as it is.
    """
    signalled = admission_blocked(
        watermark_signals(
            budget_occupancy(events),
            queue_total=queue_total,
            bytes_total=bytes_total,
            pause_high_percent=pause_high_percent,
            resume_low_percent=resume_low_percent,
        ),
        queue_total=queue_total,
        bytes_total=bytes_total,
    )
    signal = F.when(F.col("should_pause") | F.col("blocked"), True).when(F.col("should_resume"), False)
    scanned = prefix_scan(
        signalled.withColumn("_signal", signal),
        "seq",
        [
            Running("last", F.col("_signal"), "paused"),
            Running("last", F.col("_signal"), "was_paused", exclusive=True),
        ],
    )
    return scanned.withColumns(
        {c: F.coalesce(c, F.lit(False)) for c in ("paused", "was_paused")}
    ).drop("_signal")


def pause_transitions(events: DataFrame, **settings: int) -> DataFrame:
    """The events at which intake paused or resumed."""
    states = paused_state(events, **settings).filter(F.col("paused") != F.col("was_paused"))
    action = F.when(F.col("paused"), "pause").otherwise("resume")
    return states.select("seq", action.alias("action"), "queue_used", "bytes_used")


def peak_concurrency(spans: DataFrame, start: str = "start_tick", end: str = "end_tick") -> DataFrame:
    """Largest number of spans open at once; ends count before starts of the same tick."""
    edges = spans.select(F.col(start).alias("tick"), F.lit(1).cast("long").alias("delta")).unionByName(
        spans.select(F.col(end).alias("tick"), F.lit(-1).cast("long").alias("delta"))
    )
    # The peak of a tick comes after all of its edges, so one net delta per tick is
    # enough; that also makes the scan key unique.
    ticks = edges.groupBy("tick").agg(F.sum("delta").alias("delta"))
    scanned = prefix_scan(ticks, "tick", [Running("sum", F.col("delta"), "open")])
    return scanned.agg(F.coalesce(F.max("open"), F.lit(0)).alias("peak"))
