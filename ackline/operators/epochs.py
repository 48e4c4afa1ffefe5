"""Assignment epochs: numbering, validity intervals, as-of stamping and fencing.

The assignment log is treated as data of any size: its global counter and its
per-partition successor lookups run as blocked scans. All other operators take
the interval table :func:`epoch_intervals` makes of it, best stored once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ackline.params import choice
from ackline.plans.joins import lookup_join
from ackline.plans.scan import Running, prefix_scan
from ackline.schemas import PARTITION, PROGRESS


def _changes(log: DataFrame) -> DataFrame:
    """Assign and revoke events; assign events carry their epoch.

    Epochs come from one counter over all partitions, in log and list order.
    """
    changes = log.filter(F.col("event").isin("assigned", "revoked")).select(
        "seq", "list_pos", "event", *PARTITION
    )
    assigned = F.col("event") == "assigned"
    one = F.when(assigned, F.lit(1).cast("long"))
    counted = prefix_scan(changes, "seq", [Running("sum", one, "epoch")], ties=["list_pos"])
    return counted.withColumn("epoch", F.when(assigned, F.col("epoch")))


def assignment_epochs(log: DataFrame) -> DataFrame:
    """Every assign event with its new epoch."""
    return _changes(log).filter(F.col("event") == "assigned").select(
        "seq", "list_pos", *PARTITION, "epoch"
    )


def epoch_intervals(log: DataFrame) -> DataFrame:
    """Validity ``[from_seq, to_seq)`` of every epoch; ``to_seq`` null while current.

    ``closed_by`` is the event that ended the epoch.
    """
    following = [
        Running("last", F.col("seq"), "to_seq", exclusive=True),
        Running("last", F.col("event"), "closed_by", exclusive=True),
    ]
    scanned = prefix_scan(
        _changes(log), "seq", following, group=PARTITION, ties=["list_pos"], reverse=True
    )
    return scanned.filter(F.col("event") == "assigned").select(
        *PARTITION, "epoch", F.col("seq").alias("from_seq"), "to_seq", "closed_by"
    )


def effective_revokes(intervals: DataFrame) -> DataFrame:
    """Revokes of partitions that had an epoch, with that epoch."""
    return intervals.filter(F.col("closed_by") == "revoked").select(
        F.col("to_seq").alias("seq"), *PARTITION, "epoch"
    )


def current_assignments(intervals: DataFrame) -> DataFrame:
    """Partitions assigned at the end of the log, with their epoch."""
    return intervals.filter(F.col("to_seq").isNull()).select(*PROGRESS)


def known_at(intervals: DataFrame, seq: int) -> DataFrame:
    """The intervals as they were known at ``seq``: later epochs are not there, those that end later are current."""
    ended = F.col("to_seq") <= seq
    return intervals.filter(F.col("from_seq") <= seq).withColumns(
        {"to_seq": F.when(ended, F.col("to_seq")), "closed_by": F.when(ended, F.col("closed_by"))}
    )


def stamp_epochs(events: DataFrame, intervals: DataFrame, *, method: str = "scan") -> DataFrame:
    """Add ``epoch``, the epoch in force at each event's ``seq`` (null if none).

    ``scan`` is an as-of scan: one shuffle of the events by partition and seq
    block, whatever the number of epochs or the size of a partition. ``join``
    looks the intervals up by partition and range, for streaming events, which
    cannot be scanned; Catalyst broadcasts the intervals where they are small.
    """
    choice("method", method, ("scan", "join"))
    if method == "join":
        return _stamp_by_join(events, intervals)
    starts = intervals.select(*PARTITION, F.col("from_seq").alias("seq"), F.col("epoch").alias("_mark"))
    ends = effective_revokes(intervals).select(*PARTITION, "seq", F.lit(-1).cast("long").alias("_mark"))
    marks = starts.unionByName(ends)
    both = events.withColumn("_event", F.lit(True)).unionByName(marks, allowMissingColumns=True)
    stamped = prefix_scan(
        # An event at the seq of a change comes after it.
        both.withColumn("_after", F.coalesce("_event", F.lit(False))),
        "seq",
        [Running("last", F.col("_mark"), "epoch")],
        group=PARTITION,
        ties=["_after"],
        tied_values=False,
    )
    return stamped.filter("_event").select(
        *events.columns, F.when(F.col("epoch") >= 0, F.col("epoch")).alias("epoch")
    )


# Seqs in a block of the join by range.
JOIN_BLOCK_BITS = 20


def _stamp_by_join(events: DataFrame, intervals: DataFrame) -> DataFrame:
    """Look ended intervals up by partition and block of ``seq``, those without an end by partition.

    An event meets the intervals that reach into its block, not all of its
    partition's; a partition has at most one interval without an end.
    """
    block = lambda c: F.shiftright(c, JOIN_BLOCK_BITS).cast("long")
    spans = intervals.select(*PARTITION, "from_seq", "to_seq", F.col("epoch").alias("_epoch"))
    ended = spans.filter(F.col("to_seq") > F.col("from_seq"))
    blocks = F.sequence(block(F.col("from_seq")), block(F.col("to_seq") - 1))
    ended = ended.withColumn("_block", F.explode(blocks)).alias("s")
    rows = events.withColumn("_block", block(F.col("seq"))).alias("e")
    keys = [F.col(f"e.{c}") == F.col(f"s.{c}") for c in (*PARTITION, "_block")]
    inside = _inside(F.col("e.seq"), F.col("s.from_seq"), F.col("s.to_seq"))
    names = [F.col(f"e.{c}") for c in events.columns]
    closed = rows.join(ended, [*keys, inside], "left").select(*names, F.col("s._epoch").alias("_ended")).alias("e")
    open_ = spans.filter("to_seq is null").alias("s")
    same = [F.col(f"e.{c}") == F.col(f"s.{c}") for c in PARTITION]
    joined = closed.join(open_, [*same, F.col("e.seq") >= F.col("s.from_seq")], "left")
    return joined.select(*names, F.coalesce("e._ended", "s._epoch").alias("epoch"))


def _inside(seq: Column, from_seq: Column, to_seq: Column) -> Column:
    return (seq >= from_seq) & (to_seq.isNull() | (seq < to_seq))


def assigned_records(records: DataFrame, intervals: DataFrame, *, method: str = "scan") -> DataFrame:
    """Records with their epoch; records outside any assignment are dropped."""
    return stamp_epochs(records, intervals, method=method).filter(F.col("epoch").isNotNull())


def unassigned_records(records: DataFrame, intervals: DataFrame, *, method: str = "scan") -> DataFrame:
    """The records :func:`assigned_records` drops."""
    return stamp_epochs(records, intervals, method=method).filter(F.col("epoch").isNull()).drop("epoch")


# Ranges of seq the log is cut into for fencing: two to this power, or half as many.
FENCE_BITS = 6


def fence(events: DataFrame, intervals: DataFrame) -> DataFrame:
    """Add ``is_current``: the event's epoch was in force at the event's ``seq``.

    Epochs and events meet by range of ``seq``, 32 to 65 over the whole log: a long
    epoch is spread over as many tasks as it has ranges, and a short one, of
    which there may be as many as events, is one row. An event outside all
    ranges of its epoch is not current. The bounds of the ranges are one row
    that reaches the driver; with them the call reads ``intervals``.
    """
    spans, part = _by_range(intervals.drop("closed_by"))
    joined = events.withColumn("_part", part(F.col("seq"))).join(spans, [*PROGRESS, "_part"], "left")
    inside = _inside(F.col("seq"), F.col("from_seq"), F.col("to_seq"))
    return joined.withColumn("is_current", F.coalesce(inside, F.lit(False))).drop("_part", "from_seq", "to_seq")


def _by_range(spans: DataFrame) -> tuple[DataFrame, Callable[[Column], Column]]:
    """A row of ``spans`` for each range of ``seq`` it reaches into, as ``_part``; the range of a ``seq``."""
    low, high = spans.agg(F.min("from_seq"), F.max(F.greatest("from_seq", "to_seq"))).first()
    low, high = low or 0, high or 0
    bits = max(0, (high - low).bit_length() - FENCE_BITS)

    def part(seq: Column) -> Column:
        within = F.least(F.greatest(seq.cast("long"), F.lit(low).cast("long")), F.lit(high).cast("long"))
        return F.when(seq.isNotNull(), F.shiftright(within, bits))

    parts = F.sequence(part(F.col("from_seq")), part(F.coalesce("to_seq", F.lit(high).cast("long"))))
    return spans.withColumn("_part", F.explode(parts)), part


def live_events(events: DataFrame, intervals: DataFrame) -> DataFrame:
    """Events whose epoch is still current at the end of the log."""
    return lookup_join(events, current_assignments(intervals), PROGRESS, "left_semi", spread=["seq"])


def stale_events(events: DataFrame, intervals: DataFrame) -> DataFrame:
    """Events whose epoch is no longer current at the end of the log."""
    return lookup_join(events, current_assignments(intervals), PROGRESS, "left_anti", spread=["seq"])


def rebalance_errors(log: DataFrame) -> DataFrame:
    """Error events, each of which is fatal to a run."""
    # Fixed value: error text.
    text = F.concat(F.lit("Kafka rebalance failed: "), F.coalesce("message", F.lit("")))
    return log.filter(F.col("event") == "error").select("seq", "message", text.alias("failure"))


def rebalance_counts(log: DataFrame, intervals: DataFrame) -> DataFrame:
    """Partitions per rebalance event: all assigned ones, and revoked ones that had an epoch."""
    listed = log.filter(F.col("event").isin("assigned", "revoked"))
    sizes = listed.groupBy("seq", "event").agg(F.count(F.lit(1)).alias("n_listed"))
    revoked = effective_revokes(intervals).groupBy("seq").agg(F.count(F.lit(1)).alias("n_revoked"))
    is_assign = F.col("event") == "assigned"
    n = F.when(is_assign, F.col("n_listed")).otherwise(F.coalesce("n_revoked", F.lit(0)))
    return sizes.join(revoked, "seq", "left").select("seq", "event", "n_listed", n.alias("n_effective"))
