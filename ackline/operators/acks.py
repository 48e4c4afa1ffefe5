"""Delivery and completion logs: what each partition may commit, and why.

Within one ``(topic, partition_id, epoch)`` accepted deliveries have strictly
increasing offsets. Let ``c(o)`` be the seq of the first live success of ``o``
after its delivery and ``R(o)`` the largest ``c`` at or below ``o``. Then ``o``
leaves the pending prefix at seq ``R(o)``, and a completion at seq ``s`` moves
the safe offset to ``max{o : R(o) = s} + 1`` if there is such an ``o``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ackline.functions.records import partition_text, record_location
from ackline.operators.epochs import current_assignments, fence, stamp_epochs
from ackline.params import COMMIT_INTERVAL_MS, I64_MAX, choice, positive
from ackline.plans.joins import lookup_join
from ackline.plans.scan import Running, prefix_scan
from ackline.schemas import PARTITION, PROGRESS, PROGRESS_KEYS, TOKEN, TOKEN_KEYS
from ackline.session import cut


def _successes(completions: DataFrame) -> DataFrame:
    return completions.filter(F.col("outcome") == "succeeded")


def first_success(completions: DataFrame) -> DataFrame:
    """The first success of every token; repeats change nothing."""
    firsts = _successes(completions).groupBy(*TOKEN_KEYS).agg(F.min("seq").alias("first_seq"))
    return firsts.select(*TOKEN, "first_seq")


# -- safe prefix -------------------------------------------------------------


def safe_prefix(deliveries: DataFrame, completions: DataFrame, intervals: DataFrame) -> DataFrame:
    """Next offset each current assignment may commit.

    One row per ``(topic, partition_id, epoch)`` current at the end of the log
    whose first delivered record has succeeded. ``deliveries`` are accepted ones.
    """
    return live_prefix(safe_offsets(deliveries, completions), intervals)


def safe_offsets(deliveries: DataFrame, completions: DataFrame) -> DataFrame:
    """``safe_next_offset`` of every epoch, current or not.

    Deliveries and successes meet in one aggregation by token, which combines
    repeats before its shuffle; the first gap of an epoch and the last delivery
    below it are plain minima and maxima, so no epoch is ever gathered or sorted.
    Everything below the first gap has succeeded, so the second pass reads the
    deliveries alone. ``2**63 - 1`` has no next offset and is never included.
    """
    delivered = deliveries.select(*TOKEN, F.col("seq").alias("_delivery"))
    succeeded = _successes(completions).select(*TOKEN, F.col("seq").alias("_success"))
    tokens = (
        delivered.unionByName(succeeded, allowMissingColumns=True)
        .groupBy(*TOKEN_KEYS)
        .agg(F.min("_delivery").alias("_delivery"), F.max("_success").alias("_success"))
    )
    open_ = F.col("_success").isNull() | (F.col("_success") <= F.col("_delivery"))
    # One row per epoch: stored, Catalyst sees its true size and broadcasts it.
    gaps = cut(
        tokens.filter(F.col("_delivery").isNotNull() & open_)
        .groupBy(*PROGRESS_KEYS)
        .agg(F.min("record_offset").alias("_gap")),
        "first-gaps",
    )
    below = F.col("_gap").isNull() | (F.col("record_offset") < F.col("_gap"))
    return (
        lookup_join(deliveries.select(*TOKEN), gaps, PROGRESS_KEYS, "left", spread=["record_offset"])
        .filter(below & (F.col("record_offset") < F.lit(I64_MAX)))
        .groupBy(*PROGRESS_KEYS)
        .agg((F.max("record_offset") + 1).alias("safe_next_offset"))
        .select(*PROGRESS, "safe_next_offset")
    )


def merge_blocks(blocks: DataFrame) -> DataFrame:
    """Combine summaries of offset blocks to ``safe_next_offset`` per epoch.

    ``first_open`` is the lowest delivered offset of a block without success,
    ``last_ok`` its highest delivered offset below that.
    """
    gaps = blocks.groupBy(*PROGRESS_KEYS).agg(F.min("first_open").alias("_gap"))
    reachable = F.col("_gap").isNull() | (F.col("last_ok") < F.col("_gap"))
    return (
        lookup_join(blocks, gaps, PROGRESS, "inner", spread=["offset_block"])
        .filter(reachable & F.col("last_ok").isNotNull())
        .groupBy(*PROGRESS_KEYS)
        .agg((F.max("last_ok") + 1).alias("safe_next_offset"))
    )


def live_prefix(prefixes: DataFrame, intervals: DataFrame) -> DataFrame:
    """Keep the prefixes of current assignments."""
    return prefixes.join(current_assignments(intervals), PROGRESS, "left_semi")


def final_snapshot(deliveries: DataFrame, completions: DataFrame, intervals: DataFrame) -> DataFrame:
    """The offsets to commit at a stop, sorted by topic and partition."""
    return safe_prefix(deliveries, completions, intervals).orderBy(*PARTITION)


# -- positions of deliveries on the completion log ---------------------------


def prefix_positions(deliveries: DataFrame, completions: DataFrame, intervals: DataFrame) -> DataFrame:
    """Accepted deliveries with ``success_seq`` (c) and ``popped_seq`` (R).

    ``popped_seq`` is null while the delivery is not part of the safe prefix.
    """
    live = fence(_successes(completions).select(*TOKEN, "seq"), intervals).filter("is_current")
    live = cut(live.select(*TOKEN, "seq"), "live-successes")
    succeeded = first_success_after(deliveries.select(*TOKEN, "seq"), live)
    never = F.lit(I64_MAX)
    scanned = prefix_scan(
        succeeded,
        "record_offset",
        [Running("max", F.coalesce("success_seq", never), "popped_seq")],
        group=PROGRESS_KEYS,
    )
    return scanned.withColumn("popped_seq", F.when(F.col("popped_seq") < never, F.col("popped_seq")))


def first_success_after(deliveries: DataFrame, successes: DataFrame) -> DataFrame:
    """Add ``success_seq``, the first success of the token after its delivery, to ``deliveries`` (TOKEN, ``seq``, any others).

    Successes are reduced per token before the join. Only tokens whose first
    success came before their delivery look at all their successes again: they
    are normally few, and stored, so Catalyst sees how few and broadcasts them.
    ``successes`` are read twice, best stored.
    """
    firsts = successes.groupBy(*TOKEN_KEYS).agg(F.min("seq").alias("_first"))
    joined = cut(deliveries.join(firsts, TOKEN_KEYS, "left"), "with-first-success")
    early = joined.filter(F.col("_first") <= F.col("seq")).select(*TOKEN, F.col("seq").alias("_delivered"))
    early = cut(early, "early-successes")
    later = cut(
        lookup_join(successes, early, TOKEN_KEYS, "inner", spread=["seq"])
        .filter(F.col("seq") > F.col("_delivered"))
        .groupBy(*TOKEN_KEYS)
        .agg(F.min("seq").alias("_later")),
        "later-successes",
    )
    in_time = F.when(F.col("_first") > F.col("seq"), F.col("_first"))
    return (
        joined.join(later, TOKEN_KEYS, "left")
        .withColumn("success_seq", F.coalesce(in_time, F.col("_later")))
        .select(*deliveries.columns, "success_seq")
    )


def delivery_violations(
    deliveries: DataFrame, completions: DataFrame, intervals: DataFrame, *, positions: DataFrame | None = None
) -> DataFrame:
    """Judge every delivery; the first broken rule wins and rejects change nothing.

    ``verdict``: ``unassigned``, ``epoch_mismatch``, ``duplicate`` (the same
    offset is still pending), ``non_monotonic`` (at or below the last accepted
    offset), else ``ok``. Numeric gaps are legal. ``message`` is null for ``ok``.
    """
    judged = cut(_judge_order(deliveries, intervals), "judged-deliveries")
    if positions is None:
        accepted = judged.filter(F.col("verdict") == "ok")
        positions = cut(prefix_positions(accepted, completions, intervals), "prefix-positions")
    # Normally few: stored, Catalyst sees how few and broadcasts what is looked up.
    late = cut(judged.filter(F.col("verdict") == "late"), "late-deliveries")
    pending = positions.select(
        *TOKEN, F.col("seq").alias("_accepted"), "popped_seq"
    )
    # A token can be repeated any number of times: reduce before looking it up.
    repeated = late.select(*TOKEN).distinct()
    known = pending.join(repeated, TOKEN_KEYS, "left_semi")
    still = (F.col("_accepted") < F.col("seq")) & (
        F.col("popped_seq").isNull() | (F.col("popped_seq") > F.col("seq"))
    )
    settled = (
        lookup_join(late, known, TOKEN_KEYS, "left", spread=["seq"])
        .withColumn("verdict", F.when(still, "duplicate").otherwise("non_monotonic"))
        .select(judged.columns)
    )
    final = judged.filter(F.col("verdict") != "late").unionByName(settled)
    return final.select(*TOKEN, "seq", "verdict", _delivery_message().alias("message"))


def accepted_deliveries(deliveries: DataFrame, intervals: DataFrame) -> DataFrame:
    """The deliveries with verdict ``ok``; needs no completions."""
    return _judge_order(deliveries, intervals).filter(F.col("verdict") == "ok").select(deliveries.columns)


def _judge_order(deliveries: DataFrame, intervals: DataFrame) -> DataFrame:
    """Verdicts up to ``late``: at or below the last accepted offset of its epoch.

    Deliveries of the epoch in force, normally nearly all, are told apart by an
    equality lookup; only the others need the as-of scan that names the epoch
    they should have had.
    """
    # Stored: both scans below read their rows twice.
    fenced = cut(fence(deliveries, intervals), "fenced-deliveries")
    # Rejected offsets never exceed the running maximum, so it is the maximum
    # over accepted deliveries as well.
    ordered = prefix_scan(
        fenced.filter("is_current").drop("is_current"),
        "seq",
        [Running("max", F.col("record_offset"), "_last", exclusive=True)],
        group=PROGRESS_KEYS,
    )
    late = F.when(F.col("record_offset") <= F.col("_last"), "late").otherwise("ok")
    valid = ordered.withColumns({"_in_force": F.col("epoch"), "verdict": late})

    strays = fenced.filter(~F.col("is_current")).drop("is_current").withColumnRenamed("epoch", "_claimed")
    stamped = stamp_epochs(strays, intervals).withColumnsRenamed(
        {"epoch": "_in_force", "_claimed": "epoch"}
    )
    wrong = F.when(F.col("_in_force").isNull(), "unassigned").otherwise("epoch_mismatch")
    return valid.unionByName(
        stamped.withColumns({"_last": F.lit(None).cast("long"), "verdict": wrong})
    )


def _delivery_message():
    tp = partition_text(F.col("topic"), F.col("partition_id"))
    offset = F.col("record_offset").cast("string")
    # Error texts.
    return (
        F.when(
            F.col("verdict") == "unassigned",
            F.concat(F.lit("delivery references unassigned partition "), tp),
        )
        .when(
            F.col("verdict") == "epoch_mismatch",
            F.concat(
                F.lit("delivery epoch "), F.col("epoch").cast("string"),
                F.lit(" does not match assignment epoch "), F.col("_in_force").cast("string"),
                F.lit(" for "), tp,
            ),
        )
        .when(
            F.col("verdict") == "duplicate",
            F.concat(F.lit("duplicate in-flight delivery for "), tp, F.lit(" at offset "), offset),
        )
        .when(
            F.col("verdict") == "non_monotonic",
            F.concat(
                F.lit("non-monotonic delivery for "), tp, F.lit(": offset "), offset,
                F.lit(" followed "), F.col("_last").cast("string"),
            ),
        )
    )


def prefix_advances(
    deliveries: DataFrame, completions: DataFrame, intervals: DataFrame, *, positions: DataFrame | None = None
) -> DataFrame:
    """The completions that moved a safe prefix: ``seq`` and ``safe_next_offset``."""
    if positions is None:
        positions = prefix_positions(deliveries, completions, intervals)
    return _advances(positions)


def _advances(positions: DataFrame) -> DataFrame:
    return (
        positions.filter(F.col("popped_seq").isNotNull() & (F.col("record_offset") < F.lit(I64_MAX)))
        .groupBy(*PROGRESS_KEYS, F.col("popped_seq").alias("seq"))
        .agg((F.max("record_offset") + 1).alias("safe_next_offset"))
    )


def completion_effects(
    deliveries: DataFrame, completions: DataFrame, intervals: DataFrame, *, positions: DataFrame | None = None
) -> DataFrame:
    """What each successful completion did.

    ``effect``: ``stale``, ``unchanged``, ``unknown_delivery`` (error),
    ``store_next`` (with ``safe_next_offset``) or ``offset_overflow`` (error).
    ``cause`` tells the ``unchanged`` ones apart: ``below_safe``, ``repeat`` or
    ``beyond_gap``. ``message`` is set for errors. ``positions`` is a stored
    :func:`prefix_positions`; without it one is stored first.
    """
    if positions is None:
        positions = cut(prefix_positions(deliveries, completions, intervals), "prefix-positions")
    fenced = fence(_successes(completions).select(*TOKEN, "seq"), intervals)
    stale = fenced.filter(~F.col("is_current")).select(*TOKEN, "seq", F.lit("stale").alias("effect"))
    live = fenced.filter("is_current").select(*TOKEN, "seq")

    # First successes are rows of `positions` already. Of those that close a gap
    # together, the one whose own seq it is moved the prefix.
    firsts = positions.filter(F.col("success_seq").isNotNull())
    moves = F.coalesce(F.col("popped_seq") == F.col("success_seq"), F.lit(False))
    waiting = firsts.filter(~moves).select(
        *TOKEN, F.col("success_seq").alias("seq"), F.lit("beyond_gap").alias("cause")
    )
    stores = (
        positions.filter(F.col("popped_seq").isNotNull())
        .groupBy(*PROGRESS_KEYS, F.col("popped_seq").alias("seq"))
        .agg(
            F.max(F.when(moves, F.col("record_offset"))).alias("record_offset"),
            F.max("record_offset").alias("_top"),
        )
    )
    no_next = F.col("_top") == F.lit(I64_MAX)
    stores = stores.select(
        *TOKEN,
        "seq",
        F.when(no_next, "offset_overflow").otherwise("store_next").alias("effect"),
        F.when(~no_next, F.try_add("_top", F.lit(1))).alias("safe_next_offset"),
    )

    # The rest are repeats and strays. The key of this anti join includes seq, and
    # tokens are reduced before they are looked up: no token gets a task of its own.
    first_keys = firsts.select(*TOKEN, F.col("success_seq").alias("seq"))
    others = cut(live.join(first_keys, ["seq", *TOKEN_KEYS], "left_anti"), "other-completions")
    known = positions.withColumnRenamed("seq", "_delivered").join(
        others.select(*TOKEN).distinct(), TOKEN, "left_semi"
    )
    placed = cut(lookup_join(others, known, TOKEN_KEYS, "left", spread=["seq"]), "placed-completions")
    tracked = F.coalesce(F.col("_delivered") < F.col("seq"), F.lit(False))
    repeats = placed.filter(tracked).select(
        *TOKEN,
        "seq",
        F.when(F.col("popped_seq") < F.col("seq"), "below_safe").otherwise("repeat").alias("cause"),
    )
    kept = waiting.unionByName(repeats).withColumn("effect", F.lit("unchanged"))

    # A success of an offset never delivered: harmless below the safe offset of
    # its moment, which is an as-of lookup on the advances of its epoch.
    strays = placed.filter(~tracked).select(*TOKEN, "seq")
    asof = prefix_scan(
        strays.withColumn("_stray", F.lit(True)).unionByName(
            _advances(positions).withColumnRenamed("safe_next_offset", "_safe"), allowMissingColumns=True
        ),
        "seq",
        [Running("last", F.col("_safe"), "_safe_before", exclusive=True)],
        group=PROGRESS_KEYS,
    ).filter("_stray")
    below = F.coalesce(F.col("record_offset") < F.col("_safe_before"), F.lit(False))
    unmatched = asof.select(
        *TOKEN,
        "seq",
        F.when(below, "unchanged").otherwise("unknown_delivery").alias("effect"),
        F.when(below, "below_safe").alias("cause"),
    )

    effects = (
        stale.unionByName(kept, allowMissingColumns=True)
        .unionByName(stores, allowMissingColumns=True)
        .unionByName(unmatched, allowMissingColumns=True)
    )
    tp = partition_text(F.col("topic"), F.col("partition_id"))
    # Error texts.
    message = F.when(
        F.col("effect") == "unknown_delivery",
        F.concat(
            F.lit("completion references unknown delivery for "), tp,
            F.lit(" at offset "), F.col("record_offset").cast("string"),
        ),
    ).when(
        F.col("effect") == "offset_overflow",
        F.concat(F.lit("Kafka offset cannot advance beyond i64::MAX for "), tp),
    )
    return effects.select(*TOKEN, "seq", "effect", "cause", "safe_next_offset", message.alias("message"))


def failed_completions(completions: DataFrame, intervals: DataFrame) -> DataFrame:
    """Failed completions; each is fatal, whether or not its epoch is stale."""
    location = record_location(F.col("topic"), F.col("partition_id"), F.col("record_offset"))
    # Fixed value: error text.
    message = F.concat(
        F.lit("downstream processing failed for "), location,
        F.lit(": "), F.coalesce("reason", F.lit("")),
    )
    failed = completions.filter(F.col("outcome") == "failed").select(*TOKEN, "seq", "reason")
    return fence(failed, intervals).select(
        *TOKEN, "seq", "reason", (~F.col("is_current")).alias("is_stale"), message.alias("message")
    )


# -- states, commits, replay -------------------------------------------------


def committed_by_interval(
    deliveries: DataFrame,
    completions: DataFrame,
    intervals: DataFrame,
    *,
    interval_ms: int = COMMIT_INTERVAL_MS,
    positions: DataFrame | None = None,
) -> DataFrame:
    """Highest offset stored in each commit interval of an epoch.

    Every advance is stored at once; the broker sees the last one of each
    interval. Intervals are aligned to the Unix epoch of the completion's ``ts``.
    """
    positive("interval_ms", interval_ms)
    advances = prefix_advances(deliveries, completions, intervals, positions=positions)
    times = _successes(completions).select(*PROGRESS, "seq", "ts")
    return (
        advances.join(times, ["seq", *PROGRESS_KEYS])
        .groupBy(*PROGRESS_KEYS, F.window("ts", f"{interval_ms} milliseconds").alias("_w"))
        .agg(F.max("safe_next_offset").alias("committed_offset"))
        .select(
            *PROGRESS,
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            "committed_offset",
        )
    )


def last_committed(by_interval: DataFrame) -> DataFrame:
    """Where each partition stands: the last offset its latest epoch with a commit has committed."""
    latest = by_interval.groupBy(*PARTITION).agg(F.max(F.struct("epoch", "committed_offset")).alias("_last"))
    return latest.select(*PARTITION, "_last.epoch", "_last.committed_offset")


def record_states(
    deliveries: DataFrame,
    completions: DataFrame,
    intervals: DataFrame,
    committed: DataFrame,
) -> DataFrame:
    """State of every delivery of a current assignment.

    ``DELIVERED`` without success, ``COMPLETED`` beyond a gap, ``STORED`` below
    the safe offset, ``COMMITTED`` below ``committed.committed_offset`` (one row
    per topic, partition and epoch).
    """
    # One row per partition: stored, Catalyst sees its true size and broadcasts it.
    current = cut(current_assignments(intervals), "current-assignments")
    live = lookup_join(deliveries.select(*TOKEN, "seq"), current, PROGRESS, "left_semi", spread=["record_offset"])
    done = _successes(completions).groupBy(*TOKEN_KEYS).agg(F.max("seq").alias("_success"))
    # A few longs per epoch: stored, Catalyst sees their true size and broadcasts them.
    marks = cut(
        safe_offsets(deliveries, completions).join(
            committed.select(*PROGRESS, "committed_offset"), PROGRESS, "full"
        ),
        "prefix-marks",
    )
    joined = lookup_join(
        live.join(done, TOKEN_KEYS, "left"), marks, PROGRESS, "left", spread=["record_offset"]
    )
    state = (
        F.when(F.col("record_offset") < F.col("committed_offset"), "COMMITTED")
        .when(F.col("record_offset") < F.col("safe_next_offset"), "STORED")
        .when(F.col("_success") > F.col("seq"), "COMPLETED")
        .otherwise("DELIVERED")
    )
    return joined.select(*TOKEN, state.alias("state"))


def replay_set(
    records: DataFrame,
    committed: DataFrame,
    completions: DataFrame,
    *,
    auto_offset_reset: str,
) -> DataFrame:
    """Records a restart reads again.

    A partition resumes at ``committed.committed_offset`` (one row per topic and
    partition). Without one the policy decides: ``earliest`` replays everything,
    ``latest`` nothing, ``error`` fails the job. ``replayed_success`` marks
    records that had already succeeded beyond a gap.
    """
    choice("auto_offset_reset", auto_offset_reset, ("earliest", "latest", "error"))
    # One row per partition: stored, Catalyst sees its true size and broadcasts it.
    marks = cut(committed.select(*PARTITION, "committed_offset"), "committed-offsets")
    resumed = lookup_join(records, marks, PARTITION, "left", spread=["record_offset"])
    missing = F.col("committed_offset").isNull()
    if auto_offset_reset == "earliest":
        wanted = missing | (F.col("record_offset") >= F.col("committed_offset"))
    elif auto_offset_reset == "latest":
        wanted = F.col("record_offset") >= F.col("committed_offset")
    else:
        tp = partition_text(F.col("topic"), F.col("partition_id"))
        refuse = F.raise_error(F.concat(F.lit("no committed offset for "), tp)).cast("boolean")
        wanted = F.when(missing, refuse).otherwise(F.col("record_offset") >= F.col("committed_offset"))
    succeeded = (
        _successes(completions)
        .groupBy(*PARTITION, "record_offset")
        .agg(F.lit(True).alias("_succeeded"))
    )
    return (
        resumed.filter(wanted)
        .join(succeeded, [*PARTITION, "record_offset"], "left")
        .withColumn("replayed_success", F.coalesce("_succeeded", F.lit(False)))
        .drop("_succeeded")
    )


def in_flight(deliveries: DataFrame, completions: DataFrame, intervals: DataFrame) -> DataFrame:
    """Delivered but not succeeded, per current assignment."""
    done = _successes(completions).groupBy(*TOKEN_KEYS).agg(F.max("seq").alias("_success"))
    open_ = (
        deliveries.join(done, TOKEN_KEYS, "left")
        .filter(F.col("_success").isNull() | (F.col("_success") <= F.col("seq")))
        .groupBy(*PROGRESS_KEYS)
        .agg(
            F.count(F.lit(1)).alias("n_records"),
            F.sum("accounted_bytes").alias("n_bytes"),
            F.min("record_offset").alias("first_offset"),
        )
    )
    return live_prefix(open_, intervals)
