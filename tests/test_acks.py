import random

import pytest
from pyspark.sql import functions as F

from ackline.operators import acks, epochs, snapshots
from ackline.schemas import ASSIGNMENT_EVENT, COMPLETION, DELIVERY
from ackline.session import cut
from model import TOP, Tracker

TOPIC, P = "audit", 2


class Log:
    """Collects the three logs while the model runs the same events."""

    def __init__(self):
        self.tracker = Tracker()
        self.seq = 0
        self.assignments, self.deliveries, self.completions = [], [], []
        self.verdicts, self.effects, self.snapshot = {}, {}, {}

    def _next(self):
        self.seq += 1
        return self.seq

    def assign(self, *partitions):
        seq = self._next()
        for i, p in enumerate(partitions):
            self.assignments.append((seq, "assigned", i, TOPIC, p, ""))
            self.tracker.assign((TOPIC, p))

    def revoke(self, *partitions):
        seq = self._next()
        for i, p in enumerate(partitions):
            self.assignments.append((seq, "revoked", i, TOPIC, p, ""))
            self.tracker.revoke((TOPIC, p))

    def deliver(self, p, epoch, offset):
        seq = self._next()
        self.deliveries.append((TOPIC, p, epoch, offset, seq, 100))
        self.verdicts[seq] = self.tracker.deliver((TOPIC, p), epoch, offset)

    def succeed(self, p, epoch, offset):
        seq = self._next()
        self.completions.append((TOPIC, p, epoch, offset, seq, None, "succeeded", None))
        self.effects[seq] = self.tracker.succeed((TOPIC, p), epoch, offset)

    def fail(self, p, epoch, offset, reason):
        self.completions.append((TOPIC, p, epoch, offset, self._next(), None, "failed", reason))

    def frames(self, spark):
        log = spark.createDataFrame(self.assignments, ASSIGNMENT_EVENT)
        return (
            spark.createDataFrame(self.deliveries, DELIVERY),
            spark.createDataFrame(self.completions, COMPLETION),
            cut(epochs.epoch_intervals(log), "intervals"),
        )


def merged(logs):
    """One log of all ``logs``, each under its own topic, one after the other."""
    total = Log()
    seq = epoch = 0
    for i, log in enumerate(logs):
        topic = f"{TOPIC}-{i}"
        # Epochs come from one counter: shift those that name no real epoch too.
        total.assignments += [(r[0] + seq, *r[1:3], topic, *r[4:]) for r in log.assignments]
        total.deliveries += [(topic, r[1], r[2] + epoch, r[3], r[4] + seq, r[5]) for r in log.deliveries]
        total.completions += [(topic, r[1], r[2] + epoch, r[3], r[4] + seq, *r[5:]) for r in log.completions]
        total.verdicts.update({k + seq: v for k, v in log.verdicts.items()})
        total.effects.update({k + seq: v for k, v in log.effects.items()})
        total.snapshot.update(
            {(topic, p, e + epoch): safe for (_, p, e), safe in log.tracker.snapshot().items()}
        )
        seq += log.seq
        epoch += log.tracker.assignments()
    return total


SCENARIOS = []


def scenario(build):
    SCENARIOS.append(build)
    return build


@pytest.fixture(scope="module")
def everything(spark):
    """All scenarios and some random logs in one set of frames."""
    return merged([build() for build in SCENARIOS] + [_random_log(seed, 400) for seed in range(6)])


def test_verdicts_match_the_sequential_model(spark, everything):
    verdicts = acks.delivery_violations(*everything.frames(spark))
    assert {r.seq: r.verdict for r in verdicts.collect()} == everything.verdicts


def test_effects_and_prefixes_match_the_sequential_model(spark, everything):
    deliveries, completions, intervals = everything.frames(spark)
    accepted = cut(acks.accepted_deliveries(deliveries, intervals), "accepted")
    effects = cut(acks.completion_effects(accepted, completions, intervals), "effects")
    assert {r.seq: (r.effect, r.safe_next_offset) for r in effects.collect()} == everything.effects
    safe = acks.safe_prefix(accepted, completions, intervals)
    got = {(r.topic, r.partition_id, r.epoch): r.safe_next_offset for r in safe.collect()}
    assert got == everything.snapshot
    overflow = effects.filter("effect = 'offset_overflow'").collect()
    assert [r.message.split(" for ")[0] for r in overflow] == ["Kafka offset cannot advance beyond i64::MAX"]


@scenario
def numeric_gaps():
    log = Log()
    log.assign(P)
    for offset in (100, 102, 105):
        log.deliver(P, 1, offset)
    log.succeed(P, 1, 102)
    log.succeed(P, 1, 100)
    log.succeed(P, 1, 105)
    assert list(log.effects.values()) == [("unchanged", None), ("store_next", 103), ("store_next", 106)]
    return log


@scenario
def stale_epoch_leaves_nothing_to_commit():
    log = Log()
    log.assign(P)
    log.deliver(P, 1, 10)
    log.revoke(P)
    log.assign(P)
    log.succeed(P, 1, 10)
    assert list(log.effects.values()) == [("stale", None)]
    assert log.tracker.snapshot() == {}
    return log


@scenario
def gap_blocks_prefix():
    log = Log()
    log.assign(P)
    for offset in (100, 101, 102):
        log.deliver(P, 1, offset)
    log.succeed(P, 1, 100)
    log.succeed(P, 1, 102)
    assert log.tracker.snapshot() == {(TOPIC, P, 1): 101}
    return log


@scenario
def revoked_partition_has_no_snapshot():
    log = Log()
    log.assign(P)
    for offset in (20, 21, 22):
        log.deliver(P, 1, offset)
    log.succeed(P, 1, 20)
    log.succeed(P, 1, 22)
    log.revoke(P)
    return log


def test_rejected_deliveries_and_messages(spark):
    log = Log()
    log.deliver(P, 1, 1)
    log.assign(P)
    log.assign(P)
    log.deliver(P, 1, 1)
    log.deliver(P, 2, 102)
    log.succeed(P, 2, 102)
    log.deliver(P, 2, 100)
    log.deliver(P, 2, 110)
    log.deliver(P, 2, 110)
    assert list(log.verdicts.values()) == [
        "unassigned", "epoch_mismatch", "ok", "non_monotonic", "ok", "duplicate",
    ]
    deliveries, completions, intervals = log.frames(spark)
    messages = {
        r.verdict: r.message for r in acks.delivery_violations(deliveries, completions, intervals).collect()
    }
    assert messages == {
        "ok": None,
        "unassigned": "delivery references unassigned partition audit[2]",
        "epoch_mismatch": "delivery epoch 1 does not match assignment epoch 2 for audit[2]",
        "non_monotonic": "non-monotonic delivery for audit[2]: offset 100 followed 102",
        "duplicate": "duplicate in-flight delivery for audit[2] at offset 110",
    }


@scenario
def unknown_and_gap_completions():
    log = Log()
    log.assign(P)
    log.succeed(P, 1, 5)  # before any delivery
    log.deliver(P, 1, 5)
    log.deliver(P, 1, 9)
    log.succeed(P, 1, 7)  # inside a numeric gap above the safe offset
    log.succeed(P, 1, 5)
    log.succeed(P, 1, 9)
    log.succeed(P, 1, 7)  # the same gap, now below it
    log.succeed(P, 1, 9)
    assert [e for e, _ in log.effects.values()] == [
        "unknown_delivery", "unknown_delivery", "store_next", "store_next", "unchanged", "unchanged",
    ]
    return log


@scenario
def largest_offset_has_no_next():
    log = Log()
    log.assign(P)
    log.deliver(P, 1, TOP - 1)
    log.deliver(P, 1, TOP)
    log.succeed(P, 1, TOP - 1)
    log.succeed(P, 1, TOP)
    assert list(log.effects.values()) == [("store_next", TOP), ("offset_overflow", None)]
    return log


def test_failures_are_fatal_even_when_stale(spark):
    log = Log()
    log.assign(P)
    log.deliver(P, 1, 1)
    log.assign(P)
    log.fail(P, 1, 1, "disk full")
    log.deliver(P, 2, 1)
    log.fail(P, 2, 1, "again")
    _, completions, intervals = log.frames(spark)
    rows = acks.failed_completions(completions, intervals).orderBy("seq").collect()
    assert [(r.is_stale, r.message) for r in rows] == [
        (True, "downstream processing failed for audit[2] offset 1: disk full"),
        (False, "downstream processing failed for audit[2] offset 1: again"),
    ]


def _random_log(seed, n, partitions=3):
    rng = random.Random(seed)
    log = Log()
    log.assign(*range(partitions))
    sent = []
    for _ in range(n):
        p = rng.choice([0, 0, 0, *range(partitions)])
        epoch = log.tracker.epoch_of((TOPIC, p)) or rng.randint(1, 4)
        action = rng.random()
        if action < 0.42:
            last = max(log.tracker.offsets((TOPIC, p), "delivery"), default=None)
            offset = rng.choice([(last or 0) + rng.choice([1, 1, 1, 2, 70_000]), rng.randint(0, 12)])
            if rng.random() < 0.05:
                epoch += 1
            log.deliver(p, epoch, offset)
            sent.append((p, epoch, offset))
        elif action < 0.9 and sent:
            log.succeed(*rng.choice(sent[-8:] if rng.random() < 0.8 else sent))
        elif action < 0.93:
            log.succeed(p, epoch, rng.randint(0, 12))
        elif action < 0.96:
            log.revoke(p)
        else:
            log.assign(p)
    log.deliver(0, 99, 0)
    log.succeed(0, 99, 0)
    return log


@scenario
def hot_token_and_hot_partition():
    """A third of the completions repeat one token; nearly all rows share a partition."""
    log = Log()
    log.assign(0, 1)
    for offset in range(300):
        log.deliver(0, 1, offset)
    log.deliver(1, 2, 0)
    for offset in range(300):
        if offset != 250:
            log.succeed(0, 1, offset)
    for _ in range(150):
        log.succeed(0, 1, 260)
    return log


def test_replay_policies(spark):
    records = spark.createDataFrame(
        [("t", 0, i) for i in range(5)] + [("t", 1, i) for i in range(3)],
        "topic string, partition_id int, record_offset bigint",
    )
    committed = spark.createDataFrame([("t", 0, 2)], "topic string, partition_id int, committed_offset bigint")
    done = spark.createDataFrame(
        [("t", 0, 1, o, s, None, "succeeded", None) for s, o in enumerate((0, 1, 3))], COMPLETION
    )

    def replayed(policy):
        rows = acks.replay_set(records, committed, done, auto_offset_reset=policy).collect()
        return sorted((r.partition_id, r.record_offset, r.replayed_success) for r in rows)

    resumed = [(0, 2, False), (0, 3, True), (0, 4, False)]
    assert replayed("latest") == resumed
    assert replayed("earliest") == resumed + [(1, i, False) for i in range(3)]
    with pytest.raises(Exception, match=r"no committed offset for t\[1\]"):
        replayed("error")
    with pytest.raises(ValueError):
        replayed("newest")


def test_first_success_ignores_repeats_and_failures(spark):
    log = Log()
    log.assign(P)
    log.deliver(P, 1, 1)
    log.fail(P, 1, 1, "x")
    log.succeed(P, 1, 1)
    log.succeed(P, 1, 1)
    _, completions, _ = log.frames(spark)
    rows = acks.first_success(completions).collect()
    assert [(r.record_offset, r.first_seq) for r in rows] == [(1, 4)]


def test_final_snapshot_is_sorted_and_counts_assignments(spark):
    log = Log()
    log.assign(3, 1, 2)
    for p, epoch in ((3, 1), (1, 2), (2, 3)):
        log.deliver(p, epoch, 0)
    log.succeed(3, 1, 0)
    log.succeed(1, 2, 0)
    rows = acks.final_snapshot(*log.frames(spark)).collect()
    assert [(r.partition_id, r.safe_next_offset) for r in rows] == [(1, 1), (3, 1)]


def test_in_flight(spark):
    log = Log()
    log.assign(P)
    for offset in range(4):
        log.deliver(P, 1, offset)
    log.succeed(P, 1, 0)
    log.succeed(P, 1, 2)
    row = acks.in_flight(*log.frames(spark)).head()
    assert (row.n_records, row.n_bytes, row.first_offset) == (2, 200, 1)


def test_intervals_reassign_and_unknown_revoke(spark):
    log = Log()
    log.revoke(0)
    log.assign(0)
    log.assign(0)
    log.revoke(0, 7)
    intervals = epochs.epoch_intervals(spark.createDataFrame(log.assignments, ASSIGNMENT_EVENT))
    rows = sorted((r.epoch, r.from_seq, r.to_seq, r.closed_by) for r in intervals.collect())
    assert rows == [(1, 2, 3, "assigned"), (2, 3, 4, "revoked")]
    assert [(r.seq, r.epoch) for r in epochs.effective_revokes(intervals).collect()] == [(4, 2)]
    assert epochs.current_assignments(intervals).count() == 0


@pytest.mark.parametrize("method", ["scan", "join"])
def test_stamp_at_interval_edges(spark, method):
    intervals = spark.createDataFrame(
        [("t", 0, 1, 10, 20, "revoked"), ("t", 0, 2, 30, 40, "assigned"), ("t", 0, 3, 40, None, None)],
        "topic string, partition_id int, epoch bigint, from_seq bigint, to_seq bigint, closed_by string",
    )
    events = spark.createDataFrame(
        [("t", 0, s) for s in (9, 10, 19, 20, 29, 30, 39, 40, 10**12)] + [("t", 1, 15)],
        "topic string, partition_id int, seq bigint",
    )
    stamped = epochs.stamp_epochs(events, intervals, method=method)
    got = {(r.partition_id, r.seq): r.epoch for r in stamped.collect()}
    assert got == {
        (0, 9): None, (0, 10): 1, (0, 19): 1, (0, 20): None, (0, 29): None,
        (0, 30): 2, (0, 39): 2, (0, 40): 3, (0, 10**12): 3, (1, 15): None,
    }


def test_live_and_stale_split_all_events(spark):
    log = Log()
    log.assign(0, 1)
    log.assign(1)
    for p, e in ((0, 1), (1, 2), (1, 3)):
        log.succeed(p, e, 0)
    _, completions, intervals = log.frames(spark)
    assert sorted(r.epoch for r in epochs.live_events(completions, intervals).collect()) == [1, 3]
    assert [r.epoch for r in epochs.stale_events(completions, intervals).collect()] == [2]


def test_record_states(spark):
    log = Log()
    log.assign(P)
    for offset in range(5):
        log.deliver(P, 1, offset)
    for offset in (0, 1, 3):
        log.succeed(P, 1, offset)
    committed = spark.createDataFrame(
        [(TOPIC, P, 1, 1)], "topic string, partition_id int, epoch bigint, committed_offset bigint"
    )
    states = acks.record_states(*log.frames(spark), committed)
    assert [r.state for r in states.orderBy("record_offset").collect()] == [
        "COMMITTED", "STORED", "DELIVERED", "COMPLETED", "DELIVERED",
    ]


def test_commit_intervals(spark):
    log = Log()
    log.assign(P)
    for offset in range(4):
        log.deliver(P, 1, offset)
        log.succeed(P, 1, offset)
    deliveries, completions, intervals = log.frames(spark)
    times = {0: 0, 1: 4999, 2: 5000, 3: 12000}
    ms = F.element_at(F.create_map(*[F.lit(x) for kv in times.items() for x in kv]), F.col("record_offset").cast("int"))
    timed = completions.withColumn("ts", F.timestamp_millis(ms))
    rows = acks.committed_by_interval(deliveries, timed, intervals).orderBy("window_start").collect()
    assert [r.committed_offset for r in rows] == [2, 3, 4]
    with pytest.raises(ValueError):
        acks.committed_by_interval(deliveries, timed, intervals, interval_ms=0)


def test_snapshots_in_steps(spark, tmp_path):
    """Steps over a log with an epoch that ends between them, a gap that closes late, and repeats."""
    tok = lambda epoch, offset, seq: ("t", 0, epoch, offset, seq, 7)
    delivered = [tok(1, o, 10 + o) for o in range(6)] + [tok(2, o, 60 + o) for o in range(6, 10)]
    success = [(1, 1, 20), (1, 2, 21), (1, 0, 30), (1, 0, 31), (1, 4, 33), (1, 3, 55), (2, 6, 70), (2, 8, 71), (1, 5, 72), (2, 7, 80), (2, 7, 81)]
    deliveries = spark.createDataFrame(delivered, "topic string, partition_id int, epoch long, record_offset long, seq long, accounted_bytes long")
    completions = spark.createDataFrame(
        [("t", 0, e, o, s, None, "succeeded") for e, o, s in success],
        "topic string, partition_id int, epoch long, record_offset long, seq long, ts timestamp, outcome string",
    )
    intervals = spark.createDataFrame(
        [("t", 0, 1, 0, 50, "revoked"), ("t", 0, 2, 56, None, None)],
        "topic string, partition_id int, epoch long, from_seq long, to_seq long, closed_by string",
    )
    step = snapshots.empty(spark)
    seen, advances = [], []
    for number, (low, high) in enumerate([(0, 25), (25, 40), (40, 40), (40, 75), (75, 99)]):
        new = f"seq > {low} and seq <= {high}"
        step = snapshots.advance(step, deliveries.filter(new), completions.filter(new), intervals, f"{tmp_path}/{number}")
        known = epochs.known_at(intervals, high)
        seen.append({r.epoch: r.safe_next_offset for r in snapshots.safe_prefix(step, known).collect()})
        advances += [(r.epoch, r.seq, r.safe_next_offset) for r in step.advances.collect()]
    assert seen == [{}, {1: 3}, {1: 3}, {2: 7}, {2: 9}]
    assert sorted(advances) == [(1, 30, 3), (2, 70, 7), (2, 80, 9)]
    assert [tuple(r)[2:] for r in snapshots.in_flight(step, intervals).collect()] == [(2, 1, 7, 9)]
    assert [(r.epoch, r.record_offset) for r in step.open.collect()] == [(2, 9)]
    before = step.safe.collect()
    again = snapshots.advance(snapshots.read(spark, f"{tmp_path}/3"), deliveries.filter("seq > 75"), completions.filter("seq > 75"), intervals, f"{tmp_path}/4")
    assert again.safe.collect() == before


def test_first_success_takes_other_columns_along(spark):
    """A step needs one join by token: what else a delivery has comes through it, for any success found late too."""
    deliveries = spark.createDataFrame(
        [("t", 0, 1, 5, 10, 7, None), ("t", 0, 1, 6, 20, 8, 15), ("t", 0, None, 6, 20, 9, None)],
        "topic string, partition_id int, epoch long, record_offset long, seq long, accounted_bytes long, _before long",
    )
    successes = spark.createDataFrame(
        [("t", 0, 1, 5, 3), ("t", 0, 1, 5, 12), ("t", 0, 1, 5, 14), ("t", 0, None, 6, 30)],
        "topic string, partition_id int, epoch long, record_offset long, seq long",
    )
    rows = acks.first_success_after(deliveries, successes).select("accounted_bytes", "_before", "success_seq").collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == {7: (None, 12), 8: (15, None), 9: (None, None)}
