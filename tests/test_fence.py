"""Fencing by range of seq, and how often the operators on logs read them."""

import pytest

from ackline.operators import acks, epochs
from ackline.session import cut

LOG = "seq bigint, event string, list_pos int, topic string, partition_id int, message string"
TOKENS = "topic string, partition_id int, epoch bigint, record_offset bigint, seq bigint"


def _intervals(spark, assignments):
    rows = [(seq, "assigned", 0, "t", p, "") for seq, p in assignments]
    return cut(epochs.epoch_intervals(spark.createDataFrame(rows, LOG)), "intervals")


def _counted(df):
    seen = df.sparkSession.sparkContext.accumulator(0)

    def see(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(see, df.schema), seen


@pytest.mark.parametrize("step", [1, 1000, 2**55])
def test_fence_equals_a_plain_comparison(spark, step):
    spans = [(p, -40 * step + i * step + p) for p in range(2) for i in range(0, 80, 7)]
    intervals = _intervals(spark, [(seq, p) for p, seq in spans] + [(5 * step, 9)])
    seqs = [-(2**63), 2**63 - 1, None, *(i * step + d for i in range(-45, 45, 3) for d in (-1, 0, 1))]
    known = intervals.collect()
    rows = [(r.topic, r.partition_id, r.epoch + more, 0, s) for r in known for more in (0, 99) for s in seqs]
    got = epochs.fence(spark.createDataFrame(rows, TOKENS), intervals).collect()
    at = {(r.partition_id, r.epoch): (r.from_seq, r.to_seq) for r in known}

    def current(partition, epoch, seq):
        if seq is None or (partition, epoch) not in at:
            return False
        start, end = at[partition, epoch]
        return start <= seq and (end is None or seq < end)

    want = [(p, e, s, current(p, e, s)) for _, p, e, _, s in rows]
    assert sorted(map(str, ((r.partition_id, r.epoch, r.seq, r.is_current) for r in got))) == sorted(map(str, want))


def test_short_epochs_are_not_multiplied(spark):
    """As many epochs as events: a row or two each, and up to 65 ranges for one that lasts."""
    intervals = _intervals(spark, [(i, i % 4) for i in range(4000)] + [(0, 9)])
    spans, _ = epochs._by_range(intervals.drop("closed_by"))
    assert spans.filter("partition_id < 9").count() < 1.2 * 4000
    assert 32 <= spans.filter("partition_id = 9").count() <= 65


def test_logs_are_read_once(spark):
    intervals = _intervals(spark, [(i * 50, 0) for i in range(20)])
    rows = [("t", 0, i // 50 + 1, i, i) for i in range(1000)]
    deliveries = spark.createDataFrame(rows, TOKENS)
    done = deliveries.selectExpr("topic", "partition_id", "epoch", "record_offset", "seq + 1 as seq", "'succeeded' as outcome")
    (delivered, n_delivered), (completed, n_completed) = _counted(deliveries), _counted(done)
    verdicts = acks.delivery_violations(delivered, completed, intervals).groupBy("verdict").count().collect()
    assert [tuple(r) for r in verdicts] == [("ok", 1000)]
    assert n_delivered.value == 1000
    assert n_completed.value == 1000
