import random

import pytest

from ackline.operators import budget

SCHEMA = "seq bigint, event string, record_offset bigint, queue_delta int, bytes_delta bigint"


def test_watermark_vectors(spark):
    usage = spark.createDataFrame([(8, 1), (1, 8), (5, 6), (5, 5)], "queue_used bigint, bytes_used bigint")
    rows = budget.watermark_signals(usage, queue_total=10, bytes_total=10).collect()
    assert {(r.queue_used, r.bytes_used): (r.should_pause, r.should_resume) for r in rows} == {
        (8, 1): (True, False), (1, 8): (True, False), (5, 6): (False, False), (5, 5): (False, True),
    }


def _model(events, queue_total, bytes_total, high, low):
    queue = size = 0
    paused, states, moves = False, {}, []
    for seq, event, _, dq, db in sorted(events):
        blocked = event == "enqueued" and (queue >= queue_total or size + db > bytes_total)
        queue, size = queue + dq, size + db
        before = paused
        if blocked or queue * 100 >= queue_total * high or size * 100 >= bytes_total * high:
            paused = True
        elif queue * 100 <= queue_total * low and size * 100 <= bytes_total * low:
            paused = False
        states[seq] = (queue, size, blocked, paused)
        if paused != before:
            moves.append((seq, "pause" if paused else "resume"))
    return states, moves


@pytest.mark.parametrize("seed", [1, 2])
def test_paused_state_matches_a_sequential_model(spark, seed):
    rng = random.Random(seed)
    events = []
    for i in range(400):
        start = i * 3_000_000 + rng.randint(0, 999)
        size = rng.randint(50, 400)
        events.append((start, "enqueued", i, 1, size))
        events.append((start + rng.randint(1, 12) * 1_000_000 + i, "dequeued", i, -1, 0))
        events.append((start + rng.randint(12, 24) * 1_000_000 + 500_000 + i, "released", i, 0, -size))
    settings = dict(queue_total=4, bytes_total=2000, pause_high_percent=80, resume_low_percent=50)
    states, moves = _model(events, 4, 2000, 80, 50)
    df = spark.createDataFrame(events, SCHEMA)
    got = budget.paused_state(df, **settings).collect()
    assert {r.seq: (r.queue_used, r.bytes_used, r.blocked, r.paused) for r in got} == states
    switches = budget.pause_transitions(df, **settings).orderBy("seq").collect()
    assert [(r.seq, r.action) for r in switches] == moves and moves


def test_peak_concurrency(spark):
    spans = spark.createDataFrame([(0, 10), (10, 20), (5, 10), (9, 12)], "start_tick bigint, end_tick bigint")
    assert budget.peak_concurrency(spans).head().peak == 3
    assert budget.peak_concurrency(spans.limit(0)).head().peak == 0
    hot = spark.range(1000).selectExpr("0L AS start_tick", "id + 1 AS end_tick")
    assert budget.peak_concurrency(hot).head().peak == 1000
