import random

import pandas as pd
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ackline.operators import acks
from ackline.schemas import RECORD, TOKEN
from ackline.session import ROCKSDB, STATE_STORE, workspace
from ackline.sources.record_log import stream_record_log, write_record_log
from ackline.streaming import epochs, prefix, run

EVENTS = "topic string, partition_id int, epoch bigint, record_offset bigint, seq bigint, kind string"


def _stream(spark, root, batches, transform, schema, mode="update"):
    """Feed ``batches`` one micro-batch each, restarting between them; the rows put out."""
    spark.conf.set(STATE_STORE, ROCKSDB)
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = stream_record_log(spark, f"{root}/in", spark.createDataFrame([], schema).schema)
        query = (
            transform(stream)
            .writeStream.outputMode(mode)
            .foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{root}/out/batch={n}"))
            .option("checkpointLocation", f"{root}/cp")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return spark.read.parquet(f"{root}/out")


def _prefixes(spark, batches):
    """The safe offsets after the last of ``batches``."""
    out = _stream(spark, workspace(spark, "stream-test"), batches, prefix.stream_prefix, EVENTS)
    merged = acks.merge_blocks(prefix.latest_blocks(out)).collect()
    return {(r.partition_id, r.epoch): r.safe_next_offset for r in merged}


def _state(spark, root, name="stripe"):
    return spark.read.format("statestore").option("stateVarName", name).load(f"{root}/cp").select("value.*").collect()


def test_stream_state_across_batches_and_order(spark):
    """Any order over restarts, repeats included, ends at the batch result."""
    rng = random.Random(3)
    events = []
    for p, offsets in ((0, range(0, 200_000, 4_000)), (1, range(10))):
        for i, o in enumerate(offsets):
            events.append(("t", p, 1, o, i * 10, "delivered"))
            if not (p == 0 and o == 120_000):
                events.append(("t", p, 1, o, i * 10 + 5, "succeeded"))
            if i % 3 == 0:
                events.append(("t", p, 1, o, i * 10 + 7, "succeeded" if o != 120_000 else "delivered"))
    rng.shuffle(events)
    third = len(events) // 3
    got = _prefixes(spark, [events[:third], events[third: 2 * third], events[2 * third:]])
    assert got == {(0, 1): 116_001, (1, 1): 10}


def test_epoch_end_clears_the_state_and_repeats_change_nothing(spark):
    root = workspace(spark, "stream-test")
    event = lambda kind, epoch, offset, seq: ("t", 0, epoch, offset, seq, kind)
    first = [event("assigned", 1, None, 0)]
    first += [event("delivered", 1, o, 10 + o) for o in range(50)]
    first += [event("succeeded", 1, o, 100 + o) for o in range(50) if o != 20]
    _stream(spark, root, [first], prefix.stream_prefix, EVENTS)
    (held,) = [r for r in _state(spark, root) if r.pending_offset]
    assert held.pending_offset == list(range(20, 50)) and held.floor == 1
    second = [event("succeeded", 1, o, 200 + o) for o in range(50) if o != 20]  # repeats
    second += [event("succeeded", 1, 20, 260), event("succeeded", 1, 20, 270), event("delivered", 1, 60, 280)]
    third = [event("revoked", 1, None, 300), event("succeeded", 1, 60, 310), event("assigned", 2, None, 320)]
    third += [event("delivered", 2, 60, 330), event("delivered", 2, 61, 331), event("succeeded", 2, 61, 340), event("succeeded", 1, 60, 345)]
    out = _stream(spark, root, [second, third], prefix.stream_prefix, EVENTS)
    firsts = {(r.epoch, r.record_offset): r.first_seq for r in prefix.first_successes(out).collect()}
    assert firsts == {(1, o): 260 if o == 20 else 100 + o for o in range(50)} | {(2, 61): 340}
    assert prefix.first_successes(out).count() == 51
    states = _state(spark, root)
    assert {(tuple(r.pending_epoch), tuple(r.pending_offset)) for r in states} == {((2, 2), (60, 61)), ((), ())}
    assert {e for r in states for e in r.blocks_epoch} == {2} and {r.floor for r in states} == {2}
    merged = {r.epoch: r.safe_next_offset for r in acks.merge_blocks(prefix.latest_blocks(out)).collect()}
    assert merged == {1: 50}


def test_prefix_state_against_the_batch_operator(spark):
    """Random logs over several epochs, cut into batches by seq, against the set form."""
    rng = random.Random(8)
    log, seq, epoch, offset = [], 0, 0, 0
    pending = []
    for _ in range(400):
        seq += 1
        roll = rng.random()
        if epoch == 0 or roll < 0.02:
            epoch += 1
            pending = []
            log.append(("t", 0, epoch, None, seq, "assigned"))
        elif roll < 0.55:
            offset += rng.choice([1, 1, 3, 40_000])
            pending.append(offset)
            log.append(("t", 0, epoch, offset, seq, "delivered"))
        elif pending:
            o = rng.choice(pending)
            log.append(("t", 0, rng.choice([epoch, epoch, epoch, max(1, epoch - 1)]), o, seq, "succeeded"))
    starts = [e for e in log if e[5] == "assigned"]
    ends = [e[4] for e in starts[1:]] + [None]
    intervals = spark.createDataFrame(
        [("t", 0, e[2], e[4], end, None if end is None else "assigned") for e, end in zip(starts, ends)],
        "topic string, partition_id int, epoch bigint, from_seq bigint, to_seq bigint, closed_by string",
    )
    events = spark.createDataFrame(log, EVENTS)
    deliveries = events.filter("kind = 'delivered'").withColumn("accounted_bytes", F.lit(1).cast("long"))
    completions = events.filter("kind = 'succeeded'").select(
        *TOKEN, "seq", F.lit("succeeded").alias("outcome"), F.lit(None).cast("timestamp").alias("ts")
    )
    out = _stream(spark, workspace(spark, "stream-test"), [log[i : i + 100] for i in range(0, len(log), 100)], prefix.stream_prefix, EVENTS)
    live = acks.live_prefix(acks.merge_blocks(prefix.latest_blocks(out)), intervals)
    assert live.collect() == acks.safe_prefix(deliveries, completions, intervals).collect()
    want = acks.prefix_positions(deliveries, completions, intervals).filter("success_seq is not null").select(*TOKEN, "success_seq")
    assert sorted(map(tuple, prefix.first_successes(out).collect())) == sorted(map(tuple, want.collect()))


def test_offsets_beyond_floating_point(spark):
    big = 2**62 + 1
    event = lambda kind, offset, seq: ("t", 0, 1, offset, seq, kind)
    first = [("t", 0, 1, None, 0, "assigned"), event("delivered", big, 1), event("succeeded", big, 2), event("delivered", 5, 3)]
    second = [event("delivered", big + 2, 4), event("succeeded", big + 2, 5), event("delivered", 2**63 - 1, 6), event("succeeded", 5, 7)]
    # Stripes with blocks that a batch does not touch.
    many = [event(kind, o, 10 + o) for o in range(0, 400_000, 4_000) for kind in ("delivered",)]
    out = _stream(spark, workspace(spark, "stream-test"), [first, many, second], prefix.stream_prefix, EVENTS)
    latest = {r.offset_block: (r.first_open, r.last_ok) for r in prefix.latest_blocks(out).collect()}
    assert latest[big // prefix.BLOCK_OFFSETS] == (None, big + 2)
    assert latest[(2**63 - 1) // prefix.BLOCK_OFFSETS] == (2**63 - 1, None)
    assert {r.record_offset: r.first_seq for r in prefix.first_successes(out).collect()} == {big: 2, big + 2: 5, 5: 7}


def test_events_reach_the_state_packed_by_stripe(spark):
    """The state handler takes each row by itself: many events of a stripe are one row, none is lost."""
    topics = [None, "t"]
    rows = [(topics[i % 2], i % 3, i % 4 if i % 5 else None, i, i + 1, i + 2, i % 2) for i in range(6000)]
    schema = "topic string, partition_id int, stripe int, " + ", ".join(f"{n} bigint" for n in prefix._EVENT)
    single = spark.createDataFrame(rows, schema).coalesce(1)
    change = F.col("stripe").isNull()
    changes = {"change_seq": F.when(change, F.col("seq")), "least": F.when(change, F.col("epoch"))}
    single = single.withColumns(changes).withColumns({n: F.when(~change, F.col(n)) for n in prefix._EVENT})
    packed = single.mapInArrow(prefix.packed, prefix._PACKED).collect()
    assert len(packed) == len({r[:3] for r in rows})
    events = [(r.topic, r.partition_id, r.stripe, *v) for r in packed for v in zip(*(r[n] or () for n in prefix._EVENT))]
    assert sorted(map(str, events)) == sorted(map(str, (r for r in rows if r[2] is not None)))
    ends = [(r.topic, r.partition_id, *v) for r in packed for v in zip(*(r[n] or () for n in prefix._CHANGE))]
    assert sorted(map(str, ends)) == sorted(str((r[0], r[1], r[5], r[3])) for r in rows if r[2] is None)


def test_finished_blocks_are_forgotten():
    size = prefix.BLOCK_OFFSETS
    blocks = pd.DataFrame({"epoch": [1, 1, 1, 2], "block": [0, 1, 5, 0], "last_ok": [9, size + 9, 5 * size, 5], "touched": [1, 1, 30, 30]})
    pending = pd.DataFrame({"epoch": [1], "offset": [size + 10]})
    finished = pd.DataFrame({"epoch": pd.Series(dtype="int64"), "below": pd.Series(dtype="int64")})
    stays, below = prefix.StripePrefix._forgotten(pending, blocks, finished, 40)
    assert stays[["epoch", "block"]].to_numpy().tolist() == [[1, 1], [1, 5], [2, 0]]
    assert below.to_numpy().tolist() == [[1, 1]]


RECORDS = "topic string, partition_id int, record_offset bigint, seq bigint, note string, mark bigint, is_change boolean"


def test_stream_of_epochs(spark):
    root = workspace(spark, "stream-test")
    record = lambda p, o, seq: ("t", p, o, seq, f"n{o}", None, False)
    change = lambda p, seq, epoch: ("t", p, None, seq, None, epoch, True)
    first = [record(0, 1, 5), change(0, 10, 1), record(0, 2, 9), record(0, 3, 10), record(0, 4, 30), change(0, 20, -1), record(0, 5, 19)]
    first += [change(1, 11, 2), *[record(1, o, 12 + o) for o in range(40)]]
    second = [record(0, 6, 40), change(0, 41, 3), record(0, 7, 42), change(1, 60, 4), change(1, 60, -1), record(1, 50, 59), record(1, 51, 60)]
    third = [change(1, 70, -1), record(1, 52, 80), record(0, 8, 81)]
    out = _stream(spark, root, [first, second], epochs.stream_epochs, RECORDS, "append")
    got = {(r.partition_id, r.record_offset): r.epoch for r in out.collect()}
    want = {(0, 1): None, (0, 2): None, (0, 3): 1, (0, 4): None, (0, 5): 1, (0, 6): None, (0, 7): 3, (1, 50): 2, (1, 51): 4}
    assert got == want | {(1, o): 2 for o in range(40)}
    assert {r.epoch for r in _state(spark, root, "epoch")} == {3, 4}
    out = _stream(spark, root, [third], epochs.stream_epochs, RECORDS, "append")
    assert {(r.record_offset, r.epoch) for r in out.filter("seq >= 80").collect()} == {(52, None), (8, 3)}
    # A revoked partition leaves no state behind.
    assert {r.epoch for r in _state(spark, root, "epoch")} == {3}
    assert out.filter("note = concat('n', record_offset)").count() == out.count()


class Poison:
    """Sink that fails one offset while ``armed``."""

    def __init__(self, offset, armed):
        self.offset, self.armed = offset, armed

    def __call__(self, delivered):
        bad = (F.col("record_offset") == self.offset) & F.lit(self.armed)
        return delivered.select(
            *TOKEN,
            F.when(bad, "failed").otherwise("succeeded").alias("outcome"),
            F.when(bad, "the store was closed").alias("reason"),
        )


def _log(spark, n, payload=b"row"):
    path = workspace(spark, "records")
    write_record_log(
        spark.createDataFrame([("orders", 0, i, i, None, payload, None, None) for i in range(n)], RECORD), path
    )
    return path


def test_failed_run_commits_the_prefix_and_restart_resumes_there(spark):
    path = _log(spark, 100)
    paths = run.RunPaths(workspace(spark, "run"))
    query = run.run_with_sink(stream_record_log(spark, path), Poison(40, True), paths, epoch=1)
    with pytest.raises(Exception, match="downstream processing failed for orders\\[0\\] offset 40: the store"):
        query.awaitTermination()
    committed = run.committed_offsets(run.read_acks(spark, paths)).collect()
    assert [r.committed_offset for r in committed] == [40]

    again = run.run_with_sink(stream_record_log(spark, path), Poison(40, False), paths, epoch=2)
    again.awaitTermination()
    acks_table = run.read_acks(spark, paths)
    second = acks_table.filter("epoch = 2").agg(F.min("record_offset"), F.count("*")).head()
    assert tuple(second) == (40, 60)
    assert [r.committed_offset for r in run.committed_offsets(acks_table).collect()] == [100]

    # A third run has nothing left to read.
    run.run_with_sink(stream_record_log(spark, path), Poison(0, True), paths, epoch=3).awaitTermination()
    assert run.read_acks(spark, paths).filter("epoch = 3").count() == 0


def test_failure_at_the_first_record_commits_nothing(spark):
    paths = run.RunPaths(workspace(spark, "run"))
    query = run.run_with_sink(stream_record_log(spark, _log(spark, 3)), Poison(0, True), paths, epoch=1)
    with pytest.raises(Exception, match="the store was closed"):
        query.awaitTermination()
    assert run.committed_offsets(run.read_acks(spark, paths)).count() == 0


def test_oversized_payload_stops_the_run(spark):
    paths = run.RunPaths(workspace(spark, "run"))
    query = run.run_with_sink(
        stream_record_log(spark, _log(spark, 2, b"x" * 600)), Poison(0, False), paths, epoch=1, max_payload_bytes=512
    )
    with pytest.raises(Exception, match="has a 600 byte payload, exceeding max_payload_bytes=512"):
        query.awaitTermination()


def _object_run(spark, payloads, processor, **options):
    path = workspace(spark, "records")
    rows = [("objects", 0, i, i, None, p, None, None) for i, p in enumerate(payloads)]
    write_record_log(spark.createDataFrame(rows, RECORD), path)
    paths = run.RunPaths(workspace(spark, "run"))
    query = run.run_with_object_processor(
        stream_record_log(spark, path), processor, paths, epoch=1, max_object_size=1024, **options
    )
    error = None
    try:
        query.awaitTermination()
    except StreamingQueryException as raised:
        error = str(raised)
    rows = run.read_acks(spark, paths).orderBy("record_offset").collect()
    return error, [(r.outcome, r.reason) for r in rows]


VALID = b'{"bucket":"depot","key":"a/first.txt","size":3}'


def test_object_run_succeeds(spark):
    error, outcomes = _object_run(spark, [VALID] * 6, lambda metadata: None, worker_count=2)
    assert error is None and outcomes == [("succeeded", None)] * 6


def test_object_run_never_processes_what_does_not_decode(spark):
    def processor(metadata):
        raise AssertionError("called")

    error, outcomes = _object_run(spark, [b"size: 1"], processor)
    assert "objects[0] offset 0: object metadata is not valid JSON" in error
    assert outcomes == [("failed", "object metadata is not valid JSON")]


def test_object_run_keeps_the_processor_error(spark):
    def processor(metadata):
        raise RuntimeError("no room for it")

    error, outcomes = _object_run(spark, [VALID], processor)
    assert "no room for it" in error
    assert outcomes == [("failed", "no room for it")]


def test_discarding_run(spark):
    paths = run.RunPaths(workspace(spark, "run"))
    run.run_discarding(stream_record_log(spark, _log(spark, 5)), paths, epoch=1).awaitTermination()
    assert [r.committed_offset for r in run.committed_offsets(run.read_acks(spark, paths)).collect()] == [5]


class Careless:
    """Sink that leaves out one offset, answers another twice, and one it was never given."""

    def __init__(self, silent, twice=None, foreign=None):
        self.silent, self.twice, self.foreign = silent, twice, foreign

    def __call__(self, delivered):
        done = delivered.select(*TOKEN, F.lit("succeeded").alias("outcome"), F.lit(None).cast("string").alias("reason"))
        answers = done.filter(F.col("record_offset") != self.silent)
        if self.twice is not None:
            again = done.filter(F.col("record_offset") == self.twice)
            answers = answers.unionByName(again.withColumns({"outcome": F.lit("failed"), "reason": F.lit("second thoughts")}))
        if self.foreign is not None:
            unknown = done.filter(F.col("record_offset") == 0).withColumn("record_offset", F.lit(self.foreign).cast("long"))
            answers = answers.unionByName(unknown)
        return answers


def test_unanswered_record_is_delivered_again(spark):
    path = _log(spark, 100)
    paths = run.RunPaths(workspace(spark, "run"))
    query = run.run_with_sink(stream_record_log(spark, path), Careless(40), paths, epoch=1)
    with pytest.raises(Exception, match="the sink gave no outcome for orders\\[0\\] offset 40"):
        query.awaitTermination()
    assert [r.committed_offset for r in run.committed_offsets(run.read_acks(spark, paths)).collect()] == [40]
    run.run_with_sink(stream_record_log(spark, path), Careless(-1), paths, epoch=2).awaitTermination()
    acks_table = run.read_acks(spark, paths)
    assert tuple(acks_table.filter("epoch = 2").agg(F.min("record_offset"), F.count("*")).head()) == (40, 60)
    assert [r.committed_offset for r in run.committed_offsets(acks_table).collect()] == [100]


def test_doubled_and_foreign_answers(spark):
    paths = run.RunPaths(workspace(spark, "run"))
    query = run.run_with_sink(stream_record_log(spark, _log(spark, 10)), Careless(-1, twice=4, foreign=77), paths, epoch=1)
    with pytest.raises(Exception, match="offset 4: second thoughts"):
        query.awaitTermination()
    acks_table = run.read_acks(spark, paths)
    assert acks_table.filter("delivered").count() == 10
    assert {(r.record_offset, r.answers, r.kind) for r in run.odd_answers(acks_table).collect()} == {
        (4, 2, "several_answers"),
        (77, 1, "unknown_record"),
    }
    assert [r.committed_offset for r in run.committed_offsets(acks_table).collect()] == [4]


def test_run_number_cannot_be_used_again(spark):
    path = _log(spark, 5)
    paths = run.RunPaths(workspace(spark, "run"))
    query = run.run_with_sink(stream_record_log(spark, path), Poison(2, True), paths, epoch=1)
    with pytest.raises(Exception, match="the store was closed"):
        query.awaitTermination()
    with pytest.raises(ValueError, match="run 1 has written acks"):
        run.run_with_sink(stream_record_log(spark, path), Poison(2, False), paths, epoch=1)
    assert run.read_acks(spark, paths).filter("outcome = 'failed'").count() == 1


def test_replay_over_several_batches(spark):
    path = workspace(spark, "records")
    for part in range(4):
        rows = [("orders", 0, i, i, None, b"row", None, None) for i in range(part * 25, part * 25 + 25)]
        spark.createDataFrame(rows, RECORD).coalesce(1).write.mode("append").parquet(path)
    paths = run.RunPaths(workspace(spark, "run"))
    first = stream_record_log(spark, path, max_files_per_trigger=1)
    with pytest.raises(Exception, match="offset 60: the store was closed"):
        run.run_with_sink(first, Poison(60, True), paths, epoch=1).awaitTermination()
    again = stream_record_log(spark, path, max_files_per_trigger=1)
    run.run_with_sink(again, Poison(60, False), paths, epoch=2).awaitTermination()
    acks_table = run.read_acks(spark, paths)
    assert tuple(acks_table.filter("epoch = 2").agg(F.min("record_offset"), F.count("*")).head()) == (60, 40)
    assert [r.committed_offset for r in run.committed_offsets(acks_table).collect()] == [100]
