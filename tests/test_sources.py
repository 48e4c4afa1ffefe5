import pytest

from ackline.sources import record_log, start
from ackline.sources.kafka import kafka_options
from ackline.schemas import RECORD

BASE = dict(client_id="c", auto_offset_reset="earliest")


def test_kafka_options():
    options = kafka_options(
        ["a:9092", "b:9092"], ["x", "y"], group_id="g", max_offsets_per_trigger=100, max_payload_bytes=512, **BASE
    )
    assert options == {
        "kafka.bootstrap.servers": "a:9092,b:9092",
        "subscribe": "x,y",
        "kafka.client.id": "c",
        "kafka.isolation.level": "read_committed",
        "kafka.allow.auto.create.topics": "false",
        "kafka.max.partition.fetch.bytes": "512",
        "includeHeaders": "true",
        "failOnDataLoss": "true",
        "groupIdPrefix": "g",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "100",
    }


def test_kafka_start_policies():
    def start(**changes):
        return kafka_options(["a"], ["x"], client_id="c", **changes).get("startingOffsets")

    assert start(auto_offset_reset="latest") == "latest"
    assert start(auto_offset_reset="error", has_checkpoint=True) is None
    assert start(auto_offset_reset="error", starting_offsets='{"x":{"0":5}}') == '{"x":{"0":5}}'
    with pytest.raises(ValueError):
        start(auto_offset_reset="error")
    with pytest.raises(ValueError):
        start(auto_offset_reset="none")
    with pytest.raises(TypeError):
        kafka_options(["a"], ["x"], client_id="c")


@pytest.mark.parametrize("servers, topics", [([], ["x"]), (["a"], []), (["a"], [" "]), (["a", ""], ["x"])])
def test_kafka_rejects_blank_lists(servers, topics):
    with pytest.raises(ValueError):
        kafka_options(servers, topics, **BASE)


def test_intake_bounds():
    assert record_log.log_options(3, None) == {"maxFilesPerTrigger": "3"}
    assert record_log.log_options(None, 10) == {"maxBytesPerTrigger": "10"}
    assert record_log.log_options(None, None) == {}
    with pytest.raises(ValueError):
        record_log.log_options(1, 1)
    with pytest.raises(ValueError):
        record_log.log_options(0, None)


def test_record_log_round_trip(spark, tmp_path):
    rows = [("t", 0, i, i * 10, None if i == 1 else b"k", b"v", [("h", None)], None) for i in range(3)]
    df = spark.createDataFrame(rows, RECORD)
    path = str(tmp_path / "log")
    record_log.write_record_log(df, path)
    back = record_log.read_record_log(spark, path)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert record_log.stream_record_log(spark, path, max_files_per_trigger=1).isStreaming


def test_log_in_order(spark):
    log = spark.range(1000).selectExpr("id * 3 as seq", "id")
    parts = [sorted(r.seq for r in part.collect()) for part in record_log.in_order(log, 4)]
    assert [s for part in parts for s in part] == [3 * i for i in range(1000)] and len(parts) == 4
    assert all(200 < len(part) < 300 for part in parts)
    assert [part.count() for part in record_log.in_order(log.filter("false"), 4)] == [0]
    assert record_log.in_order(log, 1)[0].count() == 1000


def test_start_policy_looks_at_the_checkpoint(spark, tmp_path):
    checkpoint = str(tmp_path / "cp")
    assert start.checkpoint_progress(spark, checkpoint) == (None, None)
    with pytest.raises(start.NoStartingPoint, match="no offsets of an earlier run"):
        start.require_start(spark, checkpoint, auto_offset_reset="error")
    with pytest.raises(start.NoStartingPoint):
        start.subscribe(spark, checkpoint, ["a"], ["x"], client_id="c", auto_offset_reset="error")
    assert start.require_start(spark, checkpoint, auto_offset_reset="error", starting_offsets="{}").planned is None
    assert start.require_start(spark, checkpoint, auto_offset_reset="earliest").planned is None
    (tmp_path / "cp" / "offsets").mkdir(parents=True)
    with pytest.raises(start.NoStartingPoint):
        start.require_start(spark, checkpoint, auto_offset_reset="error")

    log = str(tmp_path / "log")
    failing = [False]

    def run():
        def process(batch, number):
            if failing[0]:
                raise RuntimeError("stopped")

        record_log.write_record_log(spark.createDataFrame([("t", 0, 1, 1, None, b"v", None, None)], RECORD), log)
        stream = record_log.stream_record_log(spark, log)
        query = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()

    run()
    assert start.require_start(spark, checkpoint, auto_offset_reset="error") == (0, 0)
    failing[0] = True
    with pytest.raises(Exception, match="stopped"):
        run()
    # Planned, not committed: a restart repeats it.
    assert start.checkpoint_progress(spark, checkpoint) == (1, 0)
    with pytest.raises(ValueError):
        start.require_start(spark, checkpoint, auto_offset_reset="none")
