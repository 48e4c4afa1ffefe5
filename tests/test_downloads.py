import hashlib
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from ackline.operators import downloads
from ackline.operators.processing import ObjectMetadata
from ackline.plans.packing import packed_by_bytes
from ackline.schemas import LISTING
from ackline.sources import chunk_source
from ackline.sources import objects as stores

# Consumers defined here travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

REQUEST = "bucket string, object_key string, size bigint, etag string"
ABC, DEF = '"abc"', '"def"'


class Scripted:
    """A store whose answers are given; a number in a body is a wait in seconds."""

    def __init__(self, answers):
        self.answers = answers
        self.asked = []

    def get(self, bucket, key, if_match):
        self.asked.append((bucket, key, if_match))
        answer = self.answers[key]
        if isinstance(answer, Exception):
            raise answer
        length, etag, body = answer

        def chunks():
            for part in body:
                if isinstance(part, Exception):
                    raise part
                if isinstance(part, float):
                    time.sleep(part)
                else:
                    yield part

        return stores.Response(length, etag, chunks())


class Collect:
    def __init__(self, metadata, fail_at=None, slow=0.0):
        self.seen, self.fail_at, self.slow = [], fail_at, slow

    def chunk(self, data):
        time.sleep(self.slow)
        if self.fail_at == len(self.seen):
            raise ValueError("unreadable header")
        self.seen.append(data)

    def finish(self):
        return b"".join(self.seen).decode()


# name: (size, etag, answer), verdict, stage, streamed bytes, text
CASES = {
    "whole": ((6, ABC, (6, ABC, [b"abc", b"def"])), "ok", None, 6, None),
    "no etag asked": ((3, None, (3, DEF, [b"abc"])), "ok", None, 3, None),
    "empty chunks": ((3, None, (3, None, [b"", b"abc", b""])), "ok", None, 3, None),
    "missing": ((3, None, FileNotFoundError("gone")), "get_failed", "get", 0, "S3 GetObject failed for s3://b/missing"),
    "no length": ((3, None, (None, None, [])), "length_omitted", "headers", 0, "S3 response omitted Content-Length"),
    "negative": ((3, None, (-1, None, [])), "length_negative", "headers", 0, "S3 response contained a negative Content-Length"),
    "other length": ((3, None, (4, None, [b"abcd"])), "length_differs", "headers", 0, "S3 Content-Length 4 does not match metadata size 3"),
    "no etag": ((3, ABC, (3, None, [b"abc"])), "etag_omitted", "headers", 0, "S3 response omitted ETag"),
    "other etag": ((3, ABC, (3, DEF, [b"abc"])), "etag_differs", "headers", 0, 'S3 ETag "\\"def\\"" does not match metadata ETag "\\"abc\\""'),
    "too long": ((3, None, (3, None, [b"ab", b"cd"])), "exceeded", "body", 2, "S3 body exceeded metadata size 3 after receiving 4 bytes"),
    "too short": ((3, None, (3, None, [b"ab"])), "truncated", "body", 2, "S3 body size 2 does not match metadata size 3"),
    "broken": ((3, None, (3, None, [b"ab", OSError("connection reset")])), "read_failed", "body", 2, "failed to read S3 response body: connection reset"),
    "stalled": ((3, None, (3, None, [b"ab", 0.6, b"c"])), "stalled", "body", 2, "S3 body made no progress for 200ms"),
    "stalled at once": ((3, None, (3, None, [0.6, b"abc"])), "stalled", "body", 0, "S3 body made no progress for 200ms"),
    "stalled at end": ((3, None, (3, None, [b"abc", 0.6])), "stalled", "body", 3, "S3 body made no progress for 200ms"),
    "empty chunks do not reset": ((3, None, (3, None, [b"ab", 0.12, b"", 0.12, b"", 0.5, b"c"])), "stalled", "body", 2, "S3 body made no progress for 200ms"),
}


@pytest.mark.parametrize("name", CASES)
def test_transfer(name):
    (size, etag, answer), verdict, stage, streamed, text = CASES[name]
    store = Scripted({name: answer})
    made = downloads.transfer(ObjectMetadata("b", name, size, etag), store, Collect, idle_timeout_ms=200)
    assert (made["verdict"], made["stage"], made["streamed_bytes"]) == (verdict, stage, streamed)
    assert store.asked == [("b", name, etag)]
    if text is None:
        assert made["message"] is None and made["result"] == b"".join(answer[2]).decode()
        assert made["response_etag"] == answer[1]
    else:
        assert made["message"].endswith(text) and f"s3://b/{name}" in made["message"] and made["result"] is None


def test_consumer_time_does_not_count_and_its_error_stops_the_transfer():
    answer = (3, None, [b"a", b"b", b"c"])
    metadata = ObjectMetadata("b", "k", 3, None)
    slow = downloads.transfer(metadata, Scripted({"k": answer}), lambda m: Collect(m, slow=0.15), idle_timeout_ms=100)
    assert (slow["verdict"], slow["result"]) == ("ok", "abc")
    seen = Collect(metadata, fail_at=1)
    made = downloads.transfer(metadata, Scripted({"k": answer}), lambda m: seen, idle_timeout_ms=100)
    assert (made["verdict"], made["streamed_bytes"], seen.seen) == ("consumer_error", 1, [b"a"])
    assert made["message"] == "S3 body streaming failed for s3://b/k: object chunk consumer failed: unreadable header"


class Digest:
    def __init__(self, metadata):
        self.hash = hashlib.md5()

    def chunk(self, data):
        self.hash.update(data)

    def finish(self):
        return self.hash.hexdigest()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("store") / "with blank")
    rows = [("b", f"x/{i}", bytes([i]) * (i * 700)) for i in range(1, 9)]
    rows += [("b", f"x/{i}.etag", f'"e{i}"'.encode()) for i in range(1, 8)]
    stores.write_objects(spark.createDataFrame(rows, "bucket string, object_key string, content binary"), root)
    return root


def test_download_objects_from_a_folder(spark, stored):
    wanted = [("b", f"x/{i}", i * 700 + (i == 3), f'"e{i}"' if i != 4 else '"other"') for i in range(1, 9)]
    wanted += [("b", "x/9", 5, None), ("b", "../up", 5, None), (None, "x/1", 5, None), ("b", "x/1", None, None), wanted[0], wanted[0]]
    store = stores.FolderStore(stored, chunk_bytes=1000, etag_suffix=".etag")
    rows = downloads.download_objects(spark.createDataFrame(wanted, REQUEST), store, Digest, task_bytes=3000).collect()
    assert len(rows) == len(set(wanted))
    got = {(r.object_key, r.bucket, None if r.size is None else int(r.size)): r for r in rows}
    good = {i for i in range(1, 9) if got[f"x/{i}", "b", i * 700 + (i == 3)].verdict == "ok"}
    assert good == {1, 2, 5, 6, 7}
    for i in good:
        r = got[f"x/{i}", "b", i * 700]
        assert (r.result, r.streamed_bytes, r.response_etag) == (hashlib.md5(bytes([i]) * (i * 700)).hexdigest(), i * 700, f'"e{i}"')
    assert got["x/3", "b", 2101].verdict == "length_differs" and got["x/4", "b", 2800].verdict == "etag_differs"
    assert got["x/8", "b", 5600].verdict == "etag_omitted"
    assert {got["x/9", "b", 5].verdict, got["../up", "b", 5].verdict, got["x/1", None, 5].verdict} == {"get_failed"}
    assert got["x/1", "b", None].verdict == "length_differs"
    empty = downloads.download_objects(spark.createDataFrame([], REQUEST), store)
    assert empty.collect() == []


def test_listing_decides_before_anything_is_read(spark, stored):
    wanted = spark.createDataFrame([("b", "x/1", 700, ABC), ("b", "x/2", 1400, None), ("b", "x/3", 7, None), ("b", "x/5", 1, None)], REQUEST)
    listing = spark.createDataFrame([("b", "x/1", 700, ABC), ("b", "x/2", 1, None), ("b", "x/5", 1, DEF)], LISTING)
    made = {r.object_key: r for r in downloads.download_objects(wanted, stores.FolderStore(stored), Digest, listing=listing).collect()}
    verdicts = {k: (r.verdict, r.stage) for k, r in made.items()}
    assert verdicts == {"x/1": ("ok", None), "x/2": ("length_differs", "headers"), "x/3": ("get_failed", "get"), "x/5": ("exceeded", "body")}
    assert made["x/1"].response_etag == ABC and made["x/5"].response_etag == DEF and made["x/5"].result is None


def test_completions_from_records(spark, stored):
    payloads = {
        0: '{"bucket":"b","key":"x/1","size":700}', 1: '{"bucket":"b","key":"x/1","size":700}',
        2: '{"bucket":"b","key":"x/1","size":701}', 3: "no json", 4: '{"bucket":"b","key":"x/77","size":1}',
    }
    rows = [("t", 0, 1, i, i * 10, p) for i, p in payloads.items()]
    records = spark.createDataFrame(rows, "topic string, partition_id int, epoch long, record_offset long, seq long, payload string")
    made = downloads.download_completions(records, stores.FolderStore(stored), Digest).collect()
    got = {r.record_offset: (r.outcome, r.reason) for r in made}
    assert {i: o for i, (o, _) in got.items()} == {0: "succeeded", 1: "succeeded", 2: "failed", 3: "failed", 4: "failed"}
    assert "does not match metadata size 701" in got[2][1] and got[4][1] == "S3 GetObject failed for s3://b/x/77"


def test_tasks_are_packed_by_bytes(spark):
    sizes = [(f"k{i}", 100 + i % 7) for i in range(500)] + [("huge", 50_000)]
    df = spark.createDataFrame(sizes, "name string, size long")
    dealt = packed_by_bytes(df, F.col("size"), ["name"], 2000).withColumn("part", F.spark_partition_id())
    by_part = dealt.groupBy("part").agg(F.sum("size").alias("bytes"), F.max("size").alias("most"), F.count("*").alias("n"))
    rows = by_part.collect()
    assert sum(r.n for r in rows) == 501 and sorted(dealt.columns) == ["name", "part", "size"]
    assert all(r.bytes <= 2000 + 2 * 107 for r in rows if r.most < 50_000)
    # Objects are cut into ranges before they are packed, so a huge one is spread.
    requests = spark.createDataFrame([("b", n, s * 64, None) for n, s in sizes], REQUEST)
    ranges = stores.packed_ranges(requests, 1024, 8, 1 << 20).withColumn("part", F.spark_partition_id())
    moved = F.least(F.lit(8192), F.greatest(F.col("size") - F.col("range") * 8192, F.lit(0))) + stores.OPEN_BYTES
    heavy = sorted(r[1] for r in ranges.groupBy("part").agg(F.sum(moved)).collect())
    assert heavy[-1] <= 2 * heavy[len(heavy) // 2]


def test_chunks_as_a_data_source(spark, stored):
    requests = spark.createDataFrame([("b", f"x/{i}", i * 700, None) for i in range(1, 10)], REQUEST)
    options = {"chunk_bytes": 256, "range_chunks": 3}
    loaded = chunk_source.load_object_chunks(requests, stored, task_bytes=1 << 20, **options)
    plain = stores.read_object_chunks(requests, stored, **options)
    assert loaded.rdd.getNumPartitions() > 1
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(loaded) == rows(plain) and len(rows(plain)) > 90
    with pytest.raises(Exception, match="requests"):
        spark.read.format(chunk_source.FORMAT).option("root", stored).load().count()
