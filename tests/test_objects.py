import pytest
from pyspark.sql import functions as F

from ackline.operators import objects
from ackline.schemas import CHUNK, LISTING
from ackline.sources import objects as stores

REQUEST = "bucket string, object_key string, size bigint, etag string"
ABC, DEF = '"abc"', '"def"'

# name: (size, expected etag, listed, content length, response etag), verdict, message
HEADERS = {
    "both": ((3, ABC, True, 3, ABC), "ok", None),
    "no etags": ((3, None, True, 3, None), "ok", None),
    "unrequested etag": ((3, None, True, 3, DEF), "ok", None),
    "no length": ((3, None, True, None, None), "length_omitted", "S3 response omitted Content-Length"),
    "negative": ((3, None, True, -1, None), "length_negative", "S3 response contained a negative Content-Length"),
    "size differs": ((3, None, True, 2, None), "length_differs", "S3 Content-Length 2 does not match metadata size 3"),
    "no etag": ((3, ABC, True, 3, None), "etag_omitted", "S3 response omitted ETag"),
    "etag differs": (
        (3, ABC, True, 3, DEF), "etag_differs", 'S3 ETag "\\"def\\"" does not match metadata ETag "\\"abc\\""',
    ),
    "length first": ((3, ABC, True, 2, DEF), "length_differs", "S3 Content-Length 2 does not match metadata size 3"),
    "not listed": ((3, ABC, False, None, None), "get_failed", None),
}


def test_header_vectors(spark):
    requests = spark.createDataFrame([("b", n, v[0][0], v[0][1]) for n, v in HEADERS.items()], REQUEST)
    listing = spark.createDataFrame(
        [("b", n, v[0][3], v[0][4]) for n, v in HEADERS.items() if v[0][2]], LISTING
    )
    rows = objects.verify_headers(requests, listing).collect()
    assert {r.object_key: (r.verdict, r.message) for r in rows} == {n: v[1:] for n, v in HEADERS.items()}
    assert {r.if_match for r in rows if r.etag is None} == {None}


# name: (size, [(kind, index, bytes, arrived, consumed, error)]), verdict, streamed bytes, message
BODIES = {
    "whole": ((6, [("chunk", 0, 3, 10, 20, None), ("chunk", 1, 3, 30, 40, None), ("end", 9, 0, 50, None, None)]), "ok", 6, None),
    "exceeded": (
        (3, [("chunk", 0, 4, 10, 20, None), ("end", 9, 0, 50, None, None)]), "exceeded", 0,
        "S3 body exceeded metadata size 3 after receiving 4 bytes",
    ),
    "truncated": (
        (3, [("chunk", 0, 2, 10, 20, None), ("end", 9, 0, 50, None, None)]), "truncated", 2,
        "S3 body size 2 does not match metadata size 3",
    ),
    "consumer": (
        (3, [("chunk", 0, 3, 10, 20, "unreadable header"), ("end", 9, 0, 50, None, None)]),
        "consumer_error", 0, "object chunk consumer failed: unreadable header",
    ),
    "stalled": ((3, [("chunk", 0, 3, 101, 110, None), ("end", 9, 0, 120, None, None)]), "stalled", 0, "S3 body made no progress for 100ms"),
    "slow consumer": ((2, [("chunk", 0, 1, 10, 400, None), ("chunk", 1, 1, 450, 900, None), ("end", 9, 0, 950, None, None)]), "ok", 2, None),
    "empty chunk does not reset": (
        (2, [("chunk", 0, 1, 10, 20, None), ("chunk", 1, 0, 90, 90, None), ("chunk", 2, 1, 130, 140, None), ("end", 9, 0, 150, None, None)]),
        "stalled", 1, "S3 body made no progress for 100ms",
    ),
    "stalled at end": ((1, [("chunk", 0, 1, 10, 20, None), ("end", 9, 0, 121, None, None)]), "stalled", 1, "S3 body made no progress for 100ms"),
    "no end": ((2, [("chunk", 0, 2, 10, 20, None)]), "incomplete", 2, None),
    "first failure wins": (
        (3, [("chunk", 0, 1, 10, 20, "broken"), ("chunk", 1, 9, 500, 510, None), ("end", 9, 0, 520, None, None)]),
        "consumer_error", 0, "object chunk consumer failed: broken",
    ),
    "stall before excess": ((1, [("chunk", 0, 5, 500, 510, "broken"), ("end", 9, 0, 520, None, None)]), "stalled", 0, "S3 body made no progress for 100ms"),
}


@pytest.fixture(scope="module")
def transfers(spark):
    requests = spark.createDataFrame([("b", n, v[0][0], None) for n, v in BODIES.items()], REQUEST)
    chunks = spark.createDataFrame(
        [(c[0], "b", n, *c[1:]) for n, v in BODIES.items() for c in v[0][1]], CHUNK
    )
    return requests, chunks


def test_body_vectors(transfers):
    rows = objects.verify_body(*transfers, idle_timeout_ms=100).collect()
    got = {r.object_key: (r.verdict, r.streamed_bytes, r.message) for r in rows}
    assert got == {n: v[1:] for n, v in BODIES.items()}


def test_verdict_stages_and_summary(spark, transfers):
    requests, chunks = transfers
    listing = requests.select(
        "bucket", "object_key",
        F.when(F.col("object_key") == "truncated", F.lit(99)).otherwise(F.col("size")).cast("long").alias("content_length"),
        F.lit(ABC).alias("response_etag"),
    ).filter("object_key <> 'exceeded'")
    extra = spark.createDataFrame([("b", "never sent", 5, None)], REQUEST)
    listed = listing.unionByName(spark.createDataFrame([("b", "never sent", 5, ABC)], LISTING))
    # The same object asked for twice gives one verdict.
    verdicts = objects.object_verdict(
        requests.unionByName(requests).unionByName(extra), listed, chunks, idle_timeout_ms=100
    )
    rows = {r.object_key: r for r in verdicts.collect()}
    assert verdicts.count() == len(BODIES) + 1
    assert (rows["exceeded"].stage, rows["exceeded"].message) == ("get", "S3 GetObject failed for s3://b/exceeded")
    assert rows["truncated"].stage == "headers"
    assert rows["truncated"].message == (
        "S3 response validation failed for s3://b/truncated: S3 Content-Length 99 does not match metadata size 3"
    )
    assert rows["consumer"].message == (
        "S3 body streaming failed for s3://b/consumer: object chunk consumer failed: unreadable header"
    )
    assert (rows["never sent"].verdict, rows["never sent"].stage) == ("incomplete", "body")
    summary = objects.download_summary(verdicts).collect()
    assert {(r.object_key, r.size, r.etag) for r in summary} == {("whole", 6, ABC), ("slow consumer", 2, ABC)}


def test_duration_text():
    assert [objects.duration_text(n) for n in (20, 1000, 1500, 20_000, 1_001)] == ["20ms", "1s", "1.5s", "20s", "1.001s"]


def test_one_object_with_many_chunks(spark):
    """A single object spread over several chunk blocks."""
    n = 200_000
    chunks = spark.range(n).selectExpr(
        "'chunk' AS kind", "'b' AS bucket", "'big' AS object_key", "CAST(id AS INT) AS chunk_index", "10L AS n_bytes",
        "id * 10 AS arrived_ms", "id * 10 + 5 AS consumed_ms", "CAST(NULL AS STRING) AS consumer_error",
    ).unionByName(spark.createDataFrame([("end", "b", "big", n, 0, n * 10, None, None)], CHUNK))
    for size, verdict in ((n * 10, "ok"), (n * 10 - 1, "exceeded"), (n * 10 + 1, "truncated")):
        requests = spark.createDataFrame([("b", "big", size, None)], REQUEST)
        row = objects.verify_body(requests, chunks, idle_timeout_ms=1000).head()
        assert row.verdict == verdict
        assert row.streamed_bytes == (n * 10 - 10 if verdict == "exceeded" else n * 10)


def test_object_store_round_trip(spark, tmp_path):
    contents = {"empty": b"", "one": b"x", "exact": b"ab" * 8, "long": bytes(range(256)) * 3, "x/y z+%.txt": b"odd name"}
    root = str(tmp_path / "store")
    stores.write_objects(
        spark.createDataFrame([("b", k, v) for k, v in contents.items()], "bucket string, object_key string, content binary"), root
    )
    requests = spark.createDataFrame(
        [("b", k, len(v), None) for k, v in contents.items()] + [("b", "absent", 4, None)], REQUEST
    )
    rows = stores.read_object_chunks(requests, root, chunk_bytes=16, range_chunks=4).collect()
    for key, content in contents.items():
        mine = sorted((r for r in rows if r.object_key == key), key=lambda r: (r.kind == "end", r.chunk_index))
        assert b"".join(bytes(r.data) for r in mine if r.kind == "chunk") == content
        assert [r.chunk_index for r in mine if r.kind == "chunk"] == list(range(-(-len(content) // 16)))
        assert [r.kind for r in mine].count("end") == 1
    absent = [r for r in rows if r.object_key == "absent"]
    assert len(absent) == 1 and absent[0].read_error

    # Of an object stored longer than announced one chunk beyond is read, no more.
    short = spark.createDataFrame([("b", "long", 100, None)], REQUEST)
    longer = stores.read_object_chunks(short, root, chunk_bytes=16, range_chunks=4)
    assert longer.agg(F.sum("n_bytes")).head()[0] == 128

    small = {r.object_key: r for r in stores.fetch_small_objects(requests, root, max_bytes=16).collect()}
    assert small.pop("absent").read_error
    assert {k: bytes(r.content) for k, r in small.items() if r.content is not None} == {
        k: v for k, v in contents.items() if len(v) <= 16
    }
    assert set(small) == set(contents) and small["long"].read_error == "announced size 768 is over the limit of 16 bytes"
    grown = spark.createDataFrame([("b", "long", 10, None)], REQUEST)
    row = stores.fetch_small_objects(grown, root, max_bytes=16).head()
    assert row.content is None and row.read_error == "stored object exceeds 16 bytes"


def test_object_without_announced_size_is_read_to_its_end(spark, tmp_path):
    contents = {"empty": b"", "exact": b"ab" * 8, "long": bytes(range(256)) * 3}
    root = str(tmp_path / "store")
    stores.write_objects(
        spark.createDataFrame([("b", k, v) for k, v in contents.items()], "bucket string, object_key string, content binary"), root
    )
    requests = spark.createDataFrame([("b", k, None, None) for k in [*contents, "absent"]], REQUEST)
    rows = stores.read_object_chunks(requests, root, chunk_bytes=16, range_chunks=4).collect()
    for key, content in contents.items():
        mine = sorted((r for r in rows if r.object_key == key), key=lambda r: r.chunk_index)
        assert b"".join(bytes(r.data) for r in mine if r.kind == "chunk") == content
        assert [r.kind for r in mine].count("end") == 1 and mine[-1].kind == "end"
    assert [r.kind for r in rows if r.object_key == "absent"] == ["chunk"]


def test_names_outside_the_root_are_refused(spark, tmp_path):
    (tmp_path / "outside.txt").write_bytes(b"not for you")
    root = str(tmp_path / "store")
    good = spark.createDataFrame([("b", "in", b"fine")], "bucket string, object_key string, content binary")
    stores.write_objects(good, root)
    bad = [("b", "../../outside.txt"), ("..", "outside.txt"), ("b", "/etc/hostname"), ("b", "x/./in"), ("b/c", "in"), ("", "in"), ("b", ""), ("b", "nul\0")]
    requests = spark.createDataFrame([(b, k, 4, None) for b, k in [("b", "in"), *bad]], REQUEST)
    whole = stores.fetch_small_objects(requests, root, max_bytes=64).collect()
    assert [bytes(r.content) for r in whole if r.content is not None] == [b"fine"]
    assert sum(r.read_error is not None for r in whole) == len(bad)
    rows = stores.read_object_chunks(requests, root).collect()
    assert sum(r.read_error is not None for r in rows) == len(bad)
    assert [bytes(r.data) for r in rows if r.data is not None] == [b"fine"]
    with pytest.raises(ValueError):
        stores.object_path("/root", "..", "x")
