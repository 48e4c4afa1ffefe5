import pytest
from pyspark.sql import functions as F

from ackline import params
from ackline.functions.metadata import decode_metadata, metadata_rule_hits
from ackline.operators import records
from ackline.operators.processing import run_object_processor
from ackline.schemas import RECORD

GOOD = b'{"bucket":"b","key":"k","size":1}'

# payload, max size, expected (code, field)
PAYLOADS = {
    "extra field ignored": (
        b'{"note":["x",{"size":3}],"bucket":"depot","etag":"W/\\"77\\"","key":"in/box 4.bin","size":31}', None, None),
    "no etag": (b'{"size":8,"key":"in/b","bucket":"depot"}', None, None),
    "null etag": (b'{"etag":null,"size":8,"key":"in/b","bucket":"depot"}', None, None),
    "no bucket": (b'{"key":"k","size":1}', "invalid_json", None),
    "no key": (b'{"bucket":"b","size":1}', "invalid_json", None),
    "size text": (b'{"bucket":"b","key":"k","size":"1"}', "invalid_json", None),
    "other size name": (b'{"bucket":"b","key":"k","size_bytes":1}', "invalid_json", None),
    "empty bucket": (b'{"bucket":"","key":"k","size":1}', "empty_field", "bucket"),
    "blank bucket": ('{"bucket":" \\t\\u00a0\\u3000","key":"k","size":1}'.encode(), "empty_field", "bucket"),
    "zero width space is text": ('{"bucket":"​","key":"k","size":1}'.encode(), None, None),
    "empty key": (b'{"bucket":"b","key":"","size":1}', "empty_field", "key"),
    "blank key is legal": (b'{"bucket":"b","key":" ","size":1}', None, None),
    "size 0": (b'{"bucket":"b","key":"k","size":0}', "empty_object", None),
    "size above max": (b'{"bucket":"b","key":"k","size":1025}', "object_too_large", None),
    "size at max": (b'{"bucket":"b","key":"k","size":1024}', None, None),
    "empty etag": (b'{"bucket":"b","key":"k","size":1,"etag":""}', "empty_field", "etag"),
    "blank etag": (b'{"bucket":"b","key":"k","size":1,"etag":"\\n"}', "empty_field", "etag"),
    "nul in bucket": (b'{"bucket":"b\\u0000","key":"k","size":1}', "null_character", "bucket"),
    "nul in key": (b'{"bucket":"b","key":"\\u0000","size":1}', "null_character", "key"),
    "nul in etag": (b'{"bucket":"b","key":"k","size":1,"etag":"a\\u0000"}', "null_character", "etag"),
    "first rule wins": (b'{"bucket":"","key":"","size":0}', "empty_field", "bucket"),
    "missing payload": (None, "missing_payload", None),
    "empty payload": (b"", "invalid_json", None),
    "not json": (b"size: 1", "invalid_json", None),
    "bad utf-8": (b'{"bucket":"\xff","key":"k","size":1}', "invalid_json", None),
    "bucket number": (b'{"bucket":5,"key":"k","size":1}', "invalid_json", None),
    "etag number": (b'{"bucket":"b","key":"k","size":1,"etag":5}', "invalid_json", None),
    "negative size": (b'{"bucket":"b","key":"k","size":-1}', "invalid_json", None),
    "negative zero": (b'{"bucket":"b","key":"k","size":-0}', "invalid_json", None),
    "nested negative zero": (b'{"bucket":"b","key":"k","size":0,"t":{"size":-0}}', "empty_object", None),
    "nested fraction": (b'{"bucket":"b","key":"k","size":0,"t":{"size":-0.5}}', "empty_object", None),
    "nested digits": (b'{"bucket":"b","key":"k","size":9223372036854775808.0,"t":{"size":1234567890123456789}}', "invalid_json", None),
    "escaped name": (b'{"bucket":"b","key":"k","siz\\u0065":9223372036854775808}', "object_too_large", None),
    "escaped name, negative zero": (b'{"bucket":"b","key":"k","siz\\u0065":-0}', "invalid_json", None),
    "fraction": (b'{"bucket":"b","key":"k","size":1.5}', "invalid_json", None),
    "whole fraction": (b'{"bucket":"b","key":"k","size":1.0}', "invalid_json", None),
    "exponent": (b'{"bucket":"b","key":"k","size":1e2}', "invalid_json", None),
    "64-bit size": (b'{"bucket":"b","key":"k","size":18446744073709551615}', "object_too_large", None),
    "65-bit size": (b'{"bucket":"b","key":"k","size":18446744073709551616}', "invalid_json", None),
    "wide fraction": (b'{"bucket":"b","key":"k","size":9223372036854775808.0}', "invalid_json", None),
    "size true": (b'{"bucket":"b","key":"k","size":true}', "invalid_json", None),
    "trailing text": (GOOD + b" x", "invalid_json", None),
    "trailing bracket": (GOOD + b"] x", "invalid_json", None),
    "trailing brace": (GOOD + b"} x", "invalid_json", None),
    "second object": (GOOD + b"," + GOOD, "invalid_json", None),
    "surrounding space": (b" \n" + GOOD + b"\t ", None, None),
    "single quotes": (GOOD.replace(b'"', b"'"), "invalid_json", None),
    "nan": (b'{"bucket":"b","key":"k","size":1,"x":NaN}', "invalid_json", None),
    "array": (b'["b","k",1]', "invalid_json", None),
    "array of object": (b"[" + GOOD + b"]", "invalid_json", None),
    "number": (b"5", "invalid_json", None),
    "null": (b"null", "invalid_json", None),
    "key case": (b'{"Bucket":"b","key":"k","size":1}', "invalid_json", None),
    "duplicate bucket": (b'{"bucket":"a","bucket":"b","key":"k","size":1}', "invalid_json", None),
    "nested extra": (b'{"bucket":"b","key":"k","size":1,"t":{"size":"x","id":[1,{}]}}', None, None),
}


@pytest.fixture(scope="module")
def decoded(spark):
    rows = [(name, "t", 1, i, payload) for i, (name, (payload, _, _)) in enumerate(PAYLOADS.items())]
    df = spark.createDataFrame(
        rows, "name string, topic string, partition_id int, record_offset bigint, payload binary"
    )
    return df, {r.name: r for r in decode_metadata(df, max_object_size=1024).collect()}


def test_decode_verdicts(decoded):
    got = {name: (r.error_code, r.error_field) for name, r in decoded[1].items()}
    assert got == {name: (code, field) for name, (_, code, field) in PAYLOADS.items()}


def test_decode_values_and_messages(decoded):
    rows = decoded[1]
    full = rows["extra field ignored"]
    assert (full.bucket, full.object_key, int(full.size), full.etag, full.location) == (
        "depot", "in/box 4.bin", 31, 'W/"77"',
        "s3://depot/in/box 4.bin",
    )
    assert rows["null etag"].etag is None and rows["null etag"].error_message is None
    assert rows["size above max"].bucket is None
    assert {n: rows[n].error_message for n in ("missing payload", "not json", "empty key", "nul in etag", "size 0")} == {
        "missing payload": "record payload is missing",
        "not json": "object metadata is not valid JSON",
        "empty key": "object metadata field `key` must not be empty",
        "nul in etag": "object metadata field `etag` contains a null character",
        "size 0": "object metadata field `size` must be greater than zero",
    }
    assert rows["64-bit size"].error_message == (
        "object metadata size 18446744073709551615 exceeds configured maximum 1024"
    )


def test_rule_hits_lists_every_broken_rule(decoded):
    hits = metadata_rule_hits(decoded[0].filter("name = 'first rule wins'"), max_object_size=1024).collect()
    assert sorted((r.error_code, r.error_field or "") for r in hits) == [
        ("empty_field", "bucket"), ("empty_field", "key"), ("empty_object", ""),
    ]


def test_rejects_keep_their_source(decoded):
    accepted, rejected = records.split_rejects(decoded[0], max_object_size=1024)
    good = {n for n, (_, code, _) in PAYLOADS.items() if code is None}
    assert {r.name for r in accepted.collect()} == good
    bad = {r.name: r for r in rejected.collect()}
    assert set(bad) == set(PAYLOADS) - good
    assert bytes(bad["not json"].payload) == b"size: 1"
    offset = bad["not json"].record_offset
    assert bad["not json"].failure == (
        f"metadata decode failed for t[1] offset {offset}: object metadata is not valid JSON"
    )


def test_envelope_and_accounting(spark):
    messages = spark.createDataFrame(
        [
            (b"truck 5/9", b"full load", "orders", 0, 7, [("h", b"\x00\x01"), ("h", None)]),
            (None, None, "orders", 0, 8, None),
            (b"", b"", "orders", 0, 9, []),
        ],
        "key binary, value binary, topic string, partition int, offset bigint, headers array<struct<key string, value binary>>",
    ).withColumn("timestamp", F.lit(None).cast("timestamp"))
    sized = records.with_location(records.with_accounted_bytes(records.record_envelope(messages)))
    rows = {r.record_offset: r for r in sized.collect()}
    assert set(RECORD.names) <= set(sized.columns)
    assert {o: r.accounted_bytes for o, r in rows.items()} == {7: 128 + 9 + 9 + 2 + 2, 8: 128, 9: 128}
    assert [(h.key, h.value and bytes(h.value)) for h in rows[7].headers] == [("h", b"\x00\x01"), ("h", None)]
    assert rows[8].payload is None and bytes(rows[9].payload) == b""
    assert rows[7].location == "orders[0] offset 7"


def _small_records(spark, sizes):
    rows = [("t", 0, i, 100 - i, None, bytes(n) if n is not None else None, None, None) for i, n in enumerate(sizes)]
    return spark.createDataFrame(rows, RECORD)


def test_guards_and_first_violation(spark):
    guarded = records.payload_guard(
        _small_records(spark, [None, 10, 11, 12]), max_payload_bytes=11, memory_budget_bytes=138
    )
    rows = {r.record_offset: r for r in guarded.collect()}
    assert {o: r.violation for o, r in rows.items()} == {
        0: None, 1: None, 2: "budget_exceeded", 3: "payload_too_large",
    }
    assert rows[3].message == "record t[0] offset 3 has a 12 byte payload, exceeding max_payload_bytes=11"
    assert rows[2].message == "record t[0] offset 2 accounts for 139 bytes, exceeding the 138 byte ingress budget"
    first = records.first_violation(guarded).collect()
    assert [(r.seq, r.record_offset) for r in first] == [(97, 3)]
    assert records.first_violation(guarded.filter("violation is null")).count() == 0


def test_fail_closed_keeps_rows_or_fails(spark):
    df = spark.range(5)
    assert records.fail_closed(df, F.col("id") > 9, F.lit("no")).count() == 5
    with pytest.raises(Exception, match="record 3 is bad"):
        records.fail_closed(
            df, F.col("id") == 3, F.concat(F.lit("record "), F.col("id").cast("string"), F.lit(" is bad"))
        ).collect()


def test_completions(spark):
    df = spark.createDataFrame([("t", 0, 1, 5, 9)], "topic string, partition_id int, epoch bigint, record_offset bigint, seq bigint")
    assert [(r.outcome, r.reason) for r in records.discard(df).collect()] == [("succeeded", None)]
    assert [(r.outcome, r.reason) for r in records.fail(df, F.lit("why")).collect()] == [("failed", "why")]


def test_processor_sees_metadata_and_keeps_reasons(spark):
    df = spark.createDataFrame(
        [("b", f"k{i}", i + 1, None if i % 2 else '"e"') for i in range(6)],
        "bucket string, object_key string, size bigint, etag string",
    )

    def processor(metadata):
        assert isinstance(metadata.size, int) and metadata.etag in (None, '"e"')
        if metadata.key == "k3":
            raise RuntimeError("no room for it")

    for workers in (None, 2):
        done = run_object_processor(df, processor, worker_count=workers)
        rows = {r.object_key: (r.outcome, r.reason) for r in done.collect()}
        assert rows.pop("k3") == ("failed", "no room for it")
        assert set(rows.values()) == {("succeeded", None)} and len(rows) == 5
    assert run_object_processor(df, processor, worker_count=2).rdd.getNumPartitions() == 2
    with pytest.raises(ValueError):
        run_object_processor(df, processor, worker_count=0)


def test_parameter_checks():
    with pytest.raises(ValueError):
        params.budgets(10, 5)
    with pytest.raises(ValueError):
        params.budgets(1, 2**32)
    with pytest.raises(TypeError):
        params.positive("n", True)
    for high, low in ((80, 80), (101, 50), (50, 0), (40, 60)):
        with pytest.raises(ValueError):
            params.watermarks(high, low)
    assert params.watermarks(80, 50) == (80, 50)
    for bad in ([], [" "], "text"):
        with pytest.raises(ValueError):
            params.names("topics", bad)
