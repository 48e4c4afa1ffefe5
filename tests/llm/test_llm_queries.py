"""Registered queries: against reference SQL where there is some, and for their shape."""

import os
import re
from collections import Counter

import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
import corpus_pipeline
from ackline.llm.queries import ORACLES, QUERIES
from compare import duck_rows, spark_rows
from test_neardup import brute_force as brute_force_groups
from test_suffixes import brute_force as brute_force_spans

SF_DIR = os.environ.get("ACKLINE_TEST_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")

COLUMNS = {
    "op1_extract_text": "page_id url text n_chars",
    "op2_rate_quality": "doc_id held_out score predicted",
    "op3_repeated_bytes": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op4_fingerprint": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op5_pack": "doc_id piece start length ids_crc32 sequence_id offset",
    "op8_count_tokens": "doc_id n_bytes n_tokens over_limit",
}


def test_all_are_registered():
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES if name != "pipeline"}


@pytest.mark.parametrize("name", ORACLES)
def test_equals_reference_sql(spark, name):
    got = spark_rows(QUERIES[name](spark, SF_DIR))
    assert got == duck_rows(SF_DIR, ORACLES[name])
    assert got[1]


@pytest.mark.parametrize("name", COLUMNS)
def test_one_row_for_every_row(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    assert df.columns == COLUMNS[name].split()
    read = "pages" if name == "op1_extract_text" else "documents"
    key = df.columns[0]
    expected = sorted(r[0] for r in spark.read.parquet(f"{SF_DIR}/{read}.parquet").select(key).collect())
    got = [r[0] for r in df.select(key).collect()]
    assert sorted(got if name != "op5_pack" else set(got)) == expected


def _words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return " " + " ".join(w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered) if w) + " "


def test_pipeline_against_brute_force(spark, vocabulary):
    """Every stage on what the one before kept, against a plain version of it."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)

    def after(name, at):
        df = steps[name](spark, at, SF_DIR)
        assert name == "packing" or df.columns == docs.columns
        return df.collect()

    def table(rows):
        return spark.createDataFrame(rows, docs.schema)

    good = after("quality", docs)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {r.doc_id for r in good}
    rated = [r.doc_id for r in docs.collect() if labels.get(r.doc_id) == 1]
    assert sum(i in kept for i in rated) >= 0.98 * len(rated)

    single = after("near_duplicates", table(good))
    groups = brute_force_groups([(r.doc_id, r.text) for r in good], 5, 80)
    assert {r.doc_id for r in single} == {i for i, (_, _, first) in groups.items() if first}

    cut = after("repeats", table(single))
    removed = brute_force_spans([(r.doc_id, r.text) for r in single], corpus_pipeline.PASSAGE_BYTES)
    left = {i: n - gone for i, (n, gone, _, _) in removed.items()}
    assert {r.doc_id for r in cut} == {i for i, n in left.items() if n}
    assert all(left[r.doc_id] - 6 <= len(r.text.encode()) <= left[r.doc_id] and r.n_chars == len(r.text) for r in cut)

    clean = after("decontamination", table(cut))
    items = [_words(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    whole = {r.doc_id for r in cut if any(item in _words(r.text) for item in items)}
    gone = {r.doc_id for r in cut} - {r.doc_id for r in clean}
    pieces = {" ".join(w[i : i + 5]) for w in (item.split() for item in items) for i in range(len(w) - 4)}
    assert whole <= gone
    for r in cut:
        if r.doc_id in gone - whole:
            assert any(piece in _words(r.text) for piece in pieces)

    packed = after("packing", table(clean))
    library = Tokenizer.from_file(vocabulary)
    wanted = {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in clean}
    got = Counter()
    for r in packed:
        got[r.doc_id] += r.length
    assert got == wanted


def test_pipeline_on_an_empty_table(spark):
    at = spark.read.parquet(f"{SF_DIR}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, at, SF_DIR).collect() == []


def test_pipeline_keeps_null_and_repeated_ids_apart(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").filter("length(text) > 200").first().text
    long = lambda word: " ".join(f"{word}{i}" for i in range(80))
    texts = [(1, long("a")), (1, long("b")), (None, long("a")), (None, long("c")), (2, f"{long('d')} {item}"), (2, long("e")), (None, item)]
    rows = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts], docs.schema)
    left = steps["near_duplicates"](spark, rows, SF_DIR).collect()
    assert sorted((str(r.doc_id), r.text) for r in left) == sorted((str(i), t) for i, t in texts if t != texts[2][1] or i)
    clean = steps["decontamination"](spark, rows, SF_DIR).collect()
    assert sorted(r.text for r in clean) == sorted(t for _, t in texts if item not in t)
    cut = steps["repeats"](spark, rows, SF_DIR).collect()
    assert sorted(r.text for r in cut) == sorted([long("b"), long("c"), f"{long('d')} ", long("e")])
