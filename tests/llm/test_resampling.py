import hashlib
import math
import random
import re
import zlib

import pytest

from ackline.llm import resampling


def features(text, max_n):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]
    return len(words), runs


def plain_version(docs, target, max_n, buckets, least, percent, seed=2024):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for _, text in docs:
        for f in features(text, max_n)[1]:
            s[bucket(f)] += 1
    for _, text in target:
        for f in features(text, max_n)[1]:
            t[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    rows = []
    for doc_id, text in docs:
        n, found = features(text, max_n)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, None, n])
    able = [r for r in rows if r[5] >= least]
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = place
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def corpus(seed=3):
    rng = random.Random(seed)
    common = ["the same line again", "Ünï cödé, 日本語 words", "", "   ", "a-b_c", "one"]
    texts = [None, "", "\n\n", "x", "A\nB\nc\nD\nE\nF"]
    for _ in range(120):
        lines = [rng.choice([*common, " ".join(rng.choice("red green blue Grün 7 it's").strip() + rng.choice(["", "s"]) for _ in range(rng.randint(1, 9)))]) for _ in range(rng.randint(1, 8))]
        texts.append("\n".join(lines))
    texts += [texts[20]] * 30
    rows = list(enumerate(texts, -2))
    return rows + [(None, "no id " * 10), (5, "again under one id " * 6), (5, "again under one id " * 6)]


@pytest.mark.parametrize(("max_n", "percent"), [(1, 10), (2, 35), (4, 100)])
def test_equals_plain_version(make, max_n, percent):
    docs = corpus()
    target = docs[10:20] + [(1, "red green blue\nblue red"), (2, None)]
    got = resampling.resampling_digest(make(docs), make(target), max_n=max_n, buckets=500, least_words=4, percent=percent)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_version(docs, target, max_n, 500, 4, percent)


def test_runs_across_lines_are_counted_once():
    hasher = resampling.Hasher(97, 3)
    lines = [b"a".split(), [], b"b".split(), b"c d e".split(), b"f".split()]
    flat = [w for line in lines for w in line]
    inside = [x for line in lines for x in hasher.inside(line).tolist()]
    assert sorted(inside + hasher.across(lines).tolist()) == sorted(hasher.inside(flat).tolist())


def test_empty_tables_and_clashing_columns(make, spark):
    assert resampling.resampling_digest(make([]), make([])).collect() == []
    none_drawn = resampling.resampling_digest(make([(1, "few words"), (2, None)]), make([])).collect()
    assert {r.rank for r in none_drawn} == {None}
    docs = spark.createDataFrame([(1, "w " * 30, 9, "x")], "doc_id long, text string, rank int, mine string")
    (row,) = resampling.resample(docs, docs, percent=100).collect()
    assert (row["rank"], row.mine, row.n_features) == (1, "x", 30)


def test_a_very_long_text(make):
    text = "\n".join(f"line {i % 50} of a long text" for i in range(100_000))
    (row,) = resampling.resampling_digest(make([(1, text)]), make([(1, text)])).collect()
    assert row.n_features == 600_000
