"""Page text, quality, fingerprints, URL rules, licenses and contamination on small tables."""

import hashlib
import os
import random
import re
import subprocess
import sys
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from ackline.llm import contamination, fingerprints, licenses, pages, quality, urls

# -- pages --------------------------------------------------------------------

PAGE = "page_id long, url string, html string"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("just text", "just text"),
        ("<p>a &amp; b&nbsp;&eacute; <b>c</b>d<br>e</p>", "a & b é cd e"),
        ("<article><h1>T</h1><p><b>one<br><p>two</article><footer>f", "T\n\none\n\ntwo"),
        ("<nav>menu</nav><div class='ad'>buy</div><main><p>main</p><aside>side</aside></main>", "main"),
        ("<article><header><h1>T</h1></header><p>x</p><section id='comments'><p>no</p></section></article>", "T\n\nx"),
        ("<header>site</header><div><p>x</p></div><form>f</form><script>if (a<b) {'</p>'}</script>", "x"),
        ("<div class='cookie-notice'>ok?</div><p>x<!-- c --> y</p><style>p{}</style>", "x y"),
        ("<ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table>", "a\n\nb\n\n1 2\n\n3"),
        ("<article><p>a</p></article><div>outside</div><article><p>b</p></article>", "a\n\nb"),
        ("<p>un <closed <i>tag</p></div></b>", "un tag"),
        ("<div>" * 5000 + "deep", "deep"),
    ],
)
def test_article_text(html, text):
    assert pages.article_text(html) == text


def test_site_templates_are_deleted(spark):
    rows = []
    for i in range(12):
        box = "<div><span>Welcome to our site</span><p>All rights reserved</p></div>"
        rows.append((i, f"https://a.example/{i}", f"<body>{box}<p>story {i}</p><p>{'daily' if i < 3 else i}</p></body>"))
    rows += [(100 + i, "https://b.example/x", "<body><div><span>Welcome to our site</span></div></body>") for i in range(2)]
    rows += [(200, None, None), (201, "no host", "<p>x</p>"), (None, "https://a.example/0", rows[0][2])]
    got = {r.page_id: (r.text, r.n_chars) for r in pages.extract_text(spark.createDataFrame(rows, PAGE)).collect()}
    assert got[0] == ("story 0\n\ndaily", 14) and got[11][0] == "story 11\n\n11" and got[None] == got[0]
    assert got[100][0] == "Welcome to our site" and got[200] == ("", 0) and got[201] == ("x", 1)
    assert pages.extract_text(spark.createDataFrame([], PAGE)).collect() == []


def test_articles_that_share_paragraphs_keep_them(spark):
    rows = [(i, f"https://a.example/{i}", f"<nav>n</nav><article><p>{'shared' if i % 3 == 0 else 'own'} {i % 3}</p><p>t{i}</p></article>") for i in range(30)]
    got = pages.extract_text(spark.createDataFrame(rows, PAGE)).collect()
    assert all(len(r.text.split("\n\n")) == 2 for r in got)


def test_templates_decide_where_names_say_nothing(spark):
    """Neutral names: only recurrence tells the template; a large host needs no share, copies of a page count once."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("aeiourstln") for _ in range(6))
    boxes = [f"<div><b>{word()}</b><hr><span>{word()}</span></div>" for _ in range(6)]
    rows = []
    for i in range(400):
        host = "big.example" if i % 4 else f"h{i % 12}.example"
        shown = "".join(rng.sample(boxes, rng.randint(0, 2)))
        body = f"<section>{word()}<hr>{word()}</section><p>{rng.choice(['quoted passage', word()])}</p>"
        if i % 3:
            body = f"<main>{body}{rng.choice(boxes) if i % 5 == 0 else ''}</main>"
        rows.append((i, f"https://{host}/{i}", f"<body>{shown}{body}</body>"))
    copy = "<body><div>story told once</div><p>copied many times</p></body>"
    rows += [(1000 + i, f"https://big.example/copy{i}", copy) for i in range(60)]
    limits = dict(least=4, share=0.3, many=12, share_inside=0.04)
    got = {r.page_id: r.text for r in pages.extract_text(spark.createDataFrame(rows, PAGE), **limits).collect()}

    hosts, uses = {}, {}
    for _, url, html in rows:
        host = url.split("/")[2]
        hosts.setdefault(host, set()).add(html)
        for e in pages.parse(html)[1]:
            if e.said and not e.dropped and e.tag not in ("#page", "html", "body"):
                uses.setdefault((host, e.digest, e.inside), set()).add(html)
    template = {True: {}, False: {}}
    for (host, digest, inside), on in uses.items():
        n = len(hosts[host])
        if len(on) >= max(4, 0.04 * n if inside else min(0.3 * n, 12)):
            template[inside].setdefault(host, set()).add(digest)
    want = {}
    for page_id, url, html in rows:
        outside, within = (frozenset(template[k].get(url.split("/")[2], ())) for k in (False, True))
        want[page_id] = pages.article_text(html, outside, within)
    assert got == want
    assert got[1003] == "story told once\n\ncopied many times"
    assert sum(got[i] != pages.article_text(html) for i, _, html in rows) > 100


# -- quality ------------------------------------------------------------------


def _labelled(make, spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("aeiourstln") for _ in range(rng.randint(2, 8)))
    texts, labels = [], []
    for i in range(300):
        words = [word() for _ in range(rng.randint(20, 80))]
        good = i % 4 != 0
        junk = rng.choice([" | ".join(words), "!! ".join(words).upper(), " ".join([words[0]] * 60)])
        texts.append((i, " ".join(words).capitalize() + "." if good else junk))
        labels.append((i, int(good), 0))
    return make([*texts, (900, None), (901, "")]), spark.createDataFrame([*labels, (None, 1, 0), (5000, None, 0)], "doc_id long, quality int, toxic int")


def test_held_out_documents_are_told_apart(make, spark):
    docs, labels = _labelled(make, spark)
    rated = {r.doc_id: r for r in quality.rate_documents(docs, labels, per_class=60).collect()}
    assert len(rated) == 302 and all(0 <= r.score <= 1 for r in rated.values())
    held = [r for i, r in rated.items() if r.held_out and i < 900]
    assert len(held) > 30
    good = [r.score for r in held if r.doc_id % 4]
    bad = [r.score for r in held if r.doc_id % 4 == 0]
    wins = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert wins > 0.95
    assert rated[900].score == rated[901].score
    assert all(r.predicted == int(r.score >= 0.3) for r in rated.values())
    crc = {i: __import__("zlib").crc32(str(i).encode()) % 5 == 0 for i in rated}
    assert {i: r.held_out for i, r in rated.items()} == crc


def test_labels_lang_source_and_ids_are_no_inputs(make, spark):
    docs, labels = _labelled(make, spark)
    model = quality.fit(docs, quality.learnable(docs, labels), per_class=60)
    plain = {r.doc_id: r.score for r in quality.score_quality(docs, model).collect()}
    changed = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("y"), "score": F.lit(7)})
    assert {r.doc_id: r.score for r in quality.score_quality(changed, model).collect()} == plain


def test_without_labels(make, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rated = quality.rate_documents(make([(1, "a"), (1, "a"), (None, None)]), none).collect()
    assert [r.score for r in rated] == [0.5] * 3
    assert quality.rate_documents(make([]), none).collect() == []


def test_repeated_ids_long_texts_and_clashing_columns(make, spark):
    docs, labels = _labelled(make, spark)
    more = make([(1, "other text"), (1, "another"), (3, "x " * 400_000)])
    rated = quality.rate_documents(docs.unionByName(more), labels, per_class=60).collect()
    assert len(rated) == 305 and all(0 <= r.score <= 1 for r in rated)
    again = quality.rate_documents(more.unionByName(docs).repartition(7), labels, per_class=60).collect()
    rounded = lambda rows: sorted((r.doc_id is None, r.doc_id or 0, round(r.score, 4)) for r in rows)
    assert np.allclose(rounded(rated), rounded(again), atol=1e-3)
    named = docs.withColumnsRenamed({"lang": "mark", "source": "packed"}).withColumn("label", F.lit(1))
    model = quality.fit(named, quality.learnable(named, labels), per_class=60)
    scored = quality.score_quality(named, model)
    assert set(named.columns) < set(scored.columns) and scored.count() == 302


def test_scoring_holds_few_rows_of_features_at_a_time():
    rng = np.random.default_rng(3)
    n, texts = 4000, [f"Text number {i}, with {'many ' * (i % 9)}words." for i in range(1500)]
    basis, vectors = (rng.standard_normal(shape).astype(np.float32) for shape in ((quality.FEATURES, 64), (64, n)))
    vectors /= np.linalg.norm(vectors, axis=0)
    ones, labels = np.ones(n, np.float32), (np.arange(n) % 2).astype(np.float32)
    model = quality.Neighbours(ones[:1].repeat(quality.FEATURES), basis, vectors, labels, ones, 25, 8.0, 0.5)
    tracemalloc.start()
    scores = model.score(texts)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 32e6
    assert np.allclose(scores, np.concatenate([model.score(texts[i : i + 100]) for i in range(0, 1500, 100)]), atol=1e-4)


def test_runs_where_executors_lack_the_package(tmp_path):
    """The driver finds the package by path; Python workers do not."""
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = tmp_path / "run.py"
    script.write_text(
        f"""
import sys
import tracemalloc
sys.path.insert(0, {repo!r})
import __spark_entry__ as e
from pyspark.sql import SparkSession, functions as F
from ackline.llm import quality
b = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
spark = b.config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate()
def importable(batches):
    import importlib.util
    import pyarrow as pa
    for b in batches:
        yield pa.RecordBatch.from_pydict(dict(found=[importlib.util.find_spec("ackline") is not None]))
assert not spark.range(1).mapInArrow(importable, "found boolean").first().found
docs = spark.range(60).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.md5(F.concat("id", F.lit(str(k)))) for k in range(9)]).alias("text"))
labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
print("rated", quality.rate_documents(docs, labels).count())
"""
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "rated 60" in done.stdout, done.stderr[-3000:]


# -- fingerprints -------------------------------------------------------------


def _shingles(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered) if w]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def _likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_against_brute_force(make):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghié") for _ in range(4))
    texts = [None, "", "one", "Two words", "é" * 9, "!!! ..."]
    for n in (5, 20, 100, 700):
        for _ in range(6):
            texts.append(" ".join(word() for _ in range(n)))
            texts.append(" ".join(texts[-1].split()[: n - n // 10] + [word() for _ in range(n // 10)]))
    texts += [texts[-1], texts[-1]]
    ids = rng.sample(range(-(10**12), 10**12), len(texts))
    rows = sorted(zip(ids, texts), key=lambda r: -r[0])
    got = {r.doc_id: r for r in fingerprints.fingerprint_edits(make(rows)).collect()}
    errors = []
    for k, (i, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = got[i]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert len(row.fingerprint) == (256 if _shingles(text) else 0)
        errors.append(row.near_edited - _likeness(_shingles(text), _shingles(edited)))
        errors.append(row.near_next - _likeness(_shingles(text), _shingles(after)))
        for other in got.values():
            assert 0 <= other.near_next <= 1
    assert max(map(abs, errors)) < 0.2 and (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.06
    same = {r.fingerprint for r in got.values() if (dict(rows)[r.doc_id] or "") == texts[-1]}
    assert len(same) == 1


def test_next_document_with_odd_ids(make):
    got = fingerprints.fingerprint_edits(make([(7, "abcdef"), (None, "xyxy"), (3, "12"), (7, "zz")])).collect()
    assert len(got) == 4 and sum(r.doc_id is None for r in got) == 1
    only = fingerprints.fingerprint_edits(make([(1, "abcd")])).head()
    assert only.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and only.near_next == 1.0
    assert fingerprints.fingerprint_edits(make([])).collect() == []


# -- urls ---------------------------------------------------------------------


def test_listed_rules(spark):
    rows = [
        (1, "http://WWW.Example.NET/en/x?y=1", "www.example.net", "/en/x", "example.net/en/", "allow"),
        (2, "http://example.net/de/", "example.net", "/de/", "net/", "block"),
        (3, "https://a.example.com/de/1#top", "a.example.com", "/de/1", "example.com/de/", "block"),
        (4, "https://notexample.com/de/1", "notexample.com", "/de/1", None, "allow"),
        (5, "https://x.org/fr/a", "x.org", "/fr/a", "org/fr/", "allow"),
        (6, "https://x.org/FR/a", "x.org", "/FR/a", None, "allow"),
        (7, "ftp://x.net", "x.net", "", None, "allow"),
        (8, "ftp://x.net?q#f", "x.net", "", None, "allow"),
        (9, None, "", "", None, "allow"),
        (10, "/en/only", "", "", None, "allow"),
        (11, "a://b.net/://c.org/fr/", "b.net", "/://c.org/fr/", "net/", "block"),
        (12, "x://ÄB.Net/\n/y", "Äb.net", "/\n/y", "net/", "block"),
    ]
    table = spark.createDataFrame([(r[0], r[1], "old") for r in rows] * 2, "page_id long, url string, rule string")
    none = spark.createDataFrame([], "url string, blocked boolean")
    got = urls.judge_urls(table, none).collect()
    assert len(got) == 24
    assert {(r.page_id, r.url, r.host, r.path, r.rule, r.verdict) for r in got} == set(rows)
    assert urls.judge_urls(table.limit(0), none).collect() == []


def test_mined_rules(spark):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        host, path, key = rng.choice(["win", "calm"]), rng.choice(["game", "news"]), rng.choice(["id", "ref"])
        bad = host == "win" and path == "game"
        rows.append((f"http://{host}.shop/{path}/{i}?{key}=1", bad if rng.random() > 0.05 else not bad))
    rows += [("http://calm.shop/news/1", None)]
    labelled = spark.createDataFrame(rows, "url string, blocked boolean")
    mined = urls.mine_rules(labelled, confidence=0.8).collect()
    assert ["h:win", "p:game"] in [sorted(r.tokens) for r in mined]
    # A longer rule stays only if it is surer than its parts.
    assert all({"h:win", "p:game"} <= set(r.tokens) for r in mined)
    seen = spark.createDataFrame([(1, "http://win.shop/game/x"), (2, "http://win.shop/news/x"), (3, "http://sub.win.shop/game/")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in urls.judge_urls(seen, labelled, confidence=0.8).collect()}
    assert got == {1: "block", 2: "allow", 3: "block"}


def test_rules_use_every_part_of_a_url_and_any_length(spark):
    rng = random.Random(4)
    rows = []
    for i in range(800):
        on = [rng.random() < 0.6 for _ in range(4)]
        path = "/".join(a if x else b for x, a, b in zip(on, ("q", "r", "s", "t"), ("k", "l", "m", "n")))
        rows.append((f"http://calm.shop/{path}", all(on)))
    for i in range(200):
        bad = i % 2 == 0
        rows.append((f"http://{'spam' if bad else 'ham'}.a.b.c.d.info/x", bad))
        rows.append((f"http://deep.com/1/2/3/{'bad' if bad else 'good'}/{i}", bad))
        rows.append((f"http://keys.com/?a=1&b=1&c=1&d=1&{'zbad' if bad else 'zgood'}=1", bad))
    labelled = spark.createDataFrame(rows, "url string, blocked boolean")
    mined = {tuple(r.tokens): (r.n, r.n_block) for r in urls.mine_rules(labelled, confidence=0.95).collect()}
    assert {("h:spam",), ("p:bad",), ("q:zbad",), ("p:q", "p:r", "p:s", "p:t")} <= set(mined)
    assert mined["h:spam",] == (100, 100)
    # Without parts of a rule that add nothing.
    assert all(not set(a) < set(b) for a in mined for b in mined)
    seen = spark.createDataFrame(
        [(1, "http://spam.z.y.x.w.v/"), (2, "http://o.com/a/b/c/d/bad"), (3, "http://o.com/?a&b&c&d&zbad"), (4, "http://o.com/q/r/s/t"), (5, "http://o.com/q/r/s/n")],
        "page_id long, url string",
    )
    got = {r.page_id: r.verdict for r in urls.judge_urls(seen, labelled, confidence=0.95).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow"}


def test_rules_are_sought_relative_to_the_share_of_blocked(spark):
    rng = random.Random(11)
    rows = []
    for i in range(1000):
        shop = rng.choice(["a", "b", "c", "d"])
        rows.append((f"http://{shop}.com/{rng.choice('xyz')}/{i}", rng.random() < (0.3 if shop == "a" else 0.05)))
    labelled = spark.createDataFrame(rows, "url string, blocked boolean")
    tokens = {tuple(r.tokens) for r in urls.mine_rules(labelled).collect()}
    base = sum(b for _, b in rows) / len(rows)
    assert base < 0.15 and ("h:a",) in tokens and all("h:a" in t for t in tokens)
    pages_ = spark.createDataFrame([(1, "http://a.com/q"), (2, "http://b.com/q"), (3, None), (4, "http://a.com/q")], "page_id long, url string")
    verdicts = lambda **o: {r.page_id: r.verdict for r in urls.judge_urls(pages_, labelled, **o).collect()}
    # Without mined rules the first and the last are judged otherwise.
    assert verdicts() == {1: "block", 2: "allow", 3: "allow", 4: "block"}
    assert set(verdicts(lift=50.0).values()) == {"allow"}
    clashing = pages_.selectExpr("*", "1 as host", "2 as tokens", "3 as has", "4 as _salt")
    assert {r.page_id: (r.verdict, r.has) for r in urls.judge_urls(clashing, labelled).collect()}[1] == ("block", 3)


def test_tokens_that_stand_together_are_rules_each(spark):
    rows = [(f"http://one.two.three/{'/'.join('abcdefghijklmnopqrstuvw')}", True)] * 20 + [("http://three/z", False)] * 20
    mined = urls.mine_rules(spark.createDataFrame(rows, "url string, blocked boolean"), confidence=0.9).collect()
    assert {tuple(r.tokens) for r in mined} == {("h:one",), ("h:two",), *((f"p:{c}",) for c in "abcdefghijklmnopqrstuvw")}
    assert urls.mine_rules(spark.createDataFrame(rows[:3], "url string, blocked boolean")).collect() == []


# -- licenses -----------------------------------------------------------------


def test_license_scan(make):
    rng = random.Random(6)
    filler = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    gpl = dict(enumerate(text for _, text in licenses.TEMPLATES))[5]
    cut = " ".join(gpl.split()[: int(len(gpl.split()) * 0.9)])
    broken = " ".join(w if i % 4 else "other" for i, w in enumerate(gpl.split()))
    docs = make(
        [
            (1, f"{filler(200)}\n{gpl.upper()}\n{filler(30)}"),
            (2, cut),
            (3, broken),
            (4, f"{filler(13)} Released under the MIT License."),
            (5, "Released  under--the MIT\nLICENSE. Licensed under CC BY-NC 4.0."),
            (6, None),
            (7, ""),
            (8, filler(3000)),
            (9, "released under the mit"),
        ]
    )
    got = {(r.doc_id, r.license): r for r in licenses.scan_licenses(docs.unionByName(docs)).collect()}
    assert set(got) == {(1, "GPL-3.0"), (2, "GPL-3.0"), (4, "MIT"), (5, "MIT"), (5, "CC-BY-NC-4.0")}
    assert got[1, "GPL-3.0"].containment == 1.0 and 0.8 <= got[2, "GPL-3.0"].containment < 1
    assert abs(got[1, "GPL-3.0"].first_word - 200) <= 40
    assert licenses.scan_licenses(make([])).collect() == []
    assert licenses.scan_licenses(docs, [("none", "too short")]).collect() == []


def test_license_scan_finds_short_notices_and_many_licenses(make):
    known = [
        "© 2020 Acme. All Rights Reserved.",
        "// SPDX-License-Identifier: MIT",
        "# SPDX-License-Identifier: BSD-3-Clause",
        "either version 2 of the license? under the terms of the GNU General Public License v2",
        "distributed under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License",
        "under the GNU Affero General Public License, version 3",
        "subject to the terms of the Mozilla Public License, v. 2.0. This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "https://creativecommons.org/licenses/by-sa/4.0/",
        "This is licensed under CC BY 4.0.",
        "CC0 1.0 Universal",
        "available under the ISC license",
        "all rights were reserved; under the terms",
    ]
    wanted = {
        (0, "All-Rights-Reserved"), (1, "MIT"), (2, "BSD-3-Clause"), (3, "GPL-2.0"), (4, "LGPL-2.1"), (5, "AGPL-3.0"),
        (6, "MPL-2.0"), (7, "CC-BY-SA-4.0"), (8, "CC-BY-4.0"), (9, "CC0-1.0"), (10, "ISC"),
    }
    got = {(r.doc_id, r.license): r for r in licenses.scan_licenses(make(list(enumerate(known)))).collect()}
    assert set(got) == wanted
    assert got[0, "All-Rights-Reserved"].first_word == 3 and got[0, "All-Rights-Reserved"].containment == 1.0


def test_every_notice_is_found(make):
    rows = [(i, f"before {text} after") for i, (_, text) in enumerate(licenses.TEMPLATES)]
    got = {(r.doc_id, r.license): r.containment for r in licenses.scan_licenses(make(rows)).collect()}
    assert all(got.get((i, name)) == 1.0 for i, (name, _) in enumerate(licenses.TEMPLATES))
    short = [("one", "alpha"), ("two", "beta gamma"), ("four", "delta epsilon zeta eta")]
    docs = make([(1, "alpha"), (2, "x Beta, GAMMA"), (3, "gamma beta"), (4, "delta epsilon zeta eta alpha"), (5, "delta epsilon zeta")])
    got = {(r.doc_id, r.license, r.template, r.first_word) for r in licenses.scan_licenses(docs, short).collect()}
    assert got == {(1, "one", 0, 0), (2, "two", 1, 1), (4, "four", 2, 0), (4, "one", 0, 4)}


# -- contamination ------------------------------------------------------------

BENCHMARK = "item_id long, text string"


def test_contamination(make, spark):
    rng = random.Random(9)
    filler = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    items = {i: filler(n) for i, n in enumerate([5, 12, 30, 60, 30, 100])}
    words = items[3].split()
    near = " ".join([*words[:58], "changed", "end"])
    far = " ".join(w if i % 6 else "x" for i, w in enumerate(words))
    rows = [
        (1, f"{filler(50)} {items[1].upper()}, {filler(20)} {items[2]}"),
        (2, near),
        (3, far),
        (4, items[0]),
        (5, " ".join(words[:40])),
        (6, None),
        (7, ""),
        (8, filler(2000)),
        (9, f"{items[5]} {items[5]}"),
        (None, items[1]),
        (10, f"x {items[2]}"),
        (10, f"y z {items[3]}"),
        (11, f"{filler(5)} Only FOUR words -- here"),
        (12, "only four words"),
    ]
    benchmark = [*items.items(), (50, None), (51, "only four words here"), (None, items[2]), (52, items[4])]
    got = contamination.find_contamination(make([*rows, rows[1]]), spark.createDataFrame(benchmark, BENCHMARK)).collect()
    found = {(r.doc_id, r.item_id): (r.similarity, r.first_word) for r in got}
    assert set(found) == {(1, 1), (1, 2), (2, 3), (4, 0), (9, 5), (None, 1), (10, 2), (10, 3), (11, 51)}
    assert found[None, 1] == (1.0, 0) and found[10, 2] == (1.0, 1) and found[10, 3] == (1.0, 2) and found[11, 51] == (1.0, 5)
    assert found[1, 1] == (1.0, 50) and found[9, 5] == (1.0, 0) and 0.8 <= found[2, 3][0] < 1
    empty = spark.createDataFrame([], BENCHMARK)
    assert contamination.find_contamination(make(rows), empty).collect() == []
    assert contamination.find_contamination(make([]), spark.createDataFrame(benchmark, BENCHMARK)).collect() == []


def test_blocks_reach_every_fingerprint_in_the_radius(spark):
    rng = random.Random(2)
    pairs = []
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, contamination.RADIUS)):
            b ^= 1 << bit
        pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    df = spark.createDataFrame(pairs, "a long, b long")
    common = F.arrays_overlap(contamination.blocks("a"), contamination.blocks("b"))
    assert df.filter(~common).count() == 0
