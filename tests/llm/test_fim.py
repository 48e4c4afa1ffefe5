import hashlib
import random
import re

import numpy as np
import pytest

from ackline.llm import fim


def plain_version(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    prefix, middle, suffix = ("".join(part) for part in (units[:low], units[low:high], units[high:]))
    form = "spm" if h[3] % 100 < spm else "psm"
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return len(units), form, len(prefix), len(middle), output


def texts():
    rng = random.Random(4)
    made = [None, "", "\n", "\n\n\n", "one line", "é\nü\n😀", "a <P> inside", "<S>", "x<M>\ny", "<P\n><S\n<M", "<", "tab\r\nends\r\n"]
    made += ["".join(rng.choice("ab<>PSM\né😀") for _ in range(rng.randint(0, 40))) for _ in range(200)]
    made.append("\n".join("long line " * 50 for _ in range(4000)))
    return list(enumerate([*made, made[5], made[5]], -5)) + [(None, "a\nb\nc\n"), (3, "again\nunder one id")]


@pytest.mark.parametrize(("rate", "spm"), [(100, 50), (40, 0), (100, 100), (0, 50)])
def test_equals_plain_version_and_round_trip(make, rate, spm):
    rows = texts()
    made = fim.restore_text(fim.fill_in_middle(make(rows), rate_percent=rate, spm_percent=spm)).collect()
    got = sorted(((r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made), key=repr)
    want = sorted(((i, t, *plain_version(i, t, rate=rate, spm=spm)) for i, t in rows), key=repr)
    assert got == want
    assert all(r.restored == (r.text or "") for r in made)
    if rate == 100 and spm == 50:
        assert {r.form for r in made} == {"plain", "psm", "spm"}


def test_digest_columns(make):
    rows = texts()
    got = {(r.doc_id, r.restored_sha256): r.output_sha256 for r in fim.fill_in_middle_digest(make(rows)).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {(i, sha(t or "")): sha(plain_version(i, t)[-1]) for i, t in rows}


def test_rotation_is_a_block_exchange():
    for n in (0, 1, 2, 7, 200_000):
        data = np.arange(n, dtype=np.uint32)
        for start, border, stop in ((0, n // 3, n), (n // 4, n // 2, n - n // 8), (0, 0, n), (0, n, n)):
            turned = data.copy()
            fim.rotate(turned, start, border, stop)
            want = np.concatenate([data[:start], data[border:stop], data[start:border], data[stop:]])
            assert (turned == want).all()


def test_other_sentinels_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a\nb\n<P>c", "old", 5)], "doc_id long, text string, output string, kept int")
    marks = ("[pre]", "[suf]", "[mid]")
    (row,) = fim.restore_text(fim.fill_in_middle(docs, sentinels=marks), sentinels=marks).collect()
    assert row.form != "plain" and row.kept == 5 and row.restored == "a\nb\n<P>c" and "[mid]" in row.output
    with pytest.raises(ValueError, match="overlap"):
        fim.fill_in_middle(docs, sentinels=("<P<", "<S>", "<M>"))
    with pytest.raises(ValueError, match="rate_percent"):
        fim.fill_in_middle(docs, rate_percent=101)


def test_empty_table(make):
    assert fim.fill_in_middle_digest(make([])).collect() == []
