import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from ackline.llm import suffixes


def brute_force(rows, length):
    """``{id: digest}``, or of repeated and null ids a list of ``(id, digest)``."""
    count = Counter()
    raws = [(i, (t or "").encode()) for i, t in rows]
    for _, raw in raws:
        count.update(raw[k : k + length] for k in range(len(raw) - length + 1))
    out = []
    for i, raw in raws:
        gone = np.zeros(len(raw), dtype=bool)
        for k in range(len(raw) - length + 1):
            if count[raw[k : k + length]] > 1:
                gone[k : k + length] = True
        rest = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((i, (len(raw), len(raw) - len(rest), runs, hashlib.sha256(rest).hexdigest())))
    return dict(out) if len({i for i, _ in out if i is not None}) == len(out) else out


@pytest.mark.parametrize("letters", ["ab", "abcd", "ab\xff", "a"])
def test_two_stage_order(letters):
    for seed in range(60):
        rng = random.Random(seed)
        text = bytes(ord(rng.choice(letters)) for _ in range(rng.randint(1, 80)))
        assert suffixes.two_stage_order(text, 400) == sorted(range(len(text)), key=lambda i: text[i:])


def test_order_up_to_a_depth():
    text = b"abcabcabcabx" * 20
    order = suffixes.two_stage_order(text, 7)
    assert sorted(order) == list(range(len(text)))
    cut = [text[i : i + 7] for i in order]
    assert cut == sorted(cut)


def corpus(seed, length):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdeé ") for _ in range(n))
    shared = [text(n) for n in (length - 1, length, length + 1, 3 * length, 8 * length)]
    texts = [None, "", "short", "a" * (4 * length), "ab" * (3 * length), shared[3], shared[3], shared[4] * 2]
    for _ in range(40):
        parts = [text(rng.randint(0, 2 * length))]
        for _ in range(rng.randint(0, 3)):
            piece = rng.choice(shared)
            cut = rng.randint(0, len(piece) // 2)
            parts += [rng.choice([piece, piece[cut:]]), text(rng.randint(0, length))]
        texts.append("".join(parts))
    return list(enumerate(texts, -3))


@pytest.mark.parametrize(("length", "gram", "split"), [(40, 24, 5000), (40, 40, 5000), (40, 16, 1), (64, 8, 3)])
def test_equals_brute_force(make, length, gram, split):
    rows = corpus(length + gram, length)
    spans = suffixes.recurring_spans(make(rows), length=length, gram=gram, split=split)
    got = suffixes.repeated_bytes(make(rows), length=length, gram=gram).collect() if split == 5000 else None
    want = brute_force(rows, length)
    if got is not None:
        assert {r.doc_id: tuple(r)[1:] for r in got} == want
    covered = {}
    for r in spans.collect():
        for span in r.spans:
            covered.setdefault(r.doc, set()).update(range(span.first, span.last + length))
    assert {i: len(c) for i, c in covered.items()} == {i: w[1] for i, w in want.items() if w[1]}


def test_production_length(make):
    rng = random.Random(1)
    passage = " ".join(f"w{rng.randrange(10**6)}" for _ in range(80))
    rows = [(1, f"first {passage} end"), (2, f"{passage}"), (3, passage[:399]), (4, "é" * 300), (5, "nothing"), (6, None)]
    got = {r.doc_id: tuple(r)[1:] for r in suffixes.repeated_bytes(make(rows)).collect()}
    assert got == brute_force(rows, 400)


def test_texts_are_cut(make):
    passage = "".join(random.Random(2).choice("abcdefgh ") for _ in range(120))
    docs = make([(1, "x" + passage + "y"), (2, passage), (3, "own"), (4, None)])
    got = {r.doc_id: (r.text, r.n_chars, r.lang) for r in suffixes.remove_repeats(docs, length=60, gram=30).collect()}
    assert got == {1: ("xy", 2, "en"), 2: ("", 0, "en"), 3: ("own", 3, "en"), 4: (None, None, "en")}
    assert suffixes.repeated_bytes(make([])).collect() == []


def test_null_and_reused_ids_are_rows_of_their_own(make, spark):
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefé ") for _ in range(n))
    shared, same = text(90), text(150)
    rows = [(None, text(30) + shared), (None, shared + text(70)), (1, text(200)), (1, text(20) + shared + text(20)), (2, same), (2, same)]
    rows += [(None, None), (3, ""), (3, None), (4, text(50) + same + text(9)), (None, same), (None, same)]
    got = suffixes.repeated_bytes(make(rows), length=60, gram=30).collect()
    assert sorted(((r[0], tuple(r)[1:]) for r in got), key=repr) == sorted(brute_force(rows, 60), key=repr)
    named = make(rows).withColumnsRenamed({"lang": "spans", "source": "doc"})
    cut = suffixes.remove_repeats(named, length=60, gram=30)
    assert cut.columns == named.columns and {(r.spans, r.doc) for r in cut.collect()} == {("en", "s")}
    want = sorted((n - gone for _, (n, gone, _, _) in brute_force(rows, 60)), key=int)
    sizes = sorted(len((r.text or "").encode()) for r in cut.collect())
    assert all(w - 6 <= s <= w for s, w in zip(sizes, want))


def test_many_copies_of_one_row(make):
    text = "".join(random.Random(6).choice("abcdefgh ") for _ in range(300))
    rows = [(1, text)] * 40 + [(i, text) for i in range(2, 30)] + [(99, text[:200] + "own end of it")]
    got = suffixes.repeated_bytes(make(rows), length=60, gram=30).collect()
    assert sorted((r[0], tuple(r)[1:]) for r in got) == sorted(brute_force(rows, 60))
