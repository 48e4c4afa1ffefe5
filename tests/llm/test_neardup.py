import itertools
import random
import re

import pytest

from ackline.llm import neardup
from ackline.llm.components import connected_components


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or {tuple(words)}


def brute_force(rows, size, percent):
    sets = {i: shingles(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            lo, hi = sorted((find(a), find(b)))
            root[hi] = lo
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(3))
    line = " ".join(word() for _ in range(12))
    texts = [None, "", " \n ", "one", "ONE", "one two", "Two one", "a b c"]
    for _ in range(25):
        words = [word() for _ in range(rng.choice([3, 10, 40, 150]))]
        texts.append(" ".join(words))
        for _ in range(rng.choice([0, 2, 8])):
            copy = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 8))):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy) + rng.choice(["", " ", "\n" + line]))
    texts += [texts[-1]] * 20
    rng.shuffle(texts)
    return [(3 * i - 40, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("size", "percent"), [(2, 80), (5, 80)])
def test_groups_equal_brute_force(make, size, percent):
    rows = corpus(size)
    got = neardup.near_duplicates(make(rows), shingle=size, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute_force(rows, size, percent)


def test_chain_of_copies(make):
    """Neighbours are alike, the ends are not: still one group."""
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[: 60 - 3 * i] + [f"x{k}" for k in range(3 * i)])) for i in range(12)]
    got = neardup.near_duplicates(make(rows), shingle=2, percent=80).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: c for i, (_, c, _) in brute_force(rows, 2, 80).items()}


def test_odd_tables(make):
    assert neardup.near_duplicates(make([])).collect() == []
    rows = [(None, "the same words here now"), (None, "the same words here now"), (7, "the same words here now"), (7, "other words")]
    got = sorted(neardup.near_duplicates(make(rows)).collect(), key=str)
    assert all(r.kept for r in got) and {r.component_id for r in got} == {None, 7}


def test_estimate_is_unbiased():
    shingler = neardup.Shingler(1)
    errors = []
    for seed in range(60):
        rng = random.Random(seed)
        shared = [f"s{rng.random()}" for _ in range(400)]
        a, b = ([*shared, *(f"{x}{rng.random()}" for _ in range(100))] for x in "ab")
        left, right = (neardup.registers(shingler.hashes(" ".join(t))) for t in (a, b))
        errors.append(((left == right).mean() - neardup.COLLISION) / (1 - neardup.COLLISION) - 400 / 600)
    assert abs(sum(errors) / len(errors)) < 0.02


def test_bitmaps_bound_the_difference():
    shingler = neardup.Shingler(1)
    a = shingler.hashes(" ".join(f"w{i}" for i in range(900)))
    b = shingler.hashes(" ".join(f"w{i}" for i in range(100, 1000)))
    differ = sum(int(x).bit_count() for x in (neardup.bitmap(a) ^ neardup.bitmap(b)).view("<u8"))
    assert 0 < differ <= 200


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(0, i) for i in range(400, 500)] + [(i, i + 1) for i in range(600, 640)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in links:
        lo, hi = sorted((find(a), find(b)))
        root[hi] = lo
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {x for pair in links if pair[0] != pair[1] for x in pair}
    assert got == {i: find(i) for i in linked}
