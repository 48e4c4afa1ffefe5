import math

import numpy as np
import pytest

from ackline.llm import flatgraph, vectors
from ackline.llm.vectors import near_duplicate_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, radius=0.95):
    """``[(id, links, component)]``, row by row."""
    good = lambda v: v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    linked = [{i} for i in range(len(rows))]
    for length in {len(v) for _, v in rows if good(v)}:
        at = [i for i, (_, v) in enumerate(rows) if good(v) and len(v) == length]
        u = np.array([np.array(rows[i][1], np.float32).astype(np.float64) for i in at])
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        for a, b in np.argwhere(u @ u.T >= radius):
            linked[at[a]].add(at[b])
    root = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i, near in enumerate(linked):
            low = min(root[j] for j in near)
            for j in near:
                if root[j] != low:
                    root[j], changed = low, True
    groups = {}
    for i, r in enumerate(root):
        groups.setdefault(r, []).append(rows[i][0])
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in groups.items()}
    return sorted(((i, len(linked[k]) - 1, least[root[k]], i == least[root[k]]) for k, (i, _) in enumerate(rows)), key=repr)


def planted(n, dims, groups, seed=2):
    rng = np.random.default_rng(seed)
    found = rng.standard_normal((n, dims))
    at = 0
    for size, spread in groups:
        centre = rng.standard_normal(dims)
        found[at : at + size] = centre + spread * rng.standard_normal((size, dims))
        at += size
    return found.astype(np.float32)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize(("options", "exact"), [({}, True), ({"shard": 60}, False), ({"shard": 100, "part": 70}, False)])
def test_equals_brute_force(spark, options, exact):
    points = planted(900, 32, [(120, 0.12), (40, 0.2), (2, 0.05), (3, 0.1), (30, 0.25)])
    points[300:340] = points[301]
    points[340] = 3 * points[301]
    rows = [(1000 - i, p.tolist()) for i, p in enumerate(points)]
    got = rows_of(near_duplicate_vectors(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA), **options))
    want = brute_force(rows)
    if exact:
        assert got == want
    true, found = (sum(r[1] for r in x) for x in (want, got))
    assert 0.99 * true <= found <= true
    by_id = {r[0]: r for r in got}
    assert all(by_id[i][1] <= n for i, n, _, _ in want)
    assert sum(by_id[i][2] == c for i, _, c, _ in want) >= 0.99 * len(want)


def test_defined_results(spark):
    rows = [
        (5, [1.0, 0.0]), (3, [2.0, 0.01]), (3, [0.0, 1.0]), (4, [0.0, 1.0]), (None, [0.0, 2.0]), (7, None), (8, []),
        (9, [0.0, 0.0]), (10, [float("nan"), 1.0]), (11, [None, 1.0]), (12, [float("inf"), 1.0]), (13, [1.0, 0.0, 0.0]),
        (None, [-1.0, 0.0]), (None, None), (14, [1e-30, 0.0]), (15, [-1.0, -1e-3]),
    ]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    assert rows_of(near_duplicate_vectors(df)) == brute_force(rows)
    assert near_duplicate_vectors(df.filter("false")).collect() == []
    nothing = near_duplicate_vectors(df.filter("vec_id = 7")).collect()
    assert [tuple(r) for r in nothing] == [(7, 0, 7, True)]
    clashing = df.withColumnRenamed("label", "cls").withColumn("row", df.vec_id).withColumn("n_links", df.vec_id)
    assert rows_of(near_duplicate_vectors(clashing)) == brute_force(rows)


def test_a_hot_vector_is_one_class(spark):
    points = planted(200, 16, [])
    rows = [(i, points[0 if i % 3 else i].tolist()) for i in range(600) if i < 200 or i % 3]
    got = rows_of(near_duplicate_vectors(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)))
    assert got == brute_force(rows)


def test_graph_reaches_all_in_range():
    points = planted(1500, 24, [(300, 0.1), (200, 0.2)])
    v = (points / np.linalg.norm(points, axis=1, keepdims=True)).astype(np.float32)
    graph = flatgraph.build(v)
    assert all(len(set(r[r >= 0])) == (r >= 0).sum() and i not in r for i, r in enumerate(graph))
    assert set(graph[graph >= 0]) == set(range(len(v)))
    q, n = flatgraph.range_search(v, graph, v, np.arange(len(v)), flatgraph.entry_points(v, 8), 0.95, beam=24, slack=0.05)
    assert len(set(zip(q, n))) == len(q)
    assert ((v[q] * v[n]).sum(axis=1) > 0.9499).all()
    assert len(q) >= 0.99 * (v @ v.T >= 0.95).sum()


def test_low_recall_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(vectors, "audit", lambda *_: (100, 10))
    with pytest.raises(RuntimeError, match="10 of 100"):
        near_duplicate_vectors(spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [2.0, 1.0], 0)], SCHEMA))
