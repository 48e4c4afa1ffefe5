"""A flat proximity graph over the vectors of one shard, and range search in it.

All of it works on blocks of nodes or queries at a time with numpy. Vectors are
unit rows of a float32 matrix; adjacency is a matrix of neighbour numbers, -1
where there is none.
"""

from __future__ import annotations

import numpy as np

# Similarities met by one block of queries: four bytes for every query and node.
MET_BYTES = 32 << 20
BATCH = 256
# Pairs whose vectors are gathered at once.
PAIRS = 1 << 16


def _without_repeats(ids: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Neighbour lists with repeats and the node itself blanked."""
    ids = np.sort(ids, axis=1)
    ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
    ids[ids == own[:, None]] = -1
    return ids


def robust_prune(v: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Up to ``degree`` neighbours of every node: the nearest candidate left, which
    rules out those that are nearer to it, by the factor ``alpha``, than to the node."""
    candidates = _without_repeats(candidates, nodes)
    at = v[candidates]
    near = np.matmul(at, v[nodes][:, :, None])[:, :, 0]
    between = np.matmul(at, at.transpose(0, 2, 1))
    alive = candidates >= 0
    far = 1 - near
    rows = np.arange(len(nodes))
    chosen = np.full((len(nodes), degree), -1, np.int32)
    for k in range(degree):
        best = np.where(alive, near, -np.inf).argmax(axis=1)
        has = alive[rows, best]
        if not has.any():
            break
        chosen[has, k] = candidates[rows, best][has]
        alive &= alpha * alpha * (1 - between[rows, best]) > far
        alive[rows, best] = False
    return chosen


def greedy_search(
    v: np.ndarray, graph: np.ndarray, queries: np.ndarray, entries: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """Walk from ``entries`` to the nodes nearest to each query.

    Returns the ``beam`` best nodes of every query, and its similarity to every
    node it has met on the way (minus infinity for the others).
    """
    b, width = len(queries), max(beam, len(entries))
    met = np.full((b, len(v)), -np.inf, np.float32)
    ids = np.full((b, width), -1, np.int32)
    like = np.full((b, width), -np.inf, np.float32)
    ids[:, : len(entries)] = entries
    like[:, : len(entries)] = met[:, entries] = queries @ v[entries].T
    done = ids < 0
    active = np.arange(b)
    while len(active):
        waiting = np.where(done[active], -np.inf, like[active])
        pick = waiting.argmax(axis=1)
        go = waiting[np.arange(len(active)), pick] > -np.inf
        active, pick = active[go], pick[go]
        if not len(active):
            break
        done[active, pick] = True
        around = graph[ids[active, pick]]
        fresh = (around >= 0) & np.isneginf(met[active[:, None], around])
        near = np.matmul(v[around], queries[active][:, :, None])[:, :, 0]
        near[~fresh] = -np.inf
        r, c = np.nonzero(fresh)
        met[active[r], around[r, c]] = near[r, c]
        all_ids = np.concatenate([ids[active], around], axis=1)
        all_like = np.concatenate([like[active], near], axis=1)
        all_done = np.concatenate([done[active], ~fresh], axis=1)
        top = np.argpartition(-all_like, width - 1, axis=1)[:, :width]
        ids[active] = np.take_along_axis(all_ids, top, axis=1)
        like[active] = np.take_along_axis(all_like, top, axis=1)
        done[active] = np.take_along_axis(all_done, top, axis=1) | np.isneginf(like[active])
    ids[np.isneginf(like)] = -1
    return ids, met


def entry_points(v: np.ndarray, count: int) -> np.ndarray:
    """Medoids: of all nodes, and of equal slices of them."""
    slices = [np.arange(len(v)), *np.array_split(np.arange(len(v)), min(count, len(v)))]
    return np.unique([s[(v[s] @ v[s].mean(axis=0)).argmax()] for s in slices if len(s)]).astype(np.int32)


def build(v: np.ndarray, *, degree: int = 32, beam: int = 32, alpha: float = 1.2, seed: int = 1) -> np.ndarray:
    """The robust-pruned graph of all nodes, inserted in random order in growing batches.

    A node's candidates are what a search for it finds in the graph so far, and
    the nearest of its own batch. Edges go both ways; a node with too many is
    pruned again.
    """
    n = len(v)
    graph = np.full((n, degree), -1, np.int32)
    order = np.random.default_rng(seed).permutation(n).astype(np.int32)
    at = 0
    while at < n:
        batch = order[at : at + max(min(at, BATCH), degree)]
        mates = v[batch] @ v[batch].T
        np.fill_diagonal(mates, -np.inf)
        k = min(beam // 2 if at else degree, len(batch) - 1)
        parts = []
        if k > 0:
            parts.append(batch[np.argpartition(-mates, k - 1, axis=1)[:, :k]])
        if at:
            inserted = order[:at]
            start = inserted[entry_points(v[inserted[: 4 * BATCH]], 4)]
            parts.append(greedy_search(v, graph, v[batch], start, beam)[0])
        if parts:
            graph[batch] = robust_prune(v, batch, np.concatenate(parts, axis=1), degree, alpha)
            _link_back(v, graph, batch, degree, alpha)
        at += len(batch)
    return _adopted(graph)


def _adopted(graph: np.ndarray) -> np.ndarray:
    """Nodes that pruning left without an edge to them get one from their nearest neighbour."""
    reached = np.zeros(len(graph), dtype=bool)
    reached[graph[graph >= 0]] = True
    orphans = np.flatnonzero(~reached & (graph[:, 0] >= 0)) if graph.shape[1] else np.empty(0, np.int64)
    if not len(orphans):
        return graph
    parent, uses = np.unique(graph[orphans, 0], return_counts=True)
    more = np.full((len(graph), int(uses.max())), -1, np.int32)
    order = orphans[np.argsort(graph[orphans, 0], kind="stable")]
    more[np.repeat(parent, uses), np.concatenate([np.arange(u) for u in uses])] = order
    return np.concatenate([graph, more], axis=1)


def _link_back(v: np.ndarray, graph: np.ndarray, batch: np.ndarray, degree: int, alpha: float) -> None:
    """Add the reverse of the edges of ``batch``; prune where they do not fit."""
    source, k = np.nonzero(graph[batch] >= 0)
    tail, head = graph[batch][source, k], batch[source]
    order = np.argsort(tail, kind="stable")
    tail, head = tail[order], head[order]
    nodes, first, uses = np.unique(tail, return_index=True, return_counts=True)
    for a in range(0, len(nodes), BATCH):
        some, begin, many = nodes[a : a + BATCH], first[a : a + BATCH], uses[a : a + BATCH]
        width = int(many.max())
        place = begin[:, None] + np.arange(width)
        new = np.where(np.arange(width) < many[:, None], head[np.minimum(place, len(head) - 1)], -1)
        both = _without_repeats(np.concatenate([graph[some], new.astype(np.int32)], axis=1), some)
        fits = (both >= 0).sum(axis=1) <= degree
        if fits.any():
            graph[some[fits]] = -np.sort(-both[fits], axis=1)[:, :degree]
        crowded = np.flatnonzero(~fits)
        # The width of a block is that of its longest list: long ones apart.
        for part in np.array_split(crowded, max(1, len(crowded) * both.shape[1] // (BATCH * 64))):
            if len(part):
                graph[some[part]] = robust_prune(v, some[part], both[part], degree, alpha)


def range_search(
    v: np.ndarray,
    graph: np.ndarray,
    queries: np.ndarray,
    own: np.ndarray,
    entries: np.ndarray,
    radius: float,
    *,
    beam: int,
    slack: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs ``(query, node)`` with a similarity of ``radius`` or more.

    ``own`` is the node a query is itself, or -1; such a node is expanded as well.
    After the greedy walk every node within the radius (and a little beyond, by
    ``slack``) is expanded in turn, until no new one turns up: what lies in range
    is found however much it is.
    """
    found_q, found_n = [], []
    step = max(1, min(BATCH, MET_BYTES // max(1, 4 * len(v))))
    for at in range(0, len(queries), step):
        block = queries[at : at + step]
        _, met = greedy_search(v, graph, block, entries, beam)
        itself = own[at : at + step]
        met[np.flatnonzero(itself >= 0), itself[itself >= 0]] = 1.0
        q, node = np.nonzero(met >= radius - slack)
        while len(q):
            next_q, next_n = [], []
            for a in range(0, len(q), max(1, PAIRS // graph.shape[1])):
                b = a + max(1, PAIRS // graph.shape[1])
                around = graph[node[a:b]]
                fresh = (around >= 0) & np.isneginf(met[q[a:b, None], around])
                r, c = np.nonzero(fresh)
                cells = np.unique(q[a:b][r].astype(np.int64) * len(v) + around[r, c])
                nq, nn = cells // len(v), cells % len(v)
                met[nq, nn] = near = np.einsum("ij,ij->i", block[nq], v[nn])
                inside = near >= radius - slack
                next_q.append(nq[inside])
                next_n.append(nn[inside])
            q, node = np.concatenate(next_q), np.concatenate(next_n)
        q, node = np.nonzero(met >= radius)
        found_q.append(q + at)
        found_n.append(node)
    if not found_q:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_q), np.concatenate(found_n)
