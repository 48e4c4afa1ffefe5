"""Near-duplicate vectors by a robust-pruned flat graph over cluster shards.

1. Equal vectors are one class with a size, so a vector that very many rows hold
   is compared once.
2. Cluster centres are fitted on a bounded sample. Every class goes to the shard
   of its nearest centre and to those nearly as near: shards overlap.
3. Each shard builds a robust-pruned graph of its vectors; a class's adjacency
   lists from all its shards are united, and the shards get them back.
4. In its home shard every class walks greedily from the medoids towards itself
   and then expands all that lies within the radius, however much that is.
   Pairs found are confirmed in double precision.
5. A pair may be found in two places. Which of them counts it is clear from what
   either side knows, so only sums per class and one link from each class to the
   least one of its group in the shard leave a task, never the pairs.
6. Recall is measured: sampled classes are compared with all others in blocks. If
   too many links are missing, the search is repeated with a wider beam.

A shard with too many rows is dealt into parts by hash, each with a graph of its
own, and its queries visit every part.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ackline.llm.common import keep, map_batches, prepare
from ackline.llm.components import connected_components
from ackline.llm.flatgraph import build, entry_points, range_search

SHARD = 1000  # vectors a shard should have
MOST_SHARDS = 4096
PART = 20_000  # vectors a graph may have
SAMPLE = 40_000  # vectors the centres are fitted on
AUDITED = 1000
# How much less similar than the nearest centre another one may be to share a vector.
OVERLAP = 0.06
# Float32 similarities may be off by this much; what is near the radius is confirmed in double.
ROUNDING = 1e-5
ENTRIES = 8
WALK = {"slack": 0.05, "beam": 24}


def _valid(column: str) -> F.Column:
    """Whether a vector has numbers only, all finite, and not all of them zero."""
    x = F.col(column)
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return F.coalesce(finite & F.exists(x, lambda e: e != 0), F.lit(False))


def vector_classes(rows: DataFrame) -> DataFrame:
    """``(cls, size, vec)``: every different vector, the least row number that has it, and how many do."""
    return rows.filter("vec is not null").groupBy("vec").agg(F.min("row").alias("cls"), F.count("*").alias("size"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as the rows of a double matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), -1)


def _unit(matrix: np.ndarray) -> np.ndarray:
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)  # squares of tiny or huge numbers would be lost
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def fit_centres(sample: np.ndarray, count: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Unit cluster centres of unit vectors."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.permutation(len(sample))[:count]].astype(np.float32)
    points = sample.astype(np.float32)
    for _ in range(rounds):
        nearest = np.concatenate([(points[a : a + 4096] @ centres.T).argmax(axis=1) for a in range(0, len(points), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 1e-6, sums / np.maximum(norm, 1e-6), centres).astype(np.float32)
    return centres


def _centres(classes: DataFrame, total: int, shard: int, sample: int) -> np.ndarray:
    chosen = classes.select("cls", "vec").orderBy(F.xxhash64("cls"), "cls").limit(sample).orderBy("cls").toArrow()
    points = _unit(_matrix(chosen.column("vec").combine_chunks()))
    return fit_centres(points, max(1, min(math.ceil(total / shard), MOST_SHARDS, len(points))))


MEMBERS = "shard int, home int, shards array<int>, cls long, size long"


def assign(classes: DataFrame, centres: np.ndarray, overlap: float) -> DataFrame:
    """One row for every class and shard it is in."""
    kind = classes.schema["vec"].dataType.simpleString()

    def deal(batch: pa.RecordBatch) -> pa.RecordBatch:
        points = _unit(_matrix(batch.column("vec"))).astype(np.float32)
        like = points @ centres.T
        best = like.max(axis=1, keepdims=True)
        home = like.argmax(axis=1).astype(np.int32)
        row, shard = np.nonzero(like >= best - overlap)
        starts = np.searchsorted(row, np.arange(len(points) + 1)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(starts), pa.array(shard.astype(np.int32)))
        at = pa.array(row)
        columns = [pa.array(shard.astype(np.int32)), pa.array(home[row]), lists.take(at)]
        columns += [batch.column(c).take(at) for c in ("cls", "size", "vec")]
        return pa.RecordBatch.from_arrays(columns, names=["shard", "home", "shards", "cls", "size", "vec"])

    return map_batches(classes.select("cls", "size", "vec"), deal, f"{MEMBERS}, vec {kind}")


def _part(cls: np.ndarray, parts: int) -> np.ndarray:
    """Part of its shard a class is dealt to."""
    mixed = (cls.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(parts)).astype(np.int32)


def _into_parts(members: DataFrame, part: int) -> tuple[DataFrame, dict[int, int]]:
    """Add ``part``; and the number of parts of every shard that needs several."""
    sizes = members.groupBy("shard").count().filter(F.col("count") > part).collect()  # a row a shard at most
    parts = {r["shard"]: math.ceil(r["count"] / part) for r in sizes}

    def deal(batch: pa.RecordBatch) -> pa.RecordBatch:
        cls, shard = batch.column("cls").to_numpy(), batch.column("shard").to_numpy()
        dealt = np.zeros(len(cls), np.int32)
        for number, count in parts.items():
            here = shard == number
            dealt[here] = _part(cls[here], count)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(dealt)], names=[*batch.schema.names, "part"])

    if not parts:
        return members.withColumn("part", F.lit(0)), parts
    schema = members.withColumn("part", F.lit(0)).schema
    return map_batches(members, deal, schema), parts


def adjacency(members: DataFrame, degree: int, alpha: float) -> DataFrame:
    """``(cls, near)`` of every class in every shard: its neighbours in the graph there."""

    def make(group: pa.Table) -> pa.Table:
        group = group.sort_by("cls")
        cls = group.column("cls").to_numpy()
        v = _unit(_matrix(group.column("vec").combine_chunks())).astype(np.float32)
        graph = build(v, degree=degree, alpha=alpha)
        stops = np.concatenate([[0], np.cumsum((graph >= 0).sum(axis=1))]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(stops), pa.array(cls[graph[graph >= 0]]))
        return pa.table({"cls": group.column("cls"), "near": lists})

    return members.select("shard", "part", "cls", "vec").groupBy("shard", "part").applyInArrow(make, "cls long, near array<long>")


FOUND = "cls long, n long, root long"


def _graph_of(cls: np.ndarray, near: pa.ListArray) -> np.ndarray:
    """United adjacency lists as a matrix; neighbours in other shards only are left out."""
    lengths = np.diff(near.offsets.to_numpy())
    owner = np.repeat(np.arange(len(cls)), lengths)
    target = near.flatten().to_numpy()
    place = np.minimum(np.searchsorted(cls, target), len(cls) - 1)
    here = cls[place] == target
    owner, place = owner[here], place[here]
    count = np.bincount(owner, minlength=len(cls))
    graph = np.full((len(cls), max(1, int(count.max(initial=0)))), -1, np.int32)
    graph[owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)] = place
    return graph


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node each node reaches by the links ``a``-``b``."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def search(
    members: DataFrame, parts: dict[int, int], near: DataFrame, radius: float, beam: int, slack: float
) -> DataFrame:
    """``(cls, n, root)``: linked rows of other classes counted here, and the least class linked with here."""
    united = near.groupBy("cls").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    index = members.join(united, "cls").withColumn("visits", F.lit(False))
    guests = members.filter(F.col("shard") == F.col("home"))
    if parts:
        table = guests.sparkSession.createDataFrame(list(parts.items()), "shard int, parts int")
        every = F.sequence(F.lit(0), F.col("parts") - 1)
        others = guests.join(F.broadcast(table), "shard").withColumn("at", F.explode(every)).filter("at != part")
        others = others.withColumns({"part": F.col("at"), "near": F.array().cast("array<long>"), "visits": F.lit(True)})
        index = index.unionByName(others.select(*index.columns))

    def find(group: pa.Table) -> pa.Table:
        group = group.sort_by("cls")
        visits = group.column("visits").to_numpy(zero_copy_only=False).astype(bool)
        shard, part = group.column("shard")[0].as_py(), group.column("part")[0].as_py()
        every = {c: group.column(c).to_numpy() for c in ("cls", "size", "home")}
        exact = _unit(_matrix(group.column("vec").combine_chunks()))
        lists = group.column("shards").to_pylist()
        node = np.flatnonzero(~visits)
        if not len(node):
            return pa.table({c: pa.array([], pa.int64()) for c in ("cls", "n", "root")})
        graph = _graph_of(every["cls"][node], group.column("near").combine_chunks().take(pa.array(node)))
        v = exact[node].astype(np.float32)
        # Classes at home here ask; visitors are at home here too, but dealt to another part.
        asks = np.flatnonzero(every["home"] == shard)
        own = np.full(len(visits), -1)
        own[node] = np.arange(len(node))
        q, k = range_search(
            v, graph, exact[asks].astype(np.float32), own[asks], entry_points(v, ENTRIES), radius - ROUNDING,
            beam=beam, slack=slack,
        )
        a, b = asks[q], node[k]
        a, b = a[a != b], b[a != b]
        sure = np.concatenate(
            [np.zeros(0, bool), *[(exact[a[i : i + 65536]] * exact[b[i : i + 65536]]).sum(axis=1) >= radius for i in range(0, len(a), 65536)]]
        )
        a, b = a[sure], b[sure]
        # Both at home in this part: count the pair once, whichever side found it.
        at_home = (every["home"] == shard) & ~visits
        inside = at_home[a] & at_home[b]
        low, high = np.minimum(a, b), np.maximum(a, b)
        once = np.unique(low[inside].astype(np.int64) * len(visits) + high[inside])
        counts = [np.stack([once // len(visits), once % len(visits)])]
        rest = np.flatnonzero(~inside)
        if len(rest):
            mine = np.array(
                [
                    # From another part of this shard: the lower part counts. From another home: the lower shard
                    # counts, if the asking class is in the other one at all.
                    (part < _part(every["cls"][i : i + 1], parts[shard])[0])
                    if every["home"][j] == shard
                    else (shard < every["home"][j] or every["home"][j] not in lists[i])
                    for i, j in zip(a[rest].tolist(), b[rest].tolist())
                ]
            )
            counts.append(np.stack([a[rest][mine], b[rest][mine]]))
        x, y = np.concatenate(counts, axis=1)
        n = np.zeros(len(visits), np.int64)
        np.add.at(n, x, every["size"][y])
        np.add.at(n, y, every["size"][x])
        root = _roots(len(visits), x, y)
        linked = np.flatnonzero(n > 0)
        # Sorted by class, so the least place is the least class.
        return pa.table({"cls": every["cls"][linked], "n": n[linked], "root": every["cls"][root[linked]]})

    wanted = ["shard", "part", "home", "shards", "cls", "size", "vec", "near", "visits"]
    return index.select(*wanted).groupBy("shard", "part").applyInArrow(find, FOUND)


def audit(classes: DataFrame, counted: DataFrame, radius: float, sample: int) -> tuple[int, int]:
    """Links that sampled classes have in truth, and those counted, at most the true number each.

    The sample, bounded by a parameter, goes to every task; all classes are compared with it in blocks.
    """
    chosen = classes.orderBy(F.xxhash64("cls", F.lit("audit")), "cls").limit(sample).toArrow()
    if not chosen.num_rows:
        return 0, 0
    ids = chosen.column("cls").to_numpy()
    asked = _unit(_matrix(chosen.column("vec").combine_chunks()))

    def compare(batch: pa.RecordBatch) -> pa.RecordBatch:
        true = np.zeros(len(ids), np.int64)
        cls, size, points = batch.column("cls").to_numpy(), batch.column("size").to_numpy(), _unit(_matrix(batch.column("vec")))
        for a in range(0, len(cls), 4096):
            near = points[a : a + 4096] @ asked.T >= radius
            near &= cls[a : a + 4096, None] != ids
            true += (near * size[a : a + 4096, None]).sum(axis=0)
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(true)], names=["cls", "true"])

    true = map_batches(classes, compare, "cls long, true long").groupBy("cls").agg(F.sum("true").alias("true"))
    both = true.join(counted, "cls", "left").agg(
        F.sum("true").alias("all"), F.sum(F.least("true", F.coalesce("n", F.lit(0)))).alias("found")
    )
    row = both.first()
    return row["all"] or 0, row["found"] or 0


def near_duplicate_vectors(
    vectors: DataFrame,
    *,
    column: str = "embedding",
    radius: float = 0.95,
    degree: int = 32,
    alpha: float = 1.2,
    overlap: float = OVERLAP,
    shard: int = SHARD,
    part: int = PART,
    sample: int = SAMPLE,
    audited: int = AUDITED,
    least_recall: float = 0.98,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors``.

    Rows are linked at a cosine of ``radius`` or more, confirmed in double
    precision. A vector that is null, empty, zero, or holds null or non-finite
    components is linked with nothing, and vectors of different length are not
    linked. Rows that repeat an id are vectors of their own; a group's
    ``component_id`` is its least id, a null id only if it has no other. Columns
    other than ``vec_id`` and ``column`` play no part. ``sample`` bounds the
    vectors the centres are fitted on, ``audited`` those whose links are also
    counted by brute force; a recall under ``least_recall`` widens the beam, and
    is an error if three times wider ones do not help.
    """
    spark = vectors.sparkSession
    prepare(spark)
    vec = F.when(_valid(column), F.col(column))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec"))
    rows = keep(rows.withColumn("row", F.monotonically_increasing_id()), "vector-rows")
    classes = keep(vector_classes(rows).withColumn("length", F.size("vec")), "vector-classes")
    sizes = {r["length"]: r["count"] for r in classes.groupBy("length").count().collect()}  # a row a vector length

    counted = linked = None
    for length in sorted(sizes):
        same = classes.filter(F.col("length") == length).drop("length")
        centres = _centres(same, sizes[length], shard, sample)
        members, parts = _into_parts(assign(same, centres, overlap), part)
        members = keep(members, "shard-members")
        near = keep(adjacency(members, degree, alpha), "adjacency")
        beam = WALK["beam"]
        while True:
            found = keep(search(members, parts, near, radius, beam, WALK["slack"]), "found")
            sums = found.groupBy("cls").agg(F.sum("n").alias("n"))
            true, got = audit(same, sums, radius, audited)
            if got >= least_recall * true:
                break
            if beam >= 8 * WALK["beam"]:
                raise RuntimeError(f"only {got} of {true} audited links were found")
            beam *= 2
        links = found.filter("root != cls").select(F.col("cls").alias("a"), F.col("root").alias("b"))
        counted = sums if counted is None else counted.unionByName(sums)
        linked = links if linked is None else linked.unionByName(links)
    if counted is None:
        alone = rows.withColumns({"n_links": F.lit(0).cast("long"), "component_id": F.col("vec_id"), "kept": F.lit(True)})
        return alone.select("vec_id", "n_links", "component_id", "kept")

    groups = connected_components(linked, "vector-groups").withColumnsRenamed({"node": "cls", "component": "group"})
    named = classes.join(counted, "cls", "left").join(groups, "cls", "left").select(
        "vec", "cls", "size", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("group", "cls").alias("group")
    )
    named = named.select("cls", "group", (F.col("n") + F.col("size") - 1).alias("n_links"), *_digests("vec"))
    known = rows.filter("vec is not null").select("vec_id", *_digests("vec")).join(named, ["d1", "d2"])
    least = known.groupBy("group").agg(F.min("vec_id").alias("component_id"))
    joined = known.join(least, "group").select("vec_id", "n_links", "component_id")
    alone = rows.filter("vec is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.col("component_id").eqNullSafe(F.col("vec_id")))


def _digests(column: str) -> list[F.Column]:
    """128 bits that stand for a vector in joins."""
    return [F.xxhash64(column).alias("d1"), F.xxhash64(F.lit("second"), F.col(column)).alias("d2")]
