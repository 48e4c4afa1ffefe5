"""Near-duplicate groups by HyperMinHash.

A document is its set of distinct word shingles. Its sketch has 160 registers:
shingle hashes are dealt over the registers, each keeps of its least value the
number of leading zeros and ten bits of mantissa; empty registers borrow from
others in an order of their own. Four registers are a band. Documents that share
a band are candidates, kept if the collision-corrected estimate from the
registers is not clearly under the threshold, and verified on the full sets.

Two sets of similarity 0.8 miss all 40 bands with a chance of 7e-10.

Only connected groups are wanted, so pairs inside a group need not all be seen:
documents with equal sets count once; the members of a bucket are first compared
with one of them, at first the one with most company in all its buckets (an
original among its copies), then another; after that each bucket compares only
members that are still in different groups. Such a pair is taken up in its first
common bucket only, and only if bitmaps of the sets allow it: every bit in which
they differ is a shingle that only one of the sets has. That bound is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ackline.llm.common import keep, map_batches, prepare
from ackline.llm.components import connected_components

BANDS, ROWS = 40, 4
REGISTERS = BANDS * ROWS
MANTISSA = 10
# Chance that the registers of two unrelated sets of like size agree.
COLLISION = 0.169919 * 2.0**-MANTISSA
# Standard errors under the threshold at which an estimate is ruled out.
SAFETY = 5
STAR_ROUNDS = 2
BITMAP = 4096
REMEMBERED = 1_000_000

_EVEN, _MIX1, _MIX2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Distinct shingle hashes of texts; word hashes are remembered, bounded."""

    def __init__(self, size: int):
        self.size = size
        self.words: dict[bytes, int] = {}

    def hashes(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        known = self.words
        if len(known) > REMEMBERED:
            known.clear()
        try:
            h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            digest = xxhash.xxh3_64_intdigest
            for word in words:
                if word not in known:
                    known[word] = digest(word)
            h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(self.size, len(h))
        out = np.full(len(h) - size + 1, size, np.uint64)
        for k in range(size):
            out = mixed(out * _EVEN + h[k : len(h) - size + 1 + k])
        return np.unique(out)


def _borrowing_order() -> np.ndarray:
    """For each register a random order of the others."""
    cells = np.arange(REGISTERS * REGISTERS, dtype=np.uint64).reshape(REGISTERS, REGISTERS)
    return mixed(cells * _EVEN + np.uint64(1))


_ORDER = _borrowing_order()


def registers(hashes: np.ndarray) -> np.ndarray:
    """The 160 registers of a non-empty set, 16 bits each."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max)
    cell = (hashes >> np.uint64(32)) % np.uint64(REGISTERS)
    np.minimum.at(least, cell.astype(np.int64), mixed(hashes + _EVEN))
    used = np.zeros(REGISTERS, dtype=bool)
    used[cell.astype(np.int64)] = True
    fraction, exponent = np.frexp((least >> np.uint64(11)).astype(np.float64))
    zeros = np.minimum(53 - exponent, 53)
    value = ((zeros + 1) << MANTISSA) + np.maximum((fraction * 2 - 1) * (1 << MANTISSA), 0).astype(np.int64)
    if not used.all():
        have, lack = np.flatnonzero(used), np.flatnonzero(~used)
        value[lack] = value[have[_ORDER[np.ix_(lack, have)].argmin(axis=1)]]
    return value.astype("<u2")


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """One bit for every shingle, in ``BITMAP`` places."""
    bits = np.zeros(BITMAP, dtype=np.uint8)
    bits[(hashes & np.uint64(BITMAP - 1)).astype(np.int64)] = 1
    return np.packbits(bits).view("<i8")


def sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """``(doc_id, n, set_key, bands, bits)``: set size, key of the set, packed registers, bitmap."""

    def sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
        shingler = Shingler(shingle)
        n, keys, bands, bits = [], [], [], []
        for text in batch.column("text").to_pylist():
            hashes = shingler.hashes(text)
            n.append(len(hashes))
            keys.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
            bands.append(registers(hashes).view("<i8") if len(hashes) else None)
            bits.append(bitmap(hashes) if len(hashes) else None)
        columns = [
            batch.column("doc_id"),
            pa.array(n, pa.int64()),
            pa.array(keys, pa.binary()),
            pa.array(bands, pa.list_(pa.int64())),
            pa.array(bits, pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "set_key", "bands", "bits"])

    made = docs.select(F.col("doc_id").cast("long"), "text")
    return map_batches(made, sketch, "doc_id long, n long, set_key binary, bands array<long>, bits array<long>")


def estimate(a: Column, b: Column) -> Column:
    """Collision-corrected Jaccard estimate from two packed sketches."""

    def equal(x: Column, y: Column) -> Column:
        differ = x.bitwiseXOR(y)
        parts = [(F.shiftright(differ, 16 * k).bitwiseAND(F.lit(0xFFFF)) == 0).cast("int") for k in range(ROWS)]
        return parts[0] + parts[1] + parts[2] + parts[3]

    same = F.aggregate(F.zip_with(a, b, equal), F.lit(0), lambda total, x: total + x)
    return (same / REGISTERS - COLLISION) / (1 - COLLISION)


def _possible(threshold: float, n_a: Column, n_b: Column) -> Column:
    """Whether sets of these sizes can reach the threshold."""
    return F.least(n_a, n_b) >= F.greatest(n_a, n_b) * threshold - 1e-6


def _differing(a: Column, b: Column) -> Column:
    """In how many bits two bitmaps differ: no more than the sets do in shingles."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, x: total + x)


def verified(pairs: DataFrame, reps: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets reach the threshold."""
    threshold = percent / 100
    side = lambda c: reps.select(F.col("rep").alias(c), F.col("bands").alias(f"{c}_bands"), F.col("n").alias(f"{c}_n"))
    seen = F.least("a_n", "b_n", F.lit(REGISTERS))
    margin = SAFETY * F.sqrt(threshold * (1 - threshold) / seen)
    likely = pairs.join(side("a"), "a").join(side("b"), "b").filter(
        _possible(threshold, F.col("a_n"), F.col("b_n"))
        & (estimate(F.col("a_bands"), F.col("b_bands")) >= threshold - margin)
    )
    text = lambda c: texts.select(F.col("doc_id").alias(c), F.col("text").alias(f"{c}_text"))
    full = keep(likely.select("a", "b"), "likely-pairs").join(text("a"), "a").join(text("b"), "b")

    def confirm(batch: pa.RecordBatch) -> pa.RecordBatch:
        shingler = Shingler(shingle)
        held: tuple[str | None, np.ndarray] = (None, np.empty(0, np.uint64))
        good = []
        for a, b in zip(batch.column("a_text").to_pylist(), batch.column("b_text").to_pylist()):
            if held[0] != a:
                held = (a, shingler.hashes(a))
            other = shingler.hashes(b)
            both = len(np.intersect1d(held[1], other, assume_unique=True))
            good.append(100 * both >= percent * (len(held[1]) + len(other) - both))
        rows = batch.select(["a", "b"])
        return rows.filter(pa.array(good, pa.bool_()))

    return map_batches(full.select("a", "b", "a_text", "b_text"), confirm, "a long, b long")


def _in_groups(members: DataFrame, groups: DataFrame | None) -> DataFrame:
    """Members of the buckets that still hold several groups, with ``component``."""
    if groups is None:
        return members.withColumn("component", F.col("rep"))
    named = members.drop("component").join(groups.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.withColumn("component", F.coalesce("component", "rep"))
    mixed_buckets = named.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    return named.join(mixed_buckets.filter("lo < hi").select("bucket"), "bucket")


def _star_pairs(members: DataFrame, number: int) -> DataFrame:
    """Every member of a bucket with the bucket's chosen one."""
    if number == 0:
        company = members.groupBy("rep").agg((-F.sum("size")).alias("rank"))
        members = members.join(company, "rep")
    else:
        members = members.withColumn("rank", F.xxhash64("rep", F.lit(number)))
    order = F.struct("rank", "rep", "component")
    chosen = members.groupBy("bucket").agg(F.min(order).alias("chosen"))
    chosen = chosen.select("bucket", F.col("chosen.rep").alias("pivot"), F.col("chosen.component").alias("of"))
    pairs = members.join(chosen, "bucket").filter("component != of")
    return pairs.select(F.least("pivot", "rep").alias("a"), F.greatest("pivot", "rep").alias("b")).distinct()


def _rest_pairs(members: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """All pairs of a bucket in different groups; its largest group meets only the others."""
    sizes = members.groupBy("bucket", "component").agg(F.count("*").alias("uses"))
    major = sizes.groupBy("bucket").agg(F.max(F.struct("uses", "component")).alias("top"))
    major = major.select("bucket", F.col("top.component").alias("major"))
    full = members.select("bucket", "band", "rep", "component").join(reps.select("rep", "n", "bands", "bits"), "rep")
    minor = full.join(major, "bucket").filter("component != major")
    minor = minor.select("bucket", "major", *[F.col(c).alias(f"x_{c}") for c in ("rep", "component", "n", "bands", "bits")])
    first_common = F.array_position(F.zip_with("bands", "x_bands", lambda x, y: x == y), F.lit(True))
    at_most = (F.col("n") + F.col("x_n")) * ((1 - threshold) / (1 + threshold)) + 1e-6
    met = minor.join(full, "bucket").filter(
        (F.col("component") != F.col("x_component"))
        & ((F.col("component") == F.col("major")) | (F.col("x_rep") < F.col("rep")))
        & _possible(threshold, F.col("x_n"), F.col("n"))
        & (first_common == F.col("band") + 1)
        & (_differing(F.col("bits"), F.col("x_bits")) <= at_most)
    )
    return met.select(F.least("x_rep", "rep").alias("a"), F.greatest("x_rep", "rep").alias("b")).distinct()


def near_duplicates(docs: DataFrame, *, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs``.

    Texts are cut at ASCII white space after lower-casing A-Z. Documents are
    linked if ``100 * intersection >= percent * union``; ``component_id`` is the
    least id reachable and ``kept`` marks the document that has it. A text with
    fewer words than a shingle is one shingle; a null text or one without words
    is linked with nothing. Rows that repeat an id are one document with several
    texts. A null id is linked with nothing and kept. Sketches and other steps
    are written to the shared folder at the call.
    """
    spark = docs.sparkSession
    prepare(spark)
    made = keep(sketches(docs, shingle), "sketches")
    least = F.min(F.struct("doc_id", "n", "bands", "bits"))
    grouped = made.filter("n > 0 and doc_id is not null").groupBy("set_key").agg(least.alias("least"))
    reps = grouped.select("set_key", F.col("least.doc_id").alias("rep"), "least.n", "least.bands", "least.bits")
    reps = keep(reps, "set-classes")

    rows = reps.select("rep", F.posexplode("bands").alias("band", "value"))
    rows = rows.select("rep", "band", F.xxhash64("band", "value").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    members = keep(rows.join(shared, "bucket"), "bucket-members")
    wanted = members.select(F.col("rep").alias("doc_id")).distinct()
    # Of rows that repeat an id, the text that gave the class is among them.
    texts = keep(docs.select(F.col("doc_id").cast("long"), "text").join(wanted, "doc_id", "left_semi"), "candidate-texts")

    links = None
    groups = None
    rounds: list[Callable[[DataFrame], DataFrame]] = [
        *[lambda m, k=k: _star_pairs(m, k) for k in range(STAR_ROUNDS)],
        lambda m: _rest_pairs(m, reps, percent / 100),
    ]
    for pairs_of in rounds:
        members = _in_groups(members, groups) if groups is None else keep(_in_groups(members, groups), "open-buckets")
        found = keep(verified(pairs_of(members), reps, texts, shingle, percent), "links")
        links = found if links is None else links.unionByName(found)
        groups = connected_components(links)

    named = reps.select("set_key", "rep").join(groups.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("set_key", F.coalesce("component", "rep").alias("component_id"))
    joined = made.select("doc_id", F.col("n").alias("n_shingles"), "set_key").join(named, "set_key", "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept")
    )
