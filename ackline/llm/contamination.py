"""Benchmark passages in documents, by SimHash of item-sized windows.

A window of a document has the length in words of a benchmark item. A window
that verifies against an item shares word shingles with it, so windows are laid
where a shingle of some item stands, at the place it has in the item. Equal
windows count once. Each has a 64-bit SimHash of its weighted shingles; windows
and items of a length are compared if their fingerprints differ in at most
``RADIUS`` bits, found by a multi-index: with one block more than the radius some
block is equal for every such pair. The exact similarity of the weighted
shingles then decides.

All of it is DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ackline.llm.common import KEY, keep, prepare, row_key, with_once
from ackline.llm.licenses import shingle_hashes, words

SHINGLE = 5
# At a similarity of 0.8 fingerprints differ in 9.7 bits, standard deviation 2.9.
RADIUS = 20


def shingle_texts(parts: str) -> Column:
    """All runs of five words as texts, in order; the whole as one if there are fewer."""
    n = F.greatest(F.size(parts) - SHINGLE + 1, F.lit(1))
    each = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(F.col(parts), i, F.lit(SHINGLE)), " "))
    return F.when(F.size(parts) > 0, each).otherwise(F.array().cast("array<string>"))


def with_simhash(df: DataFrame, shingles: str) -> DataFrame:
    """Add ``fingerprint``: each shingle votes on every bit with its length as weight."""
    weighed = F.transform(shingles, lambda s: F.struct(F.xxhash64(s).alias("h"), F.length(s).cast("long").alias("w")))
    df = with_once(df, "_weighed", weighed)
    bits = F.expr(
        "aggregate(sequence(0, 63), 0L, (made, b) -> made | if(aggregate(_weighed, 0L, (total, x) ->"
        " total + if((shiftright(x.h, b) & 1L) = 1L, x.w, -x.w)) > 0L, shiftleft(1L, b), 0L))"
    )
    return with_once(df, "fingerprint", bits).drop("_weighed")


def blocks(fingerprint: str, radius: int = RADIUS) -> Column:
    """The ``radius + 1`` blocks of a fingerprint, each marked with its number."""
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    parts = []
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        value = F.shiftrightunsigned(F.col(fingerprint), low).bitwiseAND(F.lit((1 << (high - low)) - 1))
        parts.append(value.bitwiseOR(F.lit(i << 32)))
    return F.array(*parts)


def weighted_similarity(a: str, b: str) -> Column:
    """Jaccard similarity of two shingle lists as weighted multisets (weight: length)."""
    def times(s: Column, of: str) -> Column:
        return F.size(F.filter(of, lambda x: x == s))

    def total(counts) -> Column:
        weights = F.transform(F.array_union(a, b), lambda s: counts(times(s, a), times(s, b)) * F.length(s))
        return F.aggregate(weights, F.lit(0), lambda sum_, x: sum_ + x)

    return total(F.least) / total(F.greatest)


def _run_hashes(sizes: Sequence[int]) -> Column:
    """Place and hash of all runs of so many words of ``parts``."""
    runs = [
        F.transform(shingle_hashes("parts", k), lambda h, i: F.struct(i.alias("place"), h.alias("hash"))) for k in sizes
    ]
    return F.concat(*runs)


def _items(benchmark: DataFrame) -> DataFrame:
    """Items with their words' number, shingles, hashed runs and fingerprint."""
    cut = benchmark.select(F.col("item_id").cast("long").alias("item_id"), words(F.col("text")).alias("parts"))
    cut = cut.filter(F.col("item_id").isNotNull() & (F.size("parts") > 0)).withColumn("n", F.size("parts"))
    runs = F.coalesce(*[F.when(F.least("n", F.lit(SHINGLE)) == k, _run_hashes([k])) for k in range(1, SHINGLE + 1)])
    made = cut.withColumn("item_shingles", shingle_texts("parts")).withColumn("runs", runs)
    return keep(with_simhash(made, "item_shingles").drop("parts"), "benchmark-items")


def _alignments(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``(doc, print, places)``: starts and lengths of windows that share a run with an item."""
    known = items.select("n", F.explode("runs").alias("run")).select("n", F.col("run.place").alias("at"), F.col("run.hash").alias("hash"))
    # Stored, so that Catalyst knows its size when it chooses between broadcast and shuffle.
    known = keep(known.distinct(), "benchmark-shingles")
    sizes = sorted(r[0] for r in items.select(F.least("n", F.lit(SHINGLE))).distinct().collect())  # five at most
    parts = with_once(docs, "parts", words(F.col("text"))).select(*KEY, "parts")
    hashed = with_once(parts, "runs", _run_hashes(sizes or [SHINGLE])).select(*KEY, F.explode("runs").alias("run"))
    met = hashed.select(*KEY, F.col("run.place").alias("place"), F.col("run.hash").alias("hash")).join(known, "hash")
    start = F.greatest(F.col("place") - F.col("at"), F.lit(0))
    return met.groupBy(*KEY).agg(F.collect_set(F.struct(start.alias("start"), F.col("n"))).alias("places"))


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, threshold: float = 0.8, radius: int = RADIUS) -> DataFrame:
    """``(doc_id, item_id, similarity, first_word)`` of every item found in a document.

    ``similarity`` is the best of all windows, ``first_word`` the earliest place
    of it. Texts are compared by their words (A-Z lower-cased, cut at ASCII signs
    and blanks), five to a shingle; an item of fewer words is one shingle, found
    where it stands as a whole. Null texts and texts or items without words match
    nothing. Rows with a null id or under a repeated one are documents of their
    own; rows that repeat id and text are reported once.
    """
    found = contaminated_rows(docs, benchmark, threshold=threshold, radius=radius)
    return found.select("doc_id", "item_id", "similarity", "first_word")


def contaminated_rows(docs: DataFrame, benchmark: DataFrame, *, threshold: float = 0.8, radius: int = RADIUS) -> DataFrame:
    """The same with the row's key (``common.row_key``) before."""
    prepare(docs.sparkSession)
    docs = docs.select(*row_key(docs), F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = _items(benchmark)
    placed = docs.join(_alignments(docs, items), KEY)
    parts = with_once(placed, "parts", words(F.col("text"))).select(*KEY, "doc_id", "parts", "places")
    each = parts.select(*KEY, "doc_id", "parts", F.explode("places").alias("at"))
    window = F.array_join(F.slice("parts", F.col("at.start") + 1, F.col("at.n")), " ")
    windows = each.select(*KEY, "doc_id", F.col("at.start").alias("first_word"), F.col("at.n").alias("n"), window.alias("window"))
    windows = windows.withColumn("key", F.unhex(F.md5("window")))
    windows = keep(windows, "benchmark-windows")

    different = windows.select("n", "key", "window").dropDuplicates(["n", "key"])
    cut = with_once(different.withColumn("parts", F.split("window", " ")), "shingles", shingle_texts("parts"))
    printed = with_simhash(cut.filter(F.size("shingles") > 0).select("n", "key", "shingles"), "shingles")
    printed = keep(printed, "window-fingerprints")

    left = printed.select("n", "key", F.col("fingerprint").alias("f"), F.explode(blocks("fingerprint", radius)).alias("block"))
    right = items.select("n", "item_id", F.col("fingerprint").alias("g"), F.explode(blocks("fingerprint", radius)).alias("block"))
    near = left.join(right, ["n", "block"]).filter(F.bit_count(F.col("f").bitwiseXOR(F.col("g"))) <= radius)
    near = near.select("n", "key", "item_id").distinct()
    texts = near.join(printed.select("n", "key", "shingles"), ["n", "key"]).join(items.select("item_id", "n", "item_shingles"), ["item_id", "n"])
    judged = with_once(texts, "similarity", weighted_similarity("shingles", "item_shingles"))
    true = keep(judged.filter(F.col("similarity") >= threshold).select("n", "key", "item_id", "similarity"), "benchmark-matches")

    found = windows.select(*KEY, "doc_id", "first_word", "n", "key").join(true, ["n", "key"])
    best = F.max(F.struct("similarity", (-F.col("first_word")).alias("before"))).alias("best")
    return (
        found.groupBy(*KEY, "doc_id", "item_id")
        .agg(best)
        .select(*KEY, "doc_id", "item_id", "best.similarity", (-F.col("best.before")).alias("first_word"))
    )
