"""Importance resampling towards a target distribution of hashed word runs.

Every text is its runs of up to ``max_n`` words, each hashed to a bucket. How
often the buckets occur in the corpus and in the target texts gives every bucket
a gain, the logarithm of its likelihood ratio; a document weighs the sum of the
gains of its features, and documents are drawn without replacement by adding
Gumbel noise to the weight and taking the highest.

Corpora repeat themselves line by line, so texts are cut at line ends, which no
word holds. Equal lines meet in one aggregation that adds up their occurrences
before its shuffle, and the features of a distinct line are counted once and
multiplied. Runs that cross a line end belong to no line; they are counted where
the document is read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ackline.llm.common import keep, map_batches, prepare

BUCKETS = 10_000
# What a worker remembers before it starts afresh: words, and lines by characters of text.
REMEMBERED_WORDS = 500_000
REMEMBERED_LINES = 16 << 20

# ASCII letters and digits in lower case; every byte beyond ASCII is part of a word; the rest cuts.
_TO_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    """The words of a text, A-Z in lower case."""
    return (text or "").encode().translate(_TO_WORDS).split()


class Hasher:
    """Buckets of word runs; those of single words are remembered."""

    def __init__(self, buckets: int, max_n: int):
        self.buckets, self.max_n = buckets, max_n
        self.known: dict[bytes, int] = {}

    def _single(self, found: list[bytes]) -> np.ndarray:
        known = self.known
        try:
            return np.fromiter(map(known.__getitem__, found), np.int64, len(found))
        except KeyError:
            if len(known) > REMEMBERED_WORDS:
                known.clear()
            for word in set(found):
                if word not in known:
                    known[word] = zlib.crc32(word) % self.buckets
            return np.fromiter(map(known.__getitem__, found), np.int64, len(found))

    def inside(self, found: list[bytes]) -> np.ndarray:
        """Buckets of all runs of these words."""
        parts = [self._single(found)]
        for n in range(2, min(self.max_n, len(found)) + 1):
            runs = (zlib.crc32(b" ".join(found[i : i + n])) % self.buckets for i in range(len(found) - n + 1))
            parts.append(np.fromiter(runs, np.int64, len(found) - n + 1))
        return np.concatenate(parts)

    def across(self, lines: Iterable[list[bytes]]) -> np.ndarray:
        """Buckets of the runs that cross at least one border between these lines."""
        if self.max_n < 2:
            return np.empty(0, np.int64)
        found: list[int] = []
        # The last words before a border, with the line each is of.
        tail: list[tuple[int, bytes]] = []
        for number, line in enumerate(lines):
            near = [*tail, *((number, w) for w in line[: self.max_n - 1])]
            for i in range(len(tail)):
                for n in range(2, self.max_n + 1):
                    run = near[i : i + n]
                    # Runs that end before this line were counted at an earlier border.
                    if len(run) == n and run[-1][0] == number:
                        found.append(zlib.crc32(b" ".join([w for _, w in run])) % self.buckets)
            tail = [*tail, *((number, w) for w in line)][-(self.max_n - 1) :]
        return np.array(found, np.int64)


def _packed(counts: np.ndarray) -> pa.RecordBatch:
    bucket = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array(counts[bucket])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame, *, max_n: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all ``text`` fall into each bucket.

    What reaches the driver is one number a bucket.
    """
    lines = texts.select(F.explode(F.split("text", "\n")).alias("line")).filter("line <> ''")
    distinct = lines.groupBy("line").agg(F.count("*").alias("uses"))

    def of_lines(batch: pa.RecordBatch) -> pa.RecordBatch:
        hasher = Hasher(buckets, max_n)
        total = np.zeros(buckets, np.int64)
        for line, uses in zip(batch.column("line").to_pylist(), batch.column("uses").to_pylist()):
            np.add.at(total, hasher.inside(words(line)), uses)
        return _packed(total)

    def of_borders(batch: pa.RecordBatch) -> pa.RecordBatch:
        hasher = Hasher(buckets, max_n)
        total = np.zeros(buckets, np.int64)
        for text in batch.column("text").to_pylist():
            np.add.at(total, hasher.across(map(words, (text or "").split("\n"))), 1)
        return _packed(total)

    found = map_batches(distinct, of_lines, "bucket long, n long")
    if max_n > 1:
        found = found.unionByName(map_batches(texts.select("text"), of_borders, "bucket long, n long"))
    counts = np.zeros(buckets, np.int64)
    for bucket, n in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row a bucket at most
        counts[bucket] = n
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the smoothed log likelihood ratio of every bucket, rounded down."""
    size = len(corpus)
    s_all, t_all = float(corpus.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * (s_all + size) / ((s + 1.0) * (t_all + size))))
            for s, t in zip(corpus.tolist(), target.tolist())
        ],
        np.int64,
    )


def weigh(docs: DataFrame, gain: np.ndarray, *, max_n: int = 1, carry: Sequence[str] | None = None) -> DataFrame:
    """Add ``n_words``, ``n_features`` and ``weight`` to the columns ``carry`` (default: all).

    Lines a worker has met are not hashed again.
    """
    added = ("n_words", "n_features", "weight")
    names = [c for c in (docs.columns if carry is None else carry) if c not in added]
    others = docs.select(*names)
    schema = StructType([*others.schema.fields, *[StructField(c, LongType()) for c in added]])
    # Plain arrays travel with the task: buckets times eight bytes.
    packed = np.asarray(gain, np.int64)

    def weigh_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        hasher = Hasher(len(packed), max_n)
        remembered: dict[str, tuple[int, int, int]] = {}
        held = 0
        rows = []
        for text in batch.column(0).to_pylist():
            n_words = n_features = weight = 0
            lines = (text or "").split("\n")
            for line in lines:
                known = remembered.get(line)
                if known is None:
                    found = words(line)
                    inside = hasher.inside(found)
                    known = (len(found), len(inside), int(packed[inside].sum()))
                    held += len(line)
                    if held > REMEMBERED_LINES:
                        remembered.clear()
                        held = len(line)
                    remembered[line] = known
                n_words += known[0]
                n_features += known[1]
                weight += known[2]
            if max_n > 1:
                crossing = hasher.across(map(words, lines))
                n_features += len(crossing)
                weight += int(packed[crossing].sum())
            rows.append((n_words, n_features, weight))
        columns = [pa.array(v, pa.int64()) for v in zip(*rows)]
        return pa.RecordBatch.from_arrays([*batch.columns[1:], *columns], names=[*batch.schema.names[1:], *added])

    return map_batches(docs.select(F.col("text").alias("_line_text"), *names), weigh_batch, schema)


def gumbel(seed: int, doc_id: str) -> Column:
    """Thousandths of a Gumbel draw, rounded down, from the hash of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def _ranked(scored: DataFrame, order: list[Column]) -> DataFrame:
    """Add ``rank``, 1, 2, 3 ... over all rows, without bringing them into one task.

    Rows are dealt by ranges of the order and numbered in each; how many rows
    stand before a range is added to its numbers. There is one such number a
    range.
    """
    ranges = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = scored.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id())
    dealt = dealt.sortWithinPartitions(*order)
    schema = StructType([*dealt.schema.fields, StructField("_place", LongType())])

    def number(batches):
        seen = 0
        for batch in batches:
            place = pa.array(np.arange(seen + 1, seen + batch.num_rows + 1))
            seen += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, place], names=[*batch.schema.names, "_place"])

    numbered = keep(dealt.mapInArrow(number, schema), "ranges")
    sizes = dict(numbered.groupBy("_range").count().collect())
    before, starts = 0, {}
    for part in sorted(sizes):
        starts[part] = before
        before += sizes[part]
    start = F.lit(0).cast("long")
    if starts:
        table = scored.sparkSession.createDataFrame(list(starts.items()), "_range int, _start long")
        numbered = numbered.join(F.broadcast(table), "_range")
        start = F.col("_start")
    return numbered.withColumn("rank", F.col("_place") + start).drop("_range", "_place", "_start")


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    max_n: int = 1,
    buckets: int = BUCKETS,
    least_words: int = 20,
    percent: int = 10,
    seed: int = 2024,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """``docs`` with ``n_features``, ``weight``, ``score`` and ``rank``; undrawn rows have no rank.

    Corpus and target counts are over all rows of ``docs`` and ``target``. Of
    the N rows with ``least_words`` words, ``floor(percent * N / 100)`` of the
    highest score are drawn, ties to the lesser ``doc_id``. A null text has no
    features and weighs 0. A null id is hashed as an empty one and comes after
    all others of its score; rows that repeat an id are rows of their own.
    Columns of these names are replaced, all others (or those named by
    ``carry``) kept.
    """
    prepare(docs.sparkSession)
    gain = gains(bucket_counts(docs, max_n=max_n, buckets=buckets), bucket_counts(target, max_n=max_n, buckets=buckets))
    made = ("n_words", "n_features", "weight", "score", "rank")
    names = [c for c in (docs.columns if carry is None else carry) if c not in made]
    weighed = weigh(docs, gain, max_n=max_n, carry=names)
    # Stored with a number of its own for every row: equal rows are told apart, and ranges sample what is stored.
    scored = keep(
        weighed.withColumn("score", F.col("weight") + gumbel(seed, "doc_id")).withColumn("_row", F.monotonically_increasing_id()),
        "weighed",
    )
    eligible = scored.filter(F.col("n_words") >= least_words)
    drawn = percent * eligible.count() // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_row").asc()]
    ranked = _ranked(eligible.select("score", "doc_id", "_row"), order).filter(F.col("rank") <= drawn)
    return scored.join(ranked.select("_row", "rank"), "_row", "left").drop("_row", "n_words")


def resampling_digest(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row."""
    return resample(docs, target, carry=["doc_id"], **options).select("doc_id", "n_features", "weight", "score", "rank")
