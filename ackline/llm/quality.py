"""Text quality by nearest-neighbour voting in a latent-semantic space.

Every text becomes counts of hashed features: byte trigrams, runs of character
classes, and bands of simple measures (repetition, upper case, symbols, length).
Counts are damped and weighted by inverse document frequency over all documents.
A truncated singular value decomposition of a bounded sample of labelled texts
gives the latent space; the sample's labelled vectors are broadcast (their
number is a parameter), every document is compared with all of them by blocked
matrix products, and its nearest neighbours vote with their similarity.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ackline.llm.common import map_batches, prepare

TRIGRAMS, SHAPES, MEASURES = 2048, 2048, 448
FEATURES = TRIGRAMS + SHAPES + MEASURES
# How much each family counts in the similarity.
FAMILY = np.repeat([0.5, 1.0, 2.0], [TRIGRAMS, SHAPES, MEASURES])
BANDS = 16
# Texts a task works on at a time: what it holds beside its batch follows from this, not from the batch.
BLOCK = 256


def _classes() -> np.ndarray:
    """Class of each byte: lower case, upper case, digit, blank, line end, or itself if a sign."""
    table = np.arange(256, dtype=np.uint8)
    table[128:] = 1
    for low, high, kind in ((b"a", b"z", 1), (b"A", b"Z", 2), (b"0", b"9", 3)):
        table[low[0] : high[0] + 1] = kind
    table[[9, 11, 12, 32]] = 4
    table[[10, 13]] = 5
    return table


_CLASS = _classes()
# Odd multipliers; the top 11 bits of a 32-bit product sum are the bucket.
_A, _B, _C = (np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))
_SHIFT = np.uint32(21)
# Second bytes of upper-case Latin-1 letters in UTF-8, after 0xC3.
_UPPER_TAIL = np.zeros(256, dtype=bool)
_UPPER_TAIL[0x80:0x9F] = True


def _band(value: float) -> int:
    return min(BANDS - 1, int(value * BANDS))


def features(text: str | None) -> np.ndarray:
    """Damped counts of the hashed features of a text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    out = np.zeros(FEATURES, dtype=np.float32)
    data = np.frombuffer(raw, np.uint8)
    kinds = _CLASS[data]
    if len(data) >= 3:
        codes = data.astype(np.uint32)
        tri = codes[:-2] * _A + codes[1:-1] * _B + codes[2:] * _C
        out[:TRIGRAMS] = np.bincount(tri >> _SHIFT, minlength=TRIGRAMS)
        tail = np.flatnonzero((data[:-1] == 0xC3) & _UPPER_TAIL[data[1:]])
        kinds[tail] = kinds[tail + 1] = 2
        first = np.ones(len(kinds), dtype=bool)
        np.not_equal(kinds[1:], kinds[:-1], out=first[1:])
        runs = kinds[first].astype(np.uint32)
        if len(runs) >= 3:
            shape = runs[:-2] * _B + runs[1:-1] * _C + runs[2:] * _A
            out[TRIGRAMS : TRIGRAMS + SHAPES] = np.bincount(shape >> _SHIFT, minlength=SHAPES)
    np.log1p(out, out=out)
    # Each family weighs the same for texts of any length.
    for part in (out[:TRIGRAMS], out[TRIGRAMS : TRIGRAMS + SHAPES]):
        norm = float(np.sqrt((part * part).sum()))
        if norm:
            part /= norm
    words = (text or "").lower().split()
    n, size = len(words), max(1, len(data))
    again = sum(map(operator.eq, words, words[1:])) / max(1, n - 1)
    of_kind = np.bincount(kinds, minlength=256)
    letters = max(1, int(of_kind[1] + of_kind[2]))
    measures = (
        _band(again),
        _band(len(set(words)) / max(1, n)),
        _band(int(of_kind[2]) / letters),
        _band(4 * int(of_kind[6:].sum()) / size),
        _band(int(of_kind[0x7C]) / max(1, n)),
        _band(int(of_kind[3]) / size),
        _band(4 * int(of_kind[5]) / max(1, n)),
        _band(size / max(1, n) / 24),
        _band(np.log2(n + 1) / 16),
    )
    for i, band in enumerate(measures):
        start = TRIGRAMS + SHAPES + i * 3 * BANDS
        # Near bands are near: a band counts half for its neighbours.
        out[start + 3 * band] += 1.0
        for near in (band - 1, band + 1):
            if 0 <= near < BANDS:
                out[start + 3 * near] += 0.5
    return out


def text_blocks(batch: pa.RecordBatch) -> Iterator[list[str | None]]:
    """Texts of a batch, ``BLOCK`` of them at a time."""
    column = batch.column("text")
    for at in range(0, len(column), BLOCK):
        yield column.slice(at, BLOCK).to_pylist()


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Number of documents, and in how many of them each feature is."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        seen = np.zeros(FEATURES, dtype=np.int64)
        for texts in text_blocks(batch):
            for text in texts:
                seen += features(text) > 0
        feature = np.append(np.flatnonzero(seen), -1)
        made = [pa.array(feature, pa.int64()), pa.array(np.append(seen[seen > 0], batch.num_rows), pa.int64())]
        return pa.RecordBatch.from_arrays(made, names=["feature", "seen"])

    parts = map_batches(docs.select("text"), count, "feature long, seen long")
    rows = parts.groupBy("feature").agg(F.sum("seen").alias("seen")).collect()  # FEATURES + 1 rows at most
    frequency = np.zeros(FEATURES, dtype=np.int64)
    total = 0
    for feature, seen in rows:
        if feature < 0:
            total = seen
        else:
            frequency[feature] = seen
    return total, frequency


# Of a feature row only what is not zero is moved.
_CELL = np.dtype([("feature", "<u2"), ("count", "<f4")])


def _packed(row: np.ndarray) -> bytes:
    used = np.flatnonzero(row)
    cells = np.empty(len(used), _CELL)
    cells["feature"], cells["count"] = used, row[used]
    return cells.tobytes()


def bounded_sample(docs: DataFrame, labelled: DataFrame, per_class: int) -> tuple[np.ndarray, list[int], dict[int, float]]:
    """Feature rows and labels of up to ``per_class`` documents of each label, and what a row of a label stands for.

    Ids are chosen first, by their hash, so the choice repeats; the chosen ids
    are few enough to broadcast. What reaches the driver is a packed feature row
    a document, whatever the length of its text. Of several texts under one id
    the one of the least hash is taken.
    """
    totals = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    chosen = [
        tuple(row)
        for label in sorted(totals)
        for row in labelled.filter(F.col("label") == label)
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(per_class)
        .select("doc_id", "label")
        .collect()
    ]
    ids = docs.sparkSession.createDataFrame(chosen, "doc_id long, label int")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        packed = [_packed(features(t)) for texts in text_blocks(batch) for t in texts]
        names = ["doc_id", "label", "mark"]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(packed)], names=[*names, "packed"])

    found = docs.select("doc_id", "text", F.xxhash64("text").alias("mark")).join(F.broadcast(ids), "doc_id")
    rows = map_batches(found, count, "doc_id long, label int, mark long, packed binary")
    one = rows.groupBy("doc_id", "label").agg(F.min(F.struct("mark", "packed")).alias("one"))
    kept = one.orderBy("label", F.xxhash64("doc_id"), "doc_id").select("label", "one.packed").collect()
    matrix = np.zeros((len(kept), FEATURES), np.float32)
    for row, r in zip(matrix, kept):
        cells = np.frombuffer(r["packed"], _CELL)
        row[cells["feature"]] = cells["count"]
    return matrix, [r["label"] for r in kept], {label: n / min(n, per_class) for label, n in totals.items()}


@dataclass
class Neighbours:
    """Labelled vectors in the latent space; small, so every task gets a copy (of the plain values)."""

    weights: np.ndarray  # feature weights
    basis: np.ndarray  # features x dimensions
    vectors: np.ndarray  # dimensions x labelled texts, unit length
    labels: np.ndarray
    stands_for: np.ndarray
    nearest: int
    sharpness: float
    prior: float

    def latent(self, texts: list[str | None]) -> np.ndarray:
        counts = np.empty((len(texts), FEATURES), dtype=np.float32)
        for row, text in zip(counts, texts):
            np.multiply(features(text), self.weights, out=row)
        points = counts @ self.basis
        return points / np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-9)

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(texts), self.prior)
        out = []
        for at in range(0, len(texts), BLOCK):
            likeness = self.latent(texts[at : at + BLOCK]) @ self.vectors
            k = min(self.nearest, likeness.shape[1])
            best = np.argpartition(-likeness, k - 1, axis=1)[:, :k]
            near = np.maximum(np.take_along_axis(likeness, best, axis=1), 0) ** self.sharpness
            vote = near * self.stands_for[best]
            # One vote of the prior keeps far texts away from 0 and 1.
            out.append(((vote * self.labels[best]).sum(axis=1) + self.prior) / (vote.sum(axis=1) + 1))
        return np.clip(np.concatenate(out).astype(np.float64), 0.0, 1.0)


def leading_directions(matrix: np.ndarray, count: int, rounds: int = 6) -> np.ndarray:
    """The ``count`` leading right singular vectors, by subspace iteration from a fixed start."""
    start = np.random.default_rng(7).standard_normal((matrix.shape[0], min(matrix.shape[0], count + 16)))
    space = np.linalg.qr(matrix.T @ start.astype(np.float32))[0]
    for _ in range(rounds):
        space = np.linalg.qr(matrix.T @ (matrix @ space))[0]
    _, _, turned = np.linalg.svd(matrix @ space, full_matrices=False)
    return (space @ turned.T)[:, :count].astype(np.float32)


def fit(
    docs: DataFrame,
    labelled: DataFrame,
    *,
    per_class: int = 2000,
    dimensions: int = 64,
    nearest: int = 25,
    sharpness: float = 8.0,
) -> Neighbours:
    """Feature weights from all ``docs``; space and voters from at most ``per_class``
    rows of each label of ``labelled`` (``doc_id, label``)."""
    total, frequency = document_frequencies(docs)
    counts, given, stands_for = bounded_sample(docs, labelled, per_class)
    inverse = np.log((total + 1) / (frequency + 1)) + 0.5
    weights = (inverse * FAMILY).astype(np.float32)
    labels = np.array(given, dtype=np.float32)
    weight = np.array([stands_for[label] for label in given], dtype=np.float32)
    prior = float((labels * weight).sum() / weight.sum()) if given else 0.5
    if not given:
        empty = np.zeros((0, 0), dtype=np.float32)
        return Neighbours(weights, empty, empty, labels, weight, nearest, sharpness, prior)
    matrix = counts * weights
    basis = leading_directions(matrix, min(dimensions, len(given)))
    model = Neighbours(weights, basis, np.empty(0), labels, weight, nearest, sharpness, prior)
    points = matrix @ basis
    model.vectors = (points / np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-9)).T.astype(np.float32)
    return model


def learnable(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """``(doc_id, label)`` of labelled documents that are not held out: ``crc32(doc_id) mod 5 <> 0``."""
    known = labels.filter(F.col(label).isNotNull()).select("doc_id", F.col(label).cast("int").alias("label"))
    known = known.filter(~held_out("doc_id")).filter(F.col("label").isin(0, 1))
    return docs.select("doc_id").join(known, "doc_id").distinct()


def held_out(doc_id: str) -> Column:
    """Whether an id is held out of learning; a null id is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score_quality(docs: DataFrame, model: Neighbours, *, threshold: float = 0.3) -> DataFrame:
    """Add ``score`` (0 to 1, higher is better) and ``predicted`` to every row.

    A null text is scored as an empty one. Columns of these names are replaced;
    others and repeated rows stay.
    """
    prepare(docs.sparkSession)
    others = docs.drop("score", "predicted")
    # Plain values: a broadcast object would need this package on every executor.
    shared = docs.sparkSession.sparkContext.broadcast(dict(vars(model)))

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = np.concatenate(list(map(Neighbours(**shared.value).score, text_blocks(batch))))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, "score"])

    scored = map_batches(others, score, StructType([*others.schema.fields, StructField("score", DoubleType())]))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def rate_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    prepare(docs.sparkSession)
    model = fit(docs, learnable(docs, labels), **options)
    scored = score_quality(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
