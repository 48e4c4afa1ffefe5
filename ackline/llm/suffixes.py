"""Byte strings that occur more than once, by suffix sorting in buckets.

A string of ``length`` bytes that occurs twice brings the same grams with it
both times. Of the grams inside such a window the one with the least hash is its
anchor, at the same place in both, so

1. anchors are counted over all documents, and only windows whose anchor recurs
   remain;
2. runs of such windows with the same anchor form a piece, and pieces meet in the bucket of that anchor. Equal windows have equal anchors, so they
   are in one bucket. Pieces equal as a whole are counted once, with their number;
3. the suffixes of a bucket's different pieces are sorted in two stages: those
   smaller than their successor directly, the others induced from them by a scan
   over the first-byte buckets. Windows whose common prefix with a neighbour in
   that order is ``length`` or more occur elsewhere.

Buckets are independent and small; one with very many different pieces is split
by the window hash, a window at a time, so no bucket outgrows a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ackline.llm.common import KEY, keep, map_batches, prepare, row_key

LENGTH = 400
GRAM = 256
# A bucket with more different pieces (about 2.5 MB) is split by window.
SPLIT = 5000

_BASE = 0x9E3779B97F4A7C15 | 1
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LOW = np.uint64(0xFFFFFFFF)


def _powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64, by doubling."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        step = np.uint64(pow(base, len(out), 1 << 64))
        out = np.concatenate([out, out * step])
    return out[:n]


class Powers:
    """Powers of the base and of its inverse, grown as texts need them."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << n.bit_length()
            self.up = _powers(_BASE, size)
            self.down = _powers(pow(_BASE, -1, 1 << 64), size)
        return self.up[:n], self.down[:n]


def gram_hashes(data: np.ndarray, gram: int, powers: Powers) -> np.ndarray:
    """A 64-bit hash of every run of ``gram`` bytes."""
    up, down = powers.get(len(data) + 1)
    # Sum of byte * base**-i, then shifted to the start of each gram.
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * down[: len(data)], out=total[1:])
    n = len(data) - gram + 1
    h = (total[gram:] - total[:n]) * up[:n]
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours, in linear time."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def owners(data: np.ndarray, length: int, gram: int, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Gram hashes, and for every window the place of its anchor (ties: the first)."""
    hashes = gram_hashes(data, gram, powers)
    ranked = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
    return hashes, (sliding_minimum(ranked, length - gram + 1) & _LOW).astype(np.int64)


_KEY = "doc long, print long"


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def anchors(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    """``(doc, print, anchor, place)`` of every row."""

    def find(batch: pa.RecordBatch) -> pa.RecordBatch:
        powers = Powers()
        row, found, places = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for number, text in enumerate(batch.column("text").to_pylist()):
            data = np.frombuffer(_bytes(text), np.uint8)
            if len(data) < length:
                continue
            hashes, owner = owners(data, length, gram, powers)
            place = owner[np.flatnonzero(np.diff(owner, prepend=-1))]
            row.append(np.full(len(place), number))
            found.append(hashes[place].view(np.int64))
            places.append(place)
        at = pa.array(np.concatenate(row))
        columns = [*(batch.column(c).take(at) for c in KEY), pa.array(np.concatenate(found)), pa.array(np.concatenate(places))]
        return pa.RecordBatch.from_arrays(columns, names=[*KEY, "anchor", "place"])

    return map_batches(keyed.select(*KEY, "text"), find, f"{_KEY}, anchor long, place long")


PIECES = f"anchor long, key binary, {_KEY}, first long, n int, lead int, piece binary"


def pieces(keyed: DataFrame, recurring: DataFrame, length: int, gram: int) -> DataFrame:
    """Runs of windows with the same recurring anchor.

    ``first`` is the first window's start, ``n`` their number, ``lead`` the bytes
    before the anchor, ``piece`` the bytes all windows cover, ``key`` their digest.
    """
    marked = keyed.select(*KEY, "text").join(recurring, KEY)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        powers = Powers()
        rows = []
        columns = [batch.column(c).to_pylist() for c in (*KEY, "text", "places")]
        for doc, mark, text, places in zip(*columns):
            raw = _bytes(text)
            if len(raw) < length:
                continue
            hashes, owner = owners(np.frombuffer(raw, np.uint8), length, gram, powers)
            recurs = np.zeros(len(hashes), dtype=bool)
            good = np.asarray(places, dtype=np.int64)
            recurs[good[good < len(hashes)]] = True
            candidate = recurs[owner]
            if not candidate.any():
                continue
            # A new piece where the anchor or the candidate state changes.
            state = np.where(candidate, owner, -1)
            starts = np.flatnonzero(np.diff(state, prepend=-2))
            stops = np.append(starts[1:], len(state))
            for a, b in zip(starts.tolist(), stops.tolist()):
                if state[a] < 0:
                    continue
                piece = raw[a : b - 1 + length]
                at = int(state[a])
                key = hashlib.blake2b(piece, digest_size=16).digest()
                rows.append((int(hashes[at].view(np.int64)), key, doc, mark, a, b - a, at - a, piece))
        kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        made = [pa.array(v, k) for v, k in zip(zip(*rows) if rows else [[]] * 8, kinds)]
        return pa.RecordBatch.from_arrays(made, names=["anchor", "key", *KEY, "first", "n", "lead", "piece"])

    return map_batches(marked, cut, PIECES)


def _reach(contexts: list[bytes]) -> np.ndarray:
    """Longest common prefix of each string with any other of the list."""
    order = sorted(range(len(contexts)), key=contexts.__getitem__)
    longest = np.zeros(len(contexts), dtype=np.int64)
    for i, j in zip(order, order[1:]):
        a, b = contexts[i], contexts[j]
        size = min(len(a), len(b))
        x = np.frombuffer(a, np.uint8, size) != np.frombuffer(b, np.uint8, size)
        common = int(x.argmax()) if x.any() else size
        longest[i] = max(longest[i], common)
        longest[j] = max(longest[j], common)
    return longest


def two_stage_order(text: bytes, depth: int) -> list[int]:
    """All suffixes of ``text`` in the order of their first ``depth`` bytes at least.

    Suffixes smaller than their successor are sorted directly; a scan over the
    growing order puts each other suffix at the front of its first byte's bucket
    as soon as its successor is met.
    """
    data = np.frombuffer(text, np.uint8)
    n = len(data)
    step = np.diff(data.astype(np.int16), append=-1)
    # Where the next byte is equal, the next unequal pair decides.
    decisive = np.where(step != 0, np.arange(n), n - 1)
    decisive = np.minimum.accumulate(decisive[::-1])[::-1]
    smaller = step[decisive] > 0
    direct = sorted(np.flatnonzero(smaller).tolist(), key=lambda i: text[i : i + depth])

    counts = np.bincount(data, minlength=256)
    ends = np.cumsum(counts)
    order = np.full(n, -1, dtype=np.int64)
    per_byte = np.bincount(data[direct], minlength=256) if direct else np.zeros(256, np.int64)
    at = 0
    for byte in np.flatnonzero(per_byte).tolist():
        size = int(per_byte[byte])
        order[ends[byte] - size : ends[byte]] = direct[at : at + size]
        at += size
    sa = order.tolist()
    head = (ends - counts).tolist()
    induced = (~smaller).tolist()
    sa[head[text[n - 1]]] = n - 1
    head[text[n - 1]] += 1
    for k in range(n):
        j = sa[k] - 1
        if j >= 0 and induced[j]:
            byte = text[j]
            sa[head[byte]] = j
            head[byte] += 1
    return sa


def recurring_windows(held: list[tuple[int, int, bytes]], length: int, gram: int) -> list[np.ndarray]:
    """For different pieces ``(n, lead, bytes)`` of one anchor: which windows recur."""
    marks = [np.zeros(n, dtype=bool) for n, _, _ in held]
    left = _reach([piece[:lead][::-1] for _, lead, piece in held])
    right = _reach([piece[lead + gram :] for _, lead, piece in held])
    parts, at, where = [], 0, []
    for i, (n, lead, piece) in enumerate(held):
        # A window reaches left of the anchor and right of it; neither may go
        # beyond what some other piece has in common.
        first = max(0, lead - int(left[i]))
        last = min(n - 1, lead + gram + int(right[i]) - length)
        if first > last:
            continue
        part = piece[first : last + length]
        parts.append(part)
        where.append((i, first, at, last - first + 1))
        at += len(part) + 1
    if len(parts) < 2:
        return marks
    text = b"\xff".join(parts) + b"\xff"  # no byte of UTF-8
    window = np.full(len(text), -1, dtype=np.int64)
    for number, (_, _, offset, n) in enumerate(where):
        window[offset : offset + n] = number
    valid = window >= 0
    order = [i for i in two_stage_order(text, length) if valid[i]]
    for a, b in zip(order, order[1:]):
        if text[a : a + length] == text[b : b + length]:
            for start in (a, b):
                i, first, offset, _ = where[window[start]]
                marks[i][first + start - offset] = True
    return marks


def _runs(mark: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(mark.astype(np.int8), prepend=0, append=0))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist()))


RUNS = "anchor long, key binary, runs array<struct<lo: int, hi: int>>"


def sorted_buckets(different: DataFrame, length: int, gram: int) -> DataFrame:
    """``(anchor, key, runs)``: runs of windows that recur in other pieces, of pieces used once.

    A piece used more often recurs as a whole; it takes part in the sort only.
    """

    def sort(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def done(rows: list) -> pd.DataFrame:
            runs = []
            if len(rows) > 1:
                marks = recurring_windows([(r[2], r[3], r[4]) for r in rows], length, gram)
                found = [(r, _runs(mark)) for r, mark in zip(rows, marks) if r[5] == 1]
                runs = [(r[0], r[1], [{"lo": lo, "hi": hi} for lo, hi in held]) for r, held in found if held]
            return pd.DataFrame(runs, columns=["anchor", "key", "runs"])

        rows: list = []
        out: list[pd.DataFrame] = []
        for frame in frames:
            for row in frame[["anchor", "key", "n", "lead", "piece", "uses"]].itertuples(index=False, name=None):
                if rows and rows[0][0] != row[0]:
                    out.append(done(rows))
                    rows = []
                rows.append(row)
            yield from (f for f in out if len(f))
            out = []
        if rows:
            yield done(rows)

    dealt = different.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInPandas(sort, RUNS)


def windows_one_by_one(different: DataFrame, length: int) -> DataFrame:
    """The same for buckets with very many pieces: equal windows meet by their digest."""

    def spread(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        names = ("anchor", "key", "n", "piece", "uses")
        for anchor, key, n, piece, uses in zip(*[batch.column(c).to_pylist() for c in names]):
            for k in range(n):
                digest = hashlib.blake2b(piece[k : k + length], digest_size=16).digest()
                rows.append((anchor, key, k, digest, uses))
        kinds = (pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.int64())
        made = [pa.array(v, k) for v, k in zip(zip(*rows) if rows else [[]] * 5, kinds)]
        return pa.RecordBatch.from_arrays(made, names=["anchor", "key", "lo", "window", "uses"])

    schema = "anchor long, key binary, lo int, window binary, uses long"
    each = map_batches(different.select("anchor", "key", "n", "piece", "uses"), spread, schema)
    again = each.groupBy("anchor", "window").agg(F.count("*").alias("n")).filter("n > 1").select("anchor", "window")
    found = each.filter("uses = 1").join(again, ["anchor", "window"]).groupBy("anchor", "key")
    # Neighbouring windows of a piece, of which there are few, become one run.
    los = found.agg(F.sort_array(F.collect_set("lo")).alias("los"))
    opens = F.filter("los", lambda x, i: (i == 0) | (F.get(F.col("los"), i - 1) != x - 1))
    closes = F.filter("los", lambda x, i: (i == F.size("los") - 1) | (F.get(F.col("los"), i + 1) != x + 1))
    return los.select("anchor", "key", F.arrays_zip(opens.alias("lo"), closes.alias("hi")).alias("runs"))


def recurring_spans(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, split: int = SPLIT) -> DataFrame:
    """``(doc, print, spans)`` of every row that has some: runs of starts of windows that occur elsewhere too."""
    if not 0 < gram <= length:
        raise ValueError("a gram must fit into a window")
    keyed = docs.select(*row_key(docs), "text")
    found = keep(anchors(keyed, length, gram), "anchors")
    twice = found.groupBy("anchor").agg(F.count("*").alias("uses")).filter("uses > 1").select("anchor")
    # Stored, so that the join has exchanges of its own and a hot anchor is split.
    twice = keep(twice, "recurring-anchors")
    places = found.join(twice, "anchor").groupBy(*KEY).agg(F.collect_set("place").alias("places"))
    made = keep(pieces(keyed, places, length, gram), "pieces")

    kinds = made.groupBy("anchor", "key").agg(F.count("*").alias("uses"), F.min(F.struct(*KEY, "first")).alias("one"))
    kinds = keep(kinds, "piece-kinds")
    wide = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    chosen = kinds.join(wide, "anchor").select("anchor", "key", *[f"one.{c}" for c in KEY], "one.first", "uses", "kinds")
    different = made.join(chosen, ["anchor", "key", *KEY, "first"]).dropDuplicates(["anchor", "key"])
    different = keep(different.select("anchor", "key", "n", "lead", "piece", "uses", "kinds"), "different-pieces")
    partly = sorted_buckets(different.filter(F.col("kinds") <= split).drop("kinds"), length, gram)
    split_up = windows_one_by_one(different.filter(F.col("kinds") > split), length)

    # One row a kind: a piece used more than once recurs as a whole, another by its runs.
    whole = kinds.filter("uses > 1").select("anchor", "key", F.lit(None).cast("array<struct<lo: int, hi: int>>").alias("runs"))
    marks = keep(partly.unionByName(split_up).unionByName(whole), "window-runs")
    each = made.select("anchor", "key", *KEY, "first", "n").join(marks, ["anchor", "key"])
    all_of_it = F.array(F.struct(F.lit(0).alias("lo"), (F.col("n") - 1).alias("hi")))
    placed = F.transform(
        F.coalesce("runs", all_of_it),
        lambda r: F.struct((F.col("first") + r["lo"]).alias("first"), (F.col("first") + r["hi"]).alias("last")),
    )
    # Rows with the same key have the same spans: one of them is enough.
    spans = each.select(*KEY, "first", placed.alias("spans")).groupBy(*KEY, "first").agg(F.first("spans").alias("spans"))
    return spans.groupBy(*KEY).agg(F.flatten(F.collect_list("spans")).alias("spans"))


DIGEST = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _covered(n_bytes: int, spans: list | None, length: int) -> np.ndarray:
    """Which bytes some recurring window covers."""
    depth = np.zeros(n_bytes + 1, dtype=np.int64)
    for span in spans or ():
        depth[span["first"]] += 1
        depth[span["last"] + length] -= 1
    return np.cumsum(depth[:-1]) > 0


def _with_spans(docs: DataFrame, spans: DataFrame, *columns: str) -> DataFrame:
    """Text and spans of every row as ``_text`` and ``_spans``, before ``columns``."""
    names = [F.col(c).alias(f"_own_{i}") for i, c in enumerate(columns)]
    keyed = docs.select(*row_key(docs), F.col("text").alias("_text"), *names)
    joined = keyed.join(spans.withColumnRenamed("spans", "_spans"), KEY, "left")
    return joined.select("_text", "_spans", *[f"_own_{i}" for i in range(len(columns))])


def repeated_bytes(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per row: bytes, bytes removed, maximal removed runs, and SHA-256 of the rest.

    A byte is removed if a string of ``length`` bytes that also starts anywhere
    else covers it. A null text is empty; texts shorter than ``length`` lose
    nothing. Rows with a null id or under a repeated one are rows of their own;
    rows that repeat id and text are copies of each other.
    """
    prepare(docs.sparkSession)
    spans = recurring_spans(docs, length=length, gram=gram)

    def digest(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text, found, doc_id in zip(*[c.to_pylist() for c in batch.columns]):
            raw = _bytes(text)
            gone = _covered(len(raw), found, length)
            rest = np.frombuffer(raw, np.uint8)[~gone].tobytes()
            runs = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
            rows.append((doc_id, len(raw), len(raw) - len(rest), runs, hashlib.sha256(rest).hexdigest()))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        made = [pa.array(v, k) for v, k in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(made, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    joined = _with_spans(docs.withColumn("doc_id", F.col("doc_id").cast("long")), spans, "doc_id")
    return map_batches(joined, digest, DIGEST)


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text``, and ``n_chars`` to match if present.

    What is left of a character cut in two is dropped. All other columns stay,
    whatever their names; null and repeated ids are as in :func:`repeated_bytes`.
    """
    prepare(docs.sparkSession)
    spans = recurring_spans(docs, length=length, gram=gram)
    names = docs.columns
    joined = _with_spans(docs, spans, *names)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for text, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if found:
                raw = _bytes(text)
                gone = _covered(len(raw), found, length)
                text = np.frombuffer(raw, np.uint8)[~gone].tobytes().decode("utf-8", "ignore")
            texts.append(text)
        columns = [pa.array(texts, pa.string()) if n == "text" else c for n, c in zip(names, batch.columns[2:])]
        return pa.RecordBatch.from_arrays(columns, names=names)

    kept = map_batches(joined, cut, docs.schema)
    return kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in names else kept
