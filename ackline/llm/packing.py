"""Packing of token pieces into sequences by vector best-fit.

Every sequence has three capacities: tokens, documents, and attention cost (the
sum of squared piece lengths). Pieces are dealt over shards by a hash, sorted by
falling length, and each goes to the open sequence of its shard that fits all
three and scores best: least norm of what is left over, or largest weighted dot
product of need and room.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ackline.llm.common import keep, map_batches, prepare, shards
from ackline.llm.tokens import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"
END_OF_DOCUMENT = (1).to_bytes(4, "little")


@dataclass(frozen=True)
class Capacities:
    """What one sequence may hold, and how each part weighs in the score."""

    tokens: int = 4096
    documents: int = 4096
    attention: int = 4096 * 4096
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    # "norm" takes the least leftover, "dot" the largest weighted dot product.
    rule: str = "norm"


def token_pieces(docs: DataFrame, vocabulary: str, *, size: int = 4096) -> DataFrame:
    """One row per piece of each document's tokens and its end token.

    Only documents longer than ``size`` tokens are cut, into pieces of ``size``;
    the last may be shorter. A null or empty text is the end token alone.
    """
    prepare(docs.sparkSession)
    step = 4 * size

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode = encoder(vocabulary).ids
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            ids = encode(text or "") + END_OF_DOCUMENT
            for k, at in enumerate(range(0, len(ids), step)):
                part = ids[at : at + step]
                rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), cut, PIECES)


def best_fit(lengths: np.ndarray, caps: Capacities) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece; ``lengths`` fall."""
    full = np.array([caps.tokens, caps.documents, caps.attention], dtype=np.float64)
    weights = np.asarray(caps.weights) / full**2
    need = np.stack([lengths, np.ones_like(lengths), lengths * lengths], axis=1).astype(np.float64)
    if len(lengths) and (need > full).any():
        raise ValueError("a piece alone is over the capacities of a sequence")
    smallest = lengths[-1] if len(lengths) else 0
    room = np.empty((1024, 3))
    number = np.empty(1024, dtype=np.int64)
    n_open = n_all = 0
    sequence = np.empty(len(lengths), dtype=np.int64)
    offset = np.empty(len(lengths), dtype=np.int64)
    for i, item in enumerate(need):
        left = room[:n_open] - item
        fits = (left >= 0).all(axis=1)
        if fits.any():
            if caps.rule == "dot":
                score = np.where(fits, (room[:n_open] * item) @ weights, -np.inf)
                at = int(score.argmax())
            else:
                score = np.where(fits, (left * left) @ weights, np.inf)
                at = int(score.argmin())
        else:
            if n_open == len(room):
                room = np.concatenate([room, np.empty_like(room)])
                number = np.concatenate([number, np.empty_like(number)])
            at, n_open = n_open, n_open + 1
            room[at], number[at] = full, n_all
            n_all += 1
        sequence[i] = number[at]
        offset[i] = caps.tokens - room[at, 0]
        room[at] -= item
        if room[at, 0] < smallest or room[at, 1] < 1:
            # Closed: the last open sequence takes its place.
            n_open -= 1
            room[at], number[at] = room[n_open], number[n_open]
    return sequence, offset


def pack(pieces: DataFrame, caps: Capacities = Capacities(), *, per_shard: int = 40_000) -> DataFrame:
    """Add ``sequence_id`` and ``offset``: the place of every piece.

    ``pieces`` is read twice (counted, then packed): store it first. A shard has
    about ``per_shard`` pieces whatever the size of the table, so what sharding
    wastes is one sequence in some thousands. Repeated rows are packed each. An
    empty table gives no rows. Sequence numbers are unique, not dense.
    """
    prepare(pieces.sparkSession)
    n = shards(pieces.count(), per_shard)
    order = ["length", "doc_id", "piece", "start", "ids_crc32"]
    shard = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n))

    def place(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Partitions may hold several shards; they are few and small.
        held = pd.concat(list(parts) or [pd.DataFrame()], ignore_index=True)
        if held.empty:
            return
        held = held.sort_values(order, ascending=[False, True, True, True, True], ignore_index=True)
        for number, rows in held.groupby("shard", sort=True):
            sequence, offset = best_fit(rows["length"].to_numpy(), caps)
            yield rows.drop(columns="shard").assign(sequence_id=(int(number) << 32) + sequence, offset=offset)

    dealt = pieces.select("doc_id", "piece", "start", "length", "ids_crc32", shard.alias("shard"))
    return dealt.repartition(n, "shard").mapInPandas(place, PLACED)


def pack_documents(docs: DataFrame, vocabulary: str, caps: Capacities = Capacities()) -> DataFrame:
    """Cut ``docs`` into pieces and pack them."""
    return pack(keep(token_pieces(docs, vocabulary, size=caps.tokens), "pieces"), caps)
