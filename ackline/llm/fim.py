"""Fill-in-the-middle documents by rotating blocks in place.

A text is cut at two line ends into prefix, middle and suffix. Its bytes stand in
one bytearray with a sentinel before each part; the order a form asks for is
reached by exchanging neighbouring blocks, and a block exchange is three
reversals: of either block, then of both together. The inverse rotations put the
parts back, and taking the sentinels out restores the text byte for byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ackline.llm.common import map_batches, prepare

PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class Sentinels:
    """Marks before prefix, suffix and middle; none may begin inside another."""

    prefix: bytes = b"<P>"
    suffix: bytes = b"<S>"
    middle: bytes = b"<M>"

    def __post_init__(self) -> None:
        marks = self.all
        if not all(marks) or len(set(marks)) < 3:
            raise ValueError("three different sentinels are needed")
        for a in marks:
            for b in marks:
                # Else a part that ends like a sentinel could make a second one at a border.
                if any(a.endswith(b[:k]) for k in range(1, len(b))) or (a != b and a in b):
                    raise ValueError("sentinels must not overlap each other")

    @property
    def all(self) -> tuple[bytes, bytes, bytes]:
        return self.prefix, self.suffix, self.middle


def _reverse(buffer: np.ndarray, start: int, stop: int) -> None:
    """Reverse a stretch of ``buffer`` in place, a bounded piece of either end at a time."""
    step = 1 << 16
    while stop - start > 1:
        n = min(step, (stop - start) // 2)
        left = buffer[start : start + n].copy()
        buffer[start : start + n] = buffer[stop - n : stop][::-1]
        buffer[stop - n : stop] = left[::-1]
        start, stop = start + n, stop - n


def rotate(buffer: np.ndarray, start: int, border: int, stop: int) -> None:
    """Exchange the blocks ``start:border`` and ``border:stop`` by three reversals."""
    if start < border < stop:
        _reverse(buffer, start, border)
        _reverse(buffer, border, stop)
        _reverse(buffer, start, stop)


def line_cuts(raw: bytes, first: int, second: int) -> tuple[int, int, int]:
    """Lines of a text, and the byte places after two numbers modulo lines + 1 of them."""
    ends = np.flatnonzero(np.frombuffer(raw, np.uint8) == 0x0A) + 1
    n = len(ends) + (len(raw) > 0 and not raw.endswith(b"\n"))
    low, high = sorted((first % (n + 1), second % (n + 1)))
    place = lambda k: 0 if k == 0 else int(ends[k - 1]) if k <= len(ends) else len(raw)
    return n, place(low), place(high)


def arrange(raw: bytes, low: int, high: int, form: str, marks: Sentinels) -> bytearray:
    """The text with sentinels, its parts in the order of ``form``."""
    p, s, m = (len(x) for x in marks.all)
    buffer = bytearray(marks.prefix)
    buffer += raw[:low]
    buffer += marks.middle
    buffer += raw[low:high]
    buffer += marks.suffix
    buffer += raw[high:]
    at_middle, at_suffix = p + low, p + high + m
    # Numpy sees the bytes of the array itself.
    view = np.frombuffer(buffer, np.uint8)
    if form == PSM:
        rotate(view, at_middle, at_suffix, len(buffer))
    elif form == SPM:
        rotate(view, 0, at_suffix, len(buffer))
    else:
        raise ValueError(f"unknown form {form}")
    return buffer


def restore(output: bytes, form: str, marks: Sentinels = Sentinels()) -> bytes:
    """The text that ``output`` was made of."""
    if form == PLAIN:
        return output
    buffer = bytearray(output)
    at_suffix, at_middle = buffer.find(marks.suffix), buffer.find(marks.middle)
    view = np.frombuffer(buffer, np.uint8)
    if form == PSM:
        rotate(view, at_suffix, at_middle, len(buffer))
        middle = at_suffix
        suffix = middle + len(buffer) - at_middle
    else:
        at_prefix = buffer.find(marks.prefix)
        rotate(view, 0, at_prefix, len(buffer))
        middle = at_middle - at_prefix
        suffix = len(buffer) - at_prefix
    del view
    del buffer[suffix : suffix + len(marks.suffix)]
    del buffer[middle : middle + len(marks.middle)]
    del buffer[: len(marks.prefix)]
    return bytes(buffer)


def _characters(raw: bytes) -> int:
    """Code points of UTF-8 bytes."""
    return int(np.count_nonzero(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80))


def _draws(seed: int, doc_id: int | None) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")


def fill_in_middle(
    docs: DataFrame,
    *,
    seed: int = 7,
    rate_percent: int = 100,
    spm_percent: int = 50,
    sentinels: Sequence[str] = ("<P>", "<S>", "<M>"),
) -> DataFrame:
    """Add ``n`` (lines), ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` to every row.

    Cuts, form and order are drawn from the hash of ``seed`` and ``doc_id``, so
    repeated rows are treated alike; a null id is hashed as an empty one. A null
    text counts as empty, and an empty text, one that holds a sentinel or one
    that is not drawn stays ``plain`` (its counts are null). Texts are worked
    on one at a time whatever their length. Columns of these names are
    replaced, all others kept.
    """
    for name, value in (("rate_percent", rate_percent), ("spm_percent", spm_percent)):
        if not 0 <= value <= 100:
            raise ValueError(f"{name} must be from 0 to 100")
    prepare(docs.sparkSession)
    marks = Sentinels(*[s.encode() for s in sentinels])
    names = marks.all
    others = docs.drop(*ADDED)
    kinds = (LongType(), StringType(), LongType(), LongType(), StringType())
    schema = StructType([*others.schema.fields, *[StructField(c, k) for c, k in zip(ADDED, kinds)]])

    def transform(batch: pa.RecordBatch) -> pa.RecordBatch:
        made: list[list] = [[], [], [], [], []]
        # Ids and texts stand first.
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            raw = (text or "").encode()
            h1, h2, h3, h4 = _draws(seed, doc_id)
            n, low, high = line_cuts(raw, h1, h2)
            if not raw or h3 % 100 >= rate_percent or any(x in raw for x in names):
                row = (n, PLAIN, None, None, text or "")
            else:
                form = SPM if h4 % 100 < spm_percent else PSM
                output = arrange(raw, low, high, form, marks).decode()
                row = (n, form, _characters(raw[:low]), _characters(raw[low:high]), output)
            for column, value in zip(made, row):
                column.append(value)
        arrow = [pa.array(v, k) for v, k in zip(made, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()))]
        return pa.RecordBatch.from_arrays([*batch.columns[2:], *arrow], names=[*batch.schema.names[2:], *ADDED])

    with_inputs = others.select(F.col("doc_id").alias("_fim_id"), F.col("text").alias("_fim_text"), *others.columns)
    return map_batches(with_inputs, transform, schema)


def restore_text(
    made: DataFrame, *, sentinels: Sequence[str] = ("<P>", "<S>", "<M>"), name: str = "restored"
) -> DataFrame:
    """Add the text rebuilt from ``output`` and ``form`` alone."""
    prepare(made.sparkSession)
    marks = Sentinels(*[s.encode() for s in sentinels])
    others = made.drop(name)

    def rebuild(batch: pa.RecordBatch) -> pa.RecordBatch:
        pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        texts = [restore(output.encode(), form, marks).decode() for output, form in pairs]
        return pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(texts, pa.string())], names=[*batch.schema.names[2:], name])

    with_inputs = others.select(F.col("output").alias("_fim_output"), F.col("form").alias("_fim_form"), *others.columns)
    return map_batches(with_inputs, rebuild, StructType([*others.schema.fields, StructField(name, StringType())]))


def fill_in_middle_digest(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars`` and the SHA-256 of output and restored text."""
    made = restore_text(fill_in_middle(docs.select("doc_id", "text"), **options).drop("text"))
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        digest("output").alias("output_sha256"), digest("restored").alias("restored_sha256"),
    )
