"""Running values over an integer key, without one task per group.

A plain window over ``(group, order by seq)`` puts a whole group into one task.
Here the key space is cut into blocks of ``2**bits`` keys; each block is scanned
on its own, the per-block totals are scanned the same way one level up, and the
value carried into a block is joined back. With keys that are unique in their
group no task ever sorts more than ``2**bits`` rows of a group, however the
rows are spread over groups.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Blocks of 2**20 keys, of 2**20 blocks, and of 2**20 of those: what is scanned in
# one task at the top is 16 rows of a group for any 64-bit key.
BLOCK_BITS = (20, 20, 20)


@dataclass(frozen=True)
class Running:
    """One running value: ``kind`` is ``sum``, ``max`` or ``last`` (non-null).

    ``exclusive`` leaves the current row out.
    """

    kind: str
    value: Column
    name: str
    exclusive: bool = False

    def local(self, window) -> Column:
        end = -1 if self.exclusive else Window.currentRow
        frame = window.rowsBetween(Window.unboundedPreceding, end)
        if self.kind == "sum":
            return F.sum(self.value).over(frame)
        if self.kind == "max":
            return F.max(self.value).over(frame)
        return F.last(self.value, ignorenulls=True).over(frame)

    def total(self, order: Column, reverse: bool) -> Column:
        if self.kind == "sum":
            return F.sum(self.value)
        if self.kind == "max":
            return F.max(self.value)
        pick = F.min_by if reverse else F.max_by
        return pick(self.value, F.when(self.value.isNotNull(), order))

    def combined(self, local: Column, carry: Column | None) -> Column:
        if self.kind == "sum":
            zero = F.lit(0).cast("long")
            value = F.coalesce(local, zero)
            return value if carry is None else F.coalesce(carry, zero) + value
        if carry is None:
            return local
        if self.kind == "max":
            return F.greatest(carry, local)
        return F.coalesce(local, carry)


def prefix_scan(
    df: DataFrame,
    key: str,
    runs: Sequence[Running],
    *,
    group: Sequence[str] = (),
    ties: Sequence[str] = (),
    reverse: bool = False,
    block_bits: Sequence[int] = BLOCK_BITS,
    keep_block: str | None = None,
    tied_values: bool = True,
) -> DataFrame:
    """Add one column per entry of ``runs``, scanned by ``key`` within ``group``.

    ``ties`` orders rows that share a key; ``tied_values=False`` promises that no
    two of them have a ``last`` value, which keeps the totals a hash aggregate.
    ``reverse`` scans from the highest
    key down, so an exclusive ``last`` is the value of the following row.
    ``group`` columns must not be null. ``keep_block`` keeps the block number
    under that name; the result is partitioned by group and block, so a join on
    both needs no further shuffle.
    """
    direction = F.desc if reverse else F.asc
    ordering = [direction(c) for c in (key, *ties)]
    if not block_bits:
        window = Window.partitionBy(*group).orderBy(*ordering)
        return df.withColumns({r.name: r.combined(r.local(window), None) for r in runs})

    block = keep_block or f"_{key.strip('_')}_block"
    cut = [block, *group]
    based = df.withColumn(block, F.shiftright(F.col(key).cast("long"), int(block_bits[0])))
    window = Window.partitionBy(*cut).orderBy(*ordering)
    local = based.withColumns({r.name: r.local(window) for r in runs})

    position = F.struct(key, *ties) if ties and tied_values else F.col(key)
    totals = based.groupBy(*cut).agg(
        *[r.total(position, reverse).alias(f"_total{len(block_bits)}_{i}") for i, r in enumerate(runs)]
    )
    carried = prefix_scan(
        totals,
        block,
        [Running(r.kind, F.col(f"_total{len(block_bits)}_{i}"), f"_carry{len(block_bits)}_{i}", True) for i, r in enumerate(runs)],
        group=group,
        reverse=reverse,
        block_bits=block_bits[1:],
    )
    # First blocks carry nothing in: dropping them keeps the join small when
    # most groups fit into one block.
    carries = [F.col(f"_carry{len(block_bits)}_{i}") for i in range(len(runs))]
    useful = reduce(
        lambda a, b: a | b,
        [c.isNotNull() & ((c != 0) if r.kind == "sum" else F.lit(True)) for r, c in zip(runs, carries)],
    )
    carried = carried.filter(useful).select(*cut, *carries)
    return (
        local.join(carried, cut, "left")
        .withColumns({r.name: r.combined(F.col(r.name), c) for r, c in zip(runs, carries)})
        .drop(*([] if keep_block else [block]), *[f"_carry{len(block_bits)}_{i}" for i in range(len(runs))])
    )
