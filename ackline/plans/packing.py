"""Spread rows over tasks by what they weigh, not by how many they are."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ackline.params import positive
from ackline.plans.scan import Running, prefix_scan

# Tasks are numbered with an int, and each costs the driver something.
MOST_TASKS = 1_000_000


def packed_by_bytes(df: DataFrame, weight: Column, names: Sequence[str], target: int, *, tasks: int | None = None) -> DataFrame:
    """``df`` in partitions of about ``target`` bytes each, by ``weight``.

    Rows are put in the order of the hash of ``names``; a running sum of their
    weights, made by a blocked scan, tells the task of each. No partition holds
    more than the target and one row beyond it. ``tasks`` fixes the number of
    partitions instead. One number, the sum of all weights, reaches the driver.
    """
    positive("target", target)
    place, heavy, before = "_place", "_weight", "_before"
    # 40 bits of the hash: a block of the scan has about a millionth of the rows.
    keyed = df.withColumns({place: F.shiftrightunsigned(F.xxhash64(*names), 24), heavy: weight.cast("long")})
    total = keyed.agg(F.sum(heavy)).first()[0] or 0
    count = positive("tasks", tasks) if tasks is not None else min(MOST_TASKS, max(1, math.ceil(total / target)))
    each = max(1, math.ceil(total / count))
    summed = prefix_scan(keyed, place, [Running("sum", F.col(heavy), before, exclusive=True)], ties=[*names, heavy])
    # Half a row's weight further: a row goes where most of it lies.
    task = F.least((F.col(before) + F.col(heavy) / 2) / each, F.lit(count - 1)).cast("int")
    return summed.withColumn("_task", task).repartitionById(count, F.col("_task")).drop(place, heavy, before, "_task")
