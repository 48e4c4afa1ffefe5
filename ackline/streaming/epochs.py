"""Epochs in a stream: records and assignment changes meet in one keyed state.

The state of a key is one number, the epoch in force, so an as-of lookup needs
no join with all intervals of a partition. Records of a partition are dealt to
``STRIPES`` keys and assignment changes go to each of them. Micro-batches must
come in the order of ``seq``, as those of one log do; within a batch any order
will do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ackline.operators.epochs import effective_revokes
from ackline.schemas import PARTITION

STRIPES = 16
_NONE = -1
_MARKS = ("mark", "is_change")


def with_changes(records: DataFrame, intervals: DataFrame) -> DataFrame:
    """Records and the changes of their partitions' epochs in one log.

    Adds ``is_change`` and ``mark``, the epoch from that change on (-1: none);
    the other columns of a change but partition and ``seq`` are null.
    """
    starts = intervals.select(*PARTITION, F.col("from_seq").alias("seq"), F.col("epoch").alias("mark"))
    ends = effective_revokes(intervals).select(*PARTITION, "seq", F.lit(_NONE).cast("long").alias("mark"))
    changes = starts.unionByName(ends).withColumn("is_change", F.lit(True))
    plain = records.withColumns({"mark": F.lit(None).cast("long"), "is_change": F.lit(False)})
    return plain.unionByName(changes, allowMissingColumns=True)


class EpochInForce(StatefulProcessor):
    """Stamps the records of one stripe of a partition."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._epoch = handle.getValueState("epoch", "epoch bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = list(rows)
        current = self._epoch.get()[0] if self._epoch.exists() else _NONE
        changes = pd.concat([f[f["is_change"]] for f in frames])
        # A change at a seq comes before the records at it; of two, the assignment is the later one.
        changes = changes.sort_values(["seq", "mark"], kind="stable")
        at = changes["seq"].to_numpy(dtype="int64")
        marks = np.append(current, changes["mark"].to_numpy(dtype="int64"))
        if len(changes):
            if marks[-1] == _NONE:
                # Nothing in force: the key needs no state.
                self._epoch.clear()
            else:
                self._epoch.update((int(marks[-1]),))
        for frame in frames:
            own = frame[~frame["is_change"]]
            if len(own):
                epoch = marks[np.searchsorted(at, own["seq"].to_numpy(dtype="int64"), side="right")]
                stamped = own.drop(columns=[*_MARKS, "stripe"]).assign(epoch=pd.array(epoch, dtype="Int64"))
                yield stamped.assign(epoch=stamped["epoch"].where(stamped["epoch"] >= 0))

    def close(self) -> None:
        pass


def stream_epochs(events: DataFrame, *, spread: Column | str = "seq") -> DataFrame:
    """Records of a stream of :func:`with_changes` with ``epoch``, null where none is in force.

    Needs the RocksDB state store. ``spread`` deals the records of a partition
    to its stripes.
    """
    value = F.col(spread) if isinstance(spread, str) else spread
    own = F.array(F.pmod(F.xxhash64(value), F.lit(STRIPES)).cast("int"))
    every = F.sequence(F.lit(0), F.lit(STRIPES - 1))
    # No nulls in the numbers of changes: pandas would make floats of all of them.
    numbers = [f.name for f in events.schema.fields if isinstance(f.dataType, T.IntegralType) and f.name not in PARTITION]
    whole = {n: F.when(F.col("is_change"), F.coalesce(n, F.lit(0))).otherwise(F.col(n)) for n in numbers if n not in ("seq", "mark")}
    events = events.withColumns({**whole, "mark": F.coalesce("mark", F.lit(_NONE).cast("long"))})
    dealt = events.withColumn("stripe", F.explode(F.when(F.col("is_change"), every).otherwise(own)))
    fields = [f for f in events.schema.fields if f.name not in _MARKS]
    fields = [T.StructField(f.name, f.dataType) for f in fields]
    return dealt.groupBy(*PARTITION, "stripe").transformWithStateInPandas(
        statefulProcessor=EpochInForce(),
        outputStructType=T.StructType([*fields, T.StructField("epoch", T.LongType())]),
        outputMode="Append",
        timeMode="None",
    )


def stream_assigned(events: DataFrame, **options) -> DataFrame:
    """Records in an assignment, with its epoch; the others are dropped."""
    return stream_epochs(events, **options).filter(F.col("epoch").isNotNull())
