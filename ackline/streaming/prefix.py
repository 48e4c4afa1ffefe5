"""Safe prefix and first successes as a stream, over epochs that come and go.

Deliveries, successes and assignment changes are one keyed stream. A partition's
offsets are cut into blocks and the blocks dealt to stripes, so a hot partition
is spread over ``STRIPES`` tasks; assignment changes go to all its stripes. The
state of a stripe holds what is not settled yet: an offset leaves it as soon as
it and all earlier deliveries of its block have succeeded, an epoch as soon as a
later one starts or it is revoked, and a finished block after a while.

Rows reach the state packed: one row a stripe holds many events as arrays, as
the state handler takes each row it is given by itself.

The safe prefix does not depend on how the logs are cut into micro-batches or
interleaved. First successes are the least of a token if batches come in the
order of ``seq``, as those of one log do; within a batch any order will do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ackline.params import I64_MAX
from ackline.schemas import PARTITION, PROGRESS, TOKEN

# Offsets per block, and stripes a partition's blocks are dealt to.
OFFSET_BLOCK_BITS = 13
BLOCK_OFFSETS = 1 << OFFSET_BLOCK_BITS
STRIPES = 8
# A finished block is forgotten when its stripe has been called so often without a row of it.
KEPT_CALLS = 16
STRIPE = [*PARTITION, "stripe"]
# Events a task holds at a time to pack them by stripe.
PACKED_ROWS = 1 << 18
_EVENT = ["epoch", "record_offset", "seq", "delivered"]
_CHANGE = ["change_seq", "least"]
_PACKED = "topic string, partition_id int, stripe int, " + ", ".join(f"{n} array<bigint>" for n in (*_EVENT, *_CHANGE))
BLOCK = [*PROGRESS, "offset_block"]
_OUTPUT = (
    "kind string, topic string, partition_id int, epoch bigint, offset_block bigint, first_open bigint, last_ok bigint, "
    "version bigint, record_offset bigint, first_seq bigint"
)
_NEVER = np.iinfo(np.int64).min
# Integers that may be missing: a merge would make floats of plain ones, which cannot hold all offsets.
_EXACT = "Int64"
_PENDING = ["epoch", "offset", "delivered", "low", "high"]
_BLOCKS = ["epoch", "block", "last_ok", "touched"]
_FINISHED = ["epoch", "below"]
_PARTS = {"pending": _PENDING, "blocks": _BLOCKS, "finished": _FINISHED}
_STATE = "calls bigint, floor bigint, " + ", ".join(
    f"{part}_{name} array<bigint>" for part, names in _PARTS.items() for name in names
)


def ack_events(deliveries: DataFrame, completions: DataFrame, intervals: DataFrame | None = None) -> DataFrame:
    """Deliveries, successes and, with ``intervals``, assignment changes in one log: token, ``seq`` and ``kind``.

    ``assigned`` starts an epoch and ends all before it, ``revoked`` ends one.
    """
    delivered = deliveries.select(*TOKEN, "seq", F.lit("delivered").alias("kind"))
    succeeded = completions.filter(F.col("outcome") == "succeeded").select(
        *TOKEN, "seq", F.lit("succeeded").alias("kind")
    )
    events = delivered.unionByName(succeeded)
    if intervals is None:
        return events
    none = F.lit(None).cast("long").alias("record_offset")
    starts = intervals.select(*PROGRESS, none, F.col("from_seq").alias("seq"), F.lit("assigned").alias("kind"))
    ends = intervals.filter(F.col("closed_by") == "revoked").select(
        *PROGRESS, none, F.col("to_seq").alias("seq"), F.lit("revoked").alias("kind")
    )
    return events.unionByName(starts).unionByName(ends)


def _frame(names: list[str], arrays: list) -> pd.DataFrame:
    return pd.DataFrame({n: np.asarray(a, dtype="int64") for n, a in zip(names, arrays)})


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Events and changes of a stripe as arrays in one row, for every ``PACKED_ROWS`` rows or so.

    Rows come with ``_PACKED``'s names and single values. A change has no stripe yet and null event columns, an event null
    change columns.
    """

    def pack(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        change = rows["stripe"].is_null()
        for part, filled in ((rows.filter(change), _CHANGE), (rows.filter(pc.invert(change)), _EVENT)):
            if not part.num_rows:
                continue
            made = part.group_by(STRIPE, use_threads=False).aggregate([(n, "list") for n in filled])
            none = pa.nulls(made.num_rows, pa.list_(pa.int64()))
            columns = [made[n] for n in STRIPE] + [made[f"{n}_list"] if n in filled else none for n in (*_EVENT, *_CHANGE)]
            yield from pa.table(columns, names=[*STRIPE, *_EVENT, *_CHANGE]).combine_chunks().to_batches()

    held, n_held = [], 0
    for batch in batches:
        held.append(batch)
        n_held += batch.num_rows
        if n_held >= PACKED_ROWS:
            yield from pack(held)
            held, n_held = [], 0
    if n_held:
        yield from pack(held)


def _unpacked(rows: pd.DataFrame, names: list[str]) -> pd.DataFrame:
    """The single events or changes in packed rows."""
    return _frame(names, [np.concatenate([np.empty(0, "int64"), *rows[n].dropna()]) for n in names])


def floor_at(seq: np.ndarray, control: pd.DataFrame, floor: int) -> np.ndarray:
    """The least epoch in force at each ``seq``: ``floor`` raised by the changes up to it."""
    ordered = control.sort_values("seq", kind="stable")
    raised = np.maximum.accumulate(np.append(floor, ordered["least"].to_numpy(dtype="int64")))
    return raised[np.searchsorted(ordered["seq"].to_numpy(dtype="int64"), seq, side="right")]


class StripePrefix(StatefulProcessor):
    """Keeps the unsettled deliveries of one stripe of a partition."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("stripe", _STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        calls, floor, pending, blocks, finished = self._load()
        calls += 1
        batch = pd.concat(list(rows))
        control = _unpacked(batch, _CHANGE).rename(columns={"change_seq": "seq"})
        events = _unpacked(batch, _EVENT)
        fresh = self._fresh(events, floor_at(events["seq"].to_numpy(dtype="int64"), control, floor))
        tokens = self._combined(pending, fresh, blocks, finished)
        made, firsts, pending, blocks = self._settled(tokens, blocks, calls)
        # Only now do epochs that ended within the batch go.
        floor = int(floor_at(np.array([I64_MAX]), control, floor)[0])
        pending, blocks, finished = (f[f["epoch"] >= floor] for f in (pending, blocks, finished))
        blocks, finished = self._forgotten(pending, blocks, finished, calls)
        self._save(calls, floor, pending, blocks, finished)
        made = made[made["epoch"] >= floor]
        topic, partition_id, _ = key
        out = pd.concat(
            [
                made.assign(kind="block", version=calls),
                firsts.astype(_EXACT).assign(kind="first"),
            ]
        )
        if len(out):
            out = out.assign(topic=topic, partition_id=partition_id)
            names = [c.split()[0] for c in _OUTPUT.split(", ")]
            out = out.reindex(columns=names)
            numbers = [n for n in names if n not in ("kind", "topic", "partition_id")]
            yield out.astype({n: "Int64" for n in numbers} | {"partition_id": "int32"})

    def close(self) -> None:
        pass

    @staticmethod
    def _fresh(events: pd.DataFrame, floors: np.ndarray) -> pd.DataFrame:
        live = events[events["epoch"].to_numpy(dtype="int64") >= floors]
        seq = live["seq"].to_numpy(dtype="int64")
        delivery = live["delivered"].to_numpy() == 1
        columns = [
            live["epoch"],
            live["record_offset"],
            np.where(delivery, seq, I64_MAX),
            np.where(delivery, I64_MAX, seq),
            np.where(delivery, _NEVER, seq),
        ]
        return _frame(_PENDING, columns).assign(done=False)

    @staticmethod
    def _combined(pending: pd.DataFrame, fresh: pd.DataFrame, blocks: pd.DataFrame, finished: pd.DataFrame) -> pd.DataFrame:
        """One row a token that is not settled, in the order of epoch and offset.

        ``low`` is the first success after the delivery as far as it is known,
        ``high`` the last of all; ``was`` says that the token had succeeded before.
        """
        known = pending.assign(done=(pending["delivered"] < I64_MAX) & (pending["high"] > pending["delivered"]))
        rows = pd.concat([known, fresh], ignore_index=True)
        token = rows.groupby(["epoch", "offset"], sort=False)
        first = token["delivered"].transform("min")
        rows["low"] = np.where((rows["low"] > first) | (first == I64_MAX), rows["low"], I64_MAX)
        rows = (
            rows.groupby(["epoch", "offset"], sort=True)
            .agg(delivered=("delivered", "min"), low=("low", "min"), high=("high", "max"), was=("done", "max"))
            .reset_index()
        )
        rows["block"] = rows["offset"] // BLOCK_OFFSETS
        rows = rows.merge(blocks[["epoch", "block", "last_ok"]].astype(_EXACT), on=["epoch", "block"], how="left")
        rows = rows.merge(finished.astype(_EXACT), on="epoch", how="left")
        last_ok, below = (rows[c].fillna(_NEVER).astype("int64") for c in ("last_ok", "below"))
        settled = (rows["offset"] <= last_ok) & (last_ok > _NEVER)
        rows = rows.drop(columns=["last_ok", "below"])
        return rows[~settled & ~(rows["block"] < below)].reset_index(drop=True)

    @staticmethod
    def _settled(tokens: pd.DataFrame, blocks: pd.DataFrame, calls: int) -> tuple[pd.DataFrame, ...]:
        """Block rows and first successes to put out; what stays pending; all blocks."""
        known = tokens["delivered"] < I64_MAX
        done = known & (tokens["high"] > tokens["delivered"])
        new = tokens[done & ~tokens["was"].astype(bool)]
        firsts = pd.DataFrame(
            {
                "epoch": new["epoch"],
                "record_offset": new["offset"],
                "first_seq": np.where(new["low"] < I64_MAX, new["low"], new["high"]),
            }
        )
        group = [tokens["epoch"], tokens["block"]]
        open_ = known & ~done
        beyond = open_.groupby(group).cummax()
        reached = done & ~beyond & (tokens["offset"] < I64_MAX)
        made = (
            pd.DataFrame(
                {
                    "epoch": tokens["epoch"],
                    "block": tokens["block"],
                    "open": tokens["offset"].where(open_, I64_MAX),
                    "ok": tokens["offset"].where(reached, _NEVER),
                    "some": open_,
                }
            )
            .groupby(["epoch", "block"])
            .agg(open=("open", "min"), ok=("ok", "max"), some=("some", "max"))
            .reset_index()
            .astype({c: _EXACT for c in ("epoch", "block", "open", "ok")})
        )
        both = made.merge(blocks.astype(_EXACT), on=["epoch", "block"], how="outer", indicator="from")
        last = np.maximum(*(both[c].fillna(_NEVER).astype("int64") for c in ("ok", "last_ok")))
        here = both["from"] != "right_only"
        touched = both["touched"].where(~here, calls)
        all_blocks = _frame(_BLOCKS, [both["epoch"], both["block"], last, touched])
        at = tokens.merge(all_blocks, on=["epoch", "block"])
        rest = at[at["offset"] > at["last_ok"]][_PENDING]
        put_out = pd.DataFrame(
            {
                "epoch": both["epoch"],
                "offset_block": both["block"],
                "first_open": both["open"].where(both["some"].eq(True)),
                "last_ok": last.astype(_EXACT).where(last > _NEVER),
            }
        )[here]
        return put_out, firsts, rest, all_blocks

    @staticmethod
    def _forgotten(pending: pd.DataFrame, blocks: pd.DataFrame, finished: pd.DataFrame, calls: int) -> tuple[pd.DataFrame, pd.DataFrame]:
        """Drop finished blocks from the lowest up; rows for them are repeats from now on."""
        blocks = blocks.sort_values(["epoch", "block"])
        busy = pd.MultiIndex.from_arrays([pending["epoch"], pending["offset"] // BLOCK_OFFSETS])
        top = blocks.groupby("epoch")["block"].transform("max")
        waits = (blocks["block"] == top) | (calls - blocks["touched"] < KEPT_CALLS)
        waits |= pd.MultiIndex.from_arrays([blocks["epoch"], blocks["block"]]).isin(busy)
        waits |= blocks["last_ok"] == _NEVER
        stays = waits.groupby(blocks["epoch"]).cummax() if len(blocks) else waits
        gone = blocks[~stays].groupby("epoch")["block"].max() + 1
        below = pd.concat([finished, _frame(_FINISHED, [gone.index, gone])]).groupby("epoch")["below"].max().reset_index()
        return blocks[stays], below

    def _load(self) -> tuple[int, int, pd.DataFrame, pd.DataFrame, pd.DataFrame]:
        if not self._state.exists():
            return 0, _NEVER, *(_frame(names, [[]] * len(names)) for names in _PARTS.values())
        calls, floor, *arrays = self._state.get()
        frames = []
        for names in _PARTS.values():
            frames.append(_frame(names, arrays[: len(names)]))
            arrays = arrays[len(names) :]
        return calls, floor, *frames

    def _save(self, calls: int, floor: int, *frames: pd.DataFrame) -> None:
        arrays = [f[n].astype("int64").tolist() for f, names in zip(frames, _PARTS.values()) for n in names]
        self._state.update((calls, floor, *arrays))


def stream_prefix(events: DataFrame) -> DataFrame:
    """Rows of kind ``block`` and ``first`` from a stream of :func:`ack_events`.

    A ``block`` row is the summary of a block of offsets of an epoch in force;
    the latest ``version`` replaces earlier ones (:func:`latest_blocks`). A
    ``first`` row is the first success of a delivery: ``record_offset, first_seq``
    (:func:`first_successes`). Needs the RocksDB state store.
    """
    control = F.coalesce(F.col("kind").isin("assigned", "revoked"), F.lit(False))
    block = F.shiftright("record_offset", OFFSET_BLOCK_BITS).cast("long")
    own = F.pmod(F.coalesce(block, F.lit(0)), F.lit(STRIPES)).cast("int")
    every = F.sequence(F.lit(0), F.lit(STRIPES - 1))
    # An assignment leaves nothing below its epoch, a revocation not even that.
    least = F.when(F.col("kind") == "assigned", F.col("epoch")).when(F.col("kind") == "revoked", F.col("epoch") + 1)
    # Only arrays of whole numbers reach pandas, where a null would make floats of them.
    value = {
        "epoch": F.when(~control, F.col("epoch")),
        "record_offset": F.when(~control, F.coalesce("record_offset", F.lit(0))),
        "seq": F.when(~control, F.col("seq")),
        "delivered": F.when(~control, (F.col("kind") == "delivered").cast("long")),
        "change_seq": F.when(control, F.col("seq")),
        "least": least,
    }
    single = events.select(*PARTITION, F.when(~control, own).alias("stripe"), *[c.alias(n) for n, c in value.items()])
    dealt = F.explode(F.when(F.col("stripe").isNull(), every).otherwise(F.array("stripe"))).alias("stripe")
    shaped = single.mapInArrow(packed, _PACKED).select(*PARTITION, dealt, *_EVENT, *_CHANGE)
    return shaped.groupBy(*STRIPE).transformWithStateInPandas(
        statefulProcessor=StripePrefix(),
        outputStructType=_OUTPUT,
        outputMode="Update",
        timeMode="None",
    )


def latest_blocks(updates: DataFrame) -> DataFrame:
    """The latest summary of every block, ready for ``acks.merge_blocks``."""
    return (
        updates.filter("kind = 'block'")
        .groupBy(*BLOCK)
        .agg(F.max_by(F.struct("first_open", "last_ok"), F.col("version")).alias("_latest"))
        .select(*BLOCK, "_latest.first_open", "_latest.last_ok")
    )


def first_successes(updates: DataFrame) -> DataFrame:
    """``first_seq`` of every token that was delivered and has succeeded while its epoch was in force."""
    return updates.filter("kind = 'first'").select(*TOKEN, "first_seq")
