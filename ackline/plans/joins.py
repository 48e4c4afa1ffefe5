"""Lookup join that survives a key holding a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    spread: Sequence[str],
    salts: int = SALTS,
) -> DataFrame:
    """Join ``rows`` to a much smaller ``lookup`` on ``on``.

    Every lookup row is repeated once per salt and every left row takes one salt
    from the hash of ``spread``, so a hot key is split over ``salts`` tasks. No
    broadcast is forced: Catalyst broadcasts the lookup when its size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles both sides otherwise.
    A lookup read from a table has an exact size; one computed by aggregation is
    estimated far too large, so store it first (``session.cut``) where ``rows``
    is big.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"lookup_join cannot preserve the right side: {how}")
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")
