"""User code per validated object."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ackline.operators.records import succeed
from ackline.params import positive


class ObjectMetadata(NamedTuple):
    """What a processor sees of a record."""

    bucket: str
    key: str
    size: int
    etag: str | None


Processor = Callable[[ObjectMetadata], None]


def run_object_processor(
    accepted: DataFrame, processor: Processor | None, *, worker_count: int | None = None
) -> DataFrame:
    """Call ``processor`` on the metadata of every row and add ``outcome, reason``.

    An exception fails its row with the exception's text and no other row; the
    safe prefix then stops at the first failed record. Rows are processed where
    they are; ``worker_count`` spreads them over exactly that many tasks. Without
    a processor every row succeeds.
    """
    if worker_count is not None:
        positive("worker_count", worker_count)
        accepted = accepted.repartition(worker_count)
    if processor is None:
        return succeed(accepted)
    schema = T.StructType(
        [
            *accepted.schema.fields,
            T.StructField("outcome", T.StringType()),
            T.StructField("reason", T.StringType()),
        ]
    )

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            reasons = [
                _reason(processor, ObjectMetadata(bucket, key, int(size), None if pd.isna(etag) else etag))
                for bucket, key, size, etag in zip(
                    batch["bucket"], batch["object_key"], batch["size"], batch["etag"]
                )
            ]
            outcomes = ["succeeded" if r is None else "failed" for r in reasons]
            yield batch.assign(outcome=outcomes, reason=pd.Series(reasons, index=batch.index, dtype="object"))

    return accepted.mapInPandas(call, schema)


def _reason(processor: Processor, metadata: ObjectMetadata) -> str | None:
    try:
        processor(metadata)
    except Exception as error:  # noqa: BLE001 - user code may raise anything
        return str(error) or type(error).__name__
    return None
