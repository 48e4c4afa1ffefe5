"""File-backed record logs: replayable input in the RECORD schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ackline.params import positive
from ackline.schemas import RECORD


def read_record_log(spark: SparkSession, path: str, schema: StructType = RECORD) -> DataFrame:
    """Read a log folder; the schema is fixed, never inferred."""
    return spark.read.schema(schema).parquet(path)


def stream_record_log(
    spark: SparkSession,
    path: str,
    schema: StructType = RECORD,
    *,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Stream a log folder with bounded intake (at most one of the two bounds)."""
    reader = spark.readStream.schema(schema)
    for name, value in log_options(max_files_per_trigger, max_bytes_per_trigger).items():
        reader = reader.option(name, value)
    return reader.parquet(path)


def log_options(max_files_per_trigger: int | None, max_bytes_per_trigger: int | None) -> dict[str, str]:
    """Intake bounds of a file stream."""
    if max_files_per_trigger is not None and max_bytes_per_trigger is not None:
        raise ValueError("set max_files_per_trigger or max_bytes_per_trigger, not both")
    options = {}
    if max_files_per_trigger is not None:
        options["maxFilesPerTrigger"] = str(positive("max_files_per_trigger", max_files_per_trigger))
    if max_bytes_per_trigger is not None:
        options["maxBytesPerTrigger"] = str(positive("max_bytes_per_trigger", max_bytes_per_trigger))
    return options


def write_record_log(records: DataFrame, path: str) -> None:
    """Append records to a log folder."""
    records.select([f.name for f in RECORD.fields]).write.mode("append").parquet(path)


def in_order(log: DataFrame, parts: int, *, key: str = "seq") -> list[DataFrame]:
    """``log`` as consecutive ranges of ``key`` with about as many rows each.

    For feeding a stream one range after another: files of one write are as old
    as each other, so their order tells nothing. The bounds are quantiles: one
    row reaches the driver.
    """
    positive("parts", parts)
    if parts == 1:
        return [log]
    shares = [F.lit(i / parts) for i in range(1, parts)]
    bounds = log.agg(F.percentile_approx(key, F.array(*shares), F.lit(10_000))).first()[0] or []
    edges = [None, *sorted(set(bounds)), None]
    ranges = []
    for low, high in zip(edges, edges[1:]):
        part = log if low is None else log.filter(F.col(key) > low)
        ranges.append(part if high is None else part.filter(F.col(key) <= high))
    return ranges
