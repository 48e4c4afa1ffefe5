"""From raw documents to packed sequences, one stage after another.

Every stage works on all that its predecessor kept, is written as Parquet under
the cluster's shared folder and read again, so a lost executor costs a re-read.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ackline.llm import contamination, neardup, packing, quality, suffixes
from ackline.llm.common import KEY, keep, prepare, row_key, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
VOCABULARY = "word_bpe_49k.json"
# A passage: fifty words of three letters and a blank.
PASSAGE_BYTES = 200


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what the classifier does not reject; it learns from the labelled rows of ``docs``."""
    labels = table(spark, sf_dir, "labels")
    model = quality.fit(docs, quality.learnable(docs, labels))
    scored = quality.score_quality(docs, model)
    return scored.filter("predicted = 1").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of every near-duplicate group.

    Rows are numbered first, so those with a null id or under a repeated one are
    documents of their own; a null id comes after all others.
    """
    rows = keep(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("own")), "numbered")
    groups = neardup.near_duplicates(rows.select(F.col("row").alias("doc_id"), "own.text"))
    members = groups.select(F.col("doc_id").alias("row"), "component_id").join(rows.select("row", "own.doc_id"), "row")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    first = members.groupBy("component_id").agg(F.min_by("row", order).alias("row"))
    return rows.join(first, "row", "left_semi").select("own.*")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages out of the texts that stand anywhere else too; drops empty texts."""
    cut = suffixes.remove_repeats(docs, length=PASSAGE_BYTES, gram=PASSAGE_BYTES // 2)
    return cut.filter("text is null or text <> ''")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    found = contamination.contaminated_rows(docs, table(spark, sf_dir, "benchmark"))
    keyed = docs.select(*row_key(docs), F.struct("*").alias("own"))
    return keyed.join(found.select(*KEY).distinct(), KEY, "left_anti").select("own.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its sequence and place there."""
    return packing.pack_documents(docs, public_tokenizers.path(VOCABULARY))


STAGES: list[tuple[str, Stage]] = [
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

# SQL has neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
