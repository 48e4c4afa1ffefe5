"""One query per operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ackline.llm import contamination, fim, fingerprints, licenses, neardup, packing, pages, quality, resampling, suffixes, tokens, urls, vectors
from ackline.llm.common import table
from ackline.llm.oracles import ORACLES

VOCABULARY = "word_bpe_49k.json"

__all__ = ["ORACLES", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def op1_extract_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract_text(table(spark, sf_dir, "pages"))


def op2_rate_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_bytes(table(spark, sf_dir, "documents"))


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path(VOCABULARY))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op7_judge_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled URLs are the pages whose id has a label: to be blocked if of low quality."""
    all_pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels")
    labelled = all_pages.join(labels, all_pages.page_id == labels.doc_id)
    judged = urls.judge_urls(all_pages, labelled.select("url", (F.col("quality") == 0).alias("blocked")))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op8_count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return tokens.token_count_digest(docs, public_tokenizers.path(VOCABULARY))


def op9_scan_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op10_find_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampling_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_near_duplicate_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.fill_in_middle_digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_extract_text": op1_extract_text,
    "op2_rate_quality": op2_rate_quality,
    "op3_repeated_bytes": op3_repeated_bytes,
    "op4_fingerprint": op4_fingerprint,
    "op5_pack": op5_pack,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_judge_urls": op7_judge_urls,
    "op8_count_tokens": op8_count_tokens,
    "op9_scan_licenses": op9_scan_licenses,
    "op10_find_contamination": op10_find_contamination,
    "op11_resample": op11_resample,
    "op12_near_duplicate_vectors": op12_near_duplicate_vectors,
    "op13_fill_in_middle": op13_fill_in_middle,
    "pipeline": corpus_pipeline.run,
}
