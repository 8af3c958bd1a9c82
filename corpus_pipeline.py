"""Corpus pipeline: quality rules, exact dedup, near dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``; the last returns one row per packed
piece with its token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardline.llm.exact import deduplicate
from wardline.llm.line_quality import clean_documents
from wardline.llm.mixing import mix_documents
from wardline.llm.near import one_per_group
from wardline.llm.packing import pack_documents
from wardline.llm.queries import END_ID, vocabulary
from wardline.session import ship_library, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop rejected documents; remove page furniture from the others."""
    return clean_documents(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return deduplicate(docs, keep="max")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest doc_id stays."""
    return one_per_group(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it."""
    return mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces placed in sequences of 1024 ids, with their ids."""
    return pack_documents(docs, vocabulary("byte_bpe_50k.json"), END_ID, capacity=1024, with_ids=True)


def _shipped(stage):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_library(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [(f.__name__, _shipped(f)) for f in (quality, exact_dedup, near_dedup, mixing, packing)]

ORACLE_SQL = None      # mixing and packing cannot be stated in SQL; tests/llm holds the brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
