"""Corpus preparation: five stages over ``documents``, each one of the training-data operators.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``; the last returns the documents with their shard
and slot. A row that the mix takes more than once stands in the result as often.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textoverlap.llm import decontam, mixing, quality, sharding, simhash
from textoverlap.llm.common import materialize, read
from textoverlap.session import ship_package

SHARDS = 40


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the label model judges good."""
    return quality.keep_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each group of near copies."""
    ship_package(spark)
    return simhash.drop_near_duplicates(docs, shingle=3, distance=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    ship_package(spark)
    return decontam.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_rows(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ``shard`` and ``slot``."""
    out = sharding.shard(docs, SHARDS)
    return out.select(*[out["row"][c].alias(c) for c in docs.columns if c not in ("shard", "slot")], "shard", "slot")


STAGES = [("quality", quality_rules), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixing", source_mix), ("sharding", shards)]

# Fingerprints, label model and shard tree are not expressed in SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
