"""The corpus pipeline: stages that each read the documents the stage before them wrote.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the
columns of ``documents``: filters return rows as they came, the mix returns a row per
document and epoch with the text it takes. The last adds shard and slot. Every stage
takes null, empty and very long texts, repeated rows, empty tables and extra columns as
its operator's docstring states.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gradewise.llm.decontamination import drop_leaks
from gradewise.llm.mixing import mixed_documents
from gradewise.llm.quality import drop_low_quality
from gradewise.llm.sharding import shard_documents
from gradewise.llm.simhash import keep_one_per_group
from gradewise.sources import scratch_path

#: A document stays if its calibrated score reaches this.
QUALITY = 0.5
#: Documents with at least this share of their five-word shingles in common are near copies.
SIMILARITY = 0.8
SHARDS = 16


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as good; labels are learned from, but rows need none."""
    return drop_low_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), QUALITY)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id; a link is 0.8 of five-word shingles."""
    return keep_one_per_group(docs, similarity=SIMILARITY)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a row per document and epoch, with the words taken."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shards of near equal bytes, with each row's place in its shard."""
    return shard_documents(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("near-dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# Trained scores and XXH64 fingerprints have no SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
