"""Pipeline over documents: quality rules, near-duplicates, secrets, source mix, packing.

Each stage is written as Parquet and read again as the next one's documents; all but the last
return the columns of documents.  ``run`` does so in the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vela.llm import mixing, near_dedup, packing, quality_rules, secrets
from vela.llm.folds import release
from vela.session import ensure_checkpoint_dir, scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    ensure_checkpoint_dir(spark)
    return quality_rules.filter_docs(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    ensure_checkpoint_dir(spark)
    release(spark)  # of the stage before
    return near_dedup.filter_docs(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced."""
    release(spark)  # of the stage before
    return secrets.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    ensure_checkpoint_dir(spark)
    release(spark)  # of the stage before
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    release(spark)  # of the stage before
    return packing.pack(docs)


STAGES = [("quality rules", quality), ("near dedup", dedup), ("secret scans", secret_scan), ("mixing", mix), ("packing", pack)]

#: SQL expresses neither the near-duplicate forest nor tokenising; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    folder = scratch_path(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
