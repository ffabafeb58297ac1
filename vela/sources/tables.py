"""Driver tables (one Parquet file each under an sf directory)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customer_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1-based ids keyed on ``customer.c_custkey`` (churn data grows with it)."""
    return table(spark, sf_dir, "customer").select((F.col("c_custkey") + 1).alias("id"))


def order_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1-based ids keyed on ``orders.o_orderkey`` (fraud data grows with it)."""
    return table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("id"))
