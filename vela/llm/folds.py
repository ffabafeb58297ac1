"""Bounded samples of labelled rows for the trained operators, free column names, and the release of finished plans' files."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def fold(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``."""
    return F.crc32(key.cast("string").cast("binary")) % modulus


def class_counts(rows: DataFrame, label: str) -> dict:
    """Rows per label value; one row per value (two classes, a few languages) reaches the driver."""
    return {r[0]: r[1] for r in rows.groupBy(label).count().collect() if r[0] is not None}


def class_sample(rows: DataFrame, label: str, key: str, per_class: int, counts: dict) -> DataFrame:
    """About ``per_class`` rows of every label value of ``counts``, picked by a hash of the key; a map-only filter."""
    if not counts:
        return rows.filter(F.lit(False))
    share = F.element_at(F.create_map(*[F.lit(x) for v, n in counts.items() for x in (v, per_class / n)]), F.col(label))
    return rows.filter(F.pmod(F.xxhash64(F.col(key), F.lit(17)), F.lit(1 << 30)) < share * (1 << 30))


def unused(rows: DataFrame, name: str) -> str:
    """``name``, with underscores behind it as long as rows has a column of that name."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def release(spark: SparkSession) -> None:
    """Has Spark delete the shuffle and checkpoint files of plans that nothing refers to any more: its cleaner does so when the driver collects garbage, by itself every half hour."""
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()
