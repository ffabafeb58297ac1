"""Skew-safe per-key ordering: position within a key, next row within a key.

``row_number() over (partition by key order by t)`` sends every row of a key
to one task; a key holding a third of all rows then becomes one huge sorted
task.  Here rows are dealt by ranges of (key, order, tiebreak) instead, for any orderable types:

1. a range partitioning cuts the whole table into equal parts, whatever the keys; the part's number grows with the order
   within each key, so a hot key spans as many parts as it fills (the parts are checkpointed, so they stay as they are);
2. a window partitioned by (key, part) numbers rows locally;
3. a per-(key, part) count table (at most keys + parts rows) gives each part's offset with a tiny window per key;
4. offset + local number = the exact global position within the key.

``next_within`` is the same idea for ``lead``: inside a part it is the
local lead; the last row of a part takes the first row of the key's next
part (from a per-part table of first rows).  Equal order values are split by the tiebreak like any others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def _numeric(df: DataFrame, order: str) -> Column:
    t = df.schema[order].dataType
    if isinstance(t, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                                F.col(order)).cast("double")
    if isinstance(t, T.TimestampType):
        return F.unix_micros(F.col(order)).cast("double")
    if isinstance(t, T.DateType):
        return F.unix_date(F.col(order)).cast("double")
    return F.col(order).cast("double")


def range_parts(df: DataFrame, key: Sequence[str], order: str, tiebreak: Sequence[str] = (), parts: int | None = None, name: str = "_bkt") -> DataFrame:
    """df dealt by ranges of (key, order, tiebreak), with the number of each row's range; NULLs first, nothing goes through the driver but the sampled bounds of a range partitioner."""
    parts = parts or max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    return df.repartitionByRange(parts, *key, order, *tiebreak).withColumn(name, F.spark_partition_id()).checkpoint()


def with_order_bucket(df: DataFrame, order: str, buckets: int | None = None, name: str = "_bkt") -> DataFrame:
    """Add a monotone integer bucket of a numeric or time column (NULLs first, bucket -1): approximate quantiles in one pass, then a binary search."""
    spark = df.sparkSession
    if buckets is None:
        buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    if buckets <= 1:
        return df.withColumn(name, F.lit(0))
    num = df.withColumn("_ord_num", _numeric(df, order))
    cuts = sorted(set(num.approxQuantile("_ord_num", [i / buckets for i in range(1, buckets)],
                                         1.0 / (4 * buckets))))
    splits = [float("-inf"), *cuts, float("inf")]
    if len(splits) < 3:
        return num.withColumn(name, F.lit(0)).drop("_ord_num")
    bz = Bucketizer(splits=splits, inputCol="_ord_num", outputCol=f"{name}_d", handleInvalid="keep")
    # NULL order values sort first in ascending windows, so they get the lowest bucket
    bucket = F.when(F.col("_ord_num").isNull(), F.lit(-1)).otherwise(F.col(f"{name}_d").cast("int"))
    return bz.transform(num).withColumn(name, bucket).drop("_ord_num", f"{name}_d")


def _joined(rows: DataFrame, parts: DataFrame, key: Sequence[str], how: str) -> DataFrame:
    """rows with the columns of their (key, part); a NULL key is a key like any other."""
    named = parts.select(*[F.col(c).alias(f"_k_{c}") for c in (*key, "_bkt")], *[c for c in parts.columns if c not in (*key, "_bkt")])
    on = rows["_bkt"] == named["_k__bkt"]
    for c in key:
        on = on & rows[c].eqNullSafe(named[f"_k_{c}"])
    return rows.join(named, on, how)


def sequence_within(df: DataFrame, key: Sequence[str], order: str, tiebreak: Sequence[str] = (),
                    out: str = "seq", buckets: int | None = None) -> DataFrame:
    """0-based position of each row within its key, ordered by (order, *tiebreak)."""
    key = list(key)
    b = range_parts(df, key, order, tiebreak, buckets)
    w = Window.partitionBy(*key, "_bkt").orderBy(order, *tiebreak)
    local = b.withColumn("_local", F.row_number().over(w) - 1)
    counts = b.groupBy(*key, "_bkt").agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.select(*key, "_bkt", F.coalesce(F.sum("_n").over(
        Window.partitionBy(*key).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_off"))
    return (_joined(local, offs, key, "inner")
            .withColumn(out, (F.col("_off") + F.col("_local")).cast("bigint"))
            .select(*df.columns, out))


def next_within(df: DataFrame, key: Sequence[str], order: str, tiebreak: Sequence[str],
                cols: Sequence[str], prefix: str = "next_", buckets: int | None = None) -> DataFrame:
    """``lead(c) over (partition by key order by order, *tiebreak)`` for each c in cols."""
    key, cols = list(key), list(cols)
    b = range_parts(df, key, order, tiebreak, buckets)
    w = Window.partitionBy(*key, "_bkt").orderBy(order, *tiebreak)
    local = b.select("*", F.lead(F.lit(1)).over(w).alias("_has_next"),
                     *[F.lead(c).over(w).alias(f"_ln_{c}") for c in cols],
                     (F.row_number().over(w) == 1).alias("_first"))
    firsts = local.where("_first").select(*key, "_bkt", *[F.col(c).alias(f"_f_{c}") for c in cols])
    wb = Window.partitionBy(*key).orderBy("_bkt")
    nb = firsts.select(*key, "_bkt", *[F.lead(f"_f_{c}").over(wb).alias(f"_nb_{c}") for c in cols])
    j = _joined(local, nb, key, "left")
    outs = [F.when(F.col("_has_next").isNotNull(), F.col(f"_ln_{c}")).otherwise(F.col(f"_nb_{c}"))
            .alias(f"{prefix}{c}") for c in cols]
    keep = [c for c in df.columns]
    return j.select(*keep, *outs)


def max_before(df: DataFrame, key: Sequence[str], order: str, tiebreak: Sequence[str], value: str, out: str,
               buckets: int | None = None) -> DataFrame:
    """Largest ``value`` of the rows that come before each row of its key (NULL: none), values of any orderable type.

    A key is split over order ranges: each range takes the running maximum of its own rows and that of the
    ranges before it, from a table with one row per (key, range).
    """
    key = list(key)
    b = range_parts(df, key, order, tiebreak, buckets)
    earlier = Window.partitionBy(*key, "_bkt").orderBy(order, *tiebreak).rowsBetween(Window.unboundedPreceding, -1)
    local = b.withColumn("_local", F.max(value).over(earlier))
    tops = b.groupBy(*key, "_bkt").agg(F.max(value).alias("_top"))
    ranges = Window.partitionBy(*key).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    before = tops.select(*key, "_bkt", F.max("_top").over(ranges).alias("_before"))
    return (_joined(local, before, key, "inner").withColumn(out, F.greatest("_before", "_local")).select(*df.columns, out))
