"""Feature preparation as Column expressions.

Fitting a preprocessor is one aggregate job whose result is a handful of
numbers per column (mean, population std, sorted vocabulary); applying it is
a map-only projection.  Nothing row-sized reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sequence import sequence_within

from ..functions.random import uniform
from ..session import ensure_checkpoint_dir

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
CATEGORICAL = (T.StringType, T.BooleanType)


def feature_columns(df: DataFrame, target: str, id_column: str | None = None,
                    explicit: list[str] | None = None) -> list[str]:
    """Explicit list, else every column but the target (and the id)."""
    if explicit is not None:
        missing = [c for c in explicit if c not in df.columns]
        if missing:
            raise ValueError(f"feature columns not in frame: {missing}")
        return list(explicit)
    return [c for c in df.columns if c != target and c != id_column]


def partition_types(df: DataFrame, columns: list[str] | None = None) -> dict[str, list[str]]:
    """Numeric / categorical / dropped by Spark type (timestamps etc. are dropped)."""
    cols = columns if columns is not None else df.columns
    out: dict[str, list[str]] = {"numeric": [], "categorical": [], "dropped": []}
    types = {f.name: f.dataType for f in df.schema.fields}
    for c in cols:
        t = types[c]
        kind = "numeric" if isinstance(t, NUMERIC) else "categorical" if isinstance(t, CATEGORICAL) else "dropped"
        out[kind].append(c)
    return out


def type_partition_table(df: DataFrame, columns: list[str] | None = None) -> list[tuple[str, str, str]]:
    """(column, spark type, kind) rows for P8."""
    kinds = partition_types(df, columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [(c, types[c], k) for k, cs in kinds.items() for c in cs]


# ------------------------------------------------------------- scaling ---

def scaler_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row of mean and population std per column (single aggregate)."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}__mean"), F.stddev_pop(x).alias(f"{c}__std")]
    return df.agg(*aggs)


def fit_standard_scaler(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    row = scaler_stats(df, columns).first()
    return {c: (row[f"{c}__mean"], row[f"{c}__std"]) for c in columns}


def standard_scale(df: DataFrame, stats: dict[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    """(x - mean) / std_pop; a constant column gets scale 1, so it maps to 0."""
    cols = []
    for c in df.columns:
        if c in stats:
            mean, std = stats[c]
            scale = std if std not in (None, 0.0) else 1.0
            cols.append(((F.col(c).cast("double") - F.lit(mean)) / F.lit(scale)).alias(c + suffix))
            if suffix:
                cols.append(F.col(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


# ------------------------------------------------------------- one-hot ---

def _cat_str(c: str, dtype) -> Column:
    col = F.col(c)
    if isinstance(dtype, T.BooleanType):
        return F.when(col, F.lit("True")).when(~col, F.lit("False"))
    return col.cast("string")


def vocabulary_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """A7 as a table of any size: (column_name, category, index, times), categories numbered in sorted order within their column.

    Distinct values are counted by partial aggregates and numbered over range partitions with offsets (``sequence_within``);
    nothing is collected.  NULL is no category."""
    types = {f.name: f.dataType for f in df.schema.fields}
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), _cat_str(c, types[c]).alias("category")) for c in columns])
    counts = (df.select(F.explode(pairs).alias("p")).select("p.*").where(F.col("category").isNotNull())
              .groupBy("column_name", "category").agg(F.count(F.lit(1)).alias("times")))
    return sequence_within(counts, ["column_name"], "category", out="index").select("column_name", "category", "index", "times")


def encode(df: DataFrame, vocabulary: DataFrame, columns: list[str], drop_first: bool = False) -> DataFrame:
    """T3 / T5 for vocabularies of any size: df with ``<column>_code`` per column, ``positions`` and ``size``.

    A code is the category's index in its column (NULL if unknown or NULL).  ``positions`` are the places of the ones in the one-hot vector
    of all columns in turn, ``size`` the vector's length: a sparse vector without a column per category.  The table is joined column by column;
    the planner broadcasts small ones and merges large ones, skewed categories are split by the adaptive join."""
    types = {f.name: f.dataType for f in df.schema.fields}
    sizes = {r.column_name: r.n for r in vocabulary.groupBy("column_name").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per column
    out, offset, positions = df, 0, []
    for c in columns:
        code = f"{c}_code"
        own = vocabulary.where(F.col("column_name") == c).select(F.col("category").alias(f"_c_{c}"), F.col("index").alias(code))
        out = out.join(own, _cat_str(c, types[c]) == F.col(f"_c_{c}"), "left").drop(f"_c_{c}")
        first = 1 if drop_first else 0
        positions.append(F.when(F.col(code) >= first, F.col(code) + F.lit(offset - first)))
        offset += max(0, sizes.get(c, 0) - first)
    return out.withColumn("positions", F.array_compact(F.array(*positions))).withColumn("size", F.lit(offset).cast("bigint"))


def scaler_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """A6 as a table: (column_name, mean, std_pop)."""
    one = scaler_stats(df, columns)
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std_pop"))
        for c in columns])).alias("v")).select("v.*")


def fit_vocabulary(df: DataFrame, columns: list[str], max_categories: int = 10_000) -> dict[str, list[str]]:
    """Sorted distinct values per categorical column, for ``one_hot``, whose result has a column per category.

    A plan of more than ``max_categories`` columns is of no use: such columns are encoded by ``vocabulary_table`` and
    ``encode``, which have no such bound.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    card = df.agg(*[F.approx_count_distinct(_cat_str(c, types[c])).alias(c) for c in columns]).first()
    too_big = [c for c in columns if card[c] > max_categories]
    if too_big:
        raise ValueError(f"too many categories for one column each, use vocabulary_table and encode: {too_big}")
    row = df.agg(*[F.array_sort(F.collect_set(_cat_str(c, types[c]))).alias(c) for c in columns]).first()
    return {c: list(row[c]) for c in columns}


def one_hot(df: DataFrame, vocab: dict[str, list[str]], drop_first: bool = False,
            keep_source: bool = False) -> DataFrame:
    """T3 (all categories, unknown -> zeros) / T5 (first category dropped).

    Output columns are named ``<column>_<category>`` and are DOUBLE 0/1.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    cols: list[Column] = []
    for c in df.columns:
        if c not in vocab:
            cols.append(F.col(c))
            continue
        if keep_source:
            cols.append(F.col(c))
        cats = vocab[c][1:] if drop_first else vocab[c]
        s = _cat_str(c, types[c])
        cols += [F.when(s == F.lit(cat), F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"{c}_{cat}") for cat in cats]
    return df.select(*cols)


# --------------------------------------------------------------- split ---

def split_hash(df: DataFrame, key: str, train_fraction: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """T1 default: sticky per-key split, map-only, independent of partitioning; rows without a key are tested on."""
    u = F.coalesce(uniform(F.col(key), f"split|{seed}"), F.lit(1.0))
    return df.where(u < F.lit(train_fraction)), df.where(u >= F.lit(train_fraction))


def kth_smallest(df: DataFrame, key: str, k: int, buckets: int = 64):
    """Exact k-th smallest (1-based) value of ``key``, of any orderable type, distributed.

    Rows are counted per distinct key.  Each round deals the keys that are left into
    range partitions, counts rows per partition and goes on with the keys of the
    one that holds position k, until that is a single key.  Only one row per
    partition reaches the driver.  All sizes go this way.
    """
    ensure_checkpoint_dir(df.sparkSession)
    keys = (df.select(F.col(key).alias("k")).where(F.col("k").isNotNull())
            .groupBy("k").agg(F.count(F.lit(1)).alias("n")).checkpoint())
    remaining = k
    while True:
        parts = (keys.repartitionByRange(max(2, buckets), "k").withColumn("part", F.spark_partition_id())
                 .groupBy("part").agg(F.sum("n").alias("n"), F.min("k").alias("mn"), F.max("k").alias("mx"))
                 .orderBy("part").collect())
        if remaining < 1 or sum(p["n"] for p in parts) < remaining:
            raise ValueError("k is out of range")
        for p in parts:
            if p["n"] >= remaining:
                break
            remaining -= p["n"]
        if p["mn"] == p["mx"] or p["mn"] != p["mn"]:  # one key; NaN equals no key, itself included
            return p["mn"]
        keys = keys.where((F.col("k") >= F.lit(p["mn"])) & (F.col("k") <= F.lit(p["mx"])))


def split_prefix(df: DataFrame, key: str, train_fraction: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """T1 reference mode: first ``int(fraction * n)`` rows in key order train.

    Implemented as a cut value found by distributed selection, then two
    map-only filters; ``key`` must be unique.  Rows without a key come after
    all others, so they are tested on.
    """
    n, keyed = df.agg(F.count(F.lit(1)), F.count(key)).first()
    k = min(int(n * train_fraction), keyed)
    if k <= 0:
        return df.where(F.lit(False)), df
    cut = kth_smallest(df, key, k)
    train = F.coalesce(F.col(key) <= F.lit(cut), F.lit(False))
    return df.where(train), df.where(~train)


# --------------------------------------------------------------- align ---

def typed_zero(dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return F.lit("0")
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    return F.lit(0).cast(dtype)


def align_features(df: DataFrame, expected: T.StructType, strict: bool = False) -> DataFrame:
    """Reorder to the model's columns; absent ones become a typed zero.

    ``strict=True`` raises listing the absent columns instead (serving check).
    Extra columns (e.g. an id) are carried after the features.
    """
    have = set(df.columns)
    missing = [f.name for f in expected.fields if f.name not in have]
    if strict and missing:
        raise ValueError(f"Missing feature columns: {missing}")
    feats = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have else typed_zero(f.dataType).alias(f.name)
             for f in expected.fields]
    extra = [F.col(c) for c in df.columns if c not in {f.name for f in expected.fields}]
    return df.select(*extra, *feats)


def parse_records(df: DataFrame, payload: str, schema: T.StructType, request_id: str) -> DataFrame:
    """JSON object or array-of-objects payloads -> one row per record.

    Malformed payloads (and valid JSON of another shape) give one row with
    ``error`` set and NULL fields; they never fail the job (V6).
    """
    v = F.try_parse_json(F.col(payload))  # parse once; NULL when malformed
    arr = F.try_variant_get(v, "$", T.ArrayType(schema).simpleString())
    obj = F.try_variant_get(v, "$", schema.simpleString())
    valid = v.isNotNull()
    records = F.when(arr.isNotNull(), arr).when(obj.isNotNull(), F.array(obj))
    error = (F.when(~valid, F.lit("malformed JSON")).when(records.isNull(), F.lit("unsupported payload"))
             .when(F.size(records) == 0, F.lit("no records")))
    exploded = df.select(F.col(request_id), error.alias("error"),
                         F.posexplode_outer(records).alias("item_index", "_rec"))
    fields = [F.col("_rec").getField(f.name).alias(f.name) for f in schema.fields]
    return exploded.select(F.col(request_id),
                           F.coalesce(F.col("item_index"), F.lit(0)).cast("bigint").alias("item_index"), *fields,
                           "error")
