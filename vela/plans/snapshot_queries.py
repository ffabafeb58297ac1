"""Registered queries for snapshot tables.

Each query builds a fresh warehouse under the shared checkpoint folder,
commits snapshots generated from the driver tables, and returns a
DataFrame read back through the snapshot log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import generators as G
from ..sources import snapshots as S
from ..sources import tables as TB
from . import oracle as O
from .catalog import _doubles, register, round_doubles, rsql

CHURN = "demo.customer_churn"
FRAUD = "demo.credit_fraud"


def _catalog(spark: SparkSession) -> S.SnapshotCatalog:
    return S.SnapshotCatalog(spark, scratch_path(spark, "warehouse"), namespace="demo")


def _cust(spark, sf, version="1.0.0", seed=42, noise=0.5, ids=None) -> DataFrame:
    return G.customer_dataset(ids if ids is not None else TB.customer_ids(spark, sf), version, seed, noise)


def _csql(version="1.0.0", seed=42, noise=0.5, ids=O.CUSTOMER_IDS) -> str:
    return O.customer_sql(ids, version, seed, noise)


def _r(sql: str, version: str = "1.0.0") -> str:
    return rsql(sql, _doubles(G.CUSTOMER_COLUMNS[G.major(version)]))


def _props(kind, version, seed, noise, df) -> dict:
    return G.descriptor(kind, version, seed, noise, df.columns)


# ------------------------------------------------------------------ S14 ---
_RATES_SQL = " UNION ALL ".join(
    f"SELECT {sid}::bigint AS snapshot_id, ContractType, count(*) AS rows,"
    f" round(avg(cast(Churned AS integer)), 6) AS target_rate FROM ({_csql(v, s, n)}) GROUP BY ContractType"
    for sid, v, s, n in ((1, "1.0.0", 42, 0.5), (2, "2.0.0", 43, 0.8)))


@register("snapshot_rates", _RATES_SQL)
def snapshot_rates(spark: SparkSession, sf: str) -> DataFrame:
    cat = _catalog(spark)
    for v, seed, noise in (("1.0.0", 42, 0.5), ("2.0.0", 43, 0.8)):
        df = _cust(spark, sf, v, seed, noise)
        cat.write(df, CHURN, properties=_props("customer", v, seed, noise, df))
    return round_doubles(S.snapshot_rates(cat.read_all(CHURN), "Churned", ["ContractType"]))


# ------------------------------------------------------------- S1/S4/S8 ---
@register("snapshot_roundtrip", _r(_csql()))
def snapshot_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    cat = _catalog(spark)
    cat.create_table(CHURN, _cust(spark, sf))
    return round_doubles(cat.read(CHURN))


# ------------------------------------------------------------------- S2 ---
@register("snapshot_append", _r(f"{_csql()} UNION ALL {_csql(seed=43)}"))
def snapshot_append(spark: SparkSession, sf: str) -> DataFrame:
    cat = _catalog(spark)
    cat.write(_cust(spark, sf), CHURN)
    cat.write(_cust(spark, sf, seed=43), CHURN, mode="append")
    return round_doubles(cat.read(CHURN))


# ------------------------------------------------------------------- S5 ---
@register("snapshot_time_travel", _r(_csql()))
def snapshot_time_travel(spark: SparkSession, sf: str) -> DataFrame:
    cat = _catalog(spark)
    cat.write(_cust(spark, sf), CHURN)
    cat.write(_cust(spark, sf, "2.0.0", 43, 0.8), CHURN)
    return round_doubles(cat.read(CHURN, snapshot_id=1))


# ---------------------------------------------------------------- S6/S7 ---
_PF_SQL = (f"SELECT CustomerId, Tenure, round(MonthlyCharges, 6) AS MonthlyCharges, PaymentMethod"
           f" FROM ({_csql('3.0.0')}) WHERE Tenure > 24 AND PaymentMethod = 'Electronic check'")


@register("snapshot_projection_filter", _PF_SQL)
def snapshot_projection_filter(spark: SparkSession, sf: str) -> DataFrame:
    cat = _catalog(spark)
    cat.write(_cust(spark, sf, "3.0.0"), CHURN)
    return round_doubles(cat.read(CHURN, columns=["CustomerId", "Tenure", "MonthlyCharges", "PaymentMethod"],
                                  where="Tenure > 24 AND PaymentMethod = 'Electronic check'"))


# ------------------------------------------------------------------ S11 ---
_HIST_SQL = (
    "SELECT 'demo.customer_churn' AS table_identifier, 1::bigint AS snapshot_id, NULL::bigint AS parent_id,"
    " 'overwrite' AS operation, n AS row_count, n AS added_rows, false AS is_current FROM (SELECT count(*) n FROM customer)"
    " UNION ALL SELECT 'demo.customer_churn', 2, 1, 'append', 2 * n, n, false FROM (SELECT count(*) n FROM customer)"
    " UNION ALL SELECT 'demo.customer_churn', 3, 2, 'overwrite', n, n, true FROM (SELECT count(*) n FROM customer)")


@register("snapshot_history", _HIST_SQL)
def snapshot_history(spark: SparkSession, sf: str) -> DataFrame:
    cat = _catalog(spark)
    cat.write(_cust(spark, sf), CHURN)
    cat.write(_cust(spark, sf, seed=43), CHURN, mode="append")
    cat.write(_cust(spark, sf, "2.0.0", 43, 0.8), CHURN)
    return cat.history(CHURN).drop("committed_at")


# ------------------------------------------------------------------ S12 ---
def _stats_sql() -> str:
    cols = G.CREDIT_COLUMNS["3"]
    parts = [f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, count(*) AS row_count,"
             f" true AS has_files FROM ({O.credit_sql(O.ORDER_IDS, '3.0.0')})" for c in cols]
    return " UNION ALL ".join(parts)


@register("snapshot_stats", _stats_sql())
def snapshot_stats(spark: SparkSession, sf: str) -> DataFrame:
    cat = _catalog(spark)
    cat.write(G.credit_dataset(TB.order_ids(spark, sf), "3.0.0"), FRAUD)
    log = cat.committed().where(F.col("table_identifier") == FRAUD)
    return log.select(F.explode("null_counts").alias("column_name", "null_count"), "row_count",
                      ((F.col("added_files") > 0) & (F.col("added_bytes") > 0)).alias("has_files"))


# -------------------------------------------------------------- S14/J3 ---
_ORDERED_IDS = "SELECT DISTINCT o_custkey + 1 AS id FROM orders"
_DIFF_COLS = G.CUSTOMER_COLUMNS["1"][1:]
_DIFF_SQL = (
    f"WITH a AS ({_csql()}), b AS ({_csql(noise=0.8, ids=_ORDERED_IDS)}) "
    "SELECT coalesce(a.CustomerId, b.CustomerId) AS CustomerId, CASE WHEN a.CustomerId IS NULL THEN 'added'"
    " WHEN b.CustomerId IS NULL THEN 'removed' WHEN "
    + " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in _DIFF_COLS)
    + " THEN 'unchanged' ELSE 'changed' END AS change FROM a FULL OUTER JOIN b ON a.CustomerId = b.CustomerId")


@register("snapshot_diff", _DIFF_SQL)
def snapshot_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Customers at snapshot 1 vs. customers with orders re-scored at snapshot 2."""
    cat = _catalog(spark)
    cat.write(_cust(spark, sf), CHURN)
    ordered = TB.table(spark, sf, "orders").select((F.col("o_custkey") + 1).alias("id")).distinct()
    cat.write(_cust(spark, sf, noise=0.8, ids=ordered), CHURN)
    return S.snapshot_diff(cat.read(CHURN, snapshot_id=1), cat.read(CHURN, snapshot_id=2), ["CustomerId"])


# ------------------------------------------------------------------ S10 ---
_TABLES_SQL = (
    "SELECT 'demo.credit_fraud' AS table_identifier, 1::bigint AS current_snapshot_id, count(*) AS row_count FROM orders"
    " UNION ALL SELECT 'demo.customer_churn', 2::bigint, count(*) FROM customer")


@register("list_tables", _TABLES_SQL)
def list_tables(spark: SparkSession, sf: str) -> DataFrame:
    cat = _catalog(spark)
    cat.write(_cust(spark, sf), CHURN)
    cat.write(G.credit_dataset(TB.order_ids(spark, sf)), FRAUD)
    cat.write(_cust(spark, sf, "2.0.0", 43, 0.8), CHURN)
    return cat.list_tables()


# ------------------------------------------------------------------ S16 ---
def _evolved_sql() -> str:
    parts = []
    for sid, v in ((1, "1.0.0"), (2, "2.0.0"), (3, "3.0.0")):
        parts.append(f"SELECT *, {sid}::bigint AS snapshot_id FROM ({_r(_csql(v), v)})")
    return " UNION ALL BY NAME ".join(parts)


@register("evolved_union", _evolved_sql())
def evolved_union(spark: SparkSession, sf: str) -> DataFrame:
    cat = _catalog(spark)
    for v in ("1.0.0", "2.0.0", "3.0.0"):
        cat.write(_cust(spark, sf, v), CHURN)
    return round_doubles(cat.read_all(CHURN))


# ------------------------------------------------------------------ S17 ---
@register("snapshot_rollback", _r(_csql()))
def snapshot_rollback(spark: SparkSession, sf: str) -> DataFrame:
    cat = _catalog(spark)
    cat.write(_cust(spark, sf), CHURN)
    cat.write(_cust(spark, sf, "2.0.0", 43, 0.8), CHURN)
    cat.rollback(CHURN, 1)
    return round_doubles(cat.read(CHURN))


# ------------------------------------------------------------------ S18 ---
_PART_SQL = rsql(f"SELECT * FROM ({O.credit_sql(O.ORDER_IDS, '2.0.0')}) WHERE MerchantCategory = 'online'",
                 _doubles(G.CREDIT_COLUMNS["2"]))


@register("snapshot_partitioned", _PART_SQL)
def snapshot_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    cat = _catalog(spark)
    cat.write(G.credit_dataset(TB.order_ids(spark, sf), "2.0.0"), FRAUD, partition_by=["MerchantCategory"])
    return round_doubles(cat.read(FRAUD, where=F.col("MerchantCategory") == "online"))


# ------------------------------------------------------------------ S15 ---
_FAILED_SQL = ("SELECT 1::bigint AS snapshot_id, 'committed' AS status, count(*) AS row_count FROM customer"
               " UNION ALL SELECT 2::bigint, 'error', NULL::bigint")


@register("snapshot_failed_write", _FAILED_SQL)
def snapshot_failed_write(spark: SparkSession, sf: str) -> DataFrame:
    cat = _catalog(spark)
    cat.write(_cust(spark, sf), CHURN)
    bad = _cust(spark, sf, "2.0.0").withColumn(
        "Age", F.when(F.col("Age") >= 0, F.raise_error(F.lit("rejected row"))).otherwise(F.col("Age")))
    try:
        cat.write(bad, CHURN)
    except Exception:  # noqa: BLE001 - the failure is the point; it is logged
        pass
    return (cat.log().where(F.col("table_identifier") == CHURN)
            .select("snapshot_id", "status", "row_count"))


# -------------------------------------------------------------- P14/W5 ---
_SAMPLE_COLS = ["CustomerId", "Age", "Tenure", "ContractType", "Churned"]
_SAMPLE_SQL = (
    "SELECT snapshot_id, " + ", ".join(_SAMPLE_COLS) + " FROM (SELECT *, row_number() OVER (PARTITION BY snapshot_id"
    " ORDER BY CustomerId) AS rn FROM (" + " UNION ALL ".join(
        f"SELECT {sid}::bigint AS snapshot_id, {', '.join(_SAMPLE_COLS)} FROM ({_csql(v, s, n)})"
        for sid, v, s, n in ((1, "1.0.0", 42, 0.5), (2, "2.0.0", 43, 0.8))) + ")) WHERE rn <= 3")


@register("snapshot_sample", _SAMPLE_SQL)
def snapshot_sample(spark: SparkSession, sf: str) -> DataFrame:
    """First three rows of each snapshot by key (deterministic ``head(3)``), top-k per group."""
    cat = _catalog(spark)
    for v, seed, noise in (("1.0.0", 42, 0.5), ("2.0.0", 43, 0.8)):
        cat.write(_cust(spark, sf, v, seed, noise), CHURN)
    return S.sample_rows(cat.read_all(CHURN).select(*_SAMPLE_COLS, "snapshot_id"), ["snapshot_id"], ["CustomerId"], 3)


# ------------------------------------------------------------- L7/S12 ---
def _profile_sql(source: str, columns: list[str], numeric: set[str], table: str = "demo.credit_fraud", sid: int = 1) -> str:
    parts = []
    for c in columns:
        low, high = (f"round(cast({g}({c}) AS double), 6)" if c in numeric else "NULL::double" for g in ("min", "max"))
        # numbers are compared as numbers only: engines write doubles differently
        low_text, high_text = ("NULL::varchar" if c in numeric else f"cast({g}({c}) AS varchar)" for g in ("min", "max"))
        parts.append(f"SELECT '{table}' AS table_identifier, {sid}::bigint AS snapshot_id, count(*) AS row_count,"
                     f" '{c}' AS column_name, count(*) - count({c}) AS null_count, {low} AS min_value, {high} AS max_value,"
                     f" {low_text} AS min_text, {high_text} AS max_text FROM ({source})")
    return " UNION ALL ".join(parts)


def _profile(cat: S.SnapshotCatalog, table: str) -> DataFrame:
    """Profile of the current snapshot, the text of numbers left out."""
    log = cat.committed().where(F.col("table_identifier") == table)
    p = S.profile(log.orderBy(F.col("snapshot_id").desc()).limit(1)).drop("distinct_values")
    return round_doubles(p.withColumns({c: F.when(F.col("min_value").isNull(), F.col(c)) for c in ("min_text", "max_text")}))


_CREDIT_NUMBERS = {"Amount", "HourOfDay", "DayOfWeek", "Month", "DistanceFromHome", "DistanceFromLastTransaction",
                   "RatioToMedianPurchasePrice", "FraudSignals"}


@register("dataset_profile", _profile_sql(O.credit_sql(O.ORDER_IDS, "3.0.0"), G.CREDIT_COLUMNS["3"], _CREDIT_NUMBERS))
def dataset_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Row count, null count and range of every column, from the commit's statistics."""
    cat = _catalog(spark)
    cat.write(G.credit_dataset(TB.order_ids(spark, sf), "3.0.0"), FRAUD)
    return _profile(cat, FRAUD)


# ------------------------------------------------- S2, evolved and mixed ---
_EVENT_COLS = ["event_id", "ts", "event_type", "value"]
_EVOLVED_APPEND = ("SELECT event_id, ts, event_type, value, NULL::integer AS late, NULL::varchar AS note, NULL::double AS empty FROM events WHERE event_id % 3 > 0"
                   " UNION ALL SELECT event_id, ts, NULL, value, cast(event_id % 7 AS integer), concat('n', event_id % 11), NULL FROM events WHERE event_id % 3 = 0")


@register("snapshot_append_evolved", _profile_sql(_EVOLVED_APPEND, [*_EVENT_COLS, "late", "note", "empty"], {"event_id", "value", "late", "empty"}, "demo.events", 2)
          .replace("round(cast(min(empty) AS double), 6)", "NULL::double").replace("round(cast(max(empty) AS double), 6)", "NULL::double"))
def snapshot_append_evolved(spark: SparkSession, sf: str) -> DataFrame:
    """Profile after an append that lacks a column, adds two and has one without any value."""
    cat = _catalog(spark)
    ev = TB.table(spark, sf, "events").select(*_EVENT_COLS)
    cat.write(ev.where("event_id % 3 > 0"), "demo.events")
    more = ev.where("event_id % 3 = 0").drop("event_type").selectExpr(
        "*", "cast(event_id % 7 AS int) AS late", "concat('n', event_id % 11) AS note", "cast(NULL AS double) AS empty")
    cat.write(more, "demo.events", mode="append")
    return _profile(cat, "demo.events")


@register("snapshot_append_partitioned", "SELECT event_id, ts, event_type, value FROM events WHERE event_type = 'click' AND event_id % 2 = 0")
def snapshot_append_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """A filter over a table of three folders: unpartitioned, by event type, by event type and day."""
    cat = _catalog(spark)
    ev = TB.table(spark, sf, "events").select(*_EVENT_COLS)
    cat.write(ev.where("event_id % 3 = 0"), "demo.events")
    cat.write(ev.where("event_id % 3 = 1"), "demo.events", mode="append", partition_by=["event_type"])
    cat.write(ev.where("event_id % 3 = 2").withColumn("day", F.dayofmonth("ts")), "demo.events", mode="append", partition_by=["event_type", "day"])
    return cat.read("demo.events", columns=_EVENT_COLS, where="event_type = 'click' AND event_id % 2 = 0")


@register("snapshot_as_of", "SELECT count(*) AS rows, 1::bigint AS first_id FROM customer")
def snapshot_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """The table as of the first snapshot's commit, while a second one exists."""
    cat = _catalog(spark)
    cat.write(_cust(spark, sf), CHURN)
    cat.write(_cust(spark, sf, seed=43), CHURN, mode="append")
    first = cat.committed().where("snapshot_id = 1").first()["committed_at"]
    return cat.read(CHURN, as_of=first).agg(F.count(F.lit(1)).alias("rows")).withColumn("first_id", F.lit(1).cast("bigint"))


# ------------------------------------------------------------------ S13 ---
_SPARK_TYPE = ("CASE typeof({c}) WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'"
               " WHEN 'DOUBLE' THEN 'double' WHEN 'INTEGER' THEN 'integer' WHEN 'BOOLEAN' THEN 'boolean'"
               " WHEN 'BIGINT' THEN 'long' ELSE lower(typeof({c})) END")


def _schema_sql() -> str:
    src = O.credit_sql(O.ORDER_IDS, "3.0.0")
    return " UNION ALL ".join(
        f"SELECT DISTINCT 1::bigint AS snapshot_id, {i}::integer AS position, '{c}' AS column_name,"
        f" {_SPARK_TYPE.format(c=c)} AS data_type FROM ({src})"
        for i, c in enumerate(G.CREDIT_COLUMNS["3"]))


@register("snapshot_schema", _schema_sql())
def snapshot_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Schema recorded with each commit, as (position, column, type) rows."""
    cat = _catalog(spark)
    cat.write(G.credit_dataset(TB.order_ids(spark, sf), "3.0.0"), FRAUD)
    return S.schema_table(cat.committed().where(F.col("table_identifier") == FRAUD))


# ------------------------------------------------------------------- G9 ---
def _descriptor_sql() -> str:
    d = G.descriptor("customer", "1.0.0", 42, 0.5, G.CUSTOMER_COLUMNS["1"])
    rows = [f"SELECT '{k}' AS key, '{v}' AS value" for k, v in sorted(d.items())]
    rows.append("SELECT 'rows', cast(count(*) AS varchar) FROM customer")
    return " UNION ALL ".join(rows)


@register("dataset_descriptor", _descriptor_sql())
def dataset_descriptor(spark: SparkSession, sf: str) -> DataFrame:
    """Descriptor stored with the commit (name, version, features, target, params) plus its row count."""
    cat = _catalog(spark)
    df = _cust(spark, sf)
    cat.write(df, CHURN, properties=_props("customer", "1.0.0", 42, 0.5, df))
    log = cat.committed().where(F.col("table_identifier") == CHURN)
    props = log.select(F.explode("properties").alias("key", "value"))
    return props.unionByName(log.select(F.lit("rows").alias("key"), F.col("row_count").cast("string").alias("value")))
