"""Versioned tables as numbered Parquet snapshots plus an append-only log.

Layout under a warehouse folder (any Hadoop-compatible, shared path):

    <warehouse>/_snapshot_log/            one tiny Parquet file per commit
    <warehouse>/<namespace>/<table>/snapshot-00000001/   data of snapshot 1

A snapshot exists once its ``committed`` log row is visible; the data write
happens first (``errorifexists``), the log row last, so readers never see a
half-written snapshot.  ``append`` records the previous snapshot's folders
plus the new one, so no data is copied.  A failed write leaves an ``error``
row that every reader skips, and the error is re-raised.  One writer per
table; ids are ``max + 1`` from the log.

Statistics (rows, per-column nulls and ranges, distinct-value sketches where asked for) form a monoid: those of an append are merged with the
previous snapshot's over the union of the columns, a column that one side lacks counting as all NULL there.  Counts and the ranges of
numbers, booleans and dates are answered from the new files' Parquet footers (aggregate pushdown, in a session of its own, so the caller's
settings stay as they are); where footers cannot answer (strings, timestamps, decimals, files without any value) one scan of just
those columns does.  File count and bytes come from a listing of the new folder.

Every folder has its own partition spec, so a table may change its partitioning from one append to the next.
"""

from __future__ import annotations

import datetime as _dt
import json
import math
import traceback
from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..operators.lineage import WRITE_FACET

LOG_SCHEMA = T.StructType([
    T.StructField("table_identifier", T.StringType(), False),
    T.StructField("snapshot_id", T.LongType(), False),
    T.StructField("parent_id", T.LongType(), True),
    T.StructField("operation", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("committed_at", T.TimestampType(), False),
    T.StructField("data_dirs", T.ArrayType(T.StringType()), True),
    T.StructField("schema_json", T.StringType(), True),
    T.StructField("partition_cols", T.ArrayType(T.StringType()), True),
    T.StructField("row_count", T.LongType(), True),
    T.StructField("added_rows", T.LongType(), True),
    T.StructField("added_files", T.LongType(), True),
    T.StructField("added_bytes", T.LongType(), True),
    T.StructField("null_counts", T.MapType(T.StringType(), T.LongType()), True),
    T.StructField("properties", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("error", T.StringType(), True),
    T.StructField("min_values", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("max_values", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("sketches", T.MapType(T.StringType(), T.BinaryType()), True),
    T.StructField("dir_partitions", T.ArrayType(T.ArrayType(T.StringType())), True),
])
_FOOTER_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.BooleanType, T.DateType)
_SCAN_TYPES = (T.StringType, T.DecimalType, T.TimestampType, T.TimestampNTZType)
#: Mappings of file folders to snapshots are broadcast up to so many rows.
FOLDER_ROWS = 1_000_000


class Stats(NamedTuple):
    """Rows of a set of files and, per column, NULLs, range (as text) and sketch of the distinct values."""

    rows: int
    nulls: dict[str, int]
    low: dict[str, str | None]
    high: dict[str, str | None]
    sketches: dict[str, bytes]


def _order(type_: T.DataType):
    """Key that orders the text of a type's values as the type does."""
    if isinstance(type_, (T.FloatType, T.DoubleType)):
        return lambda text: (math.isnan(float(text)), float(text) if not math.isnan(float(text)) else 0.0)
    if isinstance(type_, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)):
        return Decimal
    return lambda text: text.encode()  # ISO dates and times, true after false


def merge_stats(spark: SparkSession, a: Stats, b: Stats, schema: T.StructType) -> Stats:
    """Statistics of both sets of files together; a column that one set lacks is all NULL there."""
    types = {f.name: f.dataType for f in schema.fields}
    columns = [c for c in types if c in a.nulls or c in b.nulls]

    def pick(best, x: dict, y: dict) -> dict:
        both = {c: [v for v in (x.get(c), y.get(c)) if v is not None] for c in columns}
        return {c: best(v, key=_order(types[c])) if v else None for c, v in both.items()}

    sketches = {**a.sketches, **b.sketches}
    shared = sorted(set(a.sketches) & set(b.sketches))
    if shared:
        pairs = spark.createDataFrame([(c, a.sketches[c], b.sketches[c]) for c in shared], "c string, x binary, y binary")
        sketches |= {r.c: bytes(r.s) for r in pairs.select("c", F.hll_union("x", "y").alias("s")).collect()}
    return Stats(a.rows + b.rows, {c: a.nulls.get(c, a.rows) + b.nulls.get(c, b.rows) for c in columns},
                 pick(min, a.low, b.low), pick(max, a.high, b.high), sketches)


def stats_of(row) -> Stats:
    """Statistics of a log row."""
    return Stats(row["row_count"] or 0, dict(row["null_counts"] or {}), dict(row["min_values"] or {}), dict(row["max_values"] or {}),
                 {c: bytes(v) for c, v in (row["sketches"] or {}).items()})


def dir_specs(row) -> list[tuple[str, tuple[str, ...]]]:
    """(folder, partition columns) of a log row's data."""
    dirs = list(row["data_dirs"] or [])
    specs = row["dir_partitions"] or [list(row["partition_cols"] or [])] * len(dirs)
    return [(d, tuple(p)) for d, p in zip(dirs, specs)]


class SnapshotNotFoundError(ValueError):
    """Table has no committed snapshot, or the requested one does not exist."""


def _split_identifier(identifier: str, default_ns: str) -> tuple[str, str]:
    if "." in identifier:
        ns, name = identifier.split(".", 1)
        return ns, name
    return default_ns, identifier


def _merge_schemas(old: T.StructType, new: T.StructType) -> T.StructType:
    """Append keeps every column: previous order first, new columns after; types must agree."""
    have = {f.name: f for f in old.fields}
    for f in new.fields:
        if f.name in have and have[f.name].dataType != f.dataType:
            raise ValueError(f"column {f.name!r} changes type on append: "
                             f"{have[f.name].dataType.simpleString()} -> {f.dataType.simpleString()}")
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in old.fields] +
                        [T.StructField(f.name, f.dataType, True) for f in new.fields if f.name not in have])


class SnapshotCatalog:
    """A warehouse of snapshot tables sharing one log."""

    def __init__(self, spark: SparkSession, warehouse: str, namespace: str = "default",
                 lineage=None):
        self.spark = spark
        self.warehouse = warehouse.rstrip("/")
        self.namespace = namespace
        self.log_path = f"{self.warehouse}/_snapshot_log"
        self.lineage = lineage

    # ------------------------------------------------------------ log ---
    def log(self) -> DataFrame:
        """Every log row (committed and error)."""
        if not self._exists(self.log_path):
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).parquet(self.log_path)

    def committed(self) -> DataFrame:
        return self.log().where(F.col("status") == "committed")

    def _append_log(self, row: dict) -> None:
        full = {f.name: row.get(f.name) for f in LOG_SCHEMA.fields}
        (self.spark.createDataFrame([full], LOG_SCHEMA).coalesce(1)
         .write.mode("append").parquet(self.log_path))

    def _exists(self, path: str) -> bool:
        jvm = getattr(self.spark, "_jvm", None)
        if jvm is None:  # Spark Connect: fall back to a listing through a read
            try:
                self.spark.read.parquet(path).schema
                return True
            except Exception:  # noqa: BLE001
                return False
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return bool(fs.exists(p))

    def _file_stats(self, path: str, schema: T.StructType, partition_cols: list[str], distinct: list[str]) -> Stats:
        """Statistics of the files of one folder."""
        meta = self.spark.newSession()  # aggregate pushdown is a feature of the V2 Parquet source; only this session reads by it
        meta.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        meta.conf.set("spark.sql.sources.useV1SourceList", ",".join(
            x for x in meta.conf.get("spark.sql.sources.useV1SourceList", "").split(",") if x.strip().lower() != "parquet"))
        footers = meta.read.schema(schema).parquet(path)
        data = [f for f in schema.fields if f.name not in partition_cols]
        counts = footers.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(f"`{f.name}`")).alias(f"n{k}") for k, f in enumerate(data)]).first()
        rows = counts["rows"]
        nulls = {f.name: rows - counts[f"n{k}"] for k, f in enumerate(data)}
        for c in partition_cols:  # prunes to the NULL partition's files, if any
            nulls[c] = footers.where(F.col(f"`{c}`").isNull()).count()
        valued = [f for f in schema.fields if nulls[f.name] < rows]
        low, high = {f.name: None for f in schema.fields}, {f.name: None for f in schema.fields}

        def ranges(df: DataFrame, fields: list[T.StructField]) -> None:
            aggs = [g(F.col(f"`{f.name}`")).cast("string").alias(f"{n}{k}") for k, f in enumerate(fields) for g, n in ((F.min, "lo"), (F.max, "hi"))]
            row = df.agg(*aggs).first() if aggs else None
            for k, f in enumerate(fields):
                low[f.name], high[f.name] = row[f"lo{k}"], row[f"hi{k}"]

        scan = [f for f in valued if isinstance(f.dataType, _SCAN_TYPES) or (f.name in partition_cols and isinstance(f.dataType, _FOOTER_TYPES))]
        footed = [f for f in valued if isinstance(f.dataType, _FOOTER_TYPES) and f.name not in partition_cols]
        try:
            ranges(footers, footed)
        except Exception:  # noqa: BLE001 - some file has no value of a column, so its footer has no range
            scan += footed
        plain = self.spark.read.schema(schema).option("basePath", path).parquet(path)
        ranges(plain, scan)
        found = plain.agg(*[F.hll_sketch_agg(F.col(f"`{c}`").cast("string")).alias(f"s{k}") for k, c in enumerate(distinct)]).first() if distinct else None
        return Stats(rows, nulls, low, high, {c: bytes(found[f"s{k}"]) for k, c in enumerate(distinct)})

    def _summary(self, path: str) -> tuple[int | None, int | None]:
        jvm = getattr(self.spark, "_jvm", None)
        if jvm is None:
            return None, None
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        it = fs.listFiles(p, True)
        n = size = 0
        while it.hasNext():
            st = it.next()
            name = st.getPath().getName()
            if name.startswith("_") or name.startswith("."):
                continue
            n += 1
            size += st.getLen()
        return n, size

    # --------------------------------------------------------- tables ---
    def identifier(self, table: str) -> str:
        ns, name = _split_identifier(table, self.namespace)
        return f"{ns}.{name}"

    def _table_dir(self, ident: str) -> str:
        ns, name = ident.split(".", 1)
        return f"{self.warehouse}/{ns}/{name}"

    def list_tables(self) -> DataFrame:
        """One row per table with a committed snapshot."""
        c = self.committed()
        return (c.groupBy("table_identifier")
                .agg(F.max("snapshot_id").alias("current_snapshot_id"),
                     F.max_by("row_count", "snapshot_id").alias("row_count")))

    def history(self, table: str) -> DataFrame:
        """Committed snapshots of a table in numeric id order, current flagged."""
        ident = self.identifier(table)
        w = Window.partitionBy("table_identifier")
        return (self.committed().where(F.col("table_identifier") == ident)
                .select("table_identifier", "snapshot_id", "parent_id", "operation", "committed_at",
                        "row_count", "added_rows",
                        (F.col("snapshot_id") == F.max("snapshot_id").over(w)).alias("is_current"))
                .orderBy("snapshot_id"))

    def _latest_row(self, ident: str, snapshot_id: int | None = None,
                    as_of: _dt.datetime | None = None):
        c = self.committed().where(F.col("table_identifier") == ident)
        if snapshot_id is not None:
            c = c.where(F.col("snapshot_id") == snapshot_id)
        if as_of is not None:
            c = c.where(F.col("committed_at") <= F.lit(as_of))
        rows = c.orderBy(F.col("snapshot_id").desc()).limit(1).collect()
        if not rows:
            what = f"snapshot {snapshot_id}" if snapshot_id is not None else "a committed snapshot"
            raise SnapshotNotFoundError(f"Table {ident} has no {what}")
        return rows[0]

    def _next_id(self, ident: str) -> tuple[int, object]:
        """Next id (max over all rows, failed ones included) and the current committed row, one job."""
        log = self.log().where(F.col("table_identifier") == ident)
        row = log.agg(F.max("snapshot_id").alias("m"),
                      F.max_by(F.struct(*log.columns),
                               F.when(F.col("status") == "committed", F.col("snapshot_id"))).alias("cur")).first()
        # A crash between the data write and the log commit leaves a folder with
        # no log row; never reuse its id.
        return max(row["m"] or 0, self._max_folder_id(ident)) + 1, row["cur"]

    def _max_folder_id(self, ident: str) -> int:
        jvm = getattr(self.spark, "_jvm", None)
        if jvm is None:
            return 0
        p = jvm.org.apache.hadoop.fs.Path(self._table_dir(ident))
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return 0
        ids = [0]
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if name.startswith("snapshot-") and name[9:].isdigit():
                ids.append(int(name[9:]))
        return max(ids)

    # ---------------------------------------------------------- write ---
    def write(self, df: DataFrame, table: str, mode: str = "overwrite",
              properties: dict[str, str] | None = None,
              partition_by: list[str] | None = None, distinct: list[str] | None = None) -> dict:
        """Commit ``df`` as a new snapshot (S1 overwrite, S2 append, S18 partitioned).

        Partitioned data is dealt by its partition columns first, large partitions to several tasks (rebalance), so a task does
        not open a file per partition.  ``distinct``: columns to sketch the distinct values of.  Whatever fails, the data
        write or what follows it, leaves an error row and ends the lineage run.
        """
        if mode not in ("overwrite", "append"):
            raise ValueError(f"unknown mode {mode!r}")
        ident = self.identifier(table)
        sid, current = self._next_id(ident)
        prev = current if mode == "append" else None
        path = f"{self._table_dir(ident)}/snapshot-{sid:08d}"
        partition_by = list(partition_by or [])
        base = {"table_identifier": ident, "snapshot_id": sid, "parent_id": current["snapshot_id"] if current else None,
                "operation": mode, "schema_json": df.schema.json(), "partition_cols": partition_by,
                "properties": {k: str(v) for k, v in (properties or {}).items()}}
        run = self.lineage.start(f"write_{ident}", inputs=[], facets={"mode": mode}) if self.lineage is not None else None
        try:
            schema = df.schema if prev is None else _merge_schemas(T.StructType.fromJson(json.loads(prev["schema_json"])), df.schema)
            writer = (df.hint("rebalance", *partition_by) if partition_by else df).write.mode("errorifexists")
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            writer.parquet(path)
            added = self._file_stats(path, df.schema, partition_by, list(distinct or []))
            files, size = self._summary(path)
            total = added if prev is None else merge_stats(self.spark, stats_of(prev), added, schema)
            dirs = [*(dir_specs(prev) if prev is not None else []), (path, tuple(partition_by))]
            self._append_log({**base, "status": "committed", "committed_at": _dt.datetime.now(), "schema_json": schema.json(),
                              "data_dirs": [d for d, _ in dirs], "dir_partitions": [list(p) for _, p in dirs], "row_count": total.rows,
                              "added_rows": added.rows, "added_files": files, "added_bytes": size, "null_counts": total.nulls,
                              "min_values": total.low, "max_values": total.high, "sketches": total.sketches})
        except Exception as exc:
            try:
                self._append_log({**base, "status": "error", "committed_at": _dt.datetime.now(), "error": "".join(
                    traceback.format_exception_only(type(exc), exc)).strip()})
            finally:
                if run is not None:
                    self.lineage.fail(run, exc)
            raise
        if run is not None:
            self.lineage.complete(run, outputs=[f"snapshot://{ident}"], facets={WRITE_FACET: {
                "table_identifier": ident, "mode": mode, "count": added.rows, "snapshot_id": sid,
                "schema": [{"name": f.name, "type": f.dataType.simpleString()} for f in df.schema.fields]}})
        return {"table_identifier": ident, "snapshot_id": sid, "path": path, "row_count": total.rows,
                "added_rows": added.rows, "files": files, "bytes": size, "status": "committed"}

    def create_table(self, table: str, df: DataFrame, properties: dict[str, str] | None = None) -> dict:
        """S3: create (or replace) a table from a DataFrame."""
        return self.write(df, table, "overwrite", properties)

    def rollback(self, table: str, snapshot_id: int) -> dict:
        """Commit a new snapshot that points at an older one's data."""
        ident = self.identifier(table)
        target = self._latest_row(ident, snapshot_id=snapshot_id)
        sid, prev = self._next_id(ident)
        self._append_log({
            "table_identifier": ident, "snapshot_id": sid,
            "parent_id": prev["snapshot_id"] if prev else None, "operation": "rollback",
            "status": "committed", "committed_at": _dt.datetime.now(),
            "data_dirs": list(target["data_dirs"]), "schema_json": target["schema_json"],
            "partition_cols": list(target["partition_cols"] or []), "row_count": target["row_count"],
            "added_rows": 0, "added_files": 0, "added_bytes": 0, "null_counts": target["null_counts"],
            "min_values": target["min_values"], "max_values": target["max_values"], "sketches": target["sketches"],
            "dir_partitions": [list(p) for _, p in dir_specs(target)],
            "properties": {**(target["properties"] or {}), "rollback_to": str(snapshot_id)}})
        return {"table_identifier": ident, "snapshot_id": sid, "rollback_to": snapshot_id}

    # ----------------------------------------------------------- read ---
    def read(self, table: str, snapshot_id: int | None = None, as_of: _dt.datetime | None = None,
             columns: list[str] | None = None, where: str | Column | None = None) -> DataFrame:
        """S4 latest / S5 time travel / S6 projection / S7 pushed-down filter."""
        ident = self.identifier(table)
        row = self._latest_row(ident, snapshot_id, as_of)
        schema = T.StructType.fromJson(json.loads(row["schema_json"]))
        df = None
        for one in self._scans(dir_specs(row), schema):
            one = one.select(*[f"`{c}`" for c in schema.fieldNames()])
            df = one if df is None else df.unionByName(one)
        if where is not None:
            df = df.where(where)
        if columns is not None:
            df = df.select(*columns)
        return df

    def _scans(self, dirs: list[tuple[str, tuple[str, ...]]], schema: T.StructType) -> list[DataFrame]:
        """One scan of all unpartitioned folders, and one, with its own partition pruning, of each partitioned folder."""
        flat = [d for d, parts in dirs if not parts]
        out = [self.spark.read.schema(schema).parquet(*flat)] if flat else []
        return out + [self.spark.read.schema(schema).option("basePath", d).parquet(d) for d, parts in dirs if parts]

    def read_all(self, table: str, snapshot_ids: list[int] | None = None, tag: str = "snapshot_id") -> DataFrame:
        """The rows of many snapshots (by default all), each with its snapshot's id, evolved schemas merged.

        Every folder is read once, however many snapshots hold it: the file's path tells the folder, a table of (folder, snapshot)
        the snapshots.  The number of scans does not grow with the number of snapshots.
        """
        ident = self.identifier(table)
        log = self.committed().where(F.col("table_identifier") == ident)
        if snapshot_ids is not None:
            log = log.where(F.col("snapshot_id").isin([int(i) for i in snapshot_ids]))
        rows = log.orderBy("snapshot_id").collect()
        if not rows or (snapshot_ids is not None and len(rows) < len(set(snapshot_ids))):
            raise SnapshotNotFoundError(f"Table {ident} lacks some of the snapshots {snapshot_ids}")
        schema = T.StructType.fromJson(json.loads(rows[0]["schema_json"]))
        for row in rows[1:]:
            schema = _merge_schemas(schema, T.StructType.fromJson(json.loads(row["schema_json"])))
        held = [(d.rsplit("/", 1)[1], row["snapshot_id"]) for row in rows for d, _ in dir_specs(row)]
        of = self.spark.createDataFrame(held, f"_folder string, `{tag}` bigint")
        of = F.broadcast(of) if len(held) <= FOLDER_ROWS else of
        folder = F.regexp_extract("_metadata.file_path", r"/(snapshot-\d{8,})/", 1).alias("_folder")
        out = None
        for one in self._scans(sorted({s for row in rows for s in dir_specs(row)}), schema):
            one = one.select(*[f"`{c}`" for c in schema.fieldNames()], folder)
            out = one if out is None else out.unionByName(one)
        return out.join(of, "_folder").drop("_folder")

    def snapshot_ids(self, table: str) -> list[int]:
        ident = self.identifier(table)
        return [r["snapshot_id"] for r in self.committed().where(F.col("table_identifier") == ident)
                .select("snapshot_id").orderBy("snapshot_id").collect()]


# ------------------------------------------------------------ analytics ---

def tagged_union(frames: dict[int, DataFrame], tag: str = "snapshot_id") -> DataFrame:
    """Union snapshots with evolved schemas, tagged by their id."""
    out = None
    for sid, df in frames.items():
        t = df.withColumn(tag, F.lit(sid).cast("bigint"))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out


def profile(log_row_df: DataFrame) -> DataFrame:
    """One row per column: nulls, range as text and, for numbers, as numbers, and the estimated distinct values, from the commit record."""
    types = F.map_from_entries(F.transform(F.from_json("schema_json", "struct<fields: array<struct<name: string, type: variant>>>").getField("fields"),
                                           lambda f: F.struct(f["name"], F.try_variant_get(f["type"], "$", "string"))))
    row = log_row_df.select("table_identifier", "snapshot_id", "row_count", F.explode("null_counts").alias("column_name", "null_count"),
                            "min_values", "max_values", "sketches", types.alias("types"))
    numeric = F.col("types")[F.col("column_name")].rlike("^(byte|short|integer|long|float|double|decimal.*)$")
    low, high = (F.col(c)[F.col("column_name")] for c in ("min_values", "max_values"))
    return row.select("table_identifier", "snapshot_id", "row_count", "column_name", "null_count", low.alias("min_text"), high.alias("max_text"),
                      F.when(numeric, low.try_cast("double")).alias("min_value"), F.when(numeric, high.try_cast("double")).alias("max_value"),
                      F.hll_sketch_estimate(F.col("sketches")[F.col("column_name")]).alias("distinct_values"))


def schema_table(log_rows: DataFrame) -> DataFrame:
    """The schema recorded with each commit as (snapshot_id, position, column_name, data_type)."""
    fields = F.from_json("schema_json", "struct<fields: array<struct<name: string, type: string>>>")
    return log_rows.select("snapshot_id", F.posexplode(fields.getField("fields")).alias("position", "f")).select(
        "snapshot_id", "position", F.col("f.name").alias("column_name"), F.col("f.type").alias("data_type"))


def sample_rows(df: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    """First ``n`` rows per group in key order (a per-group top-k, limited map-side)."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def snapshot_rates(tagged: DataFrame, target: str, by: list[str] | None = None) -> DataFrame:
    """Row count and target rate per snapshot (and optional grouping) of ``read_all``."""
    return tagged.groupBy("snapshot_id", *(by or [])).agg(F.count(F.lit(1)).alias("rows"), F.avg(F.col(target).cast("int")).alias("target_rate"))


def snapshot_diff(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Per-key change type between two snapshots (full outer equi-join).

    Columns compared are those present in both; NULL-safe equality.
    """
    common = [c for c in old.columns if c in new.columns and c not in key]
    o = old.select(*key, F.struct(*common).alias("_o"), F.lit(True).alias("_in_old"))
    n = new.select(*key, F.struct(*common).alias("_n"), F.lit(True).alias("_in_new"))
    j = o.join(n, key, "full_outer")
    change = (F.when(F.col("_in_old").isNull(), F.lit("added"))
              .when(F.col("_in_new").isNull(), F.lit("removed"))
              .when(F.col("_o").eqNullSafe(F.col("_n")), F.lit("unchanged"))
              .otherwise(F.lit("changed")))
    return j.select(*key, change.alias("change"))
