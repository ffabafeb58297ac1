"""Lineage analytics over run events.

Events follow the open run-event shape: ``eventType``, ``eventTime``,
``run.runId``, ``job{namespace,name,facets}``, ``inputs[]``, ``outputs[]``,
``producer``; facets are open-ended nested values and stay VARIANT until a path or
their fields are asked for.  Everything here is a
Spark job over a (possibly huge) event table:

* ingestion reads JSON lines with a fixed schema, routes bad lines to an
  error column, and drops replayed duplicates;
* run state is a ``max_by`` fold per run id;
* the graph is kept bipartite (dataset -> run -> dataset) so no
  inputs x outputs product is ever materialised; closure walks it with a
  frontier loop (join, distinct, anti-join against what was reached),
  checkpointing each round into the shared checkpoint folder.
"""

from __future__ import annotations

import datetime as _dt
import json
import traceback
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .reach import reach
from .sequence import next_within
from .versions import version_key

FACETS = T.VariantType()
DATASET = T.StructType([
    T.StructField("namespace", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("facets", FACETS)])
RAW_EVENT = T.StructType([
    T.StructField("eventType", T.StringType()),
    T.StructField("eventTime", T.StringType()),
    T.StructField("run", T.StructType([T.StructField("runId", T.StringType())])),
    T.StructField("job", T.StructType([T.StructField("namespace", T.StringType()),
                                       T.StructField("name", T.StringType()),
                                       T.StructField("facets", FACETS)])),
    T.StructField("inputs", T.ArrayType(DATASET)),
    T.StructField("outputs", T.ArrayType(DATASET)),
    T.StructField("producer", T.StringType()),
    T.StructField("_corrupt_record", T.StringType()),
])
TERMINAL = ("COMPLETE", "FAIL", "ABORT")

# Names in the events of existing logs.
ENVELOPE = ("_producer", "_schemaURL")  # in every facet, no part of its value
WRITE_FACET = "iceberg_write_info"  # table_identifier, mode, schema, count, catalog
READ_FACET = "iceberg_read_info"  # table_identifier, filter, selected_fields, snapshot_id, catalog
ALL_FIELDS = "all fields"  # selected_fields of an unprojected read


_TYPED = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("event_type", T.StringType()), T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("job_namespace", T.StringType()), T.StructField("job_name", T.StringType()), T.StructField("job_facets", FACETS),
    T.StructField("inputs", T.ArrayType(DATASET)), T.StructField("outputs", T.ArrayType(DATASET)), T.StructField("producer", T.StringType())])


# ------------------------------------------------------------ ingestion ---

def typed_events(raw: DataFrame) -> DataFrame:
    """L1: raw DM9 rows -> flat typed table; bad lines keep ``error`` set."""
    # an instant as UTC wall clock; without an offset the time is UTC already; malformed times are NULL
    zoned = F.col("eventTime").rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    instant = F.try_to_timestamp(F.when(zoned, F.col("eventTime")).otherwise(F.concat(F.col("eventTime"), F.lit("Z"))))
    t = F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    bad = F.col("_corrupt_record").isNotNull() | F.col("run.runId").isNull() | F.col("eventType").isNull() | t.isNull()
    return raw.select(
        F.col("run.runId").alias("run_id"), F.col("eventType").alias("event_type"), t.alias("event_time"),
        F.col("job.namespace").alias("job_namespace"), F.col("job.name").alias("job_name"),
        F.col("job.facets").alias("job_facets"),
        F.coalesce(F.col("inputs"), F.array().cast(T.ArrayType(DATASET))).alias("inputs"),
        F.coalesce(F.col("outputs"), F.array().cast(T.ArrayType(DATASET))).alias("outputs"),
        F.col("producer"),
        F.when(bad, F.coalesce(F.col("_corrupt_record"), F.lit("missing required field"))).alias("error"))


_LINES = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}


def parse_events(lines: DataFrame, column: str = "value") -> DataFrame:
    """L1: JSON lines in a column -> typed events, duplicates (run, type, time) dropped."""
    return dedupe(typed_events(lines.select(F.from_json(F.col(column), RAW_EVENT, _LINES).alias("e")).select("e.*")))


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """L1 batch: JSON lines of a folder -> typed events, duplicates (run, type, time) dropped."""
    return dedupe(typed_events(spark.read.schema(RAW_EVENT).options(**_LINES).json(path)))


def _raw_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(RAW_EVENT).options(**_LINES).json(path)


def read_bad_events_stream(spark: SparkSession, path: str) -> DataFrame:
    """The lines that the event stream leaves out, each with its ``error``."""
    return typed_events(_raw_stream(spark, path)).where(F.col("error").isNotNull())


def phase() -> F.Column:
    """Order of events of equal time: START first, terminal events last."""
    return (F.when(F.col("event_type") == "START", 0).when(F.col("event_type").isin(*TERMINAL), 2).otherwise(1))


def _day() -> Column:
    return F.to_date("event_time").cast("string").alias("day")


def ingest_stream(spark: SparkSession, path: str, sink: str, checkpoint: str) -> StreamingQuery:
    """L1 streaming twin: every good event of a growing folder once, however late or often it comes.

    Each batch writes a folder of its own, partitioned by event day, of the events that no other batch wrote: an anti-join on
    (run, type, time) with the folders of the batch's days alone.  No state is kept between batches and no watermark drops
    anything; a batch that is run again leaves its own folder out and writes it anew, so restarts change nothing.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        key = ["run_id", "event_type", "event_time"]
        new = batch.dropDuplicates(key).withColumn("day", _day())
        folders = f"{sink}/events"
        before = ingested(spark, sink, exclude=batch_id)
        if before is not None:
            days = [r.day for r in new.select("day").distinct().collect()]  # days of one batch: a handful
            new = new.join(before.where(F.col("day").isin(days)).select(*key), key, "left_anti")
        new.write.mode("overwrite").partitionBy("day").parquet(f"{folders}/batch_id={batch_id}")

    good = typed_events(_raw_stream(spark, path)).where(F.col("error").isNull()).drop("error")
    return good.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingested(spark: SparkSession, sink: str, exclude: int | None = None) -> DataFrame | None:
    """The events of all batches of ``ingest_stream`` (``exclude``: but those of one); None before the first one."""
    base = f"{sink}/events"
    p = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p) or not any(x.getPath().getName() != f"batch_id={exclude}" for x in fs.listStatus(p)):
        return None
    schema = T.StructType([f for f in _TYPED.fields] + [T.StructField("batch_id", T.LongType()), T.StructField("day", T.StringType())])
    found = spark.read.schema(schema).parquet(base)
    return found if exclude is None else found.where(F.col("batch_id") != exclude)


def dedupe(ev: DataFrame) -> DataFrame:
    """Good events once per (run, type, time) and every bad line, in one pass over the parsed lines: a number of its own keeps a bad line apart."""
    own = F.when(F.col("error").isNotNull(), F.monotonically_increasing_id())
    return ev.withColumn("_own", own).dropDuplicates(["run_id", "event_type", "event_time", "_own"]).drop("_own")


# ---------------------------------------------------------------- runs ---

def runs(ev: DataFrame) -> DataFrame:
    """L2: one row per run: job, start, end, final status, duration, error."""
    good = ev.where(F.col("error").isNull())
    o = F.struct("event_time", phase().alias("phase"), "event_type")
    is_term = F.col("event_type").isin(*TERMINAL)
    return good.groupBy("run_id").agg(
        F.max("job_namespace").alias("job_namespace"), F.max("job_name").alias("job_name"),
        F.min(F.when(F.col("event_type") == "START", F.col("event_time"))).alias("started_at"),
        F.max(F.when(is_term, F.col("event_time"))).alias("ended_at"),
        F.max_by("event_type", o).alias("status"),
        F.max_by(bare_or("job_facets", "errorMessage", "message"), F.when(F.col("event_type") == "FAIL", o))
        .alias("error_message"),
        F.count(F.lit(1)).alias("events")).withColumn(
        "duration_s", F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("ended_at")) / F.lit(1e6))


def repair_split_runs(ev: DataFrame) -> DataFrame:
    """L3: pair each START with the next event of the same job if terminal.

    For logs whose terminal events carry a different run id than their
    START (a known emitter bug).  Returns (start_run_id, end_run_id, job,
    status, started_at, ended_at).
    """
    good = ev.where(F.col("error").isNull()).select("job_namespace", "job_name", "run_id", "event_type",
                                                    "event_time")
    # lead(...) over (partition by job order by event_time, run_id), split by time bucket so a
    # job holding most events does not become one task
    nxt = next_within(good, ["job_namespace", "job_name"], "event_time", ["run_id"],
                      ["event_type", "run_id", "event_time"])
    nxt = nxt.withColumnRenamed("next_event_type", "next_type").withColumnRenamed(
        "next_run_id", "next_run").withColumnRenamed("next_event_time", "next_time")
    return nxt.where((F.col("event_type") == "START") & F.col("next_type").isin(*TERMINAL)).select(
        F.col("run_id").alias("start_run_id"), F.col("next_run").alias("end_run_id"), "job_namespace", "job_name",
        F.col("next_type").alias("status"), F.col("event_time").alias("started_at"),
        F.col("next_time").alias("ended_at"))


def run_io(ev: DataFrame) -> DataFrame:
    """L4: distinct (run, side, namespace, name, latest facets) over all events."""
    good = ev.where(F.col("error").isNull())
    side = good.select("run_id", "event_time", phase().alias("phase"), F.explode(F.array(
        F.struct(F.lit("input").alias("side"), F.col("inputs").alias("ds")),
        F.struct(F.lit("output").alias("side"), F.col("outputs").alias("ds")))).alias("s"))
    flat = side.select("run_id", "event_time", "phase", F.col("s.side").alias("side"), F.explode("s.ds").alias("d"))
    order = F.struct("event_time", "phase", F.to_json("d.facets"))  # repeatable for equal times
    return flat.groupBy("run_id", "side", F.col("d.namespace").alias("namespace"), F.col("d.name").alias("name")).agg(
        F.max_by(F.col("d.facets"), order).alias("facets"))


# -------------------------------------------------------------- facets ---

def at(facets, path: str, type_: str = "string") -> Column:
    """The value at a path of nested facets; NULL if there is none or it is of another type."""
    return F.try_variant_get(facets, f"$.{path}", type_)


def fields(value) -> Column:
    """Fields of a nested value as map<string, variant>; NULL if it is no object."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def text(value) -> Column:
    """A nested value as text: scalars plainly, objects and arrays as JSON."""
    return F.try_variant_get(value, "$", "string")


def bare_or(facets, name: str, inner: str) -> Column:
    """A facet written either as an object with the field ``inner`` or as the bare value itself."""
    return F.coalesce(at(facets, f"{name}.{inner}"), F.when(at(facets, name, "map<string,variant>").isNull(), at(facets, name)))


def latest_job_facets(ev: DataFrame) -> DataFrame:
    """(run_id, facet, value VARIANT); a later event's facet replaces the earlier one as a whole."""
    good = ev.where(F.col("error").isNull())
    kv = good.select("run_id", "event_time", "event_type", F.explode(fields("job_facets")).alias("facet", "value"))
    return kv.groupBy("run_id", "facet").agg(
        F.max_by("value", F.struct("event_time", phase().alias("phase"), "event_type", F.to_json("value"))).alias("value"))


def job_facets(ev: DataFrame) -> DataFrame:
    """L5, long form: (run_id, facet, field, value) of the latest facets; a facet that is no object has the one field ``value``."""
    inner = F.coalesce(fields("value"), F.create_map(F.lit("value"), F.col("value")))
    kv = latest_job_facets(ev).select("run_id", "facet", F.explode(inner).alias("field", "v"))
    return kv.where(~F.col("field").isin(*ENVELOPE)).select("run_id", "facet", "field", text("v").alias("value"))


def dataset_kind(name_col) -> F.Column:
    """DM10: dataset kind from the name prefix (``model://x`` -> ``model``)."""
    c = F.col(name_col) if isinstance(name_col, str) else name_col
    return F.when(c.contains("://"), F.split(c, "://").getItem(0)).otherwise(F.lit("dataset"))


def is_virtual() -> Column:
    """Outputs that stand for a result nobody stored."""
    return F.coalesce(at("facets", "virtual.isVirtual", "boolean"), F.lit(False))


def dataset_details(io: DataFrame) -> DataFrame:
    """One row per run and written dataset with what its facets say."""
    return io.where((F.col("side") == "output") & ~is_virtual()).select(
        "run_id", "namespace", "name", bare_or("facets", "version", "version").alias("version"),
        at("facets", "dataSource.uri").alias("uri"), at("facets", "documentation.description").alias("description"),
        at("facets", "datasetProperties.properties.format").alias("format"),
        at("facets", "datasetProperties.properties.snapshot_id").alias("snapshot_id"), "facets")


def dataset_versions(io: DataFrame) -> DataFrame:
    """Per written dataset: distinct versions, latest version, format, place and number of descriptions."""
    return dataset_details(io).groupBy("name").agg(
        F.count_distinct("version").alias("versions"), F.max_by("version", F.struct(version_key("version"), "version")).alias("max_version"),
        F.max("format").alias("format"), F.max("uri").alias("uri"), F.count_distinct("snapshot_id").alias("snapshots"),
        F.count("description").alias("described"))


def dataset_columns(io: DataFrame) -> DataFrame:
    """Distinct (name, version, column_name, data_type) of the schema facets of written datasets."""
    listed = F.try_variant_get("facets", "$.schema.fields", "array<struct<name:string,type:string>>")
    return (dataset_details(io).select("name", "version", F.explode(listed).alias("f"))
            .select("name", "version", F.col("f.name").alias("column_name"), F.col("f.type").alias("data_type")).distinct())


def model_facets(io: DataFrame) -> DataFrame:
    """(model, version, run_id, kind, key, value): metrics, hyperparameters and properties of written models.

    Models come with one nested ``model`` facet or with bare facets (``metrics``, ``model_type``, ``feature_count``)."""
    empty = F.create_map().cast("map<string,variant>")

    def kind(name: str, values: Column) -> Column:
        return F.transform(F.map_entries(F.coalesce(values, empty)),
                           lambda e: F.struct(F.lit(name).alias("kind"), e["key"].alias("key"), text(e["value"]).alias("value")))

    prop = [F.struct(F.lit("property").alias("kind"), F.lit(key).alias("key"), value.alias("value"))
            for key, value in (("type", F.coalesce(at("facets", "model.type"), at("facets", "model_type"))), ("feature_count", at("facets", "feature_count")))]
    rows = F.concat(kind("metric", F.coalesce(at("facets", "model.metrics", "map<string,variant>"), at("facets", "metrics", "map<string,variant>"))),
                    kind("hyperparameter", at("facets", "model.hyperparams", "map<string,variant>")), F.array(*prop))
    models = dataset_details(io).where(dataset_kind("name") == "model")
    return (models.select(F.col("name").alias("model"), "version", "run_id", F.explode(rows).alias("r"))
            .select("model", "version", "run_id", "r.*").where(F.col("value").isNotNull()))


def run_kinds(ev: DataFrame, io: DataFrame, all_runs: DataFrame) -> DataFrame:
    """Generation (outputs only) / transformation (both) / sink / other, and the rows that the runs' write facets count."""
    sides = io.groupBy("run_id").agg(
        F.count_if(F.col("side") == "input").alias("n_in"), F.count_if(F.col("side") == "output").alias("n_out"))
    written = table_writes(ev).groupBy("run_id").agg(F.sum("rows").alias("rows"))
    r = all_runs.select("run_id").join(sides, "run_id", "left").join(written, "run_id", "left")
    kind = (F.when((F.coalesce("n_in", F.lit(0)) == 0) & (F.col("n_out") > 0), "generation")
            .when((F.col("n_in") > 0) & (F.col("n_out") > 0), "transformation")
            .when(F.col("n_in") > 0, "sink").otherwise("no_io"))
    return r.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("runs"),
                                             F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_written"))


def facets_by_phase(ev: DataFrame, run_ids: DataFrame) -> DataFrame:
    """L10-L12 pattern: START facets and terminal facets side by side per run."""
    good = ev.where(F.col("error").isNull()).join(run_ids, "run_id", "left_semi")
    o = F.struct("event_time", phase().alias("phase"), "event_type", F.to_json("job_facets"))
    return good.groupBy("run_id").agg(
        F.max("job_name").alias("job_name"),
        F.max_by("job_facets", F.when(F.col("event_type") == "START", o)).alias("start_facets"),
        F.max_by("job_facets", F.when(F.col("event_type").isin(*TERMINAL), o)).alias("end_facets"),
        F.max_by("event_type", o).alias("status"),
        F.max(F.when(F.col("event_type").isin(*TERMINAL), F.col("event_time"))).alias("ended_at"))


def table_writes(ev: DataFrame) -> DataFrame:
    """(run_id, table_identifier, mode, rows) of the latest write facet of each run."""
    w = latest_job_facets(ev).where(F.col("facet") == WRITE_FACET)
    return w.select("run_id", at("value", "table_identifier").alias("table_identifier"), at("value", "mode").alias("mode"),
                    at("value", "count", "bigint").alias("rows"))


def table_reads(ev: DataFrame) -> DataFrame:
    """(run_id, table_identifier, filter, selected, snapshot_id); ``selected`` is NULL for a read of all fields."""
    r = latest_job_facets(ev).where(F.col("facet") == READ_FACET)
    return r.select("run_id", at("value", "table_identifier").alias("table_identifier"), at("value", "filter").alias("filter"),
                    at("value", "selected_fields", "array<string>").alias("selected"), at("value", "snapshot_id", "bigint").alias("snapshot_id"))


_WORDS = ("and", "or", "not", "in", "is", "null", "like", "ilike", "rlike", "between", "true", "false", "case", "when", "then", "else", "end", "cast", "as", "escape", "date", "timestamp")


def filter_columns(filter_: Column) -> Column:
    """Columns that a filter expression refers to: its names but for literals, keywords, functions and types of casts; back-quoted names whole."""
    bare = F.regexp_replace(filter_, r"'(?:[^']|'')*'", " ")
    bare = F.regexp_replace(bare, r"(?i)\bas\s+\w+", " ")
    names = F.regexp_extract_all(bare, F.lit(r"`[^`]+`|(?<![\w.`])[A-Za-z_][\w.]*(?![\w.]*\s*\()"), F.lit(0))
    kept = F.filter(names, lambda n: ~F.lower(n).isin(*_WORDS))
    return F.array_distinct(F.transform(kept, lambda n: F.regexp_replace(n, "`", "")))


def column_usage(ev: DataFrame) -> DataFrame:
    """Per table and column: reads that select it and reads that filter on it."""
    r = table_reads(ev)
    empty = F.array().cast("array<string>")
    used = r.select("table_identifier", F.explode(F.concat(
        F.transform(F.coalesce(F.array_distinct("selected"), empty), lambda c: F.struct(c.alias("column_name"), F.lit(1).alias("s"), F.lit(0).alias("f"))),
        F.transform(F.coalesce(filter_columns(F.col("filter")), empty), lambda c: F.struct(c.alias("column_name"), F.lit(0).alias("s"), F.lit(1).alias("f"))))).alias("u"))
    return used.groupBy("table_identifier", F.col("u.column_name").alias("column_name")).agg(
        F.sum(F.col("u.s")).cast("bigint").alias("selected"), F.sum(F.col("u.f")).cast("bigint").alias("filtered"))


def deployment_status(ev: DataFrame) -> DataFrame:
    """Per endpoint: what its latest ended deployment run reports (the run's own status if it reports none), its replicas, and counts of runs."""
    ph = facets_by_phase(ev, ev.select("run_id").distinct()).select(
        "run_id", "status", "ended_at", at("start_facets", "deployment.config.endpoint").alias("endpoint"),
        at("start_facets", "deployment.config.replicas", "int").alias("replicas"), at("end_facets", "deploymentStatus.status").alias("deployed"))
    o = F.struct("ended_at", "run_id")
    return ph.where(F.col("endpoint").isNotNull() & F.col("ended_at").isNotNull()).groupBy("endpoint").agg(
        F.max_by(F.coalesce("deployed", "status"), o).alias("latest_status"), F.max_by("replicas", o).alias("replicas"),
        F.count(F.lit(1)).alias("runs"), F.count_if(F.col("status") == "FAIL").alias("failed_runs"))


def inference_volume(ev: DataFrame, io: DataFrame) -> DataFrame:
    """Per model version that inference runs read: runs, failed runs, records and the worst latency they report."""
    used = io.where((F.col("side") == "input") & (dataset_kind("name") == "model")).select(
        "run_id", F.col("name").alias("model"), bare_or("facets", "version", "version").alias("version"))
    ph = facets_by_phase(ev, used.select("run_id").distinct()).where(at("start_facets", "inference", "variant").isNotNull())
    m = "inferenceMetrics.metrics"
    return ph.join(used, "run_id").groupBy("model", "version").agg(
        F.count(F.lit(1)).alias("runs"), F.count_if(F.col("status") == "FAIL").alias("failed_runs"),
        F.coalesce(F.sum(at("end_facets", f"{m}.records", "bigint")), F.lit(0)).alias("records"),
        F.max(at("end_facets", f"{m}.latency_ms", "bigint")).alias("worst_latency_ms"))


def table_usage(ev: DataFrame) -> DataFrame:
    """Reads, writes and rows written per table, from the runs' read and write facets."""
    one, none = F.lit(1), F.lit(0)
    used = (table_reads(ev).select("table_identifier", one.alias("r"), none.alias("w"), none.cast("bigint").alias("n"))
            .unionByName(table_writes(ev).select("table_identifier", none.alias("r"), one.alias("w"), F.col("rows").alias("n"))))
    return used.groupBy("table_identifier").agg(F.sum("r").alias("reads"), F.sum("w").alias("writes"), F.sum("n").alias("rows_written"))


def provenance(io: DataFrame) -> DataFrame:
    """Which version of which dataset trained which model version, per run."""
    models = dataset_details(io).where(dataset_kind("name") == "model").select(F.col("name").alias("model"), F.col("version").alias("model_version"), "run_id")
    inputs = io.where(F.col("side") == "input").select("run_id", F.col("name").alias("trained_on"), bare_or("facets", "version", "version").alias("data_version"))
    return models.join(inputs, "run_id").select("model", "model_version", "trained_on", "data_version", "run_id")


# --------------------------------------------------------------- graph ---

def bipartite_edges(io: DataFrame) -> DataFrame:
    """Dataset -> run ('consumes') and run -> dataset ('produces')."""
    ins = io.where(F.col("side") == "input").select(F.col("name").alias("src"), F.col("run_id").alias("dst"),
                                                     "run_id", F.lit("consumes").alias("kind"))
    outs = io.where(F.col("side") == "output").select(F.col("run_id").alias("src"), F.col("name").alias("dst"),
                                                       "run_id", F.lit("produces").alias("kind"))
    return ins.unionByName(outs)


def closure(io: DataFrame, direction: str = "downstream", seeds: DataFrame | None = None) -> DataFrame:
    """(origin, node, depth) for every dataset reachable from each seed.

    Runs are collapsed once to distinct dataset -> dataset edges; then a
    breadth-first loop joins the frontier to that small graph, with
    ``distinct`` and a left-anti join against pairs already reached, so each
    pair is produced once at its minimum depth, cycles terminate, and a hub
    dataset costs its distinct neighbours, not its runs.  The loop ends when a
    round reaches nothing new.  Each round's frontier is checkpointed
    (reliable, shared folder) to cut lineage.
    """
    ins = io.where(F.col("side") == "input").select(F.col("name").alias("a"), "run_id").distinct()
    outs = io.where(F.col("side") == "output").select(F.col("name").alias("b"), "run_id").distinct()
    src, dst = ("a", "b") if direction == "downstream" else ("b", "a")
    edges = (ins.join(outs, "run_id").select(F.col(src).alias("node"), F.col(dst).alias("next")).distinct().checkpoint())
    if seeds is None:
        seeds = (ins if direction == "downstream" else outs).select(F.col(src).alias("origin")).distinct()
    frontier = seeds.select("origin", F.col("origin").alias("node"))
    steps: list[DataFrame] = []
    depth = 0
    while True:
        depth += 1
        step = frontier.join(edges, "node").select("origin", F.col("next").alias("node")).distinct()
        if steps:  # earlier rounds are already materialised; their union is a cheap scan
            seen = steps[0].select("origin", "node")
            for prev in steps[1:]:
                seen = seen.unionByName(prev.select("origin", "node"))
            step = step.join(seen, ["origin", "node"], "left_anti")
        step = step.withColumn("depth", F.lit(depth)).checkpoint(eager=True)
        if step.isEmpty():
            break
        steps.append(step)
        frontier = step.select("origin", "node")
    if not steps:
        return seeds.sparkSession.createDataFrame([], "origin string, node string, depth int")
    out = steps[0]
    for s in steps[1:]:
        out = out.unionByName(s)
    return out


def dataset_edges(io: DataFrame, direction: str = "downstream") -> DataFrame:
    """(src, dst): distinct datasets that some run links, from inputs to outputs or, ``upstream``, back."""
    ins = io.where(F.col("side") == "input").select(F.col("name").alias("a"), "run_id").distinct()
    outs = io.where(F.col("side") == "output").select(F.col("name").alias("b"), "run_id").distinct()
    src, dst = ("a", "b") if direction == "downstream" else ("b", "a")
    return ins.join(outs, "run_id").select(F.col(src).alias("src"), F.col(dst).alias("dst")).distinct()


def impact(io: DataFrame, seeds: DataFrame, direction: str = "downstream") -> DataFrame:
    """(origin, node, depth) for every dataset that the datasets ``seeds`` (origin) lead to or, ``upstream``, come from.

    Long chains and cycles are condensed first (see ``reach``); the result holds pairs of the seeds only.
    """
    return reach(dataset_edges(io, direction), seeds)


# ------------------------------------------------------------- emitter ---

class LineageLog:
    """Appends this library's own run events (START, COMPLETE/FAIL) as JSON lines.

    START and the terminal event share one run id (the reference emitter
    mints a new one on exit; see ``repair_split_runs`` for such logs).
    """

    def __init__(self, spark: SparkSession, path: str, namespace: str = "vela", producer: str = "vela"):
        self.spark, self.path, self.namespace, self.producer = spark, path.rstrip("/"), namespace, producer

    def _emit(self, event_type: str, run: dict, inputs=(), outputs=(), facets=None) -> None:
        def ds(n):
            if isinstance(n, dict):
                return n
            ns = n.split("://", 1)[0] if "://" in n else self.namespace
            return {"namespace": ns, "name": n, "facets": {}}
        ev = {"eventType": event_type,
              "eventTime": _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat() + "Z",
              "run": {"runId": run["run_id"]},
              "job": {"namespace": self.namespace, "name": run["job"],
                      "facets": dict(facets or {})},
              "inputs": [ds(x) for x in inputs], "outputs": [ds(x) for x in outputs], "producer": self.producer}
        (self.spark.createDataFrame([(json.dumps(ev),)], "value string").coalesce(1)
         .write.mode("append").text(self.path))

    def start(self, job: str, inputs=(), facets=None) -> dict:
        run = {"run_id": str(uuid.uuid4()), "job": job, "inputs": list(inputs)}
        self._emit("START", run, inputs, (), facets)
        return run

    def complete(self, run: dict, outputs=(), facets=None) -> None:
        self._emit("COMPLETE", run, run.get("inputs", ()), outputs, facets)

    def fail(self, run: dict, exc: BaseException) -> None:
        msg = "".join(traceback.format_exception(type(exc), exc, exc.__traceback__))
        self._emit("FAIL", run, run.get("inputs", ()), (), {"errorMessage": {"message": str(exc), "programmingLanguage": "PYTHON", "stack": msg}})
