"""Registered lineage queries over run events derived from ``events``.

Fixture rule (grows with ``events``): every row becomes one JSON line, written by the same SQL expression in Spark and DuckDB
(``LINE``); the queries read the lines with the library, the oracles with DuckDB's JSON functions.
  rn       = row_number() over (partition by user_id order by ts, event_id) - 1
  run_id   = '<user_id>-<rn div 2>';  job = 'job_<user_id % 20>'
  type     = START if rn even, else FAIL if event_type = 'error' else COMPLETE
  layer k  = user_id % 4, i = user_id % 30, j = (2i + event_id % 2) % 30
  inputs   = [<ns(k)>://d<k>_<i>] on terminal events when k > 0 (k = 0 runs generate)
  outputs  = [<ns(k+1)>://d<k+1>_<j>] on COMPLETE events
  ns(l)    = table for l <= 2, model for l = 3, deployment for l = 4
Layer 2 trains models, layer 3 deploys them or (user_id % 8 = 7) infers with them: two inputs, one virtual output.
Facets are nested, several to an event; models have one nested ``model`` facet or, of odd event ids, bare facets.
Every 50th line stands there twice, every 97th row adds a malformed line.
Layers make the graph acyclic; the closure code does not rely on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lineage as L
from ..operators.sequence import next_within, sequence_within
from ..session import ensure_checkpoint_dir, scratch_path
from ..sources import tables as TB
from .catalog import register, round_doubles

_P = '"_producer":"vela/fixture","_schemaURL":"https://example.org/facet.json"'


def _dataset(ns: str, name: str, facets: str) -> str:
    return f"""concat('{{"namespace":"', {ns}, '","name":"', {name}, '","facets":', {facets}, '}}')"""


def _ns(layer: str) -> str:
    return f"CASE WHEN {layer} <= 2 THEN 'table' WHEN {layer} = 3 THEN 'model' ELSE 'deployment' END"


def _stored(layer: str, x: str, more: str = "''") -> str:
    """Facets of a stored dataset; ``more``: SQL text of further facets, each with a comma behind it."""
    return f"""concat('{{"dataSource":{{{_P},"name":"d', {layer}, '_', {x}, '","uri":"file:///lake/d', {layer}, '_', {x},
    '"}},"datasetProperties":{{{_P},"properties":{{"format":"parquet","partition_spec_id":0,"schema_id":0,"snapshot_id":"s', event_id,
    '"}}}},"documentation":{{{_P},"description":"layer ', {layer}, '"}},', {more}, '"schema":{{{_P},"fields":[{{"name":"id","type":"int"}},{{"name":"c', v,
    '","type":"str"}}]}},"version":{{{_P},"version":"1.', v, '"}}}}')"""


_MODEL = f"""concat('"model":{{{_P},"hyperparams":{{"max_depth":', event_id % 7, ',"n_estimators":', pk, '}},"metrics":{{"accuracy":0.', event_id % 9 + 1,
    ',"f1":0.', event_id % 8 + 1, '}},"type":"RandomForest"}},')"""
_BARE = """concat('{"feature_count":', event_id % 30, ',"metrics":{"accuracy":0.', event_id % 9 + 1, '},"model_type":"random_forest","version":"1.', v, '"}')"""
_IN = _dataset(_ns("k"), f"concat({_ns('k')}, '://d', k, '_', i)", _stored("k", "i"))
_DATA = _dataset("'table'", "concat('table://d0_', i)", "'{}'")
_OUT = _dataset(_ns("k + 1"), f"concat({_ns('k + 1')}, '://d', k + 1, '_', j)",
                f"CASE WHEN k <> 2 THEN {_stored('k + 1', 'j')} WHEN event_id % 2 = 0 THEN {_stored('k + 1', 'j', _MODEL)} ELSE {_BARE} END")
_VIRTUAL = _dataset("'vela'", "concat('inference_result_', job)", f"""'{{"virtual":{{{_P},"isVirtual":true}}}}'""")
_FILTER = """CASE event_id % 4 WHEN 0 THEN 'null' WHEN 1 THEN '"amount > 10 AND region = ''it''''s id'' OR amount < 0"'
    WHEN 2 THEN '"lower(name) LIKE ''a%'' OR cast(amount AS int) IS NULL"' ELSE '"`odd name` BETWEEN 1 AND 5"' END"""
_READ = f"""concat('"iceberg_read_info":{{{_P},"catalog":"lake","filter":', {_FILTER}, ',"selected_fields":',
    CASE WHEN event_id % 3 = 0 THEN '"all fields"' ELSE concat('["id","c', v, '"]') END, ',"snapshot_id":', CASE WHEN event_id % 5 = 0 THEN 'null' ELSE concat(event_id % 9, '') END,
    ',"table_identifier":"demo.d', k, '_', i, '"}}')"""
_WRITE = f"""concat('"iceberg_write_info":{{{_P},"catalog":"lake","count":', event_id * 3, ',"mode":"', CASE WHEN event_id % 2 = 0 THEN 'append' ELSE 'overwrite' END,
    '","table_identifier":"demo.d', k + 1, '_', j, '"}}')"""
_FACETS = f"""CASE
  WHEN et = 'FAIL' THEN concat('{{"errorMessage":{{{_P},"message":"error event ', event_id, '","programmingLanguage":"PYTHON","stack":"trace"}}}}')
  WHEN et = 'START' AND k <= 1 THEN concat('{{"documentation":{{{_P},"description":"step ', k, '"}},"stage":"prepare"}}')
  WHEN et = 'START' AND k = 2 THEN concat('{{"documentation":{{{_P},"description":"train"}},"hyperparameters":{{{_P},"hyperparameters":{{"max_depth":', event_id % 7,
    ',"n_estimators":', pk, '}}}}}}')
  WHEN et = 'START' AND inf THEN concat('{{"inference":{{{_P},"details":{{"batch":', event_id % 100, '}}}}}}')
  WHEN et = 'START' THEN concat('{{"deployment":{{{_P},"config":{{"endpoint":"/predict/', i, '","replicas":', event_id % 4 + 1, '}}}}}}')
  WHEN k = 0 THEN concat('{{', {_WRITE}, '}}') WHEN k = 1 THEN concat('{{', {_READ}, ',', {_WRITE}, '}}')
  WHEN k = 2 THEN concat('{{', {_READ}, ',"metrics":{{{_P},"metrics":{{"accuracy":0.', event_id % 9 + 1, ',"score":', event_id % 97, '}}}}}}')
  WHEN inf THEN concat('{{"inferenceMetrics":{{{_P},"metrics":{{"latency_ms":', event_id % 50, ',"records":', event_id % 1000, '}}}}}}')
  ELSE concat('{{"deploymentStatus":{{{_P},"status":"', CASE WHEN event_id % 3 = 0 THEN 'stopped' ELSE 'running' END, '"}}}}') END"""

#: The JSON line of a row, in SQL that Spark and DuckDB read alike.
LINE = f"""concat('{{"eventType":"', et, '","eventTime":"', stamp, '","run":{{"runId":"', run_id, '"}},"job":{{"namespace":"vela","name":"', job, '","facets":', {_FACETS},
  '}},"inputs":[', CASE WHEN et = 'START' OR k = 0 THEN '' WHEN inf THEN concat({_DATA}, ',', {_IN}) ELSE {_IN} END,
  '],"outputs":[', CASE WHEN et <> 'COMPLETE' THEN '' WHEN inf THEN {_VIRTUAL} ELSE {_OUT} END, '],"producer":"vela/fixture"}}')"""
COPIES, BAD = 50, 97


def event_lines(events: DataFrame) -> DataFrame:
    """Events table -> one JSON line per row (column ``value``), repeated and malformed lines included; event_id and ts stay."""
    # rn = row_number() over (partition by user_id order by ts, event_id) - 1, computed skew-safe
    b = sequence_within(events.select("event_id", "ts", "user_id", "event_type", "props"), ["user_id"], "ts", ["event_id"], out="rn")
    b = b.selectExpr(
        "event_id", "ts", "user_id", "user_id % 4 AS k", "user_id % 30 AS i", "(2 * (user_id % 30) + event_id % 2) % 30 AS j", "event_id % 5 AS v",
        "user_id % 8 = 7 AS inf", "concat('job_', user_id % 20) AS job", "concat(user_id, '-', rn div 2) AS run_id",
        "CASE WHEN rn % 2 = 0 THEN 'START' WHEN event_type = 'error' THEN 'FAIL' ELSE 'COMPLETE' END AS et",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") AS stamp", "cast(get_json_object(props, '$.k') AS int) AS pk")
    # The array function beside the line keeps Spark from fusing this long expression with its neighbours into one
    # method that the JVM does not compile (four times slower).
    line = b.selectExpr("event_id", "ts", f"{LINE} AS line",
                        f"filter(array(0, IF(event_id % {COPIES} = 0, 1, NULL), IF(event_id % {BAD} = 5, 2, NULL)), c -> c IS NOT NULL) AS copies")
    broken = F.concat(F.lit('{"eventType":"START", broken '), F.col("event_id").cast("string"))
    return (line.select("event_id", "ts", "line", F.explode("copies").alias("copy"))
            .select("event_id", "ts", F.when(F.col("copy") == 2, broken).otherwise(F.col("line")).alias("value")).where(F.col("value").isNotNull()))


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return L.parse_events(event_lines(TB.table(spark, sf, "events")))


def _recorded(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """The typed events with ``columns``, parsed once into a scratch table: for queries that read them several times."""
    folder = scratch_path(spark, "lineage-events")
    ev = _events(spark, sf).select("run_id", "event_type", "event_time", *columns, "error")
    ev.write.parquet(folder)
    return spark.read.schema(ev.schema).parquet(folder)


# The lines in DuckDB, and the typed events from their text.
FIX_SQL = f"""
WITH b AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS rn FROM events),
f AS (SELECT event_id, ts, user_id, user_id % 4 AS k, user_id % 30 AS i, (2 * (user_id % 30) + event_id % 2) % 30 AS j, event_id % 5 AS v, user_id % 8 = 7 AS inf,
  concat('job_', user_id % 20) AS job, concat(user_id, '-', rn // 2) AS run_id,
  CASE WHEN rn % 2 = 0 THEN 'START' WHEN event_type = 'error' THEN 'FAIL' ELSE 'COMPLETE' END AS et,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS stamp, cast(json_extract_string(props, '$.k') AS integer) AS pk FROM b),
l AS (SELECT {LINE} AS line FROM f),
ev AS (SELECT line ->> '$.run.runId' AS run_id, line ->> '$.eventType' AS event_type, cast(line ->> '$.eventTime' AS timestamp) AS event_time,
  line ->> '$.job.namespace' AS job_namespace, line ->> '$.job.name' AS job_name, json_extract(line, '$.job.facets') AS jf,
  json_extract(line, '$.inputs[*]') AS ins, json_extract(line, '$.outputs[*]') AS outs,
  CASE WHEN line ->> '$.eventType' = 'START' THEN 0 WHEN line ->> '$.eventType' IN ('COMPLETE', 'FAIL', 'ABORT') THEN 2 ELSE 1 END AS phase FROM l),
side AS (SELECT run_id, event_time, 'input' AS side, unnest(ins) AS d FROM ev UNION ALL SELECT run_id, event_time, 'output', unnest(outs) FROM ev),
io AS (SELECT run_id, side, d ->> '$.namespace' AS namespace, d ->> '$.name' AS name, arg_max(json_extract(d, '$.facets'), event_time) AS facets,
  arg_max(CASE WHEN json_type(d, '$.facets.version') = 'OBJECT' THEN d ->> '$.facets.version.version' ELSE d ->> '$.facets.version' END, event_time) AS version
  FROM side GROUP BY ALL),
stored AS (SELECT * FROM io WHERE side = 'output' AND NOT coalesce((facets ->> '$.virtual.isVirtual') = 'true', false)),
keys AS (SELECT run_id, event_time, phase, event_type, jf, unnest(json_keys(jf)) AS facet FROM ev),
facet AS (SELECT run_id, facet, arg_max(json_extract(jf, '$.' || facet), (event_time, phase, event_type)) AS value FROM keys GROUP BY ALL),
written AS (SELECT run_id, value ->> '$.table_identifier' AS table_identifier, value ->> '$.mode' AS mode, cast(value ->> '$.count' AS bigint) AS rows
  FROM facet WHERE facet = 'iceberg_write_info'),
reads AS (SELECT run_id, value ->> '$.table_identifier' AS table_identifier, value ->> '$.filter' AS filter,
  CASE WHEN json_type(value, '$.selected_fields') = 'ARRAY' THEN value ->> '$.selected_fields[*]' END AS selected FROM facet WHERE facet = 'iceberg_read_info')
"""
TERM = "('COMPLETE', 'FAIL', 'ABORT')"


def _q(body: str) -> str:
    return FIX_SQL + body


# ------------------------------------------------------------- L1/A10 ---
@register("lineage_ingest", _q(
    "SELECT run_id, event_type, event_time, job_name, len(ins)::INT AS n_inputs, len(outs)::INT AS n_outputs, false AS bad FROM ev"
    f" UNION ALL SELECT NULL, NULL, NULL, NULL, 0, 0, true FROM events WHERE event_id % {BAD} = 5"))
def lineage_ingest(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "lineage-json")
    event_lines(TB.table(spark, sf, "events")).select("value").write.mode("errorifexists").text(path)
    return L.read_events(spark, path).select("run_id", "event_type", "event_time", "job_name", F.size("inputs").alias("n_inputs"),
                                             F.size("outputs").alias("n_outputs"), F.col("error").isNotNull().alias("bad"))


# ----------------------------------------------------------------- L2 ---
@register("lineage_runs", _q(
    f"SELECT run_id, max(job_namespace) AS job_namespace, max(job_name) AS job_name,"
    f" min(CASE WHEN event_type = 'START' THEN event_time END) AS started_at,"
    f" max(CASE WHEN event_type IN {TERM} THEN event_time END) AS ended_at,"
    f" arg_max(event_type, (event_time, phase, event_type)) AS status,"
    f" arg_max(CASE WHEN event_type = 'FAIL' THEN jf ->> '$.errorMessage.message' END,"
    f" CASE WHEN event_type = 'FAIL' THEN (event_time, phase, event_type) END) AS error_message, count(*) AS events,"
    f" round(date_diff('microsecond', min(CASE WHEN event_type = 'START' THEN event_time END),"
    f" max(CASE WHEN event_type IN {TERM} THEN event_time END)) / 1e6::double, 6) AS duration_s FROM ev GROUP BY run_id"))
def lineage_runs(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(L.runs(_events(spark, sf)))


# ----------------------------------------------------------------- L3 ---
@register("lineage_run_repair", _q(
    f", fl AS (SELECT job_namespace, job_name, event_type, event_time, CASE WHEN event_type = 'START' THEN run_id"
    f" ELSE run_id || '-t' END AS run_id FROM ev), nx AS (SELECT *, lead(event_type) OVER w AS next_type"
    f" FROM fl WINDOW w AS (PARTITION BY job_namespace, job_name ORDER BY event_time, run_id))"
    f" SELECT job_name, count(*) AS repaired_runs, cast(count_if(next_type = 'FAIL') AS bigint) AS failed_runs FROM nx"
    f" WHERE event_type = 'START' AND next_type IN {TERM} GROUP BY job_name"))
def lineage_run_repair(spark: SparkSession, sf: str) -> DataFrame:
    ev = _events(spark, sf)
    foreign = ev.withColumn("run_id", F.when(F.col("event_type") == "START", F.col("run_id"))
                            .otherwise(F.concat(F.col("run_id"), F.lit("-t"))))
    pairs = L.repair_split_runs(foreign)
    return pairs.groupBy("job_name").agg(F.count(F.lit(1)).alias("repaired_runs"),
                                         F.count_if(F.col("status") == "FAIL").alias("failed_runs"))


# ----------------------------------------------------------------- L4 ---
@register("lineage_io", _q("SELECT run_id, side, namespace, name, version FROM io"))
def lineage_io(spark: SparkSession, sf: str) -> DataFrame:
    io = L.run_io(_events(spark, sf))
    return io.select("run_id", "side", "namespace", "name", L.bare_or("facets", "version", "version").alias("version"))


# ----------------------------------------------------------------- L5 ---
@register("lineage_facets", _q(
    ", inner_keys AS (SELECT run_id, facet, value, CASE WHEN json_type(value) = 'OBJECT' THEN unnest(json_keys(value)) END AS field FROM facet WHERE json_type(value) = 'OBJECT')"
    " SELECT run_id, facet, field, value ->> ('$.' || field) AS value FROM inner_keys WHERE field NOT IN ('_producer', '_schemaURL')"
    " UNION ALL SELECT run_id, facet, 'value', value ->> '$' FROM facet WHERE json_type(value) <> 'OBJECT'"))
def lineage_facets(spark: SparkSession, sf: str) -> DataFrame:
    return L.job_facets(_events(spark, sf))


# ----------------------------------------------------------------- L6 ---
@register("lineage_dataset_facets", _q(
    "SELECT name, count(DISTINCT version) AS versions, arg_max(version, cast(split_part(version, '.', 2) AS integer)) AS max_version,"
    " max(facets ->> '$.datasetProperties.properties.format') AS format, max(facets ->> '$.dataSource.uri') AS uri,"
    " count(DISTINCT facets ->> '$.datasetProperties.properties.snapshot_id') AS snapshots, count(facets ->> '$.documentation.description') AS described"
    " FROM stored GROUP BY name"))
def lineage_dataset_facets(spark: SparkSession, sf: str) -> DataFrame:
    return L.dataset_versions(L.run_io(_events(spark, sf)))


@register("lineage_dataset_columns", _q(
    "SELECT DISTINCT name, version, c ->> '$.name' AS column_name, c ->> '$.type' AS data_type"
    " FROM (SELECT name, version, unnest(json_extract(facets, '$.schema.fields[*]')) AS c FROM stored)"))
def lineage_dataset_columns(spark: SparkSession, sf: str) -> DataFrame:
    return L.dataset_columns(L.run_io(_events(spark, sf)))


# ----------------------------------------------------------------- L9 ---
@register("lineage_run_kinds", _q(
    ", s AS (SELECT run_id, (SELECT count(*) FROM io WHERE io.run_id = r.run_id AND side = 'input') AS n_in,"
    " (SELECT count(*) FROM io WHERE io.run_id = r.run_id AND side = 'output') AS n_out FROM (SELECT DISTINCT run_id FROM ev) r)"
    " SELECT CASE WHEN n_in = 0 AND n_out > 0 THEN 'generation' WHEN n_in > 0 AND n_out > 0 THEN 'transformation'"
    " WHEN n_in > 0 THEN 'sink' ELSE 'no_io' END AS kind, count(*) AS runs,"
    " coalesce(sum(rows), 0)::bigint AS rows_written FROM s LEFT JOIN written USING (run_id) GROUP BY 1"))
def lineage_run_kinds(spark: SparkSession, sf: str) -> DataFrame:
    ev = _recorded(spark, sf, "job_namespace", "job_name", "job_facets", "inputs", "outputs")
    return L.run_kinds(ev, L.run_io(ev), L.runs(ev))


# ---------------------------------------------------------------- L10 ---
_BY_PHASE = (f", ph AS (SELECT run_id, max(job_name) AS job_name, arg_max(CASE WHEN event_type = 'START' THEN jf END, CASE WHEN event_type = 'START' THEN event_time END) AS s,"
             f" arg_max(CASE WHEN event_type IN {TERM} THEN jf END, CASE WHEN event_type IN {TERM} THEN event_time END) AS e,"
             f" arg_max(event_type, (event_time, phase, event_type)) AS status, max(CASE WHEN event_type IN {TERM} THEN event_time END) AS ended_at FROM ev GROUP BY run_id)")


@register("lineage_training_runs", _q(
    _BY_PHASE + " SELECT run_id, cast(s ->> '$.hyperparameters.hyperparameters.n_estimators' AS integer) AS n_estimators,"
    " cast(s ->> '$.hyperparameters.hyperparameters.max_depth' AS integer) AS max_depth, cast(e ->> '$.metrics.metrics.accuracy' AS double) AS accuracy,"
    " cast(e ->> '$.metrics.metrics.score' AS integer) AS score, status FROM ph WHERE run_id IN (SELECT run_id FROM stored WHERE namespace = 'model')"))
def lineage_training_runs(spark: SparkSession, sf: str) -> DataFrame:
    ev = _recorded(spark, sf, "job_name", "job_facets", "inputs", "outputs")
    model_runs = L.dataset_details(L.run_io(ev)).where(L.dataset_kind("name") == "model").select("run_id").distinct()
    return L.facets_by_phase(ev, model_runs).select(
        "run_id", L.at("start_facets", "hyperparameters.hyperparameters.n_estimators", "int").alias("n_estimators"),
        L.at("start_facets", "hyperparameters.hyperparameters.max_depth", "int").alias("max_depth"),
        L.at("end_facets", "metrics.metrics.accuracy", "double").alias("accuracy"), L.at("end_facets", "metrics.metrics.score", "int").alias("score"), "status")


# ---------------------------------------------------------------- L11 ---
@register("lineage_deployment_status", _q(
    _BY_PHASE + ", d AS (SELECT ph.*, s ->> '$.deployment.config.endpoint' AS endpoint, e ->> '$.deploymentStatus.status' AS deployed,"
    " cast(s ->> '$.deployment.config.replicas' AS integer) AS replicas FROM ph)"
    " SELECT endpoint, arg_max(coalesce(deployed, status), (ended_at, run_id)) AS latest_status, arg_max(replicas, (ended_at, run_id)) AS replicas, count(*) AS runs,"
    " cast(count_if(status = 'FAIL') AS bigint) AS failed_runs FROM d WHERE endpoint IS NOT NULL AND ended_at IS NOT NULL GROUP BY endpoint"))
def lineage_deployment_status(spark: SparkSession, sf: str) -> DataFrame:
    return L.deployment_status(_events(spark, sf))


# ---------------------------------------------------------------- L12 ---
@register("lineage_inference_runs", _q(
    _BY_PHASE + ", m AS (SELECT DISTINCT run_id, name, version FROM io WHERE side = 'input' AND namespace = 'model')"
    " SELECT m.name AS model, m.version, count(*) AS runs, cast(count_if(status = 'FAIL') AS bigint) AS failed_runs,"
    " coalesce(sum(cast(e ->> '$.inferenceMetrics.metrics.records' AS bigint)), 0)::BIGINT AS records,"
    " max(cast(e ->> '$.inferenceMetrics.metrics.latency_ms' AS bigint)) AS worst_latency_ms"
    " FROM ph JOIN m USING (run_id) WHERE json_type(s, '$.inference') = 'OBJECT' GROUP BY ALL"))
def lineage_inference_runs(spark: SparkSession, sf: str) -> DataFrame:
    ev = _recorded(spark, sf, "job_name", "job_facets", "inputs", "outputs")
    return L.inference_volume(ev, L.run_io(ev))


# ---------------------------------------------------------------- L13 ---
@register("lineage_table_usage", _q(
    ", u AS (SELECT table_identifier, 1 AS r, 0 AS w, 0 AS n FROM reads UNION ALL SELECT table_identifier, 0, 1, rows FROM written)"
    " SELECT table_identifier, sum(r)::BIGINT AS reads, sum(w)::BIGINT AS writes, sum(n)::BIGINT AS rows_written FROM u GROUP BY 1"))
def lineage_table_usage(spark: SparkSession, sf: str) -> DataFrame:
    return L.table_usage(_recorded(spark, sf, "job_facets"))


@register("lineage_column_usage", _q(
    ", refs(filter, cols) AS (VALUES ('amount > 10 AND region = ''it''''s id'' OR amount < 0', ['amount', 'region']),"
    " ('lower(name) LIKE ''a%'' OR cast(amount AS int) IS NULL', ['name', 'amount']), ('`odd name` BETWEEN 1 AND 5', ['odd name'])),"
    " u AS (SELECT table_identifier, unnest(selected) AS column_name, 1 AS s, 0 AS f FROM reads"
    " UNION ALL SELECT table_identifier, unnest(cols), 0, 1 FROM reads JOIN refs USING (filter))"
    " SELECT table_identifier, column_name, sum(s)::BIGINT AS selected, sum(f)::BIGINT AS filtered FROM u GROUP BY ALL"))
def lineage_column_usage(spark: SparkSession, sf: str) -> DataFrame:
    return L.column_usage(_events(spark, sf))


# ---------------------------------------------------------------- L14 ---
@register("lineage_edges", _q(
    "SELECT name AS src, run_id AS dst, run_id, 'consumes' AS kind FROM io WHERE side = 'input'"
    " UNION ALL SELECT run_id, name, run_id, 'produces' FROM io WHERE side = 'output'"))
def lineage_edges(spark: SparkSession, sf: str) -> DataFrame:
    return L.bipartite_edges(L.run_io(_events(spark, sf)))


# ---------------------------------------------------------------- L15 ---
def _closure_sql(reverse: bool) -> str:
    src, dst = ("o.name", "i.name") if reverse else ("i.name", "o.name")
    return _q(
        f", e AS (SELECT DISTINCT {src} AS src, {dst} AS dst FROM io i JOIN io o ON i.run_id = o.run_id"
        " AND i.side = 'input' AND o.side = 'output'),"
        " r AS (SELECT * FROM (WITH RECURSIVE r(origin, node, depth) AS (SELECT src, dst, 1 FROM e UNION"
        " SELECT r.origin, e.dst, r.depth + 1 FROM r JOIN e ON r.node = e.src) SELECT * FROM r))"
        " SELECT origin, node, min(depth) AS depth FROM r GROUP BY origin, node")


def _closure(spark: SparkSession, sf: str, direction: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return L.closure(L.run_io(_events(spark, sf)).drop("facets").checkpoint(), direction)


@register("lineage_downstream", _closure_sql(False))
def lineage_downstream(spark: SparkSession, sf: str) -> DataFrame:
    return _closure(spark, sf, "downstream")


@register("lineage_upstream", _closure_sql(True))
def lineage_upstream(spark: SparkSession, sf: str) -> DataFrame:
    return _closure(spark, sf, "upstream")


@register("lineage_impact", _q(
    ", e AS (SELECT DISTINCT o.name AS src, i.name AS dst FROM io i JOIN io o ON i.run_id = o.run_id AND i.side = 'input' AND o.side = 'output'),"
    " final AS (SELECT run_id, arg_max(event_type, (event_time, phase, event_type)) AS status FROM ev GROUP BY run_id),"
    " s AS (SELECT DISTINCT name FROM io JOIN final USING (run_id) WHERE side = 'input' AND namespace = 'model' AND status = 'FAIL'),"
    " r AS (SELECT * FROM (WITH RECURSIVE r(origin, node, depth) AS (SELECT src, dst, 1 FROM e JOIN s ON src = name UNION"
    " SELECT r.origin, e.dst, r.depth + 1 FROM r JOIN e ON r.node = e.src) SELECT * FROM r))"
    " SELECT origin, node, min(depth) AS depth FROM r GROUP BY origin, node"))
def lineage_impact(spark: SparkSession, sf: str) -> DataFrame:
    """Every dataset that the models of failed runs come from."""
    ensure_checkpoint_dir(spark)
    ev = _recorded(spark, sf, "job_namespace", "job_name", "job_facets", "inputs", "outputs")
    io = L.run_io(ev).drop("facets").checkpoint()
    failed = L.runs(ev).where("status = 'FAIL'").select("run_id")
    models = io.where("side = 'input' AND namespace = 'model'").join(failed, "run_id", "left_semi")
    return L.impact(io, models.select(F.col("name").alias("origin")), "upstream")


@register("lineage_impact_rings", (
    "WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS st, count(*) OVER (PARTITION BY o_custkey) AS n,"
    " row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS pos FROM orders)"
    " SELECT concat('order://', a.k) AS origin, concat('order://', b.k) AS node, cast((b.pos - a.pos + a.n - 1) % a.n + 1 AS integer) AS depth"
    " FROM o a JOIN o b ON a.c = b.c WHERE a.st = 'P'"))
def lineage_impact_rings(spark: SparkSession, sf: str) -> DataFrame:
    """Rings of runs, one per customer, each reading an order and writing the next, the last one the first; seeds: the open orders."""
    ensure_checkpoint_dir(spark)
    orders = TB.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    name = lambda key: F.concat(F.lit("order://"), key.cast("string"))
    first = orders.groupBy("o_custkey").agg(F.min("o_orderkey").alias("first_key"))
    linked = (next_within(orders, ["o_custkey"], "o_orderkey", [], ["o_orderkey"]).join(first, "o_custkey")
              .withColumn("to", F.coalesce("next_o_orderkey", "first_key")).checkpoint())
    io = linked.select(F.col("o_orderkey").cast("string").alias("run_id"), F.explode(F.array(
        F.struct(F.lit("input").alias("side"), name(F.col("o_orderkey")).alias("name")),
        F.struct(F.lit("output").alias("side"), name(F.col("to")).alias("name")))).alias("d")).select("run_id", "d.*")
    return L.impact(io, linked.where("o_orderstatus = 'P'").select(name(F.col("o_orderkey")).alias("origin")))


# ---------------------------------------------------------------- L16 ---
@register("lineage_provenance", _q(
    " SELECT o.name AS model, o.version AS model_version, i.name AS trained_on, i.version AS data_version, o.run_id FROM stored o"
    " JOIN io i ON o.run_id = i.run_id AND i.side = 'input' WHERE o.namespace = 'model'"))
def lineage_provenance(spark: SparkSession, sf: str) -> DataFrame:
    return L.provenance(L.run_io(_recorded(spark, sf, "inputs", "outputs")))


# ---------------------------------------------------------------- L17 ---
@register("lineage_inventory", _q(
    " SELECT 'job' AS category, job_name AS key, count(DISTINCT run_id) AS n FROM ev GROUP BY job_name"
    " UNION ALL SELECT 'dataset_kind', CASE WHEN contains(name, '://') THEN split_part(name, '://', 1) ELSE 'dataset' END, count(DISTINCT name) FROM io GROUP BY 2"))
def lineage_inventory(spark: SparkSession, sf: str) -> DataFrame:
    ev = _recorded(spark, sf, "job_name", "inputs", "outputs")
    jobs = ev.where("error IS NULL").groupBy(F.col("job_name").alias("key")).agg(F.count_distinct("run_id").alias("n")).select(
        F.lit("job").alias("category"), "key", "n")
    kinds = L.run_io(ev).groupBy(L.dataset_kind("name").alias("key")).agg(F.count_distinct("name").alias("n")).select(
        F.lit("dataset_kind").alias("category"), "key", "n")
    return jobs.unionByName(kinds)


# ----------------------------------------------------------------- A9 ---
@register("namespace_summary", _q(
    ", n AS (SELECT job_namespace AS ns FROM ev UNION SELECT namespace FROM io)"
    " SELECT count(DISTINCT ns) AS namespaces, string_agg(DISTINCT ns, ',' ORDER BY ns) AS names FROM n"))
def namespace_summary(spark: SparkSession, sf: str) -> DataFrame:
    ev = _recorded(spark, sf, "job_namespace", "inputs", "outputs")
    ns = ev.where("error IS NULL").select(F.col("job_namespace").alias("ns")).unionByName(
        L.run_io(ev).select(F.col("namespace").alias("ns"))).distinct()
    return ns.agg(F.count(F.lit(1)).alias("namespaces"),
                  F.array_join(F.array_sort(F.collect_list("ns")), ",").alias("names"))


# ------------------------------------------------------- L1 streaming ---
def _event_counts(events: DataFrame) -> DataFrame:
    return events.select("run_id", "event_type", "event_time", "job_name", F.size("inputs").alias("n_inputs"), F.size("outputs").alias("n_outputs"))


@register("lineage_stream", _q("SELECT run_id, event_type, event_time, job_name, len(ins)::INT AS n_inputs, len(outs)::INT AS n_outputs FROM ev"))
def lineage_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Event files ingested by a stream into a typed table, each event once."""
    src, sink, ck = (scratch_path(spark, n) for n in ("lineage-src", "lineage-typed", "lineage-ckpt"))
    event_lines(TB.table(spark, sf, "events")).select("value").write.text(src)
    L.ingest_stream(spark, src, sink, ck).awaitTermination()
    return _event_counts(L.ingested(spark, sink))


@register("lineage_stream_late", _q("SELECT run_id, event_type, event_time, job_name, len(ins)::INT AS n_inputs, len(outs)::INT AS n_outputs FROM ev"))
def lineage_stream_late(spark: SparkSession, sf: str) -> DataFrame:
    """The same in two runs of the stream: the later half of the events first, then the earlier half with a quarter of the first lines again."""
    src, sink, ck = (scratch_path(spark, n) for n in ("lineage-src", "lineage-typed", "lineage-ckpt"))
    lines = event_lines(TB.table(spark, sf, "events")).withColumn("late", F.col("event_id") % 2 == 0)
    for part in (lines.where("NOT late"), lines.where("late OR event_id % 8 = 1")):
        part.select("value").write.mode("append").text(src)
        L.ingest_stream(spark, src, sink, ck).awaitTermination()
    return _event_counts(L.ingested(spark, sink))


# ----------------------------------------------------------------- L8 ---
@register("lineage_model_facets", _q(
    ", m AS (SELECT name AS model, version, run_id, facets, coalesce(json_extract(facets, '$.model.metrics'), json_extract(facets, '$.metrics')) AS ms,"
    " json_extract(facets, '$.model.hyperparams') AS hp FROM stored WHERE namespace = 'model')"
    " SELECT * FROM (SELECT model, version, run_id, 'metric' AS kind, key, ms ->> ('$.' || key) AS value FROM (SELECT *, unnest(json_keys(ms)) AS key FROM m)"
    " UNION ALL SELECT model, version, run_id, 'hyperparameter', key, hp ->> ('$.' || key) FROM (SELECT *, unnest(json_keys(hp)) AS key FROM m)"
    " UNION ALL SELECT model, version, run_id, 'property', 'type', coalesce(facets ->> '$.model.type', facets ->> '$.model_type') FROM m"
    " UNION ALL SELECT model, version, run_id, 'property', 'feature_count', facets ->> '$.feature_count' FROM m) WHERE value IS NOT NULL"))
def lineage_model_facets(spark: SparkSession, sf: str) -> DataFrame:
    return L.model_facets(L.run_io(_events(spark, sf)))
