"""Registered queries over a version log derived from ``events`` (R*, W*).

Fixture rule (grows with ``events``): each event is one registry action.
signup -> register, view -> stage 'Staging', click -> stage 'Production',
purchase -> deploy, error -> deployment status 'failed'.  Model name from
``user_id % 7``, version ``<event_id % 11>.<user_id % 3>.0`` (so "10.x.0"
must sort after "9.x.0"), deployment id from ``user_id % 11``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import versions as V
from ..session import ensure_checkpoint_dir
from ..sources import tables as TB
from .catalog import register, round_doubles


def registry_log(events: DataFrame) -> DataFrame:
    et = F.col("event_type")
    kind = (F.when(et == "signup", "register").when(et.isin("view", "click"), "stage")
            .when(et == "purchase", "deploy").otherwise("deploy_status"))
    k = F.get_json_object("props", "$.k").cast("int").cast("string")
    return events.select(
        F.col("event_id").alias("seq"), F.col("ts"), kind.alias("kind"),
        F.concat(F.lit("model_"), (F.col("user_id") % 7).cast("string")).alias("model_name"),
        F.concat_ws(".", (F.col("event_id") % 11).cast("string"), (F.col("user_id") % 3).cast("string"),
                    F.lit("0")).alias("model_version"),
        F.when(et == "view", "Staging").when(et == "click", "Production").alias("stage"),
        F.concat(F.lit("registered by user "), F.col("user_id").cast("string")).alias("description"),
        (F.col("event_id") * 10).alias("training_samples"), (F.col("event_id") * 2).alias("test_samples"),
        F.create_map(F.lit("max_depth"), (F.col("user_id") % 10).cast("string"), F.lit("n_estimators"), k)
        .alias("hyperparameters"),
        F.create_map(F.lit("accuracy"), F.col("value") / F.lit(100.0),
                     F.lit("f1"), (F.col("event_id") % 100).cast("double") / F.lit(100.0)).alias("metrics"),
        F.when(et.isin("purchase", "error"), F.concat(F.lit("dep_"), (F.col("user_id") % 11).cast("string")))
        .alias("deployment_id"),
        F.when(et == "error", "failed").alias("status"),
        F.when(et == "signup", F.concat(F.lit("models/"), F.col("event_id").cast("string"))).alias("path"),
        F.when(et == "signup", F.array(F.lit("daily"), F.concat(F.lit("team_"), (F.col("user_id") % 3).cast("string")))).alias("tags"),
        F.when(et == "signup", F.when(F.col("event_id") % 2 == 0, "random_forest").otherwise("logistic_regression")).alias("model_type"),
        F.when((et == "purchase") & (F.col("event_id") % 2 == 0), F.concat(F.lit("endpoint_"), (F.col("user_id") % 11).cast("string")))
        .alias("deployment_name"),
        F.when(et == "purchase", F.create_map(F.lit("replicas"), (F.col("event_id") % 4 + 1).cast("string"))).alias("config"))


REG_SQL = (
    "SELECT event_id AS seq, ts, CASE WHEN event_type = 'signup' THEN 'register' WHEN event_type IN ('view', 'click')"
    " THEN 'stage' WHEN event_type = 'purchase' THEN 'deploy' ELSE 'deploy_status' END AS kind,"
    " 'model_' || cast(user_id % 7 AS varchar) AS model_name,"
    " cast(event_id % 11 AS varchar) || '.' || cast(user_id % 3 AS varchar) || '.0' AS model_version,"
    " CASE WHEN event_type = 'view' THEN 'Staging' WHEN event_type = 'click' THEN 'Production' END AS stage,"
    " event_id * 10 AS training_samples, event_id * 2 AS test_samples,"
    " cast(user_id % 10 AS varchar) AS hp_max_depth,"
    " cast(cast(json_extract_string(props, '$.k') AS integer) AS varchar) AS hp_n_estimators,"
    " value / 100.0::double AS m_accuracy, cast(event_id % 100 AS double) / 100.0::double AS m_f1,"
    " CASE WHEN event_type IN ('purchase', 'error') THEN 'dep_' || cast(user_id % 11 AS varchar) END AS deployment_id,"
    " CASE WHEN event_type = 'error' THEN 'failed' END AS status,"
    " CASE WHEN event_type = 'signup' THEN 'models/' || event_id END AS path, CASE WHEN event_type = 'signup' THEN 'daily,team_' || (user_id % 3) END AS tags,"
    " CASE WHEN event_type = 'signup' THEN CASE WHEN event_id % 2 = 0 THEN 'random_forest' ELSE 'logistic_regression' END END AS model_type,"
    " CASE WHEN event_type = 'purchase' AND event_id % 2 = 0 THEN 'endpoint_' || (user_id % 11) END AS deployment_name,"
    " CASE WHEN event_type = 'purchase' THEN cast(event_id % 4 + 1 AS varchar) END AS replicas FROM events")
BROADCAST_MAX_MODELS = 100_000
VKEY = "list_transform(string_split(model_version, '.'), lambda x: cast(x AS integer))"


def _log(spark: SparkSession, sf: str) -> DataFrame:
    return registry_log(TB.table(spark, sf, "events"))


@register("registry_latest", f"SELECT model_name, arg_max(model_version, {VKEY}) AS latest_version"
                             f" FROM ({REG_SQL}) WHERE kind = 'register' GROUP BY model_name")
def registry_latest(spark: SparkSession, sf: str) -> DataFrame:
    return V.latest_versions(_log(spark, sf))


@register("registry_versions", f"SELECT model_name, model_version, min(ts) AS registered_at,"
                               f" dense_rank() OVER (PARTITION BY model_name ORDER BY {VKEY}) AS version_rank"
                               f" FROM ({REG_SQL}) WHERE kind = 'register' GROUP BY model_name, model_version")
def registry_versions(spark: SparkSession, sf: str) -> DataFrame:
    return V.model_versions(_log(spark, sf)).withColumn("version_rank", F.col("version_rank").cast("bigint"))


@register("registry_state", f"SELECT model_name, model_version, arg_max(CASE WHEN kind = 'register' THEN 'Registered'"
                            f" ELSE stage END, (ts, seq)) AS stage FROM ({REG_SQL})"
                            f" WHERE kind IN ('register', 'stage') GROUP BY model_name, model_version")
def registry_state(spark: SparkSession, sf: str) -> DataFrame:
    return V.stages(_log(spark, sf))


@register("registry_models", f"SELECT model_name, count(DISTINCT model_version) AS versions,"
                             f" arg_max(model_version, {VKEY}) AS latest_version, min(ts) AS first_registered,"
                             f" max(ts) AS last_registered FROM ({REG_SQL}) WHERE kind = 'register' GROUP BY model_name")
def registry_models(spark: SparkSession, sf: str) -> DataFrame:
    return V.list_models(_log(spark, sf))


_CMP_SQL = (
    f"WITH r AS ({REG_SQL}), reg AS (SELECT model_name, model_version, arg_max(training_samples, (ts, seq)) AS training_samples,"
    " arg_max(test_samples, (ts, seq)) AS test_samples, arg_max(hp_max_depth, (ts, seq)) AS hp_max_depth,"
    " arg_max(hp_n_estimators, (ts, seq)) AS hp_n_estimators, arg_max(m_accuracy, (ts, seq)) AS accuracy,"
    " arg_max(m_f1, (ts, seq)) AS f1 FROM r WHERE kind = 'register' AND model_name = 'model_0' GROUP BY ALL),"
    " st AS (SELECT model_name, model_version, arg_max(CASE WHEN kind = 'register' THEN 'Registered' ELSE stage END,"
    " (ts, seq)) AS stage FROM r WHERE kind IN ('register', 'stage') AND model_name = 'model_0' GROUP BY ALL)"
    " SELECT reg.model_version, st.stage, training_samples, test_samples, hp_max_depth, hp_n_estimators,"
    " round(accuracy, 6) AS accuracy, NULL::double AS precision, NULL::double AS recall, round(f1, 6) AS f1,"
    " NULL::double AS roc_auc FROM reg LEFT JOIN st USING (model_name, model_version)")


@register("registry_compare", _CMP_SQL)
def registry_compare(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(V.compare_versions(_log(spark, sf), "model_0"))


_DEP_SQL = (
    f"WITH r AS ({REG_SQL}) SELECT deployment_id, arg_max(CASE WHEN kind = 'deploy' THEN 'created' ELSE status END,"
    " (ts, seq)) AS status, arg_max(model_name, CASE WHEN kind = 'deploy' THEN (ts, seq) END) AS model_name,"
    " arg_max(model_version, CASE WHEN kind = 'deploy' THEN (ts, seq) END) AS model_version, count(*) AS events"
    " FROM r WHERE kind IN ('deploy', 'deploy_status') AND deployment_id IS NOT NULL GROUP BY deployment_id")


@register("registry_deployments", _DEP_SQL)
def registry_deployments(spark: SparkSession, sf: str) -> DataFrame:
    return V.deployments(_log(spark, sf))


# ------------------------------------------------------- R1, R5, R7, R8 ---
@register("registry_records", (
    f"SELECT model_name, model_version, arg_max(path, (ts, seq)) AS path, arg_max(tags, (ts, seq)) AS tags,"
    f" arg_max(model_type, (ts, seq)) AS model_type, arg_max(training_samples, (ts, seq)) AS training_samples, max(ts) AS registered_at"
    f" FROM ({REG_SQL}) WHERE kind = 'register' GROUP BY model_name, model_version"))
def registry_records(spark: SparkSession, sf: str) -> DataFrame:
    return V.registrations(_log(spark, sf)).select("model_name", "model_version", "path", F.array_join("tags", ",").alias("tags"), "model_type",
                                                   "training_samples", F.col("ts").alias("registered_at"))


def _requested(log: DataFrame) -> DataFrame:
    """Each version that an event of any kind names, one major version of which was never registered."""
    return log.select("model_name", F.when(F.col("seq") % 10 == 0, F.concat(F.col("model_version"), F.lit(".9"))).otherwise(F.col("model_version"))
                      .alias("model_version"))


_REQ_SQL = ("q AS (SELECT DISTINCT model_name, CASE WHEN seq % 10 = 0 THEN model_version || '.9' ELSE model_version END AS model_version FROM r)")


@register("registry_compare_long", (
    f"WITH r AS ({REG_SQL}), {_REQ_SQL}, g AS (SELECT model_name, model_version, arg_max(training_samples, (ts, seq)) AS training_samples,"
    " arg_max(test_samples, (ts, seq)) AS test_samples, arg_max(hp_max_depth, (ts, seq)) AS d,"
    " arg_max({'v': hp_n_estimators}, (ts, seq)) AS e, arg_max(m_f1, (ts, seq)) AS f1 FROM r WHERE kind = 'register' GROUP BY ALL),"
    " st AS (SELECT model_name, model_version, arg_max(CASE WHEN kind = 'register' THEN 'Registered' ELSE stage END, (ts, seq)) AS stage"
    " FROM r WHERE kind IN ('register', 'stage') GROUP BY ALL),"
    " x AS (SELECT model_name, model_version, unnest([{'kind': 'version', 'name': 'stage', 'value': stage},"
    " {'kind': 'version', 'name': 'training_samples', 'value': training_samples::varchar},"
    " {'kind': 'version', 'name': 'test_samples', 'value': test_samples::varchar},"
    " {'kind': 'hyperparameter', 'name': 'max_depth', 'value': d}, {'kind': 'hyperparameter', 'name': 'n_estimators', 'value': e.v},"
    " {'kind': 'metric', 'name': 'f1', 'value': f1::varchar}]) AS e FROM g JOIN st USING (model_name, model_version))"
    " SELECT model_name, model_version, x.e IS NOT NULL AS known, x.e.kind AS kind, x.e.name AS name, x.e.value AS value"
    " FROM q LEFT JOIN x USING (model_name, model_version)"))
def registry_compare_long(spark: SparkSession, sf: str) -> DataFrame:
    """Every named version compared; the metric ``accuracy``, whose digits the engines print differently, is left out."""
    log = _log(spark, sf).withColumn("metrics", F.map_filter("metrics", lambda k, _: k != "accuracy"))
    return V.compare_long(log, _requested(log))


@register("registry_unknown_versions", f"WITH r AS ({REG_SQL}), {_REQ_SQL} SELECT model_name, model_version FROM q WHERE NOT EXISTS (SELECT 1 FROM r"
                                       " WHERE kind = 'register' AND r.model_name = q.model_name AND r.model_version = q.model_version)")
def registry_unknown_versions(spark: SparkSession, sf: str) -> DataFrame:
    log = _log(spark, sf)
    return V.unknown_versions(log, _requested(log))


@register("registry_deployment_list", (
    f"WITH r AS ({REG_SQL}), d AS (SELECT *, kind = 'deploy' AS made FROM r WHERE kind IN ('deploy', 'deploy_status') AND deployment_id IS NOT NULL),"
    " l AS (SELECT * FROM d WHERE made QUALIFY row_number() OVER (PARTITION BY deployment_id ORDER BY ts DESC, seq DESC) = 1)"
    " SELECT s.deployment_id, coalesce(l.deployment_name, l.model_name) AS deployment_name, l.model_name, l.model_version, l.ts AS created_at,"
    " s.status, l.replicas FROM (SELECT deployment_id, arg_max(CASE WHEN made THEN 'created' ELSE status END, (ts, seq)) AS status FROM d GROUP BY 1) s"
    " LEFT JOIN l USING (deployment_id)"))
def registry_deployment_list(spark: SparkSession, sf: str) -> DataFrame:
    return V.deployment_list(_log(spark, sf)).select("deployment_id", "deployment_name", "model_name", "model_version", "created_at", "status",
                                                     F.col("config")["replicas"].alias("replicas"))


@register("registry_deployed_versions", (
    f"WITH r AS ({REG_SQL}), b AS (SELECT seq, kind, model_name, model_version, deployment_id, max(CASE WHEN kind = 'register' THEN {{'k': {VKEY},"
    " 'v': model_version}} END) OVER (PARTITION BY model_name ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest"
    " FROM r WHERE kind IN ('register', 'deploy'))"
    " SELECT seq, model_name, deployment_id, newest.v AS model_version FROM b WHERE kind = 'deploy'").replace("}}", "}"))
def registry_deployed_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Deployments that name no version take the newest one registered before them."""
    ensure_checkpoint_dir(spark)
    log = _log(spark, sf).withColumn("model_version", F.when(F.col("kind") != "deploy", F.col("model_version")))
    return V.resolve_deployments(log).select("seq", "model_name", "deployment_id", "model_version")


@register("registry_rejected", (
    f"WITH r AS ({REG_SQL}), v AS (SELECT model_name, model_version, min((ts, seq)) AS since FROM r WHERE kind = 'register' GROUP BY ALL),"
    " m AS (SELECT model_name, min(since) AS since FROM v GROUP BY ALL),"
    " n AS (SELECT r.seq, r.kind, r.ts, r.deployment_id, CASE WHEN NOT coalesce(m.since < (r.ts, r.seq), false) THEN 'unknown model'"
    " WHEN NOT coalesce(v.since < (r.ts, r.seq), false) THEN 'unknown version' END AS rejected FROM r LEFT JOIN m USING (model_name)"
    " LEFT JOIN v USING (model_name, model_version) WHERE kind IN ('stage', 'deploy')),"
    " d AS (SELECT deployment_id, min((ts, seq)) AS since FROM n WHERE kind = 'deploy' AND rejected IS NULL GROUP BY 1)"
    " SELECT seq, kind, rejected FROM n UNION ALL SELECT r.seq, r.kind, CASE WHEN NOT coalesce(d.since < (r.ts, r.seq), false) THEN 'unknown deployment' END"
    " FROM r LEFT JOIN d USING (deployment_id) WHERE r.kind = 'deploy_status'"))
def registry_rejected(spark: SparkSession, sf: str) -> DataFrame:
    return V.check_events(_log(spark, sf)).select("seq", "kind", "rejected")


# ----------------------------------------------------------------- V8 ----
@register("scores_with_registry", (
    f"WITH r AS ({REG_SQL}), latest AS (SELECT model_name, arg_max(model_version, {VKEY}) AS model_version,"
    " min(ts) AS first_registered FROM r WHERE kind = 'register' GROUP BY model_name)"
    " SELECT e.event_id, round(e.value / 100.0::double, 6) AS score, latest.model_name, latest.model_version,"
    " latest.first_registered FROM (SELECT *, 'model_' || cast(user_id % 7 AS varchar) AS model_name FROM events) e"
    " JOIN latest ON e.model_name = latest.model_name"))
def scores_with_registry(spark: SparkSession, sf: str) -> DataFrame:
    """Every scored event carries the version of its model (one per user group), looked up in the log.

    The looked-up side has one row per model (a bounded table), so it is
    broadcast in an equi-join on the model name; the event side is never
    shuffled.
    """
    log = _log(spark, sf).where(F.col("kind") == "register")
    latest = log.groupBy("model_name").agg(
        F.max_by("model_version", V.version_key("model_version")).alias("model_version"),
        F.min("ts").alias("first_registered"))
    ev = TB.table(spark, sf, "events").select(
        "event_id", F.round(F.col("value") / F.lit(100.0), 6).alias("score"),
        F.concat(F.lit("model_"), (F.col("user_id") % 7).cast("string")).alias("model_name"))
    # one row per model: broadcast while that is provably small, else a shuffle join
    lookup = F.broadcast(latest) if latest.count() <= BROADCAST_MAX_MODELS else latest
    return ev.join(lookup, "model_name").select(
        "event_id", "score", "model_name", "model_version", "first_registered")
