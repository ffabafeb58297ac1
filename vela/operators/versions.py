"""Append-only version logs: registry state as folds over events.

The registry is never a mutable document.  Every registration, stage change
and deployment status is a row; the current state is ``max_by`` over
``(ts, seq)`` per key, i.e. last write wins, computed as a partial aggregate
(map-side combine, then one shuffle by key).  Version strings order
semantically ("10.0.0" after "9.1.0") through an integer-array sort key.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sequence import max_before, sequence_within

REGISTRY_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType(), False),
    T.StructField("ts", T.TimestampNTZType(), False),
    T.StructField("kind", T.StringType(), False),          # register | stage | deploy | deploy_status
    T.StructField("model_name", T.StringType(), True),
    T.StructField("model_version", T.StringType(), True),
    T.StructField("stage", T.StringType(), True),
    T.StructField("description", T.StringType(), True),
    T.StructField("training_samples", T.LongType(), True),
    T.StructField("test_samples", T.LongType(), True),
    T.StructField("hyperparameters", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType()), True),
    T.StructField("deployment_id", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("path", T.StringType(), True),            # folder of the saved model
    T.StructField("tags", T.ArrayType(T.StringType()), True),
    T.StructField("model_type", T.StringType(), True),
    T.StructField("feature_columns", T.ArrayType(T.StringType()), True),
    T.StructField("target_column", T.StringType(), True),
    T.StructField("training_duration_s", T.DoubleType(), True),
    T.StructField("deployment_name", T.StringType(), True),
    T.StructField("config", T.MapType(T.StringType(), T.StringType()), True),
])
RECORD = ["ts", "description", "training_samples", "test_samples", "hyperparameters", "metrics", "path", "tags", "model_type",
          "feature_columns", "target_column", "training_duration_s"]

CREATED = "created"  # status of a new deployment
KNOWN_METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc"]


class VersionNotFoundError(ValueError):
    pass


def version_key(v: str | Column) -> Column:
    """Dotted version -> ARRAY<INT> (arrays compare element-wise; a part that is no number sorts first)."""
    col = F.col(v) if isinstance(v, str) else v
    return F.transform(F.split(col, r"\."), lambda x: x.try_cast("int"))


def current_state(log: DataFrame, keys: Sequence[str], values: Sequence[str],
                  order: Sequence[str] = ("ts", "seq")) -> DataFrame:
    """Last write wins per key, as one partial aggregate."""
    o = F.struct(*[F.col(c) for c in order])
    return log.groupBy(*keys).agg(*[F.max_by(F.col(v), o).alias(v) for v in values])


def latest_versions(log: DataFrame) -> DataFrame:
    """W1 / R2 (version=None): newest semantic version per model."""
    reg = log.where(F.col("kind") == "register")
    return reg.groupBy("model_name").agg(
        F.max_by("model_version", version_key("model_version")).alias("latest_version"))


def get_version(log: DataFrame, model_name: str, version: str | None = None) -> DataFrame:
    """R2 with its three errors: unknown model, no versions, unknown version."""
    reg = log.where((F.col("kind") == "register") & (F.col("model_name") == model_name))
    if not reg.limit(1).count():
        raise VersionNotFoundError(f"{model_name!r}: not found in registry")
    if version is None:
        version = latest_versions(reg).first()["latest_version"]
        if version is None:
            raise VersionNotFoundError(f"{model_name!r} has no registered version")
    row = registrations(reg.where(F.col("model_version") == version))
    if not row.limit(1).count():
        raise VersionNotFoundError(f"Version {version} of {model_name!r} is not registered")
    return row


def registrations(log: DataFrame) -> DataFrame:
    """Current registration record per (model, version) (re-register overwrites)."""
    reg = log.where(F.col("kind") == "register")
    return current_state(reg, ["model_name", "model_version"],
                         [c for c in RECORD if c in log.columns])


def stages(log: DataFrame) -> DataFrame:
    """Current stage per (model, version); registration sets 'Registered'."""
    ev = log.where(F.col("kind").isin("register", "stage")).select(
        "model_name", "model_version", "ts", "seq",
        F.when(F.col("kind") == "register", F.lit("Registered")).otherwise(F.col("stage")).alias("stage"))
    return current_state(ev, ["model_name", "model_version"], ["stage"])


def model_versions(log: DataFrame) -> DataFrame:
    """Distinct versions per model with dense semantic rank (1 = oldest).

    The rank is a skew-safe per-model position over distinct version keys, so
    a model with a very long history is split across tasks.
    """
    reg = (log.where(F.col("kind") == "register").groupBy("model_name", "model_version")
           .agg(F.min("ts").alias("registered_at"))
           .withColumn("_vkey", version_key("model_version")))
    keys = reg.select("model_name", "_vkey").distinct()
    ranked = sequence_within(keys, ["model_name"], "_vkey", out="_pos")
    return (reg.join(ranked, ["model_name", "_vkey"])
            .select("model_name", "model_version", "registered_at", (F.col("_pos") + 1).alias("version_rank")))


def list_models(log: DataFrame) -> DataFrame:
    """Per model summary (version count, newest version, registration span)."""
    reg = log.where(F.col("kind") == "register")
    return reg.groupBy("model_name").agg(
        F.count_distinct("model_version").alias("versions"),
        F.max_by("model_version", version_key("model_version")).alias("latest_version"),
        F.min("ts").alias("first_registered"), F.max("ts").alias("last_registered"))


def compare_long(log: DataFrame, requested: DataFrame) -> DataFrame:
    """R5 in long form for any number of models: (model_name, model_version, known, kind, name, value).

    ``requested`` (model_name, model_version) may be a table of any size.  A version that is not registered gives one row with
    ``known`` false; a registered one a row of kind ``version`` per record field, ``hyperparameter`` and ``metric`` per entry.
    Names are data here, not columns, so none is collected.
    """
    asked = requested.select("model_name", "model_version").distinct()
    keys = ["model_name", "model_version"]
    regs = registrations(log).join(stages(log), keys, "left")

    def entry(kind: str, name: Column, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), name.alias("name"), value.cast("string").alias("value"))

    def entries(kind: str, column: str, type_: str) -> Column:
        pairs = F.map_entries(F.coalesce(F.col(column), F.create_map().cast(type_)))
        return F.transform(pairs, lambda e: entry(kind, e["key"], e["value"]))

    fields = F.array(*[entry("version", F.lit(c), F.col(c)) for c in ("stage", "training_samples", "test_samples")])
    maps = [entries("hyperparameter", "hyperparameters", "map<string,string>"), entries("metric", "metrics", "map<string,double>")]
    rows = regs.select(*keys, F.explode(F.concat(fields, *maps)).alias("e")).select(*keys, F.lit(True).alias("known"), "e.*")
    return asked.join(rows, keys, "left").withColumn("known", F.coalesce("known", F.lit(False)))


def unknown_versions(log: DataFrame, requested: DataFrame) -> DataFrame:
    """Those of ``requested`` (model_name, model_version) that are not registered."""
    known = log.where(F.col("kind") == "register").select("model_name", "model_version")
    return requested.select("model_name", "model_version").distinct().join(known, ["model_name", "model_version"], "left_anti")


def compare_versions(log: DataFrame, model_name: str, versions: Sequence[str] | None = None,
                     metrics: Sequence[str] = KNOWN_METRICS) -> DataFrame:
    """R5 + R6: one row per version: stage, sample counts, hp_* and metrics.

    Requested versions that are not registered give no row here; ``unknown_versions`` and ``compare_long`` report them.
    Hyperparameter names become columns, so those of this one model are read from the log (a small distinct set).
    """
    regs = registrations(log.where(F.col("model_name") == model_name))
    if versions is not None:
        regs = regs.where(F.col("model_version").isin(list(versions)))
    st = stages(log.where(F.col("model_name") == model_name))
    hp_names = sorted(r["k"] for r in regs.select(F.explode(F.map_keys("hyperparameters")).alias("k"))
                      .distinct().collect())
    cols = [F.col("model_version"), F.col("stage"), F.col("training_samples"), F.col("test_samples")]
    cols += [F.col("hyperparameters").getItem(h).alias(f"hp_{h}") for h in hp_names]
    cols += [F.col("metrics").getItem(m).alias(m) for m in metrics]
    return regs.join(st, ["model_name", "model_version"], "left").select(*cols)


def deployments(log: DataFrame) -> DataFrame:
    """Current status and deployed version per deployment id."""
    dep = log.where(F.col("kind").isin("deploy", "deploy_status") & F.col("deployment_id").isNotNull())
    status = F.when(F.col("kind") == "deploy", F.lit(CREATED)).otherwise(F.col("status"))
    dep = dep.select("deployment_id", "ts", "seq", status.alias("status"),
                     F.when(F.col("kind") == "deploy", F.struct("model_name", "model_version")).alias("target"))
    o = F.struct("ts", "seq")
    return dep.groupBy("deployment_id").agg(
        F.max_by("status", o).alias("status"),
        F.max_by("target", F.when(F.col("target").isNotNull(), o)).alias("target"),
        F.count(F.lit(1)).alias("events")).select(
        "deployment_id", "status", F.col("target.model_name").alias("model_name"),
        F.col("target.model_version").alias("model_version"), "events")


def deployment_list(log: DataFrame) -> DataFrame:
    """One row per deployment: name (the model's if none), target, creation time, current status, description, config."""
    dep = log.where(F.col("kind").isin("deploy", "deploy_status") & F.col("deployment_id").isNotNull())
    made = F.col("kind") == "deploy"
    o = F.struct("ts", "seq")
    return dep.groupBy("deployment_id").agg(
        F.max_by(F.when(made, F.struct(F.coalesce("deployment_name", "model_name").alias("deployment_name"), "model_name", "model_version",
                                       F.col("ts").alias("created_at"), "description", "config")), F.when(made, o)).alias("d"),
        F.max_by(F.when(made, F.lit(CREATED)).otherwise(F.col("status")), o).alias("status")).select("deployment_id", "d.*", "status")


def get_deployment(log: DataFrame, deployment_id: str) -> DataFrame:
    """The row of one deployment; an id that no deployment has is an error."""
    row = deployment_list(log.where(F.col("deployment_id") == deployment_id)).where("created_at IS NOT NULL")
    if row.isEmpty():
        raise VersionNotFoundError(f"No deployment has the id {deployment_id!r}")
    return row


def resolve_deployments(log: DataFrame) -> DataFrame:
    """Deploy events with the version they deploy: the given one, else the newest that was registered before."""
    reg = F.col("kind") == "register"
    ev = log.where(reg | (F.col("kind") == "deploy")).withColumn(
        "_newest", F.when(reg, F.struct(version_key("model_version").alias("key"), F.col("model_version").alias("version"))))
    seen = max_before(ev, ["model_name"], "ts", ["seq"], "_newest", "_before").where(F.col("kind") == "deploy")
    return seen.withColumn("model_version", F.coalesce("model_version", "_before.version")).select(*log.columns)


def check_events(log: DataFrame) -> DataFrame:
    """Every stage, deploy and status event with ``rejected``: why it cannot apply, NULL if it can.

    An event applies if what it names existed before it: the version registered, the deployment created.
    One aggregate per kind of name holds the first (ts, seq) it existed at; events join it on their key.
    """
    at = F.struct("ts", "seq")
    made = F.col("kind") == "register"
    versions = log.where(made).groupBy("model_name", "model_version").agg(F.min(at).alias("registered"))
    models = log.where(made).groupBy("model_name").agg(F.min(at).alias("first"))
    before = lambda c: F.coalesce(F.col(c) < F.struct("ts", "seq"), F.lit(False))
    newest = (F.col("kind") == "deploy") & F.col("model_version").isNull()
    named = (log.where(F.col("kind").isin("stage", "deploy")).join(versions, ["model_name", "model_version"], "left")
             .join(models, "model_name", "left")
             .withColumn("rejected", F.when(~before("first"), "unknown model").when(~newest & ~before("registered"), "unknown version")))
    deps = (named.where((F.col("kind") == "deploy") & F.col("deployment_id").isNotNull() & F.col("rejected").isNull())
            .groupBy("deployment_id").agg(F.min(at).alias("created")))
    status = (log.where(F.col("kind") == "deploy_status").join(deps, "deployment_id", "left")
              .withColumn("rejected", F.when(~before("created"), "unknown deployment")))
    cols = [*log.columns, "rejected"]
    return named.select(*cols).unionByName(status.select(*cols))


class VersionLog:
    """R1/R7 writers: append rows to a Parquet log under a shared folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._seq = None

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(REGISTRY_SCHEMA).parquet(self.path)
        except Exception:  # noqa: BLE001 - empty log
            return self.spark.createDataFrame([], REGISTRY_SCHEMA)

    def _next_seq(self) -> int:
        if self._seq is None:
            m = self.read().agg(F.max("seq")).first()[0]
            self._seq = m or 0
        self._seq += 1
        return self._seq

    def append(self, **fields) -> None:
        row = {f.name: fields.get(f.name) for f in REGISTRY_SCHEMA.fields}
        row["seq"] = self._next_seq()
        row["ts"] = row["ts"] or _dt.datetime.now()
        self.spark.createDataFrame([row], REGISTRY_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def register(self, model_name: str, model_version: str, description: str = "",
                 training_samples: int | None = None, test_samples: int | None = None,
                 hyperparameters: dict | None = None, metrics: dict | None = None, **record) -> None:
        """``record``: path, tags, model_type, feature_columns, target_column, training_duration_s."""
        unknown = set(record) - set(RECORD)
        if unknown:
            raise ValueError(f"no fields of a registration: {sorted(unknown)}")
        self.append(kind="register", model_name=model_name, model_version=model_version, description=description,
                    training_samples=training_samples, test_samples=test_samples,
                    hyperparameters={k: str(v) for k, v in (hyperparameters or {}).items()},
                    metrics={k: float(v) for k, v in (metrics or {}).items() if v is not None}, **record)

    def append_events(self, events: DataFrame) -> DataFrame:
        """Append a table of events (columns of the log but ``seq``) in one job; those that cannot apply are returned, not written.

        Within the batch events follow their ``ts``; ``seq`` continues the log's by range-partitioned position.
        """
        log = self.read()
        last = log.agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0]
        rows = events.select(*[(F.col(f.name) if f.name in events.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                               for f in REGISTRY_SCHEMA.fields if f.name != "seq"])
        rows = sequence_within(rows.withColumn("_all", F.lit(0)), ["_all"], "ts", out="seq").drop("_all")
        rows = rows.withColumn("seq", F.col("seq") + F.lit(last + 1)).select(*REGISTRY_SCHEMA.names).checkpoint()
        checked = check_events(log.unionByName(rows)).where(F.col("seq") > last).checkpoint()
        bad = checked.where("rejected IS NOT NULL")
        good = resolve_deployments(log.unionByName(rows)).where(F.col("seq") > last).unionByName(rows.where("kind <> 'deploy'"))
        good.join(bad.select("seq"), "seq", "left_anti").select(*REGISTRY_SCHEMA.names).write.mode("append").parquet(self.path)
        self._seq = None
        return bad

    def set_stage(self, model_name: str, model_version: str, stage: str) -> None:
        known = self.read().where((F.col("model_name") == model_name) & (F.col("model_version") == model_version))
        if not known.limit(1).count():
            raise VersionNotFoundError(f"Version {model_version} of {model_name!r} is not registered")
        self.append(kind="stage", model_name=model_name, model_version=model_version, stage=stage)

    def create_deployment(self, model_name: str, model_version: str | None = None, deployment_name: str | None = None,
                          description: str | None = None, config: dict | None = None) -> str:
        """Deploy a version (newest by default); returns the deployment's id."""
        now = _dt.datetime.now()
        name = deployment_name or model_name
        dep = f"{name}_{now.isoformat().replace(':', '-')}"
        self._change(ts=now, kind="deploy", model_name=model_name, model_version=model_version, deployment_id=dep, deployment_name=name,
                     description=description, config={k: str(v) for k, v in (config or {}).items()})
        return dep

    def set_deployment_status(self, deployment_id: str, status: str) -> None:
        self._change(ts=_dt.datetime.now(), kind="deploy_status", deployment_id=deployment_id, status=status)

    def _change(self, **event) -> None:
        row = {f.name: event.get(f.name) for f in REGISTRY_SCHEMA.fields if f.name != "seq"}
        schema = T.StructType([f for f in REGISTRY_SCHEMA.fields if f.name != "seq"])
        bad = self.append_events(self.spark.createDataFrame([row], schema)).first()
        if bad is not None:
            raise VersionNotFoundError(f"{bad['rejected']}: {event.get('deployment_id') if bad['kind'] == 'deploy_status' else event['model_name']}")
