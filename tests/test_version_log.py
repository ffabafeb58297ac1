"""Version log as a log: full records, deployments, checks of batches of events, comparison of any versions."""

import datetime as dt

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import Binarizer
from pyspark.sql import functions as F

from vela.operators import sequence as SQ
from vela.operators import training as TR
from vela.operators import versions as V
from vela.session import scratch_path


def _at(minute):
    return dt.datetime(2024, 1, 1, 0, minute)


def test_record_is_stored_in_full_and_the_newest_model_loads(spark):
    log = V.VersionLog(spark, scratch_path(spark, "reg"))
    data = spark.createDataFrame([(0.2,), (0.8,)], "x double")
    for version, threshold in (("9.0.0", 0.9), ("10.0.0", 0.5)):
        path = scratch_path(spark, "model")
        TR.save(Pipeline(stages=[Binarizer(threshold=threshold, inputCol="x", outputCol="y")]).fit(data), path)
        log.register("m", version, path=path, tags=["a", "b"], model_type="binarizer", feature_columns=["x"], target_column="y",
                     training_duration_s=1.5)
    log.register("m", "1.0.0")
    row = V.get_version(log.read(), "m", "9.0.0").first()
    assert (row.tags, row.feature_columns, row.target_column, row.training_duration_s, row.model_type) == (["a", "b"], ["x"], "y", 1.5, "binarizer")
    assert [r.y for r in TR.load_version(log.read(), "m").transform(data).orderBy("x").collect()] == [0.0, 1.0]
    assert [r.y for r in TR.load_version(log.read(), "m", "9.0.0").transform(data).collect()] == [0.0, 0.0]
    with pytest.raises(ValueError, match="without a path"):
        TR.load_version(log.read(), "m", "1.0.0")
    with pytest.raises(ValueError, match="no fields"):
        log.register("m", "1.0.1", colour="red")


def test_deployment_life(spark):
    log = V.VersionLog(spark, scratch_path(spark, "reg"))
    log.register("m", "9.0.0")
    log.register("m", "10.0.0")
    newest = log.create_deployment("m", config={"replicas": 2})
    older = log.create_deployment("m", "9.0.0", deployment_name="edge", description="trial")
    log.set_deployment_status(newest, "running")
    got = {r.deployment_id: r for r in V.deployment_list(log.read()).collect()}
    assert set(got) == {newest, older}
    assert (got[newest].model_version, got[newest].status, got[newest].deployment_name, got[newest].config) == ("10.0.0", "running", "m", {"replicas": "2"})
    assert (got[older].model_version, got[older].status, got[older].deployment_name, got[older].description) == ("9.0.0", "created", "edge", "trial")
    assert V.get_deployment(log.read(), older).first()["created_at"] is not None
    for bad in (lambda: log.set_deployment_status("none", "running"), lambda: log.create_deployment("m", "3.0.0"),
                lambda: log.create_deployment("other"), lambda: V.get_deployment(log.read(), "none")):
        with pytest.raises(V.VersionNotFoundError):
            bad()
    assert V.deployment_list(log.read()).count() == 2  # refused events leave no row


def test_a_batch_of_events_is_checked_in_its_own_order(spark):
    log = V.VersionLog(spark, scratch_path(spark, "reg"))
    log.append(kind="register", model_name="m", model_version="1.0.0", ts=_at(0))
    rows = [("deploy", "m", None, "d1", None, _at(1)),  # newest so far: 1.0.0
            ("register", "m", "2.0.0", None, None, _at(2)),
            ("deploy", "m", None, "d2", None, _at(3)),  # 2.0.0
            ("deploy", "m", "5.0.0", "d3", None, _at(4)),  # refused: unknown version
            ("deploy_status", None, None, "d3", "running", _at(5)),  # refused: its deployment was
            ("deploy_status", None, None, "d1", "running", _at(6)),
            ("stage", "m", "2.0.0", None, None, _at(1)),  # refused: registered later
            ("deploy", "x", None, "d4", None, _at(7)),  # refused: unknown model
            ("deploy_status", None, None, None, "running", _at(8))]  # refused: no id
    events = spark.createDataFrame(rows, "kind string, model_name string, model_version string, deployment_id string, status string, ts timestamp_ntz")
    bad = sorted((r.kind, r.deployment_id or "", r.rejected) for r in log.append_events(events).collect())
    assert bad == [("deploy", "d3", "unknown version"), ("deploy", "d4", "unknown model"), ("deploy_status", "", "unknown deployment"),
                   ("deploy_status", "d3", "unknown deployment"), ("stage", "", "unknown version")]
    got = {r.deployment_id: (r.model_version, r.status) for r in V.deployment_list(log.read()).collect()}
    assert got == {"d1": ("1.0.0", "running"), "d2": ("2.0.0", "created")}
    assert log.read().count() == 5 and log.read().select("seq").distinct().count() == 5


def test_comparison_reports_unknown_versions(spark):
    log = V.VersionLog(spark, scratch_path(spark, "reg"))
    log.register("m", "1.0.0", hyperparameters={"depth": 3}, metrics={"f1": 0.5}, training_samples=7)
    log.register("m", "1.1.0")
    asked = spark.createDataFrame([("m", "1.0.0"), ("m", "1.1.0"), ("m", "4.0.0"), ("z", "1.0.0"), ("z", "1.0.0")], "model_name string, model_version string")
    assert {tuple(r) for r in V.unknown_versions(log.read(), asked).collect()} == {("m", "4.0.0"), ("z", "1.0.0")}
    rows = V.compare_long(log.read(), asked).collect()
    assert {(r.model_name, r.model_version) for r in rows if not r.known} == {("m", "4.0.0"), ("z", "1.0.0")}
    assert {(r.kind, r.name, r.value) for r in rows if r.model_version == "1.0.0" and r.known} == {
        ("version", "stage", "Registered"), ("version", "training_samples", "7"), ("version", "test_samples", None),
        ("hyperparameter", "depth", "3"), ("metric", "f1", "0.5")}
    assert V.compare_long(log.read(), asked.limit(0)).count() == 0


def test_running_maximum_of_a_hot_key_equals_a_window(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
                                  (F.col("id") % 700).alias("t"), "id", F.when(F.col("id") % 4 != 0, F.array(F.hash("id"))).alias("v"))
    got = {r.id: r.m for r in SQ.max_before(df, ["k"], "t", ["id"], "v", "m", buckets=6).collect()}
    best, want = {}, {}
    for r in sorted(df.collect(), key=lambda r: (r.k, r.t, r.id)):
        want[r.id] = best.get(r.k)
        if r.v is not None:
            best[r.k] = max(best.get(r.k) or r.v, r.v)
    assert got == want
