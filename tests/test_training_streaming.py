import pytest
from pyspark.sql import functions as F

from vela.operators import features as FE
from vela.operators import training as TR
from vela.plans import ml_queries as MQ
from vela.session import scratch_path
from vela.sources import generators as G
from vela.streaming import scoring as ST


@pytest.fixture(scope="module")
def churn(spark):
    return G.customer_dataset(spark.range(1, 1501), "2.0.0")


@pytest.fixture(scope="module")
def lr_model(churn):
    return TR.train(churn, "Churned", "logistic_regression", id_column="CustomerId")


def test_train_record(lr_model):
    _, rec = lr_model
    assert rec["training_samples"] + rec["test_samples"] == 1500
    assert 0.5 < rec["accuracy"] <= 1.0 and 0.5 < rec["roc_auc"] <= 1.0
    assert rec["hyperparameters"] == {"C": 1.0, "max_iter": 100}
    assert "CustomerId" not in rec["feature_columns"]


def test_unknown_model_type(churn):
    with pytest.raises(TR.UnknownModelTypeError):
        TR.train(churn, "Churned", "svm", id_column="CustomerId")


def test_forest_hyperparameter_override(churn):
    _, rec = TR.train(churn, "Churned", "random_forest", id_column="CustomerId",
                      hyperparameters={"n_estimators": 5, "max_depth": 3})
    assert rec["hyperparameters"]["n_estimators"] == 5 and rec["hyperparameters"]["min_samples_leaf"] == 1
    assert 0.0 <= rec["roc_auc"] <= 1.0


def test_save_load_same_predictions(spark, lr_model, churn):
    model, _ = lr_model
    path = scratch_path(spark, "model")
    TR.save(model, path)
    a = TR.predict(model, churn, ["CustomerId"]).collect()
    b = TR.predict(TR.load(path), churn, ["CustomerId"]).collect()
    assert sorted(a) == sorted(b)


def test_stream_equals_batch(spark, lr_model):
    model, _ = lr_model
    req = G.customer_dataset(spark.range(1, 301), "1.0.0").drop("Churned")
    src, sink, ck = (scratch_path(spark, n) for n in ("src", "sink", "ck"))
    req.select(F.to_json(F.struct(*req.columns)).alias("value")).write.text(src)
    q = ST.score_stream(spark, src, req.schema, model, MQ.FEATURES_V2, sink, ck, keep=["CustomerId"])
    q.awaitTermination()
    streamed = sorted(tuple(r) for r in spark.read.parquet(sink).where("error IS NULL").drop("error").collect())
    batch = sorted(tuple(r) for r in TR.predict(model, FE.align_features(req, MQ.FEATURES_V2), ["CustomerId"]).collect())
    assert streamed == batch and len(streamed) == 300


def test_lifecycle_end_to_end(spark):
    from vela.operators import lineage as L
    from vela.operators import versions as V
    from vela.plans.lifecycle import run_lifecycle

    res = run_lifecycle(spark, spark.range(1, 801), model_type="logistic_regression")
    assert res.snapshot["row_count"] == 800 and res.scored.count() == 800
    ev = L.read_events(spark, res.lineage_path)
    runs = L.runs(ev).collect()
    assert {r.status for r in runs} == {"COMPLETE"} and len(runs) == 2
    reg = V.VersionLog(spark, res.registry_path).read()
    assert V.latest_versions(reg).first()["latest_version"] == "1.0.0"


def test_overrides_that_a_fit_cannot_follow_are_errors():
    assert TR.effective_hyperparameters("random_forest", {"max_depth": 15})["max_depth"] == 15
    for model, bad in (("random_forest", {"depth": 3}), ("random_forest", {"min_samples_split": 10}), ("gradient_boosting", {"tol": 0.1})):
        with pytest.raises(ValueError):
            TR.effective_hyperparameters(model, bad)


def test_split_key_is_no_feature(spark):
    df = spark.range(200).selectExpr("id AS k", "id % 7 AS x", "id % 7 > 3 AS y")
    _, rec = TR.train(df, "y", "logistic_regression", key="k")
    assert rec["feature_columns"] == ["x"] and 0 < rec["test_samples"] < 200
