"""Registered training, scoring and streaming queries.

Model fits are distributed Spark ML jobs whose results (trees, weights) are
not reproducible in SQL, so these are rows-only entries; their invariants
are asserted in ``tests/``.  The event-counter stream has an SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import features as FE
from ..operators import scoring as SC
from ..operators import training as TR
from ..session import ensure_checkpoint_dir, scratch_path
from ..sources import generators as G
from ..sources import tables as TB
from ..streaming import scoring as ST
from .catalog import register, round_doubles

RECORD_COLUMNS = ["model_type", "training_samples", "test_samples", "accuracy", "precision", "recall", "f1",
                  "roc_auc"]


def churn_v2(spark: SparkSession, sf: str) -> DataFrame:
    return G.customer_dataset(TB.customer_ids(spark, sf), "2.0.0")


def _record_df(spark: SparkSession, rec: dict) -> DataFrame:
    row = {k: rec[k] for k in RECORD_COLUMNS}
    row["hyperparameters"] = {k: str(v) for k, v in rec["hyperparameters"].items()}
    schema = ("model_type string, training_samples bigint, test_samples bigint, accuracy double, precision double,"
              " recall double, f1 double, roc_auc double, hyperparameters map<string,string>")
    return spark.createDataFrame([row], schema)


def _train_query(model_type: str, overrides: dict | None = None):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        _, rec = TR.train(churn_v2(spark, sf), "Churned", model_type, id_column="CustomerId",
                          hyperparameters=overrides)
        return _record_df(spark, rec)
    return run


register("train_rf")(_train_query("random_forest"))
register("train_gbt")(_train_query("gradient_boosting"))
register("train_lr")(_train_query("logistic_regression"))
register("train_mlp")(_train_query("neural_network"))


@register("tune_lr")
def tune_lr(spark: SparkSession, sf: str) -> DataFrame:
    df = churn_v2(spark, sf)
    feats = FE.feature_columns(df, "Churned", "CustomerId")
    _, info = TR.tune(df, "Churned", feats, "CustomerId", [0.0, 0.001, 0.01, 0.1])
    return spark.createDataFrame([info], "best_reg_param double, validation_auc double, test_auc double,"
                                         " test_accuracy double")


@register("score_two_versions")
def score_two_versions(spark: SparkSession, sf: str) -> DataFrame:
    """V4 + V5: forest v1 (reference defaults) and v2 (150 trees, depth 15), one scoring scan."""
    df = churn_v2(spark, sf)
    train, _ = FE.split_hash(df, "CustomerId", TR.TRAINING_SPLIT, TR.RANDOM_STATE)
    feats = FE.feature_columns(df, "Churned", "CustomerId")
    m1, _ = TR.fit(train, "Churned", feats, "random_forest")
    m2, _ = TR.fit(train, "Churned", feats, "random_forest", {"n_estimators": 150, "max_depth": 15})
    both = SC.score_versions(df, {"v1": m1, "v2": m2}, ["CustomerId", "Churned"])
    return both.withColumn("agree", F.col("pred_v1") == F.col("pred_v2"))


@register("model_roundtrip")
def model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Save, load, and score with the loaded model (must equal the in-memory one)."""
    df = churn_v2(spark, sf)
    model, _ = TR.train(df, "Churned", "logistic_regression", id_column="CustomerId")
    path = scratch_path(spark, "model")
    TR.save(model, path)
    loaded = TR.load(path)
    a = TR.predict(model, df, ["CustomerId"]).withColumnRenamed("prediction", "p_mem") \
        .withColumnRenamed("probability", "prob_mem")
    b = TR.predict(loaded, df, ["CustomerId"])
    return a.join(b, "CustomerId").select("CustomerId", "prediction", "probability",
                                          (F.col("prediction") == F.col("p_mem")).alias("same_prediction"))


FEATURES_V2 = T.StructType([
    T.StructField("Age", T.IntegerType()), T.StructField("Tenure", T.IntegerType()),
    T.StructField("ContractType", T.StringType()), T.StructField("MonthlyCharges", T.DoubleType()),
    T.StructField("TotalCharges", T.DoubleType()), T.StructField("HasPhoneService", T.BooleanType()),
    T.StructField("HasInternetService", T.BooleanType())])


@register("stream_score")
def stream_score(spark: SparkSession, sf: str) -> DataFrame:
    """V9: v1-shaped requests (two v2 features absent) scored by a v2 model in a stream."""
    ensure_checkpoint_dir(spark)
    model, _ = TR.train(churn_v2(spark, sf), "Churned", "logistic_regression", id_column="CustomerId")
    src, sink, ck = (scratch_path(spark, n) for n in ("requests", "scored", "stream-ckpt"))
    requests = G.customer_dataset(TB.customer_ids(spark, sf), "1.0.0").drop("Churned")
    requests.select(F.to_json(F.struct(*requests.columns)).alias("value")).write.text(src)
    record_schema = T.StructType([f for f in requests.schema.fields])
    q = ST.score_stream(spark, src, record_schema, model, FEATURES_V2, sink, ck, keep=["CustomerId"])
    q.awaitTermination()
    return spark.read.parquet(sink)


_COUNTERS_SQL = ("SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, count(*) AS requests,"
                 " round(avg(value), 6) AS mean_value FROM events GROUP BY ALL")


@register("stream_event_counters", _COUNTERS_SQL)
def stream_event_counters(spark: SparkSession, sf: str) -> DataFrame:
    """Event-time windowed counters over the events table as a stream."""
    src, sink, ck = (scratch_path(spark, n) for n in ("events-src", "counters", "counters-ckpt"))
    ev = TB.table(spark, sf, "events")
    ev.write.parquet(src)
    ST.event_counters_stream(spark, src, ev.schema, sink, ck).awaitTermination()
    return round_doubles(ST.fold_counters(spark.read.parquet(sink), ["window_start", "event_type"]))


@register("stream_late_counters", _COUNTERS_SQL)
def stream_late_counters(spark: SparkSession, sf: str) -> DataFrame:
    """The same counters in two start-stop rounds, the later half of the month first."""
    src, sink, ck = (scratch_path(spark, n) for n in ("late-src", "late-counters", "late-ckpt"))
    ev = TB.table(spark, sf, "events")
    late = F.col("ts") >= F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    for part in (ev.where(late), ev.where(~F.coalesce(late, F.lit(False)))):
        part.write.mode("append").parquet(src)
        ST.event_counters_stream(spark, src, ev.schema, sink, ck).awaitTermination()
    return round_doubles(ST.fold_counters(spark.read.parquet(sink), ["window_start", "event_type"]))


@register("stream_bad_records",
          "SELECT event_id % 5 = 0 AS bad, count(*) AS records, coalesce(sum(CASE WHEN event_id % 5 <> 0 THEN"
          " cast(json_extract_string(props, '$.k') AS bigint) END), 0)::bigint AS total FROM events GROUP BY 1")
def stream_bad_records(spark: SparkSession, sf: str) -> DataFrame:
    """V6/V9: a stream of records, every fifth line malformed; each line gives one row, bad ones with an error."""
    src, sink, ck = (scratch_path(spark, n) for n in ("bad-src", "bad-records", "bad-ckpt"))
    ev = TB.table(spark, sf, "events")
    line = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("broken "), F.col("props"))).otherwise(F.col("props"))
    ev.select(line.alias("value")).write.text(src)
    records = ST.read_records_stream(spark, src, T.StructType([T.StructField("k", T.LongType())]))
    q = (records.writeStream.format("parquet").option("path", sink).option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink).groupBy(F.col("error").isNotNull().alias("bad")).agg(
        F.count(F.lit(1)).alias("records"), F.coalesce(F.sum("k"), F.lit(0)).alias("total"))


# ------------------------------------------------------- V9 + A8, metered ---
REQUEST = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("k", T.LongType()), T.StructField("amount", T.DoubleType())])
REQUEST_MODEL = {"intercept": -1.5, "weights": {"k": 0.02, "amount": 0.01}}
_REQUESTS_SQL = (
    "SELECT event_id, event_id % 7 = 3 AS broken, cast(json_extract_string(props, '$.k') AS bigint) AS k,"
    " CASE WHEN event_id % 11 <> 5 THEN value END AS amount FROM events")
_SCORES_SQL = (
    f"SELECT CASE WHEN NOT broken THEN event_id END AS event_id, CASE WHEN NOT broken THEN 1.0::double / (1.0::double + exp(-(-1.5::double"
    f" + 0.02::double * k + 0.01::double * amount))) END AS probability, CASE WHEN broken THEN 'malformed' WHEN amount IS NULL THEN 'amount missing'"
    f" END AS error FROM ({_REQUESTS_SQL})")


def _scored_in_rounds(spark: SparkSession, sf: str) -> tuple[str, str]:
    """The events as JSON requests, scored by a stream that is stopped and started again; folders of scores and metrics."""
    ensure_checkpoint_dir(spark)
    src, sink, metrics, ck = (scratch_path(spark, n) for n in ("metered-src", "metered-scores", "metered-metrics", "metered-ckpt"))
    ev = TB.table(spark, sf, "events").select(
        "event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"), F.when(F.col("event_id") % 11 != 5, F.col("value")).alias("amount"))
    line = F.to_json(F.struct("event_id", "k", "amount"))
    lines = ev.select("event_id", F.when(F.col("event_id") % 7 == 3, F.concat(F.lit("broken "), line)).otherwise(line).alias("value"))
    late = F.col("event_id") % 2 == 0
    for part in (lines.where(late), lines.where(~late)):
        part.select("value").write.mode("append").text(src)
        ST.score_batches(spark, src, REQUEST, SC.sigmoid(SC.linear_logit(**REQUEST_MODEL)), ["event_id"], sink, metrics, ck,
                         checks=lambda: SC.validity([(F.col("amount").isNotNull(), "amount missing")]), max_files_per_trigger=64).awaitTermination()
    return sink, metrics


@register("stream_linear_scores", f"SELECT event_id, round(probability, 6) AS probability, probability >= 0.5 AS prediction, error FROM ({_SCORES_SQL})")
def stream_linear_scores(spark: SparkSession, sf: str) -> DataFrame:
    sink, _ = _scored_in_rounds(spark, sf)
    broken = F.col("error").startswith("broken ")
    return spark.read.parquet(sink).select("event_id", F.round("probability", 6).alias("probability"), "prediction",
                                           F.when(broken, "malformed").otherwise(F.col("error")).alias("error"))


@register("stream_scoring_metrics", (
    f"SELECT count(*) AS requests, count(error) AS errors, count_if(probability >= 0.5)::bigint AS positives, count(probability) AS scored,"
    f" round(avg(probability), 6) AS mean_probability FROM ({_SCORES_SQL})"))
def stream_scoring_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The stored metrics of all batches of both rounds equal those of the whole table."""
    _, metrics = _scored_in_rounds(spark, sf)
    return round_doubles(ST.fold_metrics(ST.scoring_metrics(spark, metrics)).select("requests", "errors", "positives", "scored", "mean_probability"))
