"""Registered queries: samplers, features, split, metrics and scoring.

The metric queries score generated card transactions (over ``orders``)
with fixed linear models written as Column arithmetic, so every value is
checkable in DuckDB.  Inputs are rounded to six places first in both
engines, making the linear scores bit-identical.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import random as R
from ..operators import features as FE
from ..operators import metrics as M
from ..operators import scoring as SC
from ..sources import generators as G
from ..sources import tables as TB
from . import oracle as O
from .catalog import _doubles, register, round_doubles, rsql

# Fixed linear fraud models used by the checkable metric queries.
FRAUD_V1 = dict(intercept=-4.0, weights={"Amount": 0.0004, "FraudSignals": 25.0},
                indicators=[("UsedChip", True, -0.5), ("OnlineOrder", True, 0.4),
                            ("MerchantCategory", "online", 0.3)])
FRAUD_V2 = dict(intercept=-4.2, weights={"Amount": 0.0005, "FraudSignals": 30.0, "DistanceFromHome": 0.002},
                indicators=[("UsedChip", True, -0.4), ("OnlineOrder", True, 0.5)])
THRESHOLD = 0.05
CHURN_MODEL = dict(intercept=-1.0, weights={"Tenure": -0.03, "MonthlyCharges": 0.02},
                   indicators=[("ContractType", "Month-to-month", 0.8), ("HasInternetService", True, 0.3)])


def _credit3(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(G.credit_dataset(TB.order_ids(spark, sf), "3.0.0"))


_CREDIT3_SQL = rsql(O.credit_sql(O.ORDER_IDS, "3.0.0"), _doubles(G.CREDIT_COLUMNS["3"]))


def _logit_sql(m: dict) -> str:
    s = O.num(m["intercept"])
    for c, w in m["weights"].items():
        s = f"{s} + {O.num(w)} * cast({c} as double)"
    for c, v, w in m["indicators"]:
        lit = "true" if v is True else f"'{v}'"
        s = f"{s} + (CASE WHEN {c} = {lit} THEN {O.num(w)} ELSE {O.num(0.0)} END)"
    return f"({s})"


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    cut = SC.logit_threshold(THRESHOLD)
    lg = SC.linear_logit(**FRAUD_V1)
    return _credit3(spark, sf).select("TransactionId", "IsFraud", lg.alias("logit"),
                                      (lg >= F.lit(cut)).alias("pred"))


_SCORED_SQL = (f"SELECT TransactionId, IsFraud, {_logit_sql(FRAUD_V1)} AS logit,"
               f" {_logit_sql(FRAUD_V1)} >= {O.num(SC.logit_threshold(THRESHOLD))} AS pred FROM ({_CREDIT3_SQL})")


# ---------------------------------------------------------------- V3 ----
@register("linear_score", f"SELECT TransactionId, IsFraud,"
                          f" round(1.0::double / (1.0::double + exp(-logit)), 6) AS probability, pred"
                          f" FROM ({_SCORED_SQL})")
def linear_score(spark: SparkSession, sf: str) -> DataFrame:
    s = _scored(spark, sf)
    return round_doubles(s.select("TransactionId", "IsFraud",
                                  SC.sigmoid(F.col("logit")).alias("probability"), "pred"))


# ---------------------------------------------------------------- A3 ----
_CONF = ("cast(count_if(NOT IsFraud AND NOT pred) AS bigint) AS tn, cast(count_if(NOT IsFraud AND pred) AS bigint) AS fp,"
         " cast(count_if(IsFraud AND NOT pred) AS bigint) AS fn, cast(count_if(IsFraud AND pred) AS bigint) AS tp,"
         " cast(count_if(IsFraud IS NULL OR pred IS NULL) AS bigint) AS unjudged")


@register("confusion_matrix", f"SELECT {_CONF} FROM ({_SCORED_SQL})")
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return M.confusion_counts(_scored(spark, sf), "IsFraud", "pred").drop("matrix")


def _zdiv(n: str, d: str) -> str:
    return f"(CASE WHEN ({d}) = 0 THEN 0.0::double ELSE cast({n} as double) / cast({d} as double) END)"


@register("classification_metrics",
          f"SELECT tn, fp, fn, tp, unjudged, round({_zdiv('tp + tn', 'tn + fp + fn + tp')}, 6) AS accuracy,"
          f" round({_zdiv('tp', 'tp + fp')}, 6) AS precision, round({_zdiv('tp', 'tp + fn')}, 6) AS recall,"
          f" round({_zdiv('2.0::double * tp', '2 * tp + fp + fn')}, 6) AS f1 FROM (SELECT {_CONF} FROM ({_SCORED_SQL}))")
def classification_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(M.classification_metrics(_scored(spark, sf), "IsFraud", "pred"))


# ---------------------------------------------------------------- A5 ----
_AUC_SQL = (
    f"WITH per AS (SELECT logit AS s, sum(cast(IsFraud AS bigint)) AS pos, sum(1 - cast(IsFraud AS bigint)) AS neg,"
    f" count_if(IsFraud IS NULL OR logit IS NULL) AS lost FROM ({_SCORED_SQL}) GROUP BY logit),"
    " c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below"
    " FROM per) SELECT round(CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN"
    " sum(pos * (below + 0.5::double * neg)) / (cast(sum(pos) AS double) * cast(sum(neg) AS double)) END, 6) AS roc_auc,"
    " cast(sum(pos) AS bigint) AS positives, cast(sum(neg) AS bigint) AS negatives,"
    " cast(sum(lost) AS bigint) AS unjudged FROM c")


@register("roc_auc", _AUC_SQL)
def roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(M.roc_auc(_scored(spark, sf), "IsFraud", "logit"))


# ---------------------------------------------------------------- V5 ----
_AGREE_SQL = (
    f"SELECT count(*) AS rows, round(avg(cast(a = b AS integer)), 6) AS agreement_rate,"
    f" cast(count_if(NOT a AND NOT b) AS bigint) AS both_negative, cast(count_if(NOT a AND b) AS bigint) AS only_b_positive,"
    f" cast(count_if(a AND NOT b) AS bigint) AS only_a_positive, cast(count_if(a AND b) AS bigint) AS both_positive,"
    f" round(avg(abs(pa - pb)), 6) AS mean_abs_prob_gap FROM (SELECT"
    f" {_logit_sql(FRAUD_V1)} >= {O.num(SC.logit_threshold(THRESHOLD))} AS a,"
    f" {_logit_sql(FRAUD_V2)} >= {O.num(SC.logit_threshold(THRESHOLD))} AS b,"
    f" 1.0::double / (1.0::double + exp(-{_logit_sql(FRAUD_V1)})) AS pa,"
    f" 1.0::double / (1.0::double + exp(-{_logit_sql(FRAUD_V2)})) AS pb FROM ({_CREDIT3_SQL}))")


@register("model_agreement", _AGREE_SQL)
def model_agreement(spark: SparkSession, sf: str) -> DataFrame:
    cut = F.lit(SC.logit_threshold(THRESHOLD))
    l1, l2 = SC.linear_logit(**FRAUD_V1), SC.linear_logit(**FRAUD_V2)
    s = _credit3(spark, sf).select((l1 >= cut).alias("a"), (l2 >= cut).alias("b"),
                                   SC.sigmoid(l1).alias("pa"), SC.sigmoid(l2).alias("pb"))
    return round_doubles(SC.agreement(s, "a", "b", "pa", "pb"))


# ----------------------------------------------------------- P12/P13/V8 ----
_CUST2_SQL = rsql(O.customer_sql(O.CUSTOMER_IDS, "2.0.0"), _doubles(G.CUSTOMER_COLUMNS["2"]))


@register("churn_decisions",
          f"SELECT CustomerId, round(1.0::double / (1.0::double + exp(-{_logit_sql(CHURN_MODEL)})), 2) AS probability,"
          f" CASE WHEN {_logit_sql(CHURN_MODEL)} >= 0.0::double THEN 'Will Churn' ELSE 'Won''t Churn' END AS decision,"
          f" 'churn_linear' AS model_name, '1.0.0' AS model_version FROM ({_CUST2_SQL})")
def churn_decisions(spark: SparkSession, sf: str) -> DataFrame:
    df = round_doubles(G.customer_dataset(TB.customer_ids(spark, sf), "2.0.0"))
    lg = SC.linear_logit(**CHURN_MODEL)
    out = df.select("CustomerId", F.round(SC.sigmoid(lg), 2).alias("probability"),
                    SC.decision_text(lg >= F.lit(0.0)).alias("decision"))
    return SC.attach_model_info(out, {"model_name": "churn_linear", "model_version": "1.0.0"})


# ---------------------------------------------------------------- V7 ----
_CUST1_SQL = rsql(O.customer_sql(O.CUSTOMER_IDS, "1.0.0"), _doubles(G.CUSTOMER_COLUMNS["1"]))


@register("ab_assignment",
          f"SELECT arm, count(*) AS rows, round(avg(cast(Churned AS integer)), 6) AS target_rate FROM ("
          f"SELECT *, CASE WHEN {O.u('CustomerId', 'ab|retention-offer')} < 0.7::double THEN 'A' ELSE 'B' END AS arm"
          f" FROM ({_CUST1_SQL})) GROUP BY arm")
def ab_assignment(spark: SparkSession, sf: str) -> DataFrame:
    df = SC.ab_assign(G.customer_dataset(TB.customer_ids(spark, sf)), "CustomerId", "retention-offer", 0.3)
    return round_doubles(M.target_rate(df, "Churned", ["arm"]))


# ---------------------------------------------------------------- V6 ----
@register("scoring_errors",
          f"SELECT TransactionId, CASE WHEN NOT coalesce(Amount < 4000.0::double, false) THEN 'amount above limit'"
          f" WHEN NOT coalesce(DistanceFromHome < 250.0::double, false) THEN 'distance out of range' END AS error,"
          f" CASE WHEN coalesce(Amount < 4000.0::double, false) AND coalesce(DistanceFromHome < 250.0::double, false)"
          f" THEN {_logit_sql(FRAUD_V1)} >= {O.num(SC.logit_threshold(THRESHOLD))} END AS pred FROM ({_CREDIT3_SQL})")
def scoring_errors(spark: SparkSession, sf: str) -> DataFrame:
    err = SC.validity([(F.col("Amount") < 4000.0, "amount above limit"),
                       (F.col("DistanceFromHome") < 250.0, "distance out of range")])
    lg = SC.linear_logit(**FRAUD_V1)
    return _credit3(spark, sf).select(
        "TransactionId", err.alias("error"),
        F.when(err.isNull(), lg >= F.lit(SC.logit_threshold(THRESHOLD))).alias("pred"))


# ---------------------------------------------------------------- A8 ----
@register("scoring_counters", "SELECT event_type, count(*) AS requests, round(avg(value), 6) AS mean_latency_ms"
                              " FROM events GROUP BY event_type")
def scoring_counters(spark: SparkSession, sf: str) -> DataFrame:
    ev = TB.table(spark, sf, "events")
    return round_doubles(SC.scoring_counters(ev, "value", ["event_type"]))


# ------------------------------------------------------------ samplers ----
_MOMENTS = [  # (name, builder over a uniform factory u(salt))
    ("normal", lambda u: (u("m|n0"), u("m|n1")), "normal"),
    ("gamma_2_15", lambda u: [u("m|g0"), u("m|g1")], "gamma"),
    ("beta_2_5", lambda u: [u(f"m|b{i}") for i in range(6)], "beta_order"),
    ("beta_1_30", lambda u: u("m|c"), "beta_one"),
    ("exp_30", lambda u: u("m|e"), "exp"),
    ("uniform", lambda u: u("m|u"), "uniform"),
    ("beta_1_5_8", lambda u: ([u("m|h0"), u("m|h1")], u("m|h2"), [u(f"m|h{i + 3}") for i in range(8)]), "beta_half"),
    ("randint_0_24", lambda u: u("m|r"), "randint"),
    ("lognormal_clip", lambda u: (u("m|l0"), u("m|l1")), "lognormal"),
]


def _moment_expr(kind: str, args, lib):
    if kind == "normal":
        return lib.normal(*args)
    if kind == "gamma":
        return lib.gamma_int_shape(args, 15.0) if lib is R else lib.gamma_int(args, 15.0)
    if kind == "beta_order":
        return lib.beta_order_stat(args, 2) if lib is R else lib.beta_order(args, 2)
    if kind == "beta_one":
        return lib.beta_one(args, 30.0)
    if kind == "exp":
        return lib.exponential(args, 30.0)
    if kind == "beta_half":
        zs, uh, ub = args
        if lib is R:
            return R.beta_half_int(R.normal(*zs), uh, ub)
        return O.beta_half(O.normal(*zs), uh, ub)
    if kind == "randint":
        return lib.randint(args, 0, 24)
    if kind == "lognormal":
        if lib is R:
            return R.clip(F.exp(R.normal(args[0], args[1], 4.0, 1.5)), 1.0, 5000.0)
        return O.clip(f"exp({O.normal(args[0], args[1], 4.0, 1.5)})", O.num(1.0), O.num(5000.0))
    return args


def _moment_rows():
    k = "o_orderkey"
    return [(n, _moment_expr(kind, b(lambda s: R.uniform(F.col(k), s)), R), None) for n, b, kind in _MOMENTS]


def _moments_sql() -> str:
    parts = [f"SELECT '{name}' AS sampler, count(*) AS n, round(avg(x), 4) AS mean, round(var_pop(x), 4) AS variance"
             f" FROM (SELECT {_moment_expr(kind, b(lambda s: O.u('o_orderkey', s)), O)} AS x FROM orders)"
             for name, b, kind in _MOMENTS]
    return " UNION ALL ".join(parts)


@register("sampler_moments", _moments_sql())
def sampler_moments(spark: SparkSession, sf: str) -> DataFrame:
    o = TB.table(spark, sf, "orders")
    rows = _moment_rows()
    wide = o.select(*[c.alias(n) for n, c, _ in rows])
    aggs = []
    for n, _, _ in rows:
        aggs += [F.avg(n).alias(f"{n}__m"), F.var_pop(n).alias(f"{n}__v")]
    one = wide.agg(F.count(F.lit(1)).alias("n"), *aggs)
    stack = F.explode(F.array(*[F.struct(F.lit(n).alias("sampler"), F.round(F.col(f"{n}__m"), 4).alias("mean"),
                                         F.round(F.col(f"{n}__v"), 4).alias("variance")) for n, _, _ in rows]))
    return one.select("n", stack.alias("s")).select("s.sampler", "n", "s.mean", "s.variance")


# ---------------------------------------------------------------- G10 ----
@register("risk_score_existing",
          f"SELECT CustomerId, round({O.churn_p('2')}, 6) AS churn_risk FROM ({O.customer_sql(O.CUSTOMER_IDS, '2.0.0')})")
def risk_score_existing(spark: SparkSession, sf: str) -> DataFrame:
    df = G.customer_dataset(TB.customer_ids(spark, sf), "2.0.0")
    return round_doubles(df.select("CustomerId", G.churn_probability(df, "2.0.0").alias("churn_risk")))


# ---------------------------------------------------------------- T1 ----
@register("split_hash", f"SELECT CustomerId, CASE WHEN {O.u('CustomerId', 'split|42')} < 0.8::double"
                        f" THEN 'train' ELSE 'test' END AS split FROM ({_CUST1_SQL})")
def split_hash(spark: SparkSession, sf: str) -> DataFrame:
    df = G.customer_dataset(TB.customer_ids(spark, sf))
    tr, te = FE.split_hash(df, "CustomerId", 0.8, 42)
    return tr.select("CustomerId", F.lit("train").alias("split")).unionByName(
        te.select("CustomerId", F.lit("test").alias("split")))


@register("split_prefix", "SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderkey)"
                          " <= floor(0.8::double * count(*) OVER ()) THEN 'train' ELSE 'test' END AS split FROM orders")
def split_prefix(spark: SparkSession, sf: str) -> DataFrame:
    o = TB.table(spark, sf, "orders").select("o_orderkey")
    tr, te = FE.split_prefix(o, "o_orderkey", 0.8)
    return tr.select("o_orderkey", F.lit("train").alias("split")).unionByName(
        te.select("o_orderkey", F.lit("test").alias("split")))


@register("split_null_keys", "SELECT c_custkey % 5 = 0 AS keyless, count(*) AS rows_split,"
                             " count(*) FILTER (c_custkey % 5 = 0) AS keyless_tested FROM customer GROUP BY 1")
def split_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    """T1 with every fifth key missing: no row is lost, rows without a key are tested on."""
    key = F.when(F.col("c_custkey") % 5 != 0, F.col("c_custkey")).alias("key")
    tr, te = FE.split_hash(TB.table(spark, sf, "customer").select(key), "key", 0.8, 42)
    both = tr.withColumn("tested", F.lit(False)).unionByName(te.withColumn("tested", F.lit(True)))
    return both.groupBy(F.col("key").isNull().alias("keyless")).agg(
        F.count(F.lit(1)).alias("rows_split"), F.count_if(F.col("key").isNull() & F.col("tested")).alias("keyless_tested"))


# ---------------------------------------------------------------- T2 ----
_NUM1 = ["Age", "Tenure", "MonthlyCharges", "TotalCharges"]
_TRAIN1 = f"SELECT * FROM ({_CUST1_SQL}) WHERE {O.u('CustomerId', 'split|42')} < 0.8::double"


def _scale_sql() -> str:
    stats = ", ".join(f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0::double ELSE stddev_pop({c}) END AS s_{c}"
                      for c in _NUM1)
    cols = ", ".join(f"round((cast({c} AS double) - m_{c}) / s_{c}, 6) AS {c}" for c in _NUM1)
    return f"SELECT CustomerId, {cols} FROM ({_CUST1_SQL}) CROSS JOIN (SELECT {stats} FROM ({_TRAIN1}))"


@register("standard_scale", _scale_sql())
def standard_scale(spark: SparkSession, sf: str) -> DataFrame:
    df = round_doubles(G.customer_dataset(TB.customer_ids(spark, sf)))
    train, _ = FE.split_hash(df, "CustomerId", 0.8, 42)
    stats = FE.fit_standard_scaler(train, _NUM1)
    return round_doubles(FE.standard_scale(df.select("CustomerId", *_NUM1), stats))


# ------------------------------------------------------------- T3/T5 ----
_CAT3 = ["ContractType", "InternetService", "PaymentMethod"]
_CUST3_SQL = rsql(O.customer_sql(O.CUSTOMER_IDS, "3.0.0"), _doubles(G.CUSTOMER_COLUMNS["3"]))
_TRAIN3 = f"SELECT * FROM ({_CUST3_SQL}) WHERE {O.u('CustomerId', 'split|42')} < 0.8::double"


def _one_hot_sql(drop_first: bool, columns: list[str], vocab: dict[str, list[str]]) -> str:
    cols = []
    for c in columns:
        cats = vocab[c][1:] if drop_first else vocab[c]
        cols += [f"CASE WHEN {c} = '{v}' THEN 1.0::double ELSE 0.0::double END AS \"{c}_{v}\"" for v in cats]
    return ", ".join(cols)


# Category lists observed in the training rows; the query itself learns them
# from data, the oracle lists the generator's categories in sorted order.
_VOCAB = {
    "ContractType": sorted(c for c, _ in G.CONTRACTS["3"]),
    "InternetService": sorted(c for c, _ in G.INTERNET_SERVICE),
    "PaymentMethod": sorted(c for c, _ in G.PAYMENT_METHODS),
}


@register("one_hot", f"SELECT CustomerId, {_one_hot_sql(False, _CAT3, _VOCAB)} FROM ({_CUST3_SQL})")
def one_hot(spark: SparkSession, sf: str) -> DataFrame:
    df = G.customer_dataset(TB.customer_ids(spark, sf), "3.0.0").select("CustomerId", *_CAT3)
    train, _ = FE.split_hash(df, "CustomerId", 0.8, 42)
    return FE.one_hot(df, FE.fit_vocabulary(train, _CAT3))


_VOCAB1 = {"ContractType": sorted(c for c, _ in G.CONTRACTS["1"])}


@register("dummies_drop_first", f"SELECT CustomerId, {_one_hot_sql(True, ['ContractType'], _VOCAB1)} FROM ({_CUST1_SQL})")
def dummies_drop_first(spark: SparkSession, sf: str) -> DataFrame:
    df = G.customer_dataset(TB.customer_ids(spark, sf)).select("CustomerId", "ContractType")
    return FE.one_hot(df, FE.fit_vocabulary(df, ["ContractType"]), drop_first=True)


# ---------------------------------------------------------------- P8 ----
def _type_sql() -> str:
    kinds = {"Timestamp": ("timestamp_ntz", "dropped")}
    parts = []
    spark_types = {"TransactionId": "string", "Timestamp": "timestamp_ntz", "Amount": "double", "HourOfDay": "int",
                   "DayOfWeek": "int", "Month": "int", "MerchantCategory": "string", "FraudSignals": "double"}
    for c in G.CREDIT_COLUMNS["3"]:
        if c in ("TransactionId", "IsFraud"):
            continue
        t = spark_types.get(c, "boolean" if c in ("RepeatRetailer", "UsedChip", "UsedPinNumber", "OnlineOrder")
                            else "double")
        kind = kinds.get(c, (t, "numeric" if t in ("double", "int") else "categorical"))[1]
        parts.append(f"SELECT '{c}' AS column_name, '{t}' AS spark_type, '{kind}' AS kind, count({c}) AS non_null"
                     f" FROM ({O.credit_sql(O.ORDER_IDS, '3.0.0')})")
    return " UNION ALL ".join(parts)


@register("type_partition", _type_sql())
def type_partition(spark: SparkSession, sf: str) -> DataFrame:
    df = G.credit_dataset(TB.order_ids(spark, sf), "3.0.0")
    feats = FE.feature_columns(df, "IsFraud", "TransactionId")
    rows = FE.type_partition_table(df, feats)
    counts = df.agg(*[F.count(c).alias(c) for c in feats])
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("spark_type"),
                                         F.lit(k).alias("kind"), F.col(c).alias("non_null")) for c, t, k in rows]))
    return counts.select(stack.alias("r")).select("r.*")


# ---------------------------------------------------------------- P9 ----
_V2_FEATURES = T.StructType([
    T.StructField("Age", T.IntegerType()), T.StructField("Tenure", T.IntegerType()),
    T.StructField("ContractType", T.StringType()), T.StructField("MonthlyCharges", T.DoubleType()),
    T.StructField("TotalCharges", T.DoubleType()), T.StructField("HasPhoneService", T.BooleanType()),
    T.StructField("HasInternetService", T.BooleanType())])


@register("fill_missing_features",
          f"SELECT CustomerId, Age, Tenure, ContractType, MonthlyCharges, TotalCharges,"
          f" false AS HasPhoneService, false AS HasInternetService FROM ({_CUST1_SQL})")
def fill_missing_features(spark: SparkSession, sf: str) -> DataFrame:
    v1 = round_doubles(G.customer_dataset(TB.customer_ids(spark, sf))).drop("Churned")
    return FE.align_features(v1, _V2_FEATURES)


# --------------------------------------------------------------- P11 ----
_PAYLOAD_SCHEMA = T.StructType([T.StructField("k", T.IntegerType())])


def _payloads(ev: DataFrame) -> DataFrame:
    """Requests built from events: errors arrive truncated, purchases as arrays."""
    p = (F.when(F.col("event_type") == "error", F.substring("props", 1, 5))
         .when(F.col("event_type") == "purchase", F.concat(F.lit("["), F.col("props"), F.lit(", "), F.col("props"), F.lit("]")))
         .otherwise(F.col("props")))
    return ev.select(F.col("event_id").alias("request_id"), p.alias("payload"))


_PARSE_SQL = (
    "WITH p AS (SELECT event_id AS request_id, CASE WHEN event_type = 'error' THEN substr(props, 1, 5)"
    " WHEN event_type = 'purchase' THEN '[' || props || ', ' || props || ']' ELSE props END AS payload FROM events)"
    " SELECT request_id, 0::bigint AS item_index, NULL::integer AS k, 'malformed JSON' AS error FROM p WHERE NOT json_valid(payload)"
    " UNION ALL SELECT request_id, 0::bigint, from_json(payload, '{\"k\": \"INTEGER\"}').k, NULL FROM p"
    " WHERE json_valid(payload) AND NOT starts_with(ltrim(payload), '[')"
    " UNION ALL SELECT request_id, cast(i - 1 AS bigint), r.k, NULL FROM (SELECT request_id,"
    " unnest(from_json(payload, '[{\"k\": \"INTEGER\"}]')) AS r,"
    " generate_subscripts(from_json(payload, '[{\"k\": \"INTEGER\"}]'), 1) AS i FROM p"
    " WHERE json_valid(payload) AND starts_with(ltrim(payload), '['))")


@register("parse_records", _PARSE_SQL)
def parse_records(spark: SparkSession, sf: str) -> DataFrame:
    return FE.parse_records(_payloads(TB.table(spark, sf, "events")), "payload", _PAYLOAD_SCHEMA, "request_id")


# ---------------------------------------------------------------- A6/A7 ----
_NUM3 = ["Age", "Tenure", "MonthlyCharges", "TotalCharges", "CustomerValue", "RiskScore"]


@register("scaler_stats", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(avg(cast({c} AS double)), 6) AS mean,"
    f" round(stddev_pop(cast({c} AS double)), 6) AS std_pop FROM ({_TRAIN3})" for c in _NUM3))
def scaler_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Mean and population standard deviation of the numeric features on the training rows."""
    df = round_doubles(G.customer_dataset(TB.customer_ids(spark, sf), "3.0.0"))
    train, _ = FE.split_hash(df, "CustomerId", 0.8, 42)
    return round_doubles(FE.scaler_table(train, _NUM3))


@register("category_vocabulary", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS category, row_number() OVER (ORDER BY {c}) - 1 AS index, count(*) AS times FROM ({_TRAIN3}) GROUP BY {c}"
    for c in _CAT3))
def category_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    """Numbered categories per categorical feature on the training rows."""
    df = G.customer_dataset(TB.customer_ids(spark, sf), "3.0.0")
    train, _ = FE.split_hash(df, "CustomerId", 0.8, 42)
    return FE.vocabulary_table(train, _CAT3)


_CODED = ("o_custkey", "o_orderpriority", "o_orderdate")


def _encoding_sql() -> str:
    vocab = [f"v{k} AS (SELECT CAST({c} AS VARCHAR) AS category, row_number() OVER (ORDER BY CAST({c} AS VARCHAR)) - 1 AS code FROM orders WHERE o_orderkey % 5 <> 0 AND {c} IS NOT NULL GROUP BY 1)"
             for k, c in enumerate(_CODED)]
    sizes = [f"(SELECT count(*) FROM v{k})" for k in range(len(_CODED))]
    joins = " ".join(f"LEFT JOIN v{k} ON CAST({c} AS VARCHAR) = v{k}.category" for k, c in enumerate(_CODED))
    codes = ", ".join(f"v{k}.code AS {c}_code" for k, c in enumerate(_CODED))
    positions = ", ".join(f"v{k}.code + {' + '.join(['0', *sizes[:k]])}" for k in range(len(_CODED)))
    return (f"WITH {', '.join(vocab)} SELECT o_orderkey, {codes}, array_to_string([{positions}], ',') AS positions,"
            f" ({' + '.join(sizes)})::BIGINT AS size FROM orders {joins}")


@register("category_encoding", _encoding_sql())
def category_encoding(spark: SparkSession, sf: str) -> DataFrame:
    """Sparse one-hot positions of columns with many categories, learned from four fifths of the orders."""
    orders = TB.table(spark, sf, "orders").select("o_orderkey", *_CODED)
    coded = FE.encode(orders, FE.vocabulary_table(orders.where("o_orderkey % 5 <> 0"), list(_CODED)), list(_CODED))
    return coded.select("o_orderkey", *[f"{c}_code" for c in _CODED], F.concat_ws(",", F.col("positions").cast("array<string>")).alias("positions"), "size")
