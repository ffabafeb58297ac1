"""Batch scoring and model comparison.

Scoring is a projection: either a fitted ``PipelineModel.transform`` or a
linear model written as Column arithmetic (no UDF).  Several versions are
scored in one scan by chaining projections; comparisons are aggregates.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.random import uniform


def linear_logit(intercept: float, weights: Mapping[str, float],
                 indicators: Sequence[tuple[str, object, float]] = ()) -> Column:
    """b + sum(w_i * x_i) + sum(w_j * [col_j == value_j]) as one expression."""
    acc = F.lit(float(intercept))
    for col, w in weights.items():
        acc = acc + F.lit(float(w)) * F.col(col).cast("double")
    for col, value, w in indicators:
        acc = acc + F.when(F.col(col) == F.lit(value), F.lit(float(w))).otherwise(F.lit(0.0))
    return acc


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def logit_threshold(p: float) -> float:
    """The logit equal to probability p (compare logits, not probabilities)."""
    return math.log(p / (1.0 - p))


def decision_text(pred: Column, yes: str = "Will Churn", no: str = "Won't Churn") -> Column:
    """P12."""
    return F.when(pred, F.lit(yes)).otherwise(F.lit(no))


def positive_probability(df: DataFrame, prob_col: str = "probability", out: str = "p1") -> DataFrame:
    """V2: p(class 1) from a Spark ML probability vector."""
    return df.withColumn(out, vector_to_array(F.col(prob_col))[1])


def score_versions(df: DataFrame, models: Mapping[str, object], keep: Sequence[str],
                   ) -> DataFrame:
    """V4: score the same rows with several fitted pipeline models in one scan.

    Each model's prediction / p(1) are renamed ``pred_<tag>`` / ``p1_<tag>``
    before the next model runs, so the outputs never collide.
    """
    out = df
    ml_cols = ("rawPrediction", "probability", "prediction", "features")
    for tag, model in models.items():
        out = model.transform(out)
        out = (out.withColumn(f"pred_{tag}", F.col("prediction") == 1.0)
               .withColumn(f"p1_{tag}", vector_to_array(F.col("probability"))[1]))
        out = out.drop(*[c for c in out.columns if c in ml_cols or c.startswith("_f_")])
    tags = list(models)
    return out.select(*keep, *[F.col(f"pred_{t}") for t in tags], *[F.col(f"p1_{t}") for t in tags])


def agreement(df: DataFrame, a: str, b: str, pa: str | None = None, pb: str | None = None) -> DataFrame:
    """V5: agreement rate, 2x2 cross-tab and mean absolute probability gap."""
    A, B = F.col(a).cast("boolean"), F.col(b).cast("boolean")
    aggs = [F.count(F.lit(1)).alias("rows"),
            F.avg((A == B).cast("int")).alias("agreement_rate"),
            F.count_if(~A & ~B).alias("both_negative"), F.count_if(~A & B).alias("only_b_positive"),
            F.count_if(A & ~B).alias("only_a_positive"), F.count_if(A & B).alias("both_positive")]
    if pa and pb:
        aggs.append(F.avg(F.abs(F.col(pa) - F.col(pb))).alias("mean_abs_prob_gap"))
    return df.agg(*aggs)


def ab_assign(df: DataFrame, key: str, experiment: str, share_b: float = 0.5) -> DataFrame:
    """V7: sticky hash bucket per key -> arm 'A' or 'B'."""
    u = uniform(F.col(key), f"ab|{experiment}")
    return df.withColumn("arm", F.when(u < F.lit(1.0 - share_b), F.lit("A")).otherwise(F.lit("B")))


def validity(checks: Sequence[tuple[Column, str]]) -> Column:
    """V6: first failing check's message, else NULL."""
    expr = None
    for ok, msg in checks:
        cond = ~F.coalesce(ok, F.lit(False))
        expr = F.when(cond, F.lit(msg)) if expr is None else expr.when(cond, F.lit(msg))
    return expr if expr is not None else F.lit(None).cast("string")


def scoring_counters(df: DataFrame, latency_ms: str, by: Sequence[str] = ()) -> DataFrame:
    """Request count and mean latency (batch form of the running mean)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("requests"),
                               F.avg(latency_ms).alias("mean_latency_ms"))


def attach_model_info(df: DataFrame, info: Mapping[str, str]) -> DataFrame:
    """V8: constant model facts on every result row."""
    return df.select("*", *[F.lit(v).alias(k) for k, v in info.items()])
