"""Binary classification metrics as aggregate jobs.

Confusion counts and the derived rates are one partial aggregate (map-side
combine, one tiny shuffle).  ROC AUC is exact (rank-sum with ties averaged):
scores are first collapsed per distinct value, then bucketed by approximate
quantiles so every bucket computes its running negative count locally; the
per-bucket totals (one row per bucket) give each bucket's offset.  No
window ever runs over the whole data set in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import ensure_checkpoint_dir
from .sequence import with_order_bucket


def _b(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("boolean")


def confusion_counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    """A3: one row tn, fp, fn, tp (BIGINT), ``matrix`` [[tn, fp], [fn, tp]] and ``unjudged``, rows without label or prediction."""
    y, p = _b(label), _b(pred)
    agg = df.agg(
        F.count_if(~y & ~p).alias("tn"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(y & p).alias("tp"),
        F.count_if(y.isNull() | p.isNull()).alias("unjudged"))
    return agg.withColumn("matrix", F.array(F.array("tn", "fp"), F.array("fn", "tp")))


def _ratio(num: Column, den: Column) -> Column:
    """num / den with ``zero_division=0``."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def classification_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """A4: accuracy, precision, recall, f1 with positive = True, over the rows that have label and prediction; ``unjudged`` counts the others."""
    c = confusion_counts(df, label, pred)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    precision = _ratio(tp, tp + fp)
    recall = _ratio(tp, tp + fn)
    return c.select(
        "tn", "fp", "fn", "tp", "unjudged",
        _ratio(tp + tn, tn + fp + fn + tp).alias("accuracy"),
        precision.alias("precision"), recall.alias("recall"),
        _ratio(F.lit(2.0) * tp, F.lit(2) * tp + fp + fn).alias("f1"))


def roc_auc(df: DataFrame, label: str, score: str, buckets: int | None = None) -> DataFrame:
    """A5: exact ROC AUC; NULL when only one class is present (D5).  ``unjudged`` counts rows without label or score."""
    spark = df.sparkSession
    if buckets is None:
        buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    y, scored = _b(label), F.col(score).isNotNull()
    per = (df.groupBy(F.col(score).cast("double").alias("s"))
           .agg(F.count_if(y & scored).alias("pos"), F.count_if(~y & scored).alias("neg"),
                F.count_if(y.isNull() | ~scored).alias("lost")))
    # The distinct-score table feeds three passes (quantiles, bucket totals,
    # running counts): materialise it once in the shared checkpoint folder.
    ensure_checkpoint_dir(spark)
    per = per.checkpoint(eager=True)
    per = with_order_bucket(per, "s", buckets, name="bucket")
    totals = per.groupBy("bucket").agg(F.sum("neg").alias("bneg"))
    offsets = totals.select(
        "bucket",
        F.coalesce(F.sum("bneg").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("offset"))
    local = per.withColumn(
        "below", F.coalesce(F.sum("neg").over(
            Window.partitionBy("bucket").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    j = local.join(F.broadcast(offsets), "bucket")
    agg = j.agg(F.sum(F.col("pos") * (F.col("offset") + F.col("below") + F.lit(0.5) * F.col("neg"))).alias("num"),
                F.sum("pos").alias("P"), F.sum("neg").alias("N"), F.sum("lost").alias("lost"))
    return agg.select(
        F.when((F.col("P") > 0) & (F.col("N") > 0),
               F.col("num") / (F.col("P").cast("double") * F.col("N").cast("double"))).alias("roc_auc"),
        F.coalesce(F.col("P"), F.lit(0)).alias("positives"), F.coalesce(F.col("N"), F.lit(0)).alias("negatives"),
        F.coalesce(F.col("lost"), F.lit(0)).alias("unjudged"))


def target_rate(df: DataFrame, target: str, by: list[str] | None = None) -> DataFrame:
    """A1 + A2: row count and mean of a boolean target."""
    g = df.groupBy(*(by or []))
    return g.agg(F.count(F.lit(1)).alias("rows"), F.avg(_b(target).cast("int")).alias("target_rate"))
