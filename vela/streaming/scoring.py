"""Structured Streaming: record scoring and counters (V9, V10, L1 streaming).

* ``score_stream`` — JSON request files -> typed records (bad lines routed to
  an ``error`` column) -> feature alignment -> fitted ``PipelineModel`` ->
  Parquet sink.  The checkpoint lives in the shared checkpoint folder, so a
  restarted driver or lost executor resumes exactly where it stopped.
  ``observe`` publishes per-batch request counts and the mean probability.
* ``event_counters_stream`` — per event-time window partial sums of every
  batch, written through ``foreachBatch`` to a folder per batch;
  ``fold_counters`` adds them up, late events included.
* ``score_batches`` — any scoring projection, each batch's rows and its observed metrics in folders of
  their own; ``scoring_metrics`` / ``fold_metrics`` read the metrics of all batches as a table.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.features import align_features, typed_zero


def read_records_stream(spark: SparkSession, source_dir: str, record_schema: T.StructType,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON records of a growing folder; a malformed line has NULL fields and its text in ``error``."""
    schema = T.StructType(record_schema.fields + [T.StructField("error", T.StringType())])
    reader = spark.readStream.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "error")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(source_dir)


def score_stream(spark: SparkSession, source_dir: str, record_schema: T.StructType, model: PipelineModel,
                 feature_schema: T.StructType, sink_dir: str, checkpoint_dir: str, keep: list[str],
                 available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """V9: score every JSON record arriving in ``source_dir``.

    A malformed line gives a row as well: no prediction, the line in ``error``.
    """
    raw = read_records_stream(spark, source_dir, record_schema, max_files_per_trigger)
    good = F.col("error").isNull()
    features = {f.name: f.dataType for f in feature_schema.fields}
    aligned = align_features(raw, feature_schema)
    # the model sees zeros in place of a malformed line's fields; its output for them is dropped
    filled = aligned.select(*[F.when(good, F.col(c)).otherwise(typed_zero(features[c])).alias(c) if c in features else F.col(c)
                              for c in aligned.columns])
    scored = model.transform(filled).select(
        *keep, F.when(good, F.col("prediction") == 1.0).alias("prediction"),
        F.when(good, vector_to_array(F.col("probability"))[1]).alias("probability"), "error")
    observed = scored.observe("scoring", F.count(F.lit(1)).alias("requests"), F.count("error").alias("errors"),
                              F.avg("probability").alias("mean_probability"))
    w = (observed.writeStream.format("parquet").option("path", sink_dir)
         .option("checkpointLocation", checkpoint_dir).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


METRICS = T.StructType([
    T.StructField("requests", T.LongType()), T.StructField("errors", T.LongType()), T.StructField("positives", T.LongType()),
    T.StructField("scored", T.LongType()), T.StructField("probability_sum", T.DoubleType()),
    T.StructField("started_at", T.DoubleType()), T.StructField("duration_ms", T.DoubleType())])


def score_batches(spark: SparkSession, source_dir: str, record_schema: T.StructType, probability: Column, keep: Sequence[str],
                  sink_dir: str, metrics_dir: str, checkpoint_dir: str, threshold: float = 0.5,
                  checks: Callable[[], Column] | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """V9 + A8: score every JSON record of a growing folder and keep each batch's metrics.

    Rows: ``keep``, probability, prediction, ``error`` (the malformed line, or the message of ``checks``; neither is scored).
    The metrics are observed while the batch is written, without another pass, and stored beside it.  Both go to
    ``batch_id=<n>`` folders that a repeated batch replaces, so a restart neither loses nor doubles a count; a query listener,
    which hears of a batch after it is committed, would miss the last one of a lost driver.
    """
    raw = read_records_stream(spark, source_dir, record_schema, max_files_per_trigger)
    message = F.col("error") if checks is None else F.coalesce(F.col("error"), checks())
    score = F.when(F.col("error").isNull(), probability)

    def sink(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        started = time.time()
        rows = (batch.withColumn("error", message).select(*keep, score.alias("probability"), "error")
                .withColumn("prediction", F.col("probability") >= F.lit(threshold)))
        rows = rows.observe(seen, F.count(F.lit(1)).alias("requests"), F.count("error").alias("errors"),
                            F.count_if("prediction").alias("positives"), F.count("probability").alias("scored"),
                            F.coalesce(F.sum("probability"), F.lit(0.0)).alias("probability_sum"))
        rows.write.mode("overwrite").parquet(f"{sink_dir}/batch_id={batch_id}")
        row = seen.get | {"started_at": started, "duration_ms": 1000 * (time.time() - started)}
        (batch.sparkSession.createDataFrame([row], METRICS).coalesce(1)
         .write.mode("overwrite").parquet(f"{metrics_dir}/batch_id={batch_id}"))

    return raw.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start()


def scoring_metrics(spark: SparkSession, metrics_dir: str) -> DataFrame:
    """One row per batch."""
    return spark.read.schema(T.StructType([*METRICS.fields, T.StructField("batch_id", T.LongType())])).parquet(metrics_dir)


def fold_metrics(metrics: DataFrame) -> DataFrame:
    """Counts, mean probability and mean latency of a request over all batches; no batch: zero counts, NULL means."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    mean = lambda x, n: F.when(F.sum(n) > 0, F.sum(x) / F.sum(n))
    return metrics.agg(F.count(F.lit(1)).alias("batches"), *[total(c) for c in ("requests", "errors", "positives", "scored")],
                       mean("probability_sum", "scored").alias("mean_probability"), mean("duration_ms", "requests").alias("mean_latency_ms"))


_EPOCH_NTZ = "1970-01-01 00:00:00"


def ntz_to_instant(c):
    """TIMESTAMP_NTZ wall clock read as UTC -> TIMESTAMP (watermarks need TIMESTAMP)."""
    epoch = F.lit(_EPOCH_NTZ).cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, c))


def instant_to_ntz(c):
    """Inverse of ``ntz_to_instant``; independent of the session time zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))


def event_counters_stream(spark: SparkSession, source_dir: str, schema: T.StructType, sink_dir: str,
                          checkpoint_dir: str, ts: str = "ts", key: str = "event_type", value: str = "value",
                          window: str = "1 hour") -> StreamingQuery:
    """Windowed request counts and value sums per key, one partial result per batch.

    No state is kept between batches and no event is too late: every batch
    writes its own sums, ``fold_counters`` adds them up.  A repeated batch
    replaces its folder.
    """
    ev = spark.readStream.schema(schema).parquet(source_dir)
    ntz = isinstance(schema[ts].dataType, T.TimestampNTZType)
    if ntz:
        ev = ev.withColumn(ts, ntz_to_instant(F.col(ts)))

    def sink(batch: DataFrame, batch_id: int) -> None:
        start = instant_to_ntz(F.col("w.start")) if ntz else F.col("w.start")
        (batch.groupBy(F.window(ts, window).alias("w"), F.col(key))
         .agg(F.count(F.lit(1)).alias("requests"), F.sum(value).alias("total"), F.count(value).alias("valued"))
         .select(start.alias("window_start"), key, "requests", "total", "valued")
         .write.mode("overwrite").parquet(f"{sink_dir}/batch_id={batch_id}"))

    return (ev.writeStream.foreachBatch(sink)
            .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())


def fold_counters(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Requests and mean value per key over the batches' partial sums."""
    total, valued = F.sum("total"), F.sum("valued")
    return parts.groupBy(*keys).agg(F.sum("requests").alias("requests"), F.when(valued > 0, total / valued).alias("mean_value"))
