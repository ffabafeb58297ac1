"""End-to-end lifecycle as a sequence of Spark jobs.

generate (map-only over a key column) -> commit snapshot -> read it back ->
hash split -> fit pipeline -> evaluate -> append to the version log ->
score the latest snapshot.  Every step appends run events to the lineage
log, so the lineage queries see this run like any other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lineage as L
from ..operators import training as TR
from ..operators import versions as V
from ..session import scratch_path
from ..sources import generators as G
from ..sources import snapshots as S


@dataclass
class LifecycleResult:
    warehouse: str
    snapshot: dict
    record: dict
    model_path: str
    registry_path: str
    lineage_path: str
    scored: DataFrame


def run_lifecycle(spark: SparkSession, ids: DataFrame, version: str = "1.0.0", seed: int = 42,
                  noise_level: float = 0.5, model_type: str = "random_forest",
                  hyperparameters: dict | None = None, root: str | None = None,
                  model_name: str = "customer_churn_model", model_version: str = "1.0.0") -> LifecycleResult:
    root = root or scratch_path(spark, "lifecycle")
    lineage = L.LineageLog(spark, f"{root}/lineage")
    cat = S.SnapshotCatalog(spark, f"{root}/warehouse", namespace="demo", lineage=lineage)
    table = "demo.customer_churn"

    df = G.customer_dataset(ids, version, seed, noise_level)
    snap = cat.create_table(table, df, properties=G.descriptor("customer", version, seed, noise_level, df.columns))

    data = cat.read(table)
    run = lineage.start(f"train_{model_name}", inputs=[f"table://{table}"],
                        facets={k: v for k, v in (hyperparameters or {}).items()})
    try:
        model, record = TR.train(data, "Churned", model_type, id_column="CustomerId",
                                 hyperparameters=hyperparameters, model_name=model_name,
                                 model_version=model_version)
    except Exception as exc:
        lineage.fail(run, exc)
        raise
    model_path = f"{root}/models/{model_name}_{model_version}"
    TR.save(model, model_path)
    lineage.complete(run, outputs=[f"model://{model_name}"],
                     facets={k: record[k] for k in ("accuracy", "f1", "roc_auc") if record[k] is not None})

    registry = V.VersionLog(spark, f"{root}/registry")
    registry.register(model_name, model_version, description=f"{model_type} on snapshot {snap['snapshot_id']}",
                      training_samples=record["training_samples"], test_samples=record["test_samples"],
                      hyperparameters=record["hyperparameters"],
                      metrics={k: record[k] for k in ("accuracy", "precision", "recall", "f1", "roc_auc")}, path=model_path,
                      **{k: record[k] for k in ("model_type", "feature_columns", "target_column", "training_duration_s")})

    scored = TR.predict(model, cat.read(table), ["CustomerId"]).withColumn(
        "model_version", F.lit(model_version))
    return LifecycleResult(f"{root}/warehouse", snap, record, model_path, f"{root}/registry",
                           f"{root}/lineage", scored)
