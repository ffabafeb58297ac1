"""Distributed training, evaluation and model persistence.

The preprocessor is part of the fitted ``PipelineModel`` (fitted once, on the
training rows only), so scoring always applies the same preprocessing (D12).
Training reads the table through Spark ML's distributed estimators; the only
driver-side values are hyperparameters, vocabulary sizes and metric rows.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, spread
from . import features as FE
from . import metrics as M
from .versions import get_version

# ---------------------------------------------------------------------------
# The reference trainer's default hyperparameters per model type.
# ---------------------------------------------------------------------------
DEFAULT_HYPERPARAMETERS = {
    "random_forest": {"n_estimators": 100, "max_depth": 10, "min_samples_split": 2, "min_samples_leaf": 1},
    "gradient_boosting": {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3},
    "logistic_regression": {"C": 1.0, "max_iter": 100},
    "neural_network": {"hidden_layer_sizes": (64, 32), "batch_size": 64, "max_iter": 20},
}
TRAINING_SPLIT = 0.8
RANDOM_STATE = 42
# Convergence tolerance of the reference's logistic-regression and MLP library defaults.
REFERENCE_TOL = 1e-4
# Iterative fits pay per-task overhead on every pass; tiny training sets are
# regrouped to about this many rows per partition (large ones are untouched).
FIT_ROWS_PER_PARTITION = 8192


class UnknownModelTypeError(ValueError):
    pass


def effective_hyperparameters(model_type: str, overrides: Mapping | None = None) -> dict:
    """Defaults updated by the caller's overrides (the effective set is recorded); what a fit cannot follow is an error."""
    if model_type not in DEFAULT_HYPERPARAMETERS:
        raise UnknownModelTypeError(f"Unknown model type: {model_type}")
    hp = dict(DEFAULT_HYPERPARAMETERS[model_type])
    known = {*hp, *(("tol",) if "max_iter" in hp else ())}
    unknown = sorted(set(overrides or {}) - known)
    if unknown:
        raise ValueError(f"{model_type} has no hyperparameters {unknown}; known are {sorted(known)}")
    hp.update(overrides or {})
    if hp.get("min_samples_split", 2) > 2 * hp.get("min_samples_leaf", 1):
        # a split into leaves of min_samples_leaf rows needs twice as many; trees here have no further limit
        raise ValueError("min_samples_split above twice min_samples_leaf cannot be kept; raise min_samples_leaf instead")
    return hp


def preprocessing_stages(df: DataFrame, features: Sequence[str], target: str) -> tuple[list, list[str]]:
    """Label cast, booleans -> strings, scale numerics, one-hot categoricals.

    Column kinds follow the schema (P8); other types (timestamps) are dropped.
    Unknown categories at scoring time encode as all zeros.
    """
    kinds = FE.partition_types(df, list(features))
    num, cat = kinds["numeric"], kinds["categorical"]
    casts = [f"CAST(`{c}` AS STRING) AS `_f_s_{c}`" for c in cat]
    casts += [f"CAST(`{c}` AS DOUBLE) AS `_f_n_{c}`" for c in num]
    stages: list = [SQLTransformer(statement=f"SELECT *, {', '.join(casts)} FROM __THIS__")]
    parts = []
    if num:
        stages += [VectorAssembler(inputCols=[f"_f_n_{c}" for c in num], outputCol="_f_num", handleInvalid="keep"),
                   StandardScaler(inputCol="_f_num", outputCol="_f_num_scaled", withMean=True, withStd=True)]
        parts.append("_f_num_scaled")
    if cat:
        idx = [f"_f_i_{c}" for c in cat]
        stages += [StringIndexer(inputCols=[f"_f_s_{c}" for c in cat], outputCols=idx,
                                 stringOrderType="alphabetAsc", handleInvalid="keep"),
                   OneHotEncoder(inputCols=idx, outputCols=[f"_f_oh_{c}" for c in cat], dropLast=True,
                                 handleInvalid="keep")]
        parts += [f"_f_oh_{c}" for c in cat]
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return stages, num + cat


def with_label(df: DataFrame, target: str) -> DataFrame:
    """Training-time label column (kept out of the fitted model, so scoring needs no target)."""
    return df.withColumn("_f_label", F.col(target).cast("double"))


def classifier(model_type: str, hp: Mapping, n_train: int, n_features: int, seed: int = RANDOM_STATE):
    """The Spark ML estimator matching each reference model type."""
    common = dict(featuresCol="features", labelCol="_f_label")
    if model_type == "random_forest":
        return RandomForestClassifier(numTrees=int(hp["n_estimators"]), maxDepth=int(hp["max_depth"]),
                                      minInstancesPerNode=int(hp.get("min_samples_leaf", 1)),
                                      featureSubsetStrategy="sqrt", seed=seed, cacheNodeIds=True,
                                      maxMemoryInMB=1024, **common)
    if model_type == "gradient_boosting":
        return GBTClassifier(maxIter=int(hp["n_estimators"]), stepSize=float(hp["learning_rate"]),
                             maxDepth=int(hp["max_depth"]), seed=seed, **common)
    if model_type == "logistic_regression":
        return LogisticRegression(regParam=1.0 / (float(hp["C"]) * max(n_train, 1)), elasticNetParam=0.0,
                                  standardization=False, maxIter=int(hp["max_iter"]),
                                  tol=float(hp.get("tol", REFERENCE_TOL)), **common)
    if model_type == "neural_network":
        layers = [n_features, *[int(x) for x in hp["hidden_layer_sizes"]], 2]
        return MultilayerPerceptronClassifier(layers=layers, blockSize=int(hp["batch_size"]),
                                              maxIter=int(hp["max_iter"]), tol=float(hp.get("tol", REFERENCE_TOL)),
                                              seed=seed, **common)
    raise UnknownModelTypeError(f"Unknown model type: {model_type}")


def _n_features(df: DataFrame) -> int:
    meta = df.schema["features"].metadata.get("ml_attr", {})
    if "num_attrs" in meta:
        return int(meta["num_attrs"])
    return len(df.select("features").first()[0])


def fit(train: DataFrame, target: str, features: Sequence[str], model_type: str,
        hyperparameters: Mapping | None = None, seed: int = RANDOM_STATE) -> tuple[PipelineModel, dict]:
    """Fit preprocessing once on the training rows, then the classifier."""
    hp = effective_hyperparameters(model_type, hyperparameters)
    ensure_checkpoint_dir(train.sparkSession)  # boosting / node-id caches checkpoint reliably
    stages, used = preprocessing_stages(train, features, target)
    train = with_label(train, target)
    prep = Pipeline(stages=stages).fit(train)
    prepared = spread(prep.transform(train).select("features", "_f_label")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = prepared.count()
        # Light-per-pass estimators (boosting rounds, L-BFGS / MLP steps) are
        # task-overhead bound on small sets; forests do heavy work per pass.
        sized = prepared if model_type == "random_forest" else right_size(prepared, n)
        if sized is not prepared:
            sized = sized.persist(StorageLevel.MEMORY_AND_DISK)
            sized.count()
            prepared.unpersist()
            prepared = sized
        est = classifier(model_type, hp, n, _n_features(prepared), seed)
        model = est.fit(prepared)
    finally:
        prepared.unpersist()
    return PipelineModel(stages=[*prep.stages, model]), {"hyperparameters": hp, "training_samples": n,
                                                         "feature_columns": used}


def right_size(df: DataFrame, n_rows: int, rows_per_partition: int = FIT_ROWS_PER_PARTITION) -> DataFrame:
    """Partition count for an iterative fit over ``n_rows`` cached rows.

    Small sets get ceil(n / rows_per_partition) partitions (at most one per
    core); sets with at least that many rows per core keep their layout.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if n_rows >= cores * rows_per_partition:
        return df
    target = max(1, min(cores, -(-n_rows // rows_per_partition)))
    return df if df.rdd.getNumPartitions() == target else df.repartition(target)


def predict(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """V1 + V2: boolean prediction and positive-class probability per row."""
    out = model.transform(df)
    return out.select(*keep, (F.col("prediction") == 1.0).alias("prediction"),
                      vector_to_array(F.col("probability"))[1].alias("probability"))


def evaluate(model: PipelineModel, test: DataFrame, target: str) -> dict:
    """Confusion counts, accuracy/precision/recall/F1 and ROC AUC on held-out rows."""
    scored = predict(model, test, [target]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        m = M.classification_metrics(scored, target, "prediction").first().asDict()
        auc = M.roc_auc(scored, target, "probability").first()["roc_auc"]
    finally:
        scored.unpersist()
    m["roc_auc"] = auc
    m["confusion_matrix"] = [[m["tn"], m["fp"]], [m["fn"], m["tp"]]]
    return m


def train(df: DataFrame, target: str, model_type: str = "random_forest",
          features: Sequence[str] | None = None, id_column: str | None = None,
          hyperparameters: Mapping | None = None, split: str = "hash", key: str | None = None,
          seed: int = RANDOM_STATE, model_name: str = "model", model_version: str = "1.0.0") -> tuple[PipelineModel, dict]:
    """T1 + T11 + T12 + T13: split, fit, evaluate, and return the training record."""
    feats = FE.feature_columns(df, target, id_column, list(features) if features is not None else None)
    split_key = key or id_column
    if split_key is None:
        raise ValueError("a unique key column is needed to split (key=... or id_column=...)")
    feats = [c for c in feats if c != split_key]  # a key tells rows apart, it is no feature
    if split == "hash":
        tr, te = FE.split_hash(df, split_key, TRAINING_SPLIT, seed)
    elif split == "prefix":
        tr, te = FE.split_prefix(df, split_key, TRAINING_SPLIT)
    else:
        raise ValueError(f"unknown split {split!r}")
    t0 = time.time()
    model, info = fit(tr, target, feats, model_type, hyperparameters, seed)
    duration = time.time() - t0
    metrics = evaluate(model, te, target)
    record = {
        "model_name": model_name, "model_type": model_type, "model_version": model_version,
        "feature_columns": info["feature_columns"], "target_column": target,
        "hyperparameters": info["hyperparameters"], "training_samples": info["training_samples"],
        "test_samples": metrics["tn"] + metrics["fp"] + metrics["fn"] + metrics["tp"] + metrics["unjudged"],
        "training_duration_s": duration,
        **{k: metrics[k] for k in ("accuracy", "precision", "recall", "f1", "roc_auc", "confusion_matrix")},
    }
    return model, record


def tune(df: DataFrame, target: str, features: Sequence[str], key: str, reg_params: Sequence[float],
         parallelism: int = 4, seed: int = RANDOM_STATE) -> tuple[PipelineModel, dict]:
    """Grid over L2 strength with a train/validation split, fits run in parallel."""
    tr, te = FE.split_hash(df, key, TRAINING_SPLIT, seed)
    stages, _ = preprocessing_stages(tr, features, target)
    tr = with_label(tr, target)
    lr = LogisticRegression(featuresCol="features", labelCol="_f_label", elasticNetParam=0.0,
                            standardization=False, maxIter=100)
    grid = ParamGridBuilder().addGrid(lr.regParam, list(reg_params)).build()
    ev = BinaryClassificationEvaluator(labelCol="_f_label", rawPredictionCol="rawPrediction",
                                       metricName="areaUnderROC")
    tvs = TrainValidationSplit(estimator=Pipeline(stages=[*stages, lr]), estimatorParamMaps=grid, evaluator=ev,
                               trainRatio=TRAINING_SPLIT, parallelism=parallelism, seed=seed)
    fitted = tvs.fit(tr)
    best = fitted.bestModel
    scores = list(fitted.validationMetrics)
    best_i = max(range(len(scores)), key=lambda i: scores[i])
    metrics = evaluate(best, te, target)
    return best, {"best_reg_param": float(list(reg_params)[best_i]), "validation_auc": scores[best_i],
                  "test_auc": metrics["roc_auc"], "test_accuracy": metrics["accuracy"]}


def save(model: PipelineModel, path: str) -> None:
    """T14."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_version(log: DataFrame, model_name: str, version: str | None = None) -> PipelineModel:
    """R2 + T14: the saved model of a registered version (newest by default)."""
    row = get_version(log, model_name, version).first()
    if row["path"] is None:
        raise ValueError(f"{model_name!r} {row['model_version']} was registered without a path")
    return load(row["path"])
