"""Session helpers: a local session for tests/bench and shared scratch paths.

Library code never invents machine-local folders on a cluster: every
intermediate table or checkpoint lives under ``spark.checkpoint.dir``.
A private folder is only chosen when a local session has none configured
(tests); on a cluster the missing setting is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session used by tests and bench (local mode, UI off, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("vela")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, choosing a private one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get(_CKPT_KEY, None) or sc.getConf().get(_CKPT_KEY, None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {_CKPT_KEY} to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="vela-ckpt-")
        try:  # informational only; some deployments reject runtime core-conf changes
            spark.conf.set(_CKPT_KEY, conf)
        except Exception:  # noqa: BLE001
            pass
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/vela-{name}-{uuid.uuid4().hex[:12]}"


def spread(df, min_partitions: int | None = None):
    """Round-robin a frame over the cluster's cores when it has fewer partitions.

    Compute-heavy narrow work (hash samplers, model fits) on a small input file
    would otherwise run in one task.  Inputs that already have enough
    partitions (the normal case on a large table) are returned unchanged, so
    no shuffle is added at scale.
    """
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    # A plan that already shuffles is as wide as the shuffle; asking its RDD for
    # a partition count would run that shuffle eagerly under AQE, so skip it.
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want)
