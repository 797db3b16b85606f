"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings every job here is written for. A cluster sets its own sizes; these
# only fix semantics (UTC) and switch the run-time re-planning on.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join also when that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Building a plan is several times faster without a stack trace per column.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **settings: str) -> SparkSession:
    """A local session for tests and the benchmark; more settings by their names with ``__`` for dots."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("prospectra")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # Rows are few and the work per row heavy: keep the cores busy.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "32k")
    )
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``, where unset a folder in the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured.rstrip("/") if configured else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/prospectra-work"


def new_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
