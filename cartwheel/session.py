"""SparkSession helpers: a local builder for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on. On a cluster they belong in the job's spark-defaults;
# ``local_session`` sets them for tests and the bench.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    # intermediate checkpoints (hot-group tables, materialised inputs) are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cartwheel") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("CARTWHEEL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A folder that the context already has is kept. On a cluster the setting must be there; only a local master
    may go without (tests) and gets a scratch folder.
    """
    context = spark.sparkContext
    held = context.getCheckpointDir()
    if held:  # set by the user, or by Spark itself from spark.checkpoint.dir
        return held
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="cartwheel-ckpt-"))
    return context.getCheckpointDir()
