"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs are designed around. Joins carry no broadcast hint: Spark
# broadcasts a side only when its measured size is under
# spark.sql.autoBroadcastJoinThreshold, and splits hot keys of the remaining
# sort-merge joins at run time (skewJoin) and of table writes
# (optimizeSkewsInRebalancePartitions).
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Recording the call site of every column expression nearly doubles planning time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Shuffles start fine-grained and are merged to the advisory size; streams,
    # which run without that, use the plain number.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.shuffle.partitions": "2048",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_WORK_DIR_CONF = "spark.basketry.workDir"


def cluster_session(app_name: str = "basketry", **extra: str) -> SparkSession:
    """Session with ``CLUSTER_CONF``; master and resources come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**CLUSTER_CONF, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(app_name: str = "basketry", cpus: int | str = 8, **extra: str) -> SparkSession:
    """Single-JVM session for tests and benchmarks."""
    partitions = str(cpus) if str(cpus).isdigit() else "8"
    conf = {
        **CLUSTER_CONF,
        "spark.sql.shuffle.partitions": partitions,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": partitions,
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.driver.host": "localhost",
        **extra,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app_name)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Source timestamps carry no zone; one fixed zone keeps day bounds stable."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_WORK_DIR_CONF, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="basketry-")
        spark.conf.set(_WORK_DIR_CONF, root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
