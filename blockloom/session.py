"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution merges small shuffle partitions, splits hot ones in joins and rebalanced writes.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.files.maxPartitionNum": "20000",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(app: str, cores: int | str = "*", **extra: str) -> SparkSession:
    """A session on this machine, for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or a local one in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        context.setCheckpointDir(folder)
    return folder


def pace_listings(spark: SparkSession) -> None:
    """Let a listing of this session take some tasks a core, unless another number is set.

    By default Spark gives each of up to 10,000 folders or files a task of its own, which takes longer to start than to do.
    """
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, 8 * spark.sparkContext.defaultParallelism)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has written to yet."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(rows: DataFrame, label: str) -> DataFrame:
    """Write rows once and read them back: fixed contents, real size, no recomputation on a lost executor."""
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)

