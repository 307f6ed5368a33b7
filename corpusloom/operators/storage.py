"""Shared-folder helpers: reliable checkpoints and scratch tables that outlive a lost executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

ROWS_A_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXTS_AT_ONCE = 1024


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; a local session without one gets its own."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="corpusloom-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give every core work when a small input arrives in fewer pieces than there are cores.

    A large scan already has more tasks than cores and passes through without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def in_small_batches(df: DataFrame) -> DataFrame:
    """Bound the rows that a Python worker gets at once, for rows that hold whole texts.

    Spark counts rows, not bytes, and a worker holds a batch several times: as it came, as it leaves, and the one after it.
    The setting is the session's, since the plan is made later; a lower one stays.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(ROWS_A_BATCH)) <= TEXTS_AT_ONCE:
        conf.set(ROWS_A_BATCH, str(TEXTS_AT_ONCE))
    return df


def settle(df: DataFrame) -> DataFrame:
    """Write the rows once and cut the lineage, so later jobs all see the very same partitions."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def settle_for_fits(df: DataFrame) -> DataFrame:
    """Rows that iterative fits read again and again: settled, so every fit plans over a plain scan, and cached as far as
    memory goes. The others are read from where they were settled, so no row is on disk twice."""
    return settle(df).persist(StorageLevel.MEMORY_ONLY)


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def save_artifact(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write an intermediate result as Parquet and read it back."""
    df.write.mode("errorifexists").parquet(path, partitionBy=partition_by)
    return load_artifact(df.sparkSession, path)


def load_artifact(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
