"""Session helpers shared by jobs, tests and the query registry."""

from __future__ import annotations

import os
import tempfile
from math import ceil

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", app: str = "orrery", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


#: Shuffles start with at least so many partitions; adaptive execution merges small ones, so a task's share stays bounded.
FIRST_PARTITIONS = 512


def prepare(spark: SparkSession) -> SparkSession:
    """Settings every operator relies on: UTC session clock, skew handling, and partitions that do not grow with the input."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if spark.conf.get(first, None) is None:
        spark.conf.set(first, max(FIRST_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for staged output.

    On a cluster this is under the shared folder named in ``spark.checkpoint.dir``;
    a machine-local folder is made only for a local master (tests), where one machine is all there is.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        return tempfile.mkdtemp(prefix=f"spark-{purpose}-", dir="/tmp")
    return os.path.join(root, f"{purpose}-{os.urandom(6).hex()}")


def ensure_checkpoints(spark: SparkSession) -> None:
    """Make ``checkpoint()`` usable: the cluster's shared folder if named, else one of our own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(scratch_dir(spark, "checkpoint"))


def cut(df: DataFrame) -> DataFrame:
    """Write a result that several later steps read, so they neither recompute nor replan it.

    Reliable checkpoint: survives the loss of executors.
    """
    ensure_checkpoints(df.sparkSession)
    return df.checkpoint()


def wide(spark: SparkSession) -> int:
    """Tasks for a step whose cost is not in its bytes (opening files, resampling): given as a number, so that adaptive
    execution does not merge its small partitions into one or two tasks."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def deal(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Rows that an explode or a function makes much of, some ``rows`` to a task whatever their number. ``df`` is read twice."""
    return df.repartition(max(wide(df.sparkSession), ceil(df.count() / rows)), *keys)
