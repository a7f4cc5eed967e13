"""Session helpers: the shared folder of the cluster and a local session for tests."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Compression of the Parquet files that are written. Hashes in hexadecimal take half the room that they take by Spark's default.
CODEC = "zstd"


def local_session(cores: int | str = "*", name: str = "tarmac", **conf: str) -> SparkSession:
    partitions = "8" if cores == "*" else str(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as the cluster names it. Only a local session
    without one gets a folder of its own."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tarmac-"))
    return sc.getCheckpointDir()


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """Path of a new, not yet existing folder below the shared one."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The table written to the shared folder and read back.

    For results that are used more than once: they are computed once, a lost executor does not
    compute them again, and Spark knows their size when it picks a join.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, purpose)
    df.write.parquet(path, compression=CODEC)
    return spark.read.parquet(path)


def cluster_settings(input_bytes: int, cores: int, bytes_per_task: int = 200 * 1024 * 1024) -> dict[str, str]:
    """Settings for a large run: tasks small enough to stay in memory, at least three per core,
    with adaptive execution merging what turns out small and splitting what turns out skewed."""
    partitions = max(3 * cores, -(-input_bytes // bytes_per_task))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(bytes_per_task),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(bytes_per_task),
        "spark.sql.session.timeZone": "UTC",
    }
