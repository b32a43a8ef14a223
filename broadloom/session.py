"""Session settings, table loading and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", app: str = "broadloom", shuffle: int = 8) -> SparkSession:
    """Session for tests and the local benchmark. On a cluster, use the one spark-submit gives."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "4096")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.executorEnv.OPENBLAS_NUM_THREADS", "1")
        .config("spark.executorEnv.OMP_NUM_THREADS", "1")
        .config("spark.driver.memory", os.environ.get("BROADLOOM_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_base(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Taken from ``spark.checkpoint.dir`` (or a directory already set on the context). Only a local
    master may fall back to a temporary folder: executors on other machines could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="broadloom-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_base(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage through a Parquet table in the shared folder; survives the loss of executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a table that ``scratch_path`` named, once nothing reads it any more."""
    if not path.startswith(f"{scratch_base(spark)}/"):
        raise ValueError(f"{path} is not in the scratch folder")
    files, target = _file_system(spark, path)
    files.delete(target, True)


# --- versioned tables ---------------------------------------------------------------------------


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the published versions of a table, rising. A version is published by the marker that Spark's committer
    writes last, so one that failed half-way is not seen."""
    files, target = _file_system(spark, folder)
    if not files.exists(target):
        return []
    names = [s.getPath().getName() for s in files.listStatus(target) if s.isDirectory()]
    path = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(int(n[8:]) for n in names if n.startswith("version-") and files.exists(path(f"{folder}/{n}/_SUCCESS")))


def publish(table: DataFrame, folder: str, keep: int = 2) -> int:
    """Write the next version of a small table; older ones but the last ``keep`` go once it is published."""
    spark = table.sparkSession
    done = versions(spark, folder)
    number = done[-1] + 1 if done else 0
    table.coalesce(1).write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true") \
        .parquet(f"{folder}/version-{number}")
    for old in done[:max(0, len(done) + 1 - keep)]:
        files, target = _file_system(spark, f"{folder}/version-{old}")
        files.delete(target, True)
    return number


def latest(spark: SparkSession, folder: str) -> DataFrame:
    done = versions(spark, folder)
    if not done:
        raise FileNotFoundError(f"no published version in {folder}")
    return spark.read.parquet(f"{folder}/version-{done[-1]}")
