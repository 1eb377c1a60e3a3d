"""Session helpers: local sessions, folders, and tables that are written to be read again."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession


COMPRESSION = "zstd"  # of Parquet files that this library writes


def local_session(cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("voltdrift")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def materialize(df: DataFrame, folder: str) -> DataFrame:
    """Write ``df`` once, somewhere under ``folder``, and carry on from the files.

    Needed wherever two branches of a plan must see the same physical rows
    (partition positions, say): re-running the branch could place them
    differently, and the files survive the loss of executors. ``folder`` must be
    one that all executors reach; whoever names it removes it.
    """
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark remove shuffle files that no plan refers to any more.

    It does so once the driver's objects for them are collected, which a driver with
    memory to spare may not do for hours.
    """
    gc.collect()
    spark._jvm.System.gc()


def _located(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder, in whatever file system, if it is there."""
    files, path = _located(spark, folder)
    if files.exists(path) and not files.delete(path, True):
        raise OSError(f"{folder} could not be removed")


def make_folder(spark: SparkSession, folder: str) -> None:
    files, path = _located(spark, folder)
    files.mkdirs(path)
