"""What the operators share: reading tables, cutting lineage, hash folds."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_FOLDERS: dict[str, str] = {}
_PASSING: list[list[DataFrame]] = []  # what each open passing() has written


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; only a local session without one, as in tests, gets a temporary folder."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = _LOCAL_FOLDERS.get(context.applicationId)
    if not folder:
        folder = _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="llm-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and read back from the shared folder, whose files survive the loss of executors."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(_shared_folder(df.sparkSession))
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """Like :func:`checkpointed`, by a Parquet table in ``<shared folder>/<application>``, to be removed after the application.

    For large rows, as it is compressed, and for iterations: a checkpoint hands on
    how its rows are partitioned, and joins of joins add these up until planning
    them takes longer than running them. What is no longer read goes by
    :func:`forget`, or at the end of the :func:`passing` it was written in.
    """
    spark = df.sparkSession
    path = f"{_shared_folder(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_at = path
    if _PASSING:
        _PASSING[-1].append(table)
    return table


def forget(*tables: DataFrame) -> None:
    """Remove tables of :func:`written`. Whatever is made of them must have been written itself.

    Spark removes shuffle files once nothing in the driver refers to them; that is
    seen to here as well, as a driver with memory to spare may not collect for hours.
    """
    for table in tables:
        for passing_tables in _PASSING:
            passing_tables[:] = [x for x in passing_tables if x is not table]
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table._written_at)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    SparkSession.active()._jvm.System.gc()


class Passing:
    def __init__(self, tables: list[DataFrame]) -> None:
        self.tables = tables

    def keep(self, table: DataFrame) -> DataFrame:
        """Leave a table to whoever called."""
        self.tables[:] = [x for x in self.tables if x is not table]
        if len(_PASSING) > 1:
            _PASSING[-2].append(table)
        return table


@contextmanager
def passing() -> Iterator[Passing]:
    """Tables that are :func:`written` inside are removed at the end, but for those kept."""
    tables: list[DataFrame] = []
    _PASSING.append(tables)
    try:
        yield Passing(tables)
    finally:
        forget(*list(tables))
        _PASSING.remove(tables)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string")) % folds


def bounded_sample(df: DataFrame, rows: int, *keys: Column) -> DataFrame:
    """At most ``rows`` rows, the same ones at every run: those first by a hash of ``keys``."""
    return df.orderBy(F.xxhash64(*keys), *keys).limit(rows)
