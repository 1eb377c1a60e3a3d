"""CSV output of reports."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from voltdrift.operators.sequence import number_rows
from voltdrift.session import remove_folder


def write_csv(
    df: DataFrame, path: str, index_order: Sequence[str] | None = None,
    index_name: str = "row_index", mode: str = "error", compression: str = "none",
) -> None:
    """Write UTF-8 CSV files with a header under ``path``.

    With ``index_order`` a first column counts the rows from 0 in that order; the
    rows are staged beside ``path`` for it, in a folder of their own. A compressed
    file (``compression="gzip"``) is read by one task.
    """
    staging = f"{path.rstrip('/')}_index-{uuid.uuid4().hex}"
    try:
        if index_order:
            numbered = number_rows(df, index_name, index_order, staging, after=-1)
            df = numbered.select(index_name, *df.columns)
        _write(df, path, mode, compression)
    finally:
        if index_order:
            remove_folder(df.sparkSession, staging)


def _write(df: DataFrame, path: str, mode: str, compression: str) -> None:
    df.write.mode(mode).option("header", True).option("encoding", "UTF-8").option(
        "escape", '"'
    ).option("compression", compression).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read back what :func:`write_csv` wrote."""
    return (
        spark.read.schema(schema).option("header", True).option("enforceSchema", False)
        .option("escape", '"').csv(path)
    )
