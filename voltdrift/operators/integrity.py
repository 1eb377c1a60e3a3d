"""Key checks Spark does not make by itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_parents(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign keys without a parent row, with the number of rows that use each.

    Counting per key first leaves one row per key for the join, so a key that
    most children share is no heavier than another.
    """
    used = (
        child.filter(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("fk"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return used.join(parent.select(F.col(parent_key).alias("fk")), "fk", "left_anti")


def already_present(incoming: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Distinct incoming keys that the table already holds."""
    return incoming.select(key).distinct().join(existing.select(key), key, "left_semi")


def not_present(incoming: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Incoming rows whose key the table does not hold yet."""
    return incoming.join(existing.select(key), key, "left_anti")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Primary-key values that occur more than once."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter(F.col("n_rows") > 1)
