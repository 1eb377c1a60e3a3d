"""Order-dependent operators: ranks, running totals and dense row numbers.

A window over a key sorts all rows of that key in one task. Ranks and totals are
therefore a segmented scan in two levels: within (key, bucket), where the bucket is
a coarse expression that never falls as the order rises (the hour of a time, say),
plus what the key's earlier buckets hold. The second level has one summary row per
key and bucket. It is one lazy plan for all sizes, which reads and shuffles its
input once: the summaries are read off the rows as the first level leaves them, so
both levels start from the same exchange. How evenly a crowded key spreads is up to
its bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltdrift.session import materialize

_POSITION_BITS = 33  # monotonically_increasing_id: partition above, row below


def ascending(columns: Sequence[str]) -> list[Column]:
    """Ascending with NULLs last, the order the reports are defined in."""
    return [F.col(c).asc_nulls_last() for c in columns]


def time_buckets(time: str, unique: str, seconds: int = 3600, ids: int = 10_000) -> Column:
    """A bucket for the order (``time`` with NULLs last, ``unique``): spans of time, then blocks of ids.

    Rows without a time come last, in the order of their ids.
    """
    span = F.floor(F.unix_timestamp(F.col(time).cast("timestamp")) / seconds)
    block = F.floor(F.col(unique) / ids)
    return F.struct(
        F.col(time).isNull().alias("late"), F.when(F.col(time).isNull(), block).otherwise(span).cast("long").alias("part")
    )


def with_rank(df: DataFrame, key: str, order: Sequence[str], name: str, bucket: Column) -> DataFrame:
    """Number the rows of each key from 1 in ``order`` (which must be unique per key).

    ``bucket`` must not fall as ``order`` rises. Rows with a NULL key are numbered
    together. ``df`` is read once.
    """
    return _two_levels(df, key, order, bucket, name)


def with_running_total(
    df: DataFrame, key: str, order: Sequence[str], value: str, total: str, position: str, bucket: Column
) -> DataFrame:
    """Add the position within the key and the running sum of ``value`` up to it; see :func:`with_rank`."""
    return _two_levels(df, key, order, bucket, position, value, total)


def _two_levels(
    df: DataFrame, key: str, order: Sequence[str], bucket: Column, position: str, value: str | None = None, total: str | None = None
) -> DataFrame:
    # a struct is never NULL, so rows without a key meet in an ordinary join
    parted = df.withColumns({"_key": F.struct(F.col(key)), "_bucket": bucket})
    # The order is unique, so what follows it decides nothing; but both levels then
    # need all columns, so their exchanges are equal and Spark shuffles the rows once.
    rest = [c for c in df.columns if c not in order]
    within = Window.partitionBy("_key", "_bucket").orderBy(*ascending([*order, *rest]))
    ranked = parted.withColumn("_rank", F.row_number().over(within))
    sums = [F.sum(value).alias("_sum")] if value else []
    sizes = ranked.groupBy("_key", "_bucket").agg(F.max("_rank").alias("_n"), *sums)
    earlier = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.sum("_sum").over(earlier).alias("_before")] if value else []
    carry = sizes.select("_key", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_skip"), *carried)
    if value:
        so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = ranked.withColumn("_here", F.sum(value).over(so_far))
    joined = ranked.join(carry, ["_key", "_bucket"]).withColumn(position, (F.col("_skip") + F.col("_rank")).cast("long"))
    if value:
        here, before = F.col("_here"), F.col("_before")
        joined = joined.withColumn(total, F.coalesce(before + here, before, here))
    return joined.select(*df.columns, *([position, total] if value else [position]))


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str], n: int, name: str = "rn") -> DataFrame:
    """The first ``n`` rows of each key, numbered.

    Spark keeps ``n`` rows per key before the shuffle, so a crowded key costs
    no more than ``n`` rows per map task.
    """
    w = Window.partitionBy(*key).orderBy(*ascending(order))
    return df.withColumn(name, F.row_number().over(w).cast("long")).filter(F.col(name) <= n)


def bucket_of(rank: Column, size: int) -> Column:
    """Consecutive buckets of ``size`` rows, from 0, for ranks from 1."""
    return F.floor((rank - 1) / size).cast("long")


def number_rows(df: DataFrame, name: str, order: Sequence[str], folder: str, after: int = 0) -> DataFrame:
    """Dense ids ``after + 1, after + 2, ...`` in ``order``.

    The rows are written once under ``folder``, in ranges of the order key; ids
    are the place in the range plus the rows of all earlier ranges. Only that
    table of range sizes passes through a window without a key.
    """
    keys = ascending(order)
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = materialize(placed.withColumn("_place", F.monotonically_increasing_id()), folder)
    placed = placed.withColumn("_range", F.shiftright("_place", _POSITION_BITS))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    number = F.col("_before") + _row_in_range() + F.lit(after + 1)
    # one row per range: safe to broadcast
    return (
        placed.join(F.broadcast(offsets), "_range")
        .withColumn(name, number)
        .drop("_place", "_range", "_before")
    )


def _row_in_range() -> Column:
    return F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
