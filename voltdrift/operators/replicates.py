"""Replicate statistics: mean, sample deviation and %RSD of measures by keys.

They come from the values themselves, or from *states* (count, sum and squared
deviation of groups of values), which are kept per load and merged when asked for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltdrift.functions.columns import rounded, rsd_percent


@dataclass(frozen=True)
class Measure:
    """A numeric column and the decimals to report (None keeps full precision)."""

    column: str
    mean_digits: int | None = None
    sd_digits: int | None = None
    rsd_digits: int | None = 2


def replicate_stats(df: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """One row per key with ``ave_``, ``stddev_`` and ``rsd_`` of every measure.

    NULLs are skipped; one replicate has no deviation; %RSD comes from the
    unrounded mean and deviation. Whole numbers are summed exactly, whatever their
    order and size. One shuffle of partial aggregates.
    """
    aggregates = []
    for m in measures:
        value = F.col(m.column)
        if df.schema[m.column].dataType.typeName() in ("byte", "short", "integer", "long"):
            total = F.sum(value.cast("decimal(20,0)")).cast("double")
            aggregates.append(F.try_divide(total, F.count(value)).alias(f"ave_{m.column}"))
        else:
            aggregates.append(F.avg(value).alias(f"ave_{m.column}"))
        aggregates.append(F.stddev_samp(m.column).alias(f"stddev_{m.column}"))
    return _reported(df.groupBy(*keys).agg(*aggregates), keys, measures)


def _reported(stats: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    columns = [F.col(k) for k in keys]
    for m in measures:
        mean, sd = F.col(f"ave_{m.column}"), F.col(f"stddev_{m.column}")
        columns.append(rounded(mean, m.mean_digits).alias(f"ave_{m.column}"))
        columns.append(rounded(sd, m.sd_digits).alias(f"stddev_{m.column}"))
        columns.append(rounded(rsd_percent(sd, mean), m.rsd_digits).alias(f"rsd_{m.column}"))
    return stats.select(*columns)


def moment_states(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key with ``n_``, ``sum_`` and ``m2_`` (squared deviations from the mean) of every column.

    NULLs are skipped. Sums of whole numbers are exact decimals.
    """
    aggregates = []
    for c in columns:
        whole = df.schema[c].dataType.typeName() in ("byte", "short", "integer", "long")
        total = F.sum(F.col(c).cast("decimal(20,0)")).cast("decimal(38,0)") if whole else F.sum(F.col(c).cast("double"))
        squares = F.var_pop(c) * F.count(c)
        aggregates += [F.count(c).alias(f"n_{c}"), total.alias(f"sum_{c}"), F.coalesce(squares, F.lit(0.0)).alias(f"m2_{c}")]
    return df.groupBy(*keys).agg(*aggregates)


def merged_stats(
    states: DataFrame, keys: Sequence[str], measures: Sequence[Measure], counts_where: Mapping[str, Column] | None = None
) -> DataFrame:
    """What :func:`replicate_stats` gives, from the states of any groups that make up the keys' values.

    ``counts_where``: by measure, the states that count. Squared deviations add up,
    plus those of the groups' means from the mean of all; that is known first, from
    an aggregate of one row per key, so nothing large cancels out. Both aggregates
    are combined before their shuffles: a key of many groups costs no more.
    """
    counts_where = counts_where or {}

    def kept(part: str, m: Measure) -> Column:
        value = F.col(f"{part}_{m.column}")
        return F.when(counts_where[m.column], value) if m.column in counts_where else value

    totals = [F.sum(kept(part, m)).alias(f"_{part}_{m.column}") for m in measures for part in ("n", "sum")]
    means = states.groupBy(*keys).agg(*totals)
    shared = [F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)]
    means = means.select(*shared, *(F.col(f"_n_{m.column}") for m in measures), *(
        F.try_divide(F.col(f"_sum_{m.column}").cast("double"), F.col(f"_n_{m.column}")).alias(f"_mean_{m.column}") for m in measures
    ))
    same = [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)]
    beside = states.join(means, same)
    aggregates = []
    for m in measures:
        n, mean = kept("n", m), F.first(f"_mean_{m.column}")
        apart = F.try_divide(F.col(f"sum_{m.column}").cast("double"), F.col(f"n_{m.column}")) - F.col(f"_mean_{m.column}")
        squares = F.sum(kept("m2", m)) + F.coalesce(F.sum(n * apart * apart), F.lit(0.0))
        aggregates += [mean.alias(f"ave_{m.column}"), F.sqrt(F.try_divide(squares, F.nullif(F.sum(n) - 1, F.lit(0)))).alias(f"_sd_{m.column}"), F.sum(n).alias(f"_of_{m.column}")]
    stats = beside.groupBy(*keys).agg(*aggregates)
    deviations = {f"stddev_{m.column}": F.when(F.col(f"_of_{m.column}") > 1, F.col(f"_sd_{m.column}")) for m in measures}
    return _reported(stats.withColumns(deviations), keys, measures)
