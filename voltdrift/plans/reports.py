"""The ten reports over the snowflake.

Conventions: columns are lower case; ORDER BY is ascending with NULLs last and
ties broken by keys; a zero mean gives a NULL %RSD. Foreign keys are checked
when data is loaded, so a non-NULL key has its parent.

Dimension tables carry no broadcast hint: Spark broadcasts them while their size
on disk or after the map stage is under its limit, and shuffles beyond it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltdrift.functions.columns import (
    equals_as,
    kept_when,
    masked_when,
    synonym,
    without_replicate_suffix,
)
from voltdrift.operators.replicates import Measure, merged_stats, moment_states, replicate_stats
from voltdrift.operators.sequence import (
    ascending,
    bucket_of,
    first_per_key,
    time_buckets,
    with_rank,
)
from voltdrift.sources.schema import DETECTOR_MEASUREMENT, GAIN_OPTIMIZATION, TARGET, UNKNOWN
from voltdrift.sources.tables import InstrumentTables

# Names the two standards go by in the exports, and the amounts
# their reports are made at.
OFN_NAMES = ("OFN", "Perfluoronaphthalene")
TETRADECANE_NAMES = ("Tetradecane", "Tetradecane (C14)")
TETRADECANE_PG = 0.5
SENSITIVITY_PG = 0.02
ALKANE_PREFIX = "Alk"
OFN_PREFIX = "OFN"

# Digits of the statistics of R2 to R4, and of R9.
REPLICATE_MEASURES = [Measure("area", 0, 0), Measure("height", 0, 0), Measure("quant_sn", 2, 3), Measure("similarity", 1, 1)]
SENSITIVITY_MEASURES = [Measure(c, rsd_digits=3) for c in ("area", "quant_sn", "similarity")]

# Acquisition order of samples; the id settles equal times.
ACQUIRED = ["datetimestamp", "sample_id"]


def _acquired_in() -> Column:
    """The hour of acquisition, for ranks in that order."""
    return time_buckets(*ACQUIRED)


def unique_concentrations(tables: InstrumentTables, analyte: str) -> DataFrame:
    """The distinct concentrations measured for one analyte name, ascending."""
    return (
        tables.peaktable.filter(F.col("analyte") == analyte)
        .select("concentration_pg")
        .distinct()
        .orderBy(*ascending(["concentration_pg"]))
    )


def analyte_replicate_stats(
    tables: InstrumentTables, analytes: Sequence[str], concentration_pg, ordered: bool = True
) -> DataFrame:
    """R2: replicate statistics per instrument and detector offset.

    Area, height and S/N count only peaks that are not ``Unknown``, similarity
    only peaks that are not ``Target``. Samples get the attributes of their data
    set first, so the peaks, the long table, are joined once.
    """
    peaks = tables.peaktable
    attributes = with_set_attributes(
        tables.sample.select("sample_id", "dataset_id"), tables, "det_offset"
    ).drop("dataset_id")
    kind = F.col("dataprocessingtype")
    flat = (
        peaks.filter(
            F.col("analyte").isin(list(analytes))
            & equals_as(peaks, "concentration_pg", concentration_pg)
        )
        .select(
            "sample_id",
            masked_when(kind == UNKNOWN, F.col("area")).alias("area"),
            masked_when(kind == UNKNOWN, F.col("height")).alias("height"),
            masked_when(kind == UNKNOWN, F.col("quant_sn")).alias("quant_sn"),
            masked_when(kind == TARGET, F.col("similairity")).alias("similarity"),
        )
        .join(attributes, "sample_id")
    )
    stats = replicate_stats(
        flat,
        ["inst", "det_offset"],
        REPLICATE_MEASURES,
    )
    return _sorted(stats, ["det_offset", "inst"], ordered)


def ofn_replicate_stats(tables: InstrumentTables, concentration_pg) -> DataFrame:
    """R2 for octafluoronaphthalene under both its names."""
    return analyte_replicate_stats(tables, OFN_NAMES, concentration_pg)


def tetradecane_replicate_stats(
    tables: InstrumentTables, concentration_pg=TETRADECANE_PG
) -> DataFrame:
    """R2 for tetradecane at 500 fg."""
    return analyte_replicate_stats(tables, TETRADECANE_NAMES, concentration_pg)


def detector_measurement_means(
    tables: InstrumentTables, prefix: str = ALKANE_PREFIX, bucket_size: int = 3
) -> DataFrame:
    """Mean area per ion of each three consecutive detector measurements.

    A bucket measured at two voltages gives two rows.
    """
    means = bucket_means(tables, prefix, bucket_size).join(
        tables.dataset.select("dataset_id"), "dataset_id"
    )
    return means.select(
        F.col("dataset_id").alias("setname"),
        F.col("voltage").alias("detectorvoltage"),
        "ave_api",
        "dm_api_group",
    ).orderBy(*ascending(["setname", "dm_api_group", "detectorvoltage"]))


def bucket_means(tables: InstrumentTables, prefix: str, bucket_size: int) -> DataFrame:
    """The means of R5 by data set key."""
    return (
        ranked_measurements(tables, prefix).withColumn("dm_api_group", bucket_of(F.col("rn"), bucket_size))
        .groupBy("dataset_id", "dm_api_group", "voltage")
        .agg(F.avg("areaperion").alias("ave_api"))
    )


def ranked_measurements(tables: InstrumentTables, prefix: str) -> DataFrame:
    """Detector measurements with their ion statistics, numbered in each data set."""
    measured = _with_ion_stats(_ion_samples(tables, DETECTOR_MEASUREMENT, prefix), tables)
    return with_rank(measured, "dataset_id", ACQUIRED, "rn", _acquired_in())


def injection_replicates(
    tables: InstrumentTables, prefix: str = ALKANE_PREFIX, with_first: bool = False
) -> DataFrame:
    """How often each sample name was injected, in acquisition order.

    ``seq``, the sum of the acquisition numbers of a name, is the order key; it
    grows with the number of replicates, so ``with_first`` also gives
    ``first_seq``, the number of the first injection.
    """
    counts = replicate_counts(tables, prefix)
    reps = with_set_attributes(counts, tables, "offset_volts")
    columns = ["inst", "offset_volts", "s_name", "reps", "seq"]
    return reps.select(
        F.col("dataset_id").alias("setname"), *columns, *(["first_seq"] if with_first else [])
    ).orderBy(*ascending(["setname", "seq", "s_name"]))


def replicate_counts(tables: InstrumentTables, prefix: str) -> DataFrame:
    """The counts of R6 by data set key."""
    named = named_injections(tables, prefix)
    ranked = with_rank(named, "dataset_id", ACQUIRED, "rn", _acquired_in())
    return ranked.groupBy("dataset_id", "s_name").agg(
        F.count("s_name").alias("reps"), F.sum("rn").alias("seq"), F.min("rn").alias("first_seq")
    )


def named_injections(tables: InstrumentTables, prefix: str) -> DataFrame:
    """Samples of a name with ``prefix``, by the name without its replicate mark."""
    return tables.sample.filter(
        F.col("samplename").startswith(prefix) & F.col("dataset_id").isNotNull()
    ).select(
        "dataset_id", *ACQUIRED,
        without_replicate_suffix(F.col("samplename")).alias("s_name"),
    )


def gain_optimization_start_end(
    tables: InstrumentTables, prefix: str = ALKANE_PREFIX, ordered: bool = True
) -> DataFrame:
    """Voltage and area per ion of the first and second gain optimization."""
    pivot = with_set_attributes(
        _first_two_optimizations(tables, prefix), tables, "offset_volts"
    )
    columns = ["starting_go_dv", "starting_go_api", "ending_go_dv", "ending_go_api"]
    report = pivot.select(F.col("dataset_id").alias("setname"), "inst", "offset_volts", *columns)
    return _sorted(report, ["inst", "offset_volts", "setname"], ordered)


def measurement_and_optimization_summary(
    tables: InstrumentTables, prefix: str = OFN_PREFIX, starting: int = 3, ordered: bool = True,
    with_set: bool = False,
) -> DataFrame:
    """Mean area per ion at the start (first three) and afterwards, per data
    set and detector voltage, beside the first and second gain optimization.

    The last measurement of the start is found from the first three of each data
    set; the others are told apart by comparing with it, not by ranking all.
    ``with_set`` adds data set and voltage, which make the rows' order total.
    """
    identity = [F.col("dataset_id").alias("setname"), F.col("voltage").alias("dm_dv")] if with_set else []
    measured = _with_ion_stats(_ion_samples(tables, DETECTOR_MEASUREMENT, prefix), tables)

    def place(time: str, sample: str) -> Column:
        return F.struct(F.col(time).isNull().alias("late"), F.col(time).alias("time"), F.col(sample).alias("id"))

    last = (
        first_per_key(measured.select("dataset_id", *ACQUIRED), ["dataset_id"], ACQUIRED, starting)
        .filter(F.col("rn") == starting)
        .select("dataset_id", place(*ACQUIRED).alias("last"))
    )
    api = F.col("areaperion")
    started = F.col("last").isNull() | (place(*ACQUIRED) <= F.col("last"))
    means = (
        measured.join(last, "dataset_id", "left")
        .groupBy("dataset_id", "voltage")
        .agg(
            F.avg(kept_when(started, api)).cast("float").alias("ave_start_dm_api"),
            F.avg(kept_when(~started, api)).cast("float").alias("ave_end_dm_api"),
        )
    )
    both = means.join(_first_two_optimizations(tables, prefix), "dataset_id")
    report = with_set_attributes(both, tables, "offset_volts").select(
        "inst",
        "offset_volts",
        *identity,
        F.col("starting_go_dv").alias("start_go_dv"),
        F.col("starting_go_api").alias("start_go_api"),
        "ave_start_dm_api",
        "ave_end_dm_api",
        F.col("ending_go_dv").alias("end_go_dv"),
        F.col("ending_go_api").alias("end_go_api"),
    )
    return _sorted(report, ["offset_volts", "inst"], ordered)


def sensitivity(
    tables: InstrumentTables, concentration_pg=SENSITIVITY_PG, ordered: bool = True,
    with_set: bool = False,
) -> DataFrame:
    """OFN statistics per data set beside its instrument detection limit.

    Area and S/N count only ``Target`` peaks; a similarity of 0 counts as none.
    ``with_set`` adds the data set, which makes the rows' order total.
    """
    peaks = tables.peaktable
    is_target = F.col("dataprocessingtype") == TARGET
    flat = (
        peaks.filter(
            equals_as(peaks, "concentration_pg", concentration_pg)
            & F.col("analyte").isin(list(OFN_NAMES))
        )
        .select(
            "sample_id",
            synonym(F.col("analyte"), {"Perfluoronaphthalene": "OFN"}).alias("analyte"),
            F.col("concentration_pg").alias("pg_oncolumn"),
            kept_when(is_target, F.col("area")).alias("area"),
            kept_when(is_target, F.col("quant_sn")).alias("quant_sn"),
            F.nullif(F.col("similairity"), F.lit(0)).alias("similarity"),
        )
        .join(tables.sample.select("sample_id", "dataset_id"), "sample_id")
    )
    # The data set decides instrument, offset and IDL, so they join the
    # aggregate and a crowded data set has been reduced to one row by then.
    stats = replicate_stats(
        flat,
        ["dataset_id", "analyte", "pg_oncolumn"],
        SENSITIVITY_MEASURES,
    )
    return _beside_limits(stats, tables, ordered, with_set)


def _beside_limits(stats: DataFrame, tables: InstrumentTables, ordered: bool, with_set: bool) -> DataFrame:
    limits = tables.idl.select("idl_id", F.col("idl_value").alias("idl"))
    report = (
        with_set_attributes(stats, tables, "offset_volts", "idl_id")
        .join(limits, "idl_id")
        .select(
            "inst", "offset_volts", *([F.col("dataset_id").alias("setname")] if with_set else []), "idl",
            *[f"{s}_{m}" for m in ("area", "quant_sn", "similarity") for s in ("ave", "stddev", "rsd")],
        )
    )
    return _sorted(report, ["offset_volts", "inst"], ordered)


STATE_KEYS = ["dataset_id", "analyte", "concentration_pg", "dataprocessingtype"]


def peak_states(peaks: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """Counts, sums and squared deviations of peaks by data set, analyte, amount and processing type.

    All of R1 to R4, R9 and the catalogue of amounts can be had from them without
    a look at the peaks; a load keeps those of its own peaks. Without ``samples``, the
    peaks have ``dataset_id`` themselves.
    """
    placed = peaks if samples is None else peaks.join(samples.select("sample_id", "dataset_id"), "sample_id")
    measured = placed.select(
        *STATE_KEYS, "area", "height", "quant_sn", F.col("similairity").alias("similarity"),
        F.nullif(F.col("similairity"), F.lit(0)).alias("similarity_found"),
    )
    return moment_states(measured, STATE_KEYS, ["area", "height", "quant_sn", "similarity", "similarity_found"])


def unique_concentrations_of_states(states: DataFrame, analyte: str) -> DataFrame:
    """R1 from states."""
    return states.filter(F.col("analyte") == analyte).select("concentration_pg").distinct().orderBy(*ascending(["concentration_pg"]))


def analyte_stats_of_states(
    states: DataFrame, tables: InstrumentTables, analytes: Sequence[str], concentration_pg, ordered: bool = True
) -> DataFrame:
    """R2 (R3, R4 with their analytes and amounts) from states; no peak is read."""
    wanted = states.filter(F.col("analyte").isin(list(analytes)) & equals_as(states, "concentration_pg", concentration_pg))
    kind = F.col("dataprocessingtype")
    known, other = ~kind.eqNullSafe(UNKNOWN), ~kind.eqNullSafe(TARGET)
    stats = merged_stats(
        with_set_attributes(wanted, tables, "det_offset"), ["inst", "det_offset"], REPLICATE_MEASURES,
        {"area": known, "height": known, "quant_sn": known, "similarity": other},
    )
    return _sorted(stats, ["det_offset", "inst"], ordered)


def sensitivity_of_states(
    states: DataFrame, tables: InstrumentTables, concentration_pg=SENSITIVITY_PG, ordered: bool = True, with_set: bool = False
) -> DataFrame:
    """R9 from states; no peak is read."""
    wanted = states.filter(F.col("analyte").isin(list(OFN_NAMES)) & equals_as(states, "concentration_pg", concentration_pg))
    renamed = wanted.select(
        "dataset_id", synonym(F.col("analyte"), {"Perfluoronaphthalene": "OFN"}).alias("analyte"), F.col("concentration_pg").alias("pg_oncolumn"),
        "dataprocessingtype", *(f"{part}_{c}" for c in ("area", "quant_sn") for part in ("n", "sum", "m2")),
        *(F.col(f"{part}_similarity_found").alias(f"{part}_similarity") for part in ("n", "sum", "m2")),
    )
    target = F.col("dataprocessingtype").eqNullSafe(TARGET)
    stats = merged_stats(
        renamed, ["dataset_id", "analyte", "pg_oncolumn"], SENSITIVITY_MEASURES, {"area": target, "quant_sn": target}
    )
    return _beside_limits(stats, tables, ordered, with_set)


def linearity(tables: InstrumentTables, with_set: bool = False) -> DataFrame:
    """The dynamic range of every data set that has one. No order; ``with_set`` adds the data set."""
    identity = [F.col("dataset_id").alias("setname")] if with_set else []
    dynamic_range = tables.dynamicrange.select(
        "dr_id",
        F.col("ordersofmagnitude").alias("orders"),
        "concrange_pg_low",
        "concrange_pg_high",
        F.col("correlation_coefficient_r").alias("r"),
    )
    offsets = tables.ms_method.select(
        "ms_method_id", F.col("detectoroffset_volts").alias("offset_volts")
    )
    return (
        tables.dataset.select("dataset_id", F.col("instrument").alias("inst"), "ms_method_id", "dr_id")
        .join(offsets, "ms_method_id")
        .join(dynamic_range, "dr_id")
        .select("inst", "offset_volts", *identity, "orders", "concrange_pg_low", "concrange_pg_high", "r")
    )


def with_set_attributes(
    df: DataFrame, tables: InstrumentTables, offset_name: str, *keys: str
) -> DataFrame:
    """Add instrument and detector offset of each row's data set, and key columns.

    The dimensions join each other first, so ``df`` meets them once.
    """
    datasets = tables.dataset.select(
        "dataset_id", F.col("instrument").alias("inst"), "ms_method_id", *keys
    )
    offsets = tables.ms_method.select(
        "ms_method_id", F.col("detectoroffset_volts").alias(offset_name)
    )
    return df.join(datasets.join(offsets, "ms_method_id").drop("ms_method_id"), "dataset_id")


def _ion_samples(tables: InstrumentTables, sample_type: str, prefix: str) -> DataFrame:
    """Samples of one measurement type that carry ion statistics."""
    return tables.sample.filter(
        (F.col("sampletype") == sample_type)
        & F.col("dataset_id").startswith(prefix)
        & F.col("ionstats_id").isNotNull()
    ).select("dataset_id", "ionstats_id", *ACQUIRED)


def _with_ion_stats(samples: DataFrame, tables: InstrumentTables) -> DataFrame:
    return samples.join(
        tables.ionstats.select("ionstats_id", "voltage", "areaperion"), "ionstats_id"
    ).drop("ionstats_id")


def _first_two_optimizations(tables: InstrumentTables, prefix: str) -> DataFrame:
    """First and second gain optimization of each data set as columns.

    Only samples that have their ion statistics count; two per data set remain
    before the shuffle.
    """
    optimized = _with_ion_stats(_ion_samples(tables, GAIN_OPTIMIZATION, prefix), tables)
    two = first_per_key(optimized, ["dataset_id"], ACQUIRED, 2)
    at = {1: "starting", 2: "ending"}
    return (
        two.groupBy("dataset_id")
        .agg(
            *[
                F.sum(kept_when(F.col("rn") == rank, F.col(column))).alias(f"{word}_go_{short}")
                for rank, word in at.items()
                for column, short in (("voltage", "dv"), ("areaperion", "api"))
            ]
        )
    )


def _sorted(df: DataFrame, order: Sequence[str], wanted: bool) -> DataFrame:
    return df.orderBy(*ascending(order)) if wanted else df
