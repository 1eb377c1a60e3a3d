"""What the application makes of the reports: drift curve and plot series.

Series are long: one row per point, so any number of instruments and data sets
fits and the points stay distributed until a caller draws them.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltdrift.functions.columns import SAMPLE_NAME_PATTERN, parsed_concentration
from voltdrift.operators.sequence import (
    ascending,
    bucket_of,
    first_per_key,
    time_buckets,
    with_running_total,
)
from voltdrift.plans.reports import (
    ACQUIRED,
    ALKANE_PREFIX,
    TETRADECANE_NAMES,
    TETRADECANE_PG,
    analyte_replicate_stats,
    bucket_means,
    gain_optimization_start_end,
    named_injections,
    ranked_measurements,
    replicate_counts,
    sensitivity,
    with_set_attributes,
)
from voltdrift.sources.schema import TARGET, UNKNOWN
from voltdrift.sources.sinks import write_csv
from voltdrift.sources.tables import InstrumentTables

SPAN = 100_000  # of sums of acquisition numbers, in which names are totalled together

# Analyte group, names in the exports, short name, masses summed.
ANALYTES = [
    ("OFN", ("Perfluoronaphthalene", "OFN"), "OFN", "Quant Mass = 271.99"),
    ("C14", ("Tetradecane", "Tetradecane (C14)"), "Tetradecane", "Quant Masses = SUM(57.07, 71.09, 81.10)"),
    ("C20", ("Eicosane", "Eicosane (C20)"), "Eicosane", "Quant Masses = SUM(57.07, 71.09, 81.10)"),
    ("C30", ("Triacontane", "Triacontane (C30)"), "Triacontane", "Quant Masses = SUM(57.07, 71.09, 81.10)"),
]

# Legends of known instruments (others go by their name), metrics
# with their axis and the processing type of the peaks they count.
LEGENDS = {"PV1": "Peg BT - PV1", "PV2": "Peg BT - PV2"}
METRIC_LABELS = {
    "ave_area": "Average Area",
    "ave_height": "Average Height",
    "ave_quant_sn": "Average Quant S/N",
    "ave_similarity": "Average Similarity",
}
METRIC_KINDS = {
    "ave_area": TARGET,
    "ave_height": TARGET,
    "ave_quant_sn": TARGET,
    "ave_similarity": UNKNOWN,
}


def drift_curve(
    tables: InstrumentTables, prefix: str = ALKANE_PREFIX, bucket_size: int = 3,
    name_pattern: str = SAMPLE_NAME_PATTERN, ordered: bool = True, pairing: str = "position",
) -> DataFrame:
    """Area per ion against the number of injections made so far.

    Measurements are taken before the first and after each group of injections:
    bucket k of the detector measurements (R5) goes with the k-th sample name in
    injection order (R6), bucket 0 with no injection yet. Buckets past the last
    name keep the last total, without a name. With ``pairing="time"`` a bucket
    goes with all injections acquired before its first measurement instead, so
    none is lost, and with the name injected last. How the two combine is this
    library's definition.
    """
    if pairing not in ("position", "time"):
        raise ValueError(f"no pairing by {pairing!r}")
    measured = bucket_means(tables, prefix, bucket_size).withColumnRenamed("voltage", "det_volts")
    key = ["dataset_id", "dm_api_group"]
    if pairing == "time":
        points = measured.join(_injected_by_time(tables, prefix, bucket_size), key, "left")
    else:
        names = _injected_by_position(tables, prefix)
        # both sides of it start from the exchange that the running total makes
        in_all = names.groupBy("dataset_id").agg(
            F.max("dm_api_group").alias("_names"), F.max("cumulative_inj").alias("_all")
        )
        past = F.col("dm_api_group") > F.col("_names")
        points = measured.join(names, key, "left").join(in_all, "dataset_id", "left").withColumn(
            "cumulative_inj", F.when(past, F.col("_all")).otherwise(F.col("cumulative_inj"))
        )
    points = points.withColumn("conc_pg", parsed_concentration(F.col("sample"), name_pattern))
    curve = (
        with_set_attributes(points, tables, "offset_volts")
        .fillna(0, ["conc_pg", "cumulative_inj"])
        .select(
            F.col("dataset_id").alias("dataset"), "inst", "offset_volts", "dm_api_group",
            "sample", "conc_pg", "cumulative_inj", "det_volts", "ave_api",
        )
    )
    return curve.orderBy(*ascending(CURVE_ORDER)) if ordered else curve


def _injected_by_position(tables: InstrumentTables, prefix: str) -> DataFrame:
    """The k-th sample name of each data set, with the injections up to it."""
    # sums of acquisition numbers are far apart where names are many: a span holds
    # no more names than it is wide, but for names that tie
    return with_running_total(
        replicate_counts(tables, prefix).drop("first_seq"),
        "dataset_id", ["seq", "s_name"], "reps", "cumulative_inj", "position", F.floor(F.col("seq") / SPAN),
    ).select(
        "dataset_id",
        F.col("position").alias("dm_api_group"),
        F.col("s_name").alias("sample"),
        "cumulative_inj",
    )


def _injected_by_time(tables: InstrumentTables, prefix: str, bucket_size: int) -> DataFrame:
    """The injections before each bucket's first measurement, and the last one's name.

    Injections and measurements run in one order; a measurement adds nothing to
    the total, an injection one.
    """
    firsts = (
        ranked_measurements(tables, prefix)
        .filter((F.col("rn") - 1) % bucket_size == 0)
        .select(
            "dataset_id", *ACQUIRED, F.lit(0).alias("_one"), F.lit(None).cast("string").alias("sample"),
            bucket_of(F.col("rn"), bucket_size).alias("dm_api_group"),
        )
    )
    named = named_injections(tables, prefix).select(
        "dataset_id", *ACQUIRED, F.lit(1).alias("_one"), F.col("s_name").alias("sample"),
        F.lit(None).cast("bigint").alias("dm_api_group"),
    )
    # a sample that is both was measured before it counts as injected
    totals = with_running_total(
        named.unionByName(firsts), "dataset_id", [*ACQUIRED, "_one"], "_one", "cumulative_inj", "_position",
        time_buckets(*ACQUIRED),
    )
    names = totals.filter("_one = 1").select("dataset_id", "cumulative_inj", "sample")
    firsts = totals.filter(F.col("dm_api_group").isNotNull()).select("dataset_id", "dm_api_group", "cumulative_inj")
    return firsts.join(names, ["dataset_id", "cumulative_inj"], "left")


CURVE_ORDER = ["dataset", "dm_api_group", "det_volts"]


def drift_curve_series(curve: DataFrame, with_instrument: bool = False) -> DataFrame:
    """The drift curve as labelled series, one per data set.

    A curve is named after offset and voltage of its third point; a shorter
    curve has no label. The curve is read twice, so hand in a stored one.
    """
    third = first_per_key(
        curve.select(*CURVE_ORDER, F.col("offset_volts").alias("_v"), F.col("inst").alias("_i")),
        ["dataset"], CURVE_ORDER[1:], 3,
    ).filter(F.col("rn") == 3)
    if with_instrument:
        label = F.format_string("Inst: %s - Offset: +%s v = %s v", "_i", "_v", "det_volts")
    else:
        label = F.format_string("Offset: +%s v = %s v", "_v", "det_volts")
    labels = third.select("dataset", label.alias("curve_label"))
    return curve.join(labels, "dataset", "left").select(
        "inst", "dataset", "curve_label", "dm_api_group",
        F.col("cumulative_inj").alias("x"), F.col("ave_api").alias("y"),
    )


def zero_filled(stats: DataFrame) -> DataFrame:
    """NULL numbers as 0, the form in which the statistics are tabulated and drawn."""
    return stats.fillna(0)


def metric_series(
    tables: InstrumentTables, analytes: Sequence[str], concentration_pg,
    instruments: Sequence[str] | None = None,
) -> DataFrame:
    """Four averages against detector offset, one series per instrument.

    ``quant_masses`` are those the catalogue has for the names, ``kind`` the
    processing type that the metric counts.
    """
    masses = sorted({m for _, names, _, m in ANALYTES if set(names) & set(analytes)})
    stats = zero_filled(analyte_replicate_stats(tables, analytes, concentration_pg, ordered=False))
    return (
        _labelled(stats, instruments)
        .unpivot(["inst", "series", "det_offset"], list(METRIC_LABELS), "metric", "y")
        .select(
            "inst", "series", F.col("det_offset").alias("x"), "metric",
            _lookup(METRIC_LABELS, F.col("metric")).alias("axis_label"),
            F.lit("; ".join(masses) or None).cast("string").alias("quant_masses"),
            _lookup(METRIC_KINDS, F.col("metric")).alias("kind"), "y",
        )
        .orderBy(*ascending(["metric", "inst", "x"]))
    )


def analyte_names(group: str) -> tuple[str, ...]:
    """The names under which a catalogue group's peaks are reported."""
    return next(names for g, names, _, _ in ANALYTES if g == group)


def tabulated_statistics(
    tables: InstrumentTables, group: str, concentration_pg, folder: str
) -> DataFrame:
    """Write R2 for a catalogue group, NULLs as 0 and rows indexed, as CSV.

    The files go to ``<folder>/<short name>_<amount>pg_TabulatedResults``.
    """
    analyte_id = next(short for g, _, short, _ in ANALYTES if g == group)
    stats = zero_filled(analyte_replicate_stats(tables, analyte_names(group), concentration_pg))
    name = f"{export_prefix(analyte_id, concentration_pg)}_TabulatedResults"
    export_report(stats, f"{folder}/{name}", ["det_offset", "inst"])
    return stats


def tetradecane_metric_series(
    tables: InstrumentTables, concentration_pg=TETRADECANE_PG,
    instruments: Sequence[str] | None = None,
) -> DataFrame:
    """D3: D2 for tetradecane at 500 fg."""
    return metric_series(tables, TETRADECANE_NAMES, concentration_pg, instruments)


def export_prefix(analyte_id: str, concentration_pg) -> str:
    """Name stem of the files made for one analyte and amount."""
    return f"{analyte_id}_{_shortest(concentration_pg)}pg"


def _shortest(amount) -> str:
    """An amount as its 4-byte column prints it: the shortest text that reads back the same."""
    return str(np.float32(amount)) if isinstance(amount, float) else str(amount)


def analyte_catalogue(spark: SparkSession) -> DataFrame:
    """Every name an analyte goes by, numbered within its group (8 rows)."""
    rows = [
        (group, i + 1, name, analyte_id, masses)
        for group, names, analyte_id, masses in ANALYTES
        for i, name in enumerate(names)
    ]
    return spark.createDataFrame(
        rows, "analyte_group STRING, name_no INT, analyte STRING, analyte_id STRING, quant_masses STRING"
    )


def selectable_concentrations(tables: InstrumentTables, name_no: int = 2) -> DataFrame:
    """The amounts a user may choose from for each analyte group.

    They are looked up under the second name of the group only.
    """
    looked_up = [names[name_no - 1] for _, names, _, _ in ANALYTES]
    found = (
        tables.peaktable.filter(F.col("analyte").isin(looked_up))
        .select("analyte", "concentration_pg")
        .distinct()
    )
    catalogue = analyte_catalogue(tables.peaktable.sparkSession).filter(F.col("name_no") == name_no)
    return (
        found.join(F.broadcast(catalogue), "analyte")
        .select("analyte_group", "analyte", "analyte_id", "quant_masses", "concentration_pg")
        .orderBy(*ascending(["analyte_group", "concentration_pg"]))
    )


def detection_limit_series(
    tables: InstrumentTables, instruments: Sequence[str] | None = None, **options
) -> DataFrame:
    """Instrument detection limit against detector offset, per instrument."""
    limits = sensitivity(tables, ordered=False, **options)
    return (
        _labelled(limits, instruments)
        .select("inst", "series", F.col("offset_volts").alias("x"), F.col("idl").alias("y"))
        .orderBy(*ascending(["inst", "x", "y"]))
    )


def optimized_voltage_change_series(
    tables: InstrumentTables, prefix: str = ALKANE_PREFIX, instruments: Sequence[str] | None = None
) -> DataFrame:
    """Optimized voltage at the end minus at the start, against offset.

    One point per data set whose id starts with ``prefix``.
    """
    report = gain_optimization_start_end(tables, prefix, ordered=False)
    change = F.col("ending_go_dv") - F.col("starting_go_dv")
    return (
        _labelled(report, instruments)
        .select("inst", "series", F.col("offset_volts").alias("x"), change.alias("y"))
        .orderBy(*ascending(["inst", "x", "y"]))
    )


def export_report(df: DataFrame, path: str, order: Sequence[str] | None = None) -> None:
    """A report as CSV, with a leading row index when ``order`` is given."""
    write_csv(df, path, index_order=order)


def _labelled(df: DataFrame, instruments: Sequence[str] | None) -> DataFrame:
    """Rows of the instruments asked for (all if none are named) with their legend as ``series``."""
    if instruments is not None:
        df = df.filter(F.col("inst").isin(list(instruments)))
    return df.withColumn("series", F.coalesce(_lookup(LEGENDS, F.col("inst")), F.col("inst")))


def _lookup(values: dict[str, str], key):
    result = F.lit(None).cast("string")
    for k, v in values.items():
        result = F.when(key == k, v).otherwise(result)
    return result
