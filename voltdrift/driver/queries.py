"""One query per report, derived output and load step, on the driver's tables.

Averages that depend on summation order are rounded here, as in the SQL.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltdrift.driver import mapping
from voltdrift.driver.mapping import (
    ANALYTE,
    MEASURED,
    SAMPLE_NAME,
    SAMPLE_TYPE,
    VOLTAGE,
    instrument_tables,
    read,
    set_id,
)
from voltdrift.operators.integrity import already_present, missing_parents
from voltdrift.plans import derived, ingest, reports
from voltdrift.session import materialize, release, remove_folder
from voltdrift.sources import tables as warehouse
from voltdrift.sources.csv_frames import read_export, read_frame
from voltdrift.sources.schema import FOREIGN_KEYS, TABLES
from voltdrift.sources.sinks import read_csv, write_csv

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

_local_folders: dict[str, str] = {}

OFN_PG = 0.05
TETRADECANE_PG = 0.05  # the driver's amounts end at 0.10


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


def scratch(spark: SparkSession) -> str:
    """A new folder for a query that writes and reads back.

    It lies under ``spark.checkpoint.dir``, or the context's checkpoint folder
    where only that is set. A local session without either gets a temporary
    folder that goes with the process; a cluster must name one.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        app = context.applicationId
        if app not in _local_folders:
            folder = tempfile.mkdtemp(prefix="voltdrift-")
            _local_folders[app] = folder
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        base = _local_folders[app]
    return f"{base.rstrip('/')}/{context.applicationId}/{uuid.uuid4().hex}"


def exported(spark: SparkSession, frames: dict[str, DataFrame]) -> str:
    """A new folder with the frames as compressed CSV, one subfolder each; whoever has read them removes it."""
    export = scratch(spark)
    for frame, df in frames.items():
        write_csv(df, f"{export}/{frame}", compression="gzip")
        release(spark)
    return export


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query
def r1_unique_concentrations(spark, sf_dir):
    return reports.unique_concentrations(instrument_tables(spark, sf_dir), "OFN")


@query
def r2_replicate_stats(spark, sf_dir):
    tables = instrument_tables(spark, sf_dir)
    return reports.analyte_replicate_stats(tables, ["OFN", "Perfluoronaphthalene"], OFN_PG)


@query
def r3_ofn_stats(spark, sf_dir):
    return reports.ofn_replicate_stats(instrument_tables(spark, sf_dir), 0.02)


@query
def r4_tetradecane_stats(spark, sf_dir):
    return reports.tetradecane_replicate_stats(instrument_tables(spark, sf_dir), TETRADECANE_PG)


def _states(tables):
    """Peak states as five loads would keep them, put together."""
    loads = [reports.peak_states(tables.peaktable.filter(F.col("sample_id") % 5 == n), tables.sample) for n in range(5)]
    return reduce(DataFrame.unionByName, loads)


@query
def a12_r2_of_states(spark, sf_dir):
    tables = instrument_tables(spark, sf_dir)
    return reports.analyte_stats_of_states(_states(tables), tables, ["OFN", "Perfluoronaphthalene"], OFN_PG)


@query
def a12_r4_of_states(spark, sf_dir):
    tables = instrument_tables(spark, sf_dir)
    return reports.analyte_stats_of_states(_states(tables), tables, reports.TETRADECANE_NAMES, TETRADECANE_PG)


@query
def a12_r9_of_states(spark, sf_dir):
    tables = instrument_tables(spark, sf_dir)
    return _sensitivity_rounded(reports.sensitivity_of_states(_states(tables), tables))


@query
def a12_r1_of_states(spark, sf_dir):
    return reports.unique_concentrations_of_states(_states(instrument_tables(spark, sf_dir)), "OFN")


@query
def r5_dm_bucket_mean(spark, sf_dir):
    report = reports.detector_measurement_means(instrument_tables(spark, sf_dir))
    return rounded(report, 4, "ave_api")


@query
def r6_injection_reps(spark, sf_dir):
    return reports.injection_replicates(instrument_tables(spark, sf_dir))


@query
def r7_go_start_end(spark, sf_dir):
    return reports.gain_optimization_start_end(instrument_tables(spark, sf_dir))


@query
def r8_dm_go_summary(spark, sf_dir):
    report = reports.measurement_and_optimization_summary(instrument_tables(spark, sf_dir))
    return rounded(report, 1, "ave_start_dm_api", "ave_end_dm_api")


@query
def r9_sensitivity(spark, sf_dir):
    return _sensitivity_rounded(reports.sensitivity(instrument_tables(spark, sf_dir)))


def _sensitivity_rounded(report: DataFrame) -> DataFrame:
    return rounded(
        report, 4, "ave_area", "stddev_area", "ave_quant_sn", "stddev_quant_sn",
        "ave_similarity", "stddev_similarity",
    )


@query
def r10_linearity(spark, sf_dir):
    return reports.linearity(instrument_tables(spark, sf_dir))


@query
def d1_drift_curve(spark, sf_dir):
    return rounded(derived.drift_curve(instrument_tables(spark, sf_dir)), 4, "ave_api")


@query
def d2_metric_series(spark, sf_dir):
    return derived.metric_series(instrument_tables(spark, sf_dir), reports.OFN_NAMES, OFN_PG)


@query
def d3_metric_series_preset(spark, sf_dir):
    return derived.tetradecane_metric_series(instrument_tables(spark, sf_dir), TETRADECANE_PG)


@query
def d4_analyte_catalogue(spark, sf_dir):
    return derived.selectable_concentrations(instrument_tables(spark, sf_dir))


@query
def d5_curve_labels(spark, sf_dir):
    curve = derived.drift_curve(instrument_tables(spark, sf_dir), ordered=False)
    return rounded(derived.drift_curve_series(materialize(curve, scratch(spark))), 4, "y")


@query
def d6_idl_vs_offset(spark, sf_dir):
    return rounded(derived.detection_limit_series(instrument_tables(spark, sf_dir)), 8, "y")


@query
def d7_go_delta(spark, sf_dir):
    return derived.optimized_voltage_change_series(instrument_tables(spark, sf_dir))


@query
def d8_report_export(spark, sf_dir):
    report = reports.gain_optimization_start_end(instrument_tables(spark, sf_dir), ordered=False)
    return _exported(report, ["inst", "offset_volts", "setname"])


@query
def d8_ostat(spark, sf_dir):
    report = reports.measurement_and_optimization_summary(
        instrument_tables(spark, sf_dir), ordered=False, with_set=True
    )
    exported = _exported(report, ["offset_volts", "inst", "setname", "dm_dv"])
    return rounded(exported, 1, "ave_start_dm_api", "ave_end_dm_api")


@query
def d8_olin(spark, sf_dir):
    report = reports.linearity(instrument_tables(spark, sf_dir), with_set=True)
    return _exported(report, ["inst", "offset_volts", "setname"])


@query
def d8_osen(spark, sf_dir):
    report = reports.sensitivity(instrument_tables(spark, sf_dir), ordered=False, with_set=True)
    return _sensitivity_rounded(_exported(report, ["offset_volts", "inst", "setname"]))


def _exported(report: DataFrame, order: list[str]) -> DataFrame:
    """A report as it reads back from its CSV export."""
    path = scratch(report.sparkSession)
    derived.export_report(report, path, order)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in report.schema)
    return read_csv(report.sparkSession, path, f"row_index bigint, {types}")


@query
def k1_csv_roundtrip(spark, sf_dir):
    root = scratch(spark)
    write_csv(mapping.export_frames(spark, sf_dir)["Sample"], f"{root}/Sample")
    frame = read_frame(spark, root, "Sample", layout="by_frame")
    return frame.drop("dataset", "_file", "_block", "_line")


@query
def k1_all_frames(spark, sf_dir):
    """All six frames as CSV and back, with line breaks and quotes in cells: rows, bad rows and a checksum of each."""
    root = scratch(spark)
    for frame, df in mapping.export_frames(spark, sf_dir).items():
        if frame == "Sample":
            broken = F.concat(F.lit('Done,\nand "checked"\n'), F.col("index"))
            df = df.withColumn("Status", F.when(F.col("index") % 10 == 0, broken).otherwise(F.col("Status")))
        write_csv(df, f"{root}/{frame}")
    frames = read_export(spark, root, layout="by_frame", multi_line=True)
    content = {
        "sample": "length(status) + length(samplename) + length(gc_method_id)",
        "peaktable": "area + height + similairity + peak_sn + quant_sn",
        "idl": "round(double(idl_value) * 1000000)",
        "gc": "splitratio + length(gc_method_id)",
        "ms": "detectoroffset_volts + massrange_top",
        "dr": "round(double(ordersofmagnitude) * 1000)",
    }
    found = [
        getattr(frames, name).agg(
            F.lit(name).alias("frame"), F.count(F.lit(1)).alias("n_rows"), F.count_if("_bad").alias("n_bad"),
            F.sum(F.expr(f"bigint({value})")).alias("checksum"),
        )
        for name, value in content.items()
    ]
    return reduce(DataFrame.union, found)


@query
def k4_append_roundtrip(spark, sf_dir):
    root = scratch(spark)
    warehouse.bootstrap(spark, root)
    samples = mapping.samples(spark, sf_dir)
    measured = F.col("sampletype") != "Sample"
    for load, part in (("measured", samples.filter(measured)), ("other", samples.filter(~measured))):
        warehouse.append_load(root, load, {"sample": part}, _empty_report(spark))
    return warehouse.InstrumentTables.from_warehouse(spark, root).sample


@query
def k7_bootstrap(spark, sf_dir):
    """Create the tables, load some of them, and count all of them."""
    root = scratch(spark)
    warehouse.bootstrap(spark, root)
    mapped = instrument_tables(spark, sf_dir)
    loaded = ("ms_method", "dataset", "sample", "peaktable")
    warehouse.append_load(
        root, "some", {t: getattr(mapped, t) for t in loaded}, _empty_report(spark)
    )
    return _counted(warehouse.InstrumentTables.from_warehouse(spark, root))


@query
def k7_reset(spark, sf_dir):
    """Fill all tables, reset them, fill them again under the same name; count them each time."""
    root = scratch(spark)
    mapped = instrument_tables(spark, sf_dir)
    steps = []
    for step in ("filled", "reset", "filled again"):
        if step != "filled again":
            warehouse.bootstrap(spark, root)
        if step != "reset":
            warehouse.append_load(
                root, "all", {t: getattr(mapped, t) for t in TABLES}, _empty_report(spark)
            )
        counts = _counted(warehouse.InstrumentTables.from_warehouse(spark, root))
        # counted now, before the next step changes the tables
        steps.append(materialize(counts.select(F.lit(step).alias("step"), "*"), scratch(spark)))
    return reduce(DataFrame.union, steps)


def _counted(tables: warehouse.InstrumentTables) -> DataFrame:
    counts = [
        getattr(tables, t).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        for t in TABLES
    ]
    return reduce(DataFrame.union, counts)


@query
def i1_i2_optional_dims(spark, sf_dir):
    """IDL rows from detector measurements, dynamic ranges from suppliers."""
    customer, orders = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders")
    supplier = read(spark, sf_dir, "supplier")
    datasets = customer.selectExpr(f"{set_id('c_custkey')} AS dataset_id")
    idl = ingest.first_row_per_dataset(
        orders.filter("o_orderstatus = 'F'").selectExpr(
            f"{set_id('o_custkey')} AS dataset_id", "o_totalprice / 1000000 AS idl_value",
            "0.02D AS concentration_pg", *_position("o_orderkey"),
        ),
        ["idl_value", "concentration_pg"], "idl_id", scratch(spark),
    )
    dr = ingest.first_row_per_dataset(
        customer.filter("c_mktsegment <> 'HOUSEHOLD'")
        .join(supplier, customer.c_custkey % 10 == supplier.s_suppkey)
        .selectExpr(
            f"{set_id('c_custkey')} AS dataset_id", "s_acctbal / 1000 AS ordersofmagnitude",
            *_position("s_suppkey"),
        ),
        ["ordersofmagnitude"], "dr_id", scratch(spark),
    )
    return datasets.join(idl, "dataset_id", "left").join(dr, "dataset_id", "left")


@query
def i3_methods_insert_if_absent(spark, sf_dir):
    """Each customer brings the method of its nation; two regions' are known."""
    nation, customer = read(spark, sf_dir, "nation"), read(spark, sf_dir, "customer")
    method = [
        "n_name AS ms_method_id", "smallint(17) AS acquisitionrate",
        "smallint(50) AS massrange_bottom", "smallint(500) AS massrange_top",
        "float(30) AS extractionfrequency", "smallint(n_regionkey * 100) AS detectoroffset_volts",
    ]
    known = nation.filter("n_regionkey <= 1").selectExpr(*method)
    brought = customer.join(nation, customer.c_nationkey == nation.n_nationkey).selectExpr(
        f"{set_id('c_custkey')} AS dataset_id", *method, *_position("c_custkey")
    )
    return ingest.new_methods(brought, known, "ms_method")


@query
def i4_dataset_row(spark, sf_dir):
    samples = read(spark, sf_dir, "orders").selectExpr(
        f"{set_id('o_custkey')} AS dataset_id", "o_orderkey AS sample_id",
        "o_orderpriority AS gc_method_id", f"{SAMPLE_TYPE} AS ms_method_id",
        "decode(o_orderstatus, 'P', 'False', 'F', 'PV1', 'PV2') AS instrument",
    )
    known = instrument_tables(spark, sf_dir).dataset
    return ingest.dataset_rows(
        samples, known.filter("idl_id IS NOT NULL"), known.filter("dr_id IS NOT NULL")
    )


@query
def i5_ionstats_extract(spark, sf_dir):
    return ingest.ionstats_rows(_sample_frame(spark, sf_dir), scratch(spark)).drop("_bad")


@query
def i6_sample_load(spark, sf_dir):
    samples = ingest.number_samples(_sample_frame(spark, sf_dir).drop("sample_id"), scratch(spark))
    return ingest.sample_rows(samples, ingest.ionstats_rows(samples, scratch(spark)))


@query
def i7_peak_sample_join(spark, sf_dir):
    """Peaks by sample name, which repeats within data sets; plain injections
    are not among the samples, so peaks that only they carry drop out."""
    orders, lineitem = read(spark, sf_dir, "orders"), read(spark, sf_dir, "lineitem")
    peaks = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).selectExpr(
        f"{set_id('o_custkey')} AS dataset_id", f"{SAMPLE_NAME} AS samplename",
        f"{ANALYTE} AS analyte", "floor(l_extendedprice) AS area", "l_partkey AS quant_sn",
        "l_discount AS concentration_pg", *_position("l_orderkey"),
    )
    samples = mapping.samples(spark, sf_dir).filter(F.col("sampletype") != "Sample")
    linked = ingest.link_peaks(peaks, samples).filter(F.col("sample_id").isNotNull())
    return linked.select("sample_id", "analyte", "area", "quant_sn", "concentration_pg")


@query
def i8_duplicate_dataset(spark, sf_dir):
    tables = instrument_tables(spark, sf_dir)
    loaded = tables.dataset.filter(F.col("instrument") == "PV1")
    return already_present(tables.sample, loaded, "dataset_id")


@query
def i9_fk_violations(spark, sf_dir):
    """Foreign keys against parents of which a kind is missing."""
    tables = instrument_tables(spark, sf_dir)
    measured = tables.sample.filter(F.col("ionstats_id").isNotNull())
    edges = [
        ("sample", "ionstats_id", tables.sample,
         measured.filter(F.col("sampletype") == "Detector Measurement"), "ionstats_id"),
        ("peaktable", "sample_id", tables.peaktable, measured, "sample_id"),
        ("dataset", "dr_id", tables.dataset,
         tables.dynamicrange.filter(F.col("ordersofmagnitude") >= 5), "dr_id"),
    ]
    checks = [
        missing_parents(child, key, parent, parent_key).select(
            F.lit(name).alias("child"), F.lit(key).alias("fk"),
            F.col("fk").cast("bigint").alias("key_value"), "n_rows",
        )
        for name, key, child, parent, parent_key in edges
    ]
    return reduce(DataFrame.union, checks)


@query
def i9_all_edges(spark, sf_dir):
    """All seven foreign keys, each against its parents without those whose key is divisible by 3 (ids as numbers)."""
    tables = instrument_tables(spark, sf_dir)
    number = "bigint(regexp_extract({key}, '[0-9]+$', 0))"
    checks = []
    for child, key, parent in FOREIGN_KEYS:
        kept = getattr(tables, parent).filter(f"{number.format(key=f'string({key})')} % 3 <> 0")
        checks.append(
            missing_parents(getattr(tables, child), key, kept, key).select(
                F.lit(child).alias("child"), F.lit(key).alias("fk"),
                F.col("fk").cast("string").alias("key_value"), "n_rows",
            )
        )
    return reduce(DataFrame.union, checks)


@query
def i11_staged_load(spark, sf_dir):
    """Export, load, load once more under another name, then R2 on the result."""
    export, root = exported(spark, mapping.export_frames(spark, sf_dir)), scratch(spark)
    warehouse.bootstrap(spark, root)
    frames = read_export(spark, export, layout="by_frame")
    ingest.load_export(spark, root, frames, "first")
    ingest.load_export(spark, root, frames, "again")
    remove_folder(spark, export)
    stored = warehouse.InstrumentTables.from_warehouse(spark, root)
    return reports.ofn_replicate_stats(stored, OFN_PG)


@query
def i11_loaded_tables(spark, sf_dir):
    """The same load: each table's rows, ids and a checksum of its content."""
    export, root = exported(spark, mapping.export_frames(spark, sf_dir)), scratch(spark)
    warehouse.bootstrap(spark, root)
    ingest.load_export(spark, root, read_export(spark, export, layout="by_frame"), "first")
    remove_folder(spark, export)
    stored = warehouse.InstrumentTables.from_warehouse(spark, root)
    content = {
        "idl": ("idl_id", "round(double(idl_value) * 1000000)"),
        "gc_method": (None, "splitratio + length(gc_method_id)"),
        "ms_method": (None, "detectoroffset_volts + length(ms_method_id)"),
        "dynamicrange": ("dr_id", "round(double(ordersofmagnitude) * 1000)"),
        "dataset": (None, "coalesce(idl_id, 0) + 3 * coalesce(dr_id, 0) + length(ms_method_id)"),
        # which row has which id depends on how the files were written
        "ionstats": ("ionstats_id", "round(voltage)"),
        "sample": ("sample_id", "length(dataset_id) + 3 * length(samplename) + if(ionstats_id IS NULL, 0, 7)"),
        "peaktable": (None, "area + 3 * height + similairity + 7 * quant_sn"),
    }
    found = [
        getattr(stored, table).agg(
            F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
            *[F.expr(f"{f}({key})" if key else "bigint(NULL)").cast("bigint").alias(f"{f}_id") for f in ("min", "max")],
            F.sum(F.expr(f"bigint({value})")).alias("checksum"),
        )
        for table, (key, value) in content.items()
    ]
    return reduce(DataFrame.union, found)


@query
def i11_quarantine(spark, sf_dir):
    """An export with damaged cells and peaks without a sample, loaded all the same: each cell that did not fit, as written."""
    export, root = exported(spark, mapping.damaged_frames(spark, sf_dir)), scratch(spark)
    warehouse.bootstrap(spark, root)
    ingest.load_export(spark, root, read_export(spark, export, layout="by_frame"), "damaged", strict=False)
    remove_folder(spark, export)
    kept = warehouse.read_quarantine(spark, root).select("frame", "dataset_id", "cells", F.explode("problems").alias("header"))
    return kept.select(
        "frame", "dataset_id", "header",
        F.coalesce(F.element_at("cells", F.lit("Sample")), F.element_at("cells", F.lit("Name"))).alias("named"),
        F.element_at("cells", F.col("header")).alias("text"),
    )


def _position(line: str) -> list[str]:
    return ["'' AS _file", "0L AS _block", f"{line} AS _line"]


def _sample_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as rows of a Sample frame; blank cells where nothing was measured."""
    return read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS sample_id", f"{set_id('o_custkey')} AS dataset_id",
        "o_orderdate AS datetimestamp", f"{SAMPLE_TYPE} AS sampletype",
        f"{SAMPLE_NAME} AS samplename",
        f"if({MEASURED}, string({VOLTAGE}), '') AS detectorvoltage",
        f"if({MEASURED}, string(o_totalprice), '') AS areaperion", *_position("o_orderkey"),
    )


def _empty_report(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(0,) * len(warehouse.LOADS)], warehouse.LOADS)
