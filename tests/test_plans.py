"""Physical plans: what reaches the scan, what is shuffled, what never appears."""

import re
from dataclasses import replace

import pytest

from tests.fixtures import dataset, make_tables, method, peak, sample
from voltdrift.driver.mapping import instrument_tables
from voltdrift.driver.queries import QUERIES
from voltdrift.plans import derived, reports
from voltdrift.sources import tables as warehouse
from voltdrift.sources.tables import InstrumentTables

SF_DIR = "/root/testdata/sf0.001"
LAZY = [name for name in QUERIES if name[0] in "rd" and name != "d5_curve_labels" and not name.startswith("d8")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    warehouse.bootstrap(spark, root)
    t = make_tables(
        spark, ms_method=[method()], dataset=[dataset("OFN1")], sample=[sample(1, "OFN1")],
        peaktable=[peak(1, area=10)],
    )
    loaded = {name: getattr(t, name) for name in ("ms_method", "dataset", "sample", "peaktable")}
    report = spark.createDataFrame([(0,) * len(warehouse.LOADS)], warehouse.LOADS)
    warehouse.append_load(root, "a", loaded, report)
    return InstrumentTables.from_warehouse(spark, root)


def test_filters_and_columns_reach_the_fact_scan(stored):
    text = formatted(reports.analyte_replicate_stats(stored, ["OFN", "Perfluoronaphthalene"], 0.02))
    scan = next(s for s in re.split(r"\n\(\d+\) ", text) if "peaktable" in s and "PushedFilters" in s)
    assert "In(analyte, [OFN,Perfluoronaphthalene])" in scan
    assert "EqualTo(concentration_pg,0.02)" in scan
    columns = re.search(r"ReadSchema: struct<(.*?)>", scan).group(1)
    names = {c.split(":")[0] for c in columns.split(",")}
    assert names == {
        "analyte", "dataprocessingtype", "area", "height", "similairity", "quant_sn",
        "concentration_pg", "sample_id",
    }
    assert re.search(r"PartitionFilters: \[.*dynamicpruning", scan)


def test_prefix_filters_reach_the_sample_scan(stored):
    text = formatted(reports.detector_measurement_means(stored))
    assert "StringStartsWith(dataset_id,Alk)" in text
    assert "EqualTo(sampletype,Detector Measurement)" in text
    assert "StringStartsWith(samplename,Alk)" in formatted(reports.injection_replicates(stored))


def test_first_two_are_taken_before_the_shuffle(stored):
    text = plan(reports.gain_optimization_start_end(stored))
    final, partial = text.index("Final"), text.index("Partial")
    assert final < text.index("Exchange hashpartitioning(dataset_id", final) < partial


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_cartesian_no_single_task_window(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for node in ("Python", "ArrowEval", "MapInPandas", "CartesianProduct", "BroadcastNestedLoop"):
        assert node not in text
    assert "Exchange SinglePartition" not in text


def test_statistics_take_one_shuffle_after_the_joins(stored):
    text = plan(reports.analyte_replicate_stats(stored, ["OFN"], 0.02))
    assert text.count("Exchange hashpartitioning(inst") == 1
    assert text.index("HashAggregate") < text.index("partial_stddev_samp")


@pytest.fixture
def small_limits(spark):
    """Limits at which a few thousand rows count as a large skewed table."""
    settings = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, setting in settings.items():
        spark.conf.set(key, setting)
    yield
    for key, setting in before.items():
        spark.conf.set(key, setting) if setting else spark.conf.unset(key)


def test_joins_of_a_crowded_data_set_are_split(spark, small_limits, tmp_path):
    """A third of all peaks in one sample and data set, no table small enough to broadcast."""
    key = "if(id % 3 = 0, 0, 1 + pmod(hash(id), 400))"
    peaks = spark.range(0, 60_000, 1, 8).selectExpr(
        "id AS peaktable_id", "'OFN' AS analyte", "'Target' AS dataprocessingtype",
        "xxhash64(id) % 100000 AS area", "xxhash64(id, 1) % 100000 AS height",
        "smallint(1) AS similairity", "int(id) AS quant_sn", "float(0.02) AS concentration_pg",
        f"bigint({key}) AS sample_id",
    )
    samples = spark.range(0, 401).selectExpr(
        "id AS sample_id", "timestamp_ntz'2018-01-15 08:00:00' AS datetimestamp",
        "'Sample' AS sampletype", "'s' AS samplename", "bigint(NULL) AS ionstats_id",
        "concat('OFN', id) AS dataset_id",
    )
    datasets = spark.range(0, 401).selectExpr(
        "concat('OFN', id) AS dataset_id", "'PV1' AS instrument", "1L AS idl_id",
        "string(NULL) AS gc_method_id", "'m0' AS ms_method_id", "bigint(NULL) AS dr_id",
    )
    stored = {}
    for name, df in (("peaktable", peaks), ("sample", samples), ("dataset", datasets)):
        df.write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    t = replace(make_tables(spark, ms_method=[method()], idl=[(1, 0.5, 0.02)]), **stored)

    def joins(df):
        df.collect()
        final = plan(df).split("== Initial Plan ==")[0]
        return re.findall(r"SortMergeJoin(\(skew=true\))? \[(\w+)#", final)

    statistics = dict((column, skew) for skew, column in joins(reports.ofn_replicate_stats(t, 0.02)))
    assert statistics["sample_id"]
    # here the data sets meet one row each
    sensitivity = dict((column, skew) for skew, column in joins(reports.sensitivity(t)))
    assert sensitivity["sample_id"] and not sensitivity["dataset_id"]
    assert reports.ofn_replicate_stats(t, 0.02).count() == 1


def test_reports_run_nothing_while_being_built(spark):
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    context.setJobGroup("building", "")
    for name in LAZY:
        QUERIES[name](spark, SF_DIR)
    assert not tracker.getJobIdsForGroup("building")
    context.setLocalProperty("spark.jobGroup.id", None)


def no_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    return lambda: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_peaks_are_shuffled_once_before_the_aggregate(spark):
    t = instrument_tables(spark, SF_DIR)
    restore = no_broadcasts(spark)
    try:
        text = plan(reports.analyte_replicate_stats(t, ["OFN"], 0.05, ordered=False))
        series = plan(derived.metric_series(t, ["OFN"], 0.05))
    finally:
        restore()
    lines = text.split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-*("))
    scan = next(i for i, line in enumerate(lines) if "lineitem.parquet" in line)
    above, level = [], depth(lines[scan])
    for line in reversed(lines[:scan]):
        if depth(line) < level:
            above.append(line)
            level = depth(line)
    first = next(i for i, line in enumerate(above) if "HashAggregate" in line)
    assert sum("Exchange hashpartitioning" in line for line in above[:first]) == 1
    assert series.count("Exchange rangepartitioning") == 1


def test_summary_ranks_no_more_than_the_start(spark):
    text = plan(reports.measurement_and_optimization_summary(instrument_tables(spark, SF_DIR)))
    assert text.count("Window [") == text.count("WindowGroupLimit") // 2 > 0


def test_data_set_rows_need_no_sort_aggregate(spark):
    assert "SortAggregate" not in plan(QUERIES["i4_dataset_row"](spark, SF_DIR))


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize(
    "name, orders", [("r5_dm_bucket_mean", 2), ("r6_injection_reps", 1), ("d1_drift_curve", 3)]
)  # of which one for ion statistics in r5 and d1: the driver's tables have them in orders too
def test_scans_of_ranks_and_totals_read_their_input_once(spark, name, orders):
    text = final_plan(QUERIES[name](spark, SF_DIR))
    assert len(re.findall(r"FileScan parquet \[.*?orders.parquet", text)) == orders
    assert text.count("FileScan parquet") <= orders + 2  # data sets and methods, once each
    assert "ReusedExchange" in text
