"""Derived outputs on hand-made tables."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.fixtures import dataset, make_tables, method, peak, rows, sample
from voltdrift.plans import derived, reports
from voltdrift.sources.sinks import read_csv

DM, GO = "Detector Measurement", "Gain Optimization"
OFFSETS = (0, 150, 250, 350)
# Published detection limits and voltage changes by offset.
LIMITS = {
    "PV1": (0.036614, 0.009674, 0.0056418, 0.004696),
    "PV2": (0.0083151, 0.0044855, 0.0046082, 0.0033099),
}
VOLTAGE_CHANGES = {"PV1": (-7.7, 26.5, 42.8, 66.1), "PV2": (-8, 4.1, 13.5, 48.4)}


def drift_tables(spark):
    """Alk1: a measurement, two injections of 1 pg, a measurement, one of 2.5 pg,
    a measurement, and two more without injections of their own."""
    plan = [
        (DM, "dm"), ("Sample", "Alk-1pg:1"), ("Sample", "Alk-1pg:2"), (DM, "dm"),
        ("Sample", "Alk-2.5pg"), (DM, "dm"), (DM, "dm"),
    ]
    samples, ions = [], []
    for i, (kind, name) in enumerate(plan, start=1):
        samples.append(sample(i, "Alk1", i, kind, name, i if kind == DM else None))
        if kind == DM:
            ions.append((i, 1500.0, 10.0 * i))
    samples += [sample(100, "Alk2", 0, DM, "dm", 100), sample(101, "Alk2", 1, name="Alk-1pg")]
    ions.append((100, 1450.0, 3.0))
    return make_tables(
        spark, ms_method=[method(offset=150)], dataset=[dataset("Alk1"), dataset("Alk2", "PV2")],
        sample=samples, ionstats=ions,
    )


@pytest.fixture
def curve(spark):
    return derived.drift_curve(drift_tables(spark), bucket_size=1)


def test_drift_curve(curve):
    assert rows(curve) == [
        ("Alk1", "PV1", 150, 0, None, 0.0, 0, 1500.0, 10.0),
        ("Alk1", "PV1", 150, 1, "Alk-1pg", 1.0, 2, 1500.0, 40.0),
        ("Alk1", "PV1", 150, 2, "Alk-2.5pg", 2.5, 3, 1500.0, 60.0),
        # past the last name, the last total holds
        ("Alk1", "PV1", 150, 3, None, 0.0, 3, 1500.0, 70.0),
        ("Alk2", "PV2", 150, 0, None, 0.0, 0, 1450.0, 3.0),
    ]


def test_curve_labels(curve):
    series = rows(derived.drift_curve_series(curve), "dataset", "curve_label", "x", "y")
    assert sorted(series, key=repr) == [
        ("Alk1", "Offset: +150 v = 1500.0 v", 0, 10.0),
        ("Alk1", "Offset: +150 v = 1500.0 v", 2, 40.0),
        ("Alk1", "Offset: +150 v = 1500.0 v", 3, 60.0),
        ("Alk1", "Offset: +150 v = 1500.0 v", 3, 70.0),
        ("Alk2", None, 0, 3.0),
    ]
    labels = {r[0] for r in rows(derived.drift_curve_series(curve, True), "curve_label")}
    assert labels == {"Inst: PV1 - Offset: +150 v = 1500.0 v", None}


def test_last_cumulative_count_is_the_number_of_injections(spark):
    from voltdrift.operators.sequence import with_running_total
    from voltdrift.plans.reports import injection_replicates

    reps = injection_replicates(drift_tables(spark))
    total = with_running_total(reps, "setname", ["seq", "s_name"], "reps", "cum", "pos", F.col("seq"))
    last = total.groupBy("setname").agg({"cum": "max"}).orderBy("setname")
    assert rows(last) == [("Alk1", 3), ("Alk2", 1)]


def test_curve_by_time_loses_no_injection(spark):
    tables = drift_tables(spark)
    found = derived.drift_curve(tables, bucket_size=1, pairing="time")
    assert rows(found, "dataset", "dm_api_group", "sample", "conc_pg", "cumulative_inj", "ave_api") == [
        ("Alk1", 0, None, 0.0, 0, 10.0), ("Alk1", 1, "Alk-1pg", 1.0, 2, 40.0),
        ("Alk1", 2, "Alk-2.5pg", 2.5, 3, 60.0), ("Alk1", 3, "Alk-2.5pg", 2.5, 3, 70.0),
        ("Alk2", 0, None, 0.0, 0, 3.0),
    ]
    with pytest.raises(ValueError):
        derived.drift_curve(tables, pairing="name")


def test_totals_of_a_crowded_data_set_are_spread(spark, monkeypatch):
    """40,000 names in one data set, in one to three injections each, and a few in others."""
    monkeypatch.setattr(derived, "SPAN", 2_000)
    samples = spark.sql(
        """SELECT id AS sample_id, timestamp_ntz'2018-01-15 08:00:00' + make_interval(0, 0, 0, 0, 0, id) AS datetimestamp,
            'Sample' AS sampletype, concat('Alk-', id DIV (1 + id DIV 100 % 3), 'pg') AS samplename,
            bigint(NULL) AS ionstats_id, if(id % 5 > 0, 'Alk1', concat('Alk', id % 100)) AS dataset_id
        FROM range(60000)"""
    )
    t = replace(make_tables(spark), sample=samples)
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, setting in settings.items():
        spark.conf.set(key, setting)
    try:
        found = derived._injected_by_position(t, "Alk")
        per_task = found.withColumn("task", F.spark_partition_id()).groupBy("dataset_id", "task").count()
        hot = [n for name, _, n in rows(per_task) if name == "Alk1"]
        assert max(hot) < sum(hot) / 8
        plain = reports.replicate_counts(t, "Alk").selectExpr(
            "dataset_id", "row_number() OVER (PARTITION BY dataset_id ORDER BY seq, s_name) AS dm_api_group",
            "s_name AS sample", "sum(reps) OVER (PARTITION BY dataset_id ORDER BY seq, s_name) AS cumulative_inj",
        )
        assert found.exceptAll(plain).isEmpty() and found.count() == plain.count()
    finally:
        for key, setting in before.items():
            spark.conf.set(key, setting)


def test_metric_series_fills_and_labels(spark):
    t = make_tables(
        spark, ms_method=[method()], dataset=[dataset("A", "PV1"), dataset("B", "PV9")],
        sample=[sample(1, "A"), sample(2, "B")],
        peaktable=[peak(1, area=10, height=20, quant_sn=30), peak(2, area=1)],
    )
    mass = "Quant Mass = 271.99"
    found = rows(derived.metric_series(t, ["OFN"], 0.02))
    assert [r for r in found if r[0] == "PV1"] == [
        ("PV1", "Peg BT - PV1", 0, "ave_area", "Average Area", mass, "Target", 10.0),
        ("PV1", "Peg BT - PV1", 0, "ave_height", "Average Height", mass, "Target", 20.0),
        ("PV1", "Peg BT - PV1", 0, "ave_quant_sn", "Average Quant S/N", mass, "Target", 30.0),
        ("PV1", "Peg BT - PV1", 0, "ave_similarity", "Average Similarity", mass, "Unknown", 0.0),
    ]
    # an instrument without a legend goes by its name
    assert ("PV9", "PV9", 0, "ave_area", "Average Area", mass, "Target", 1.0) in found
    only = derived.metric_series(t, ["OFN"], 0.02, instruments=["PV9"])
    assert {r[0] for r in rows(only, "inst")} == {"PV9"} and only.count() == 4


def test_all_groups_are_selectable(spark):
    names = ["OFN", "Tetradecane (C14)", "Eicosane (C20)", "Triacontane (C30)"]
    t = make_tables(spark, peaktable=[peak(i, n, pg=i / 4) for i, n in enumerate(names)])
    found = rows(derived.selectable_concentrations(t), "analyte_group", "concentration_pg")
    assert found == [("C14", 0.25), ("C20", 0.5), ("C30", 0.75), ("OFN", 0.0)]


def test_selectable_concentrations_use_the_second_name(spark):
    t = make_tables(
        spark,
        peaktable=[
            peak(1, "OFN", pg=0.5), peak(1, "OFN", pg=0.5), peak(1, "Perfluoronaphthalene", pg=9.0),
            peak(1, "Triacontane (C30)", pg=0.25), peak(1, "Eicosane", pg=0.25),
        ],
    )
    found = rows(derived.selectable_concentrations(t), "analyte_group", "concentration_pg")
    assert found == [("C30", 0.25), ("OFN", 0.5)]
    assert derived.analyte_catalogue(spark).count() == 8
    assert derived.export_prefix("OFN", 0.02) == "OFN_0.02pg"
    assert derived.export_prefix("OFN", 0.019999999552965164) == "OFN_0.02pg"
    assert derived.export_prefix("OFN", "0.5") == "OFN_0.5pg" and derived.export_prefix("OFN", 5) == "OFN_5pg"


def campaign(spark):
    """One OFN and one alkane data set per instrument and offset."""
    idl, methods, datasets, samples, peaks, ions = [], [], [], [], [], []
    for inst, limits in LIMITS.items():
        for n, offset in enumerate(OFFSETS):
            i = len(idl) + 1
            idl.append((i, limits[n], 0.02))
            methods.append(method(f"{inst} +{offset}", offset))
            datasets.append(dataset(f"OFN{i}", inst, f"{inst} +{offset}", i))
            datasets.append(dataset(f"Alk{i}", inst, f"{inst} +{offset}"))
            samples.append(sample(i, f"OFN{i}"))
            peaks.append(peak(i, area=10))
            for k, volts in ((100, 1500.0), (200, 1500.0 + VOLTAGE_CHANGES[inst][n])):
                samples.append(sample(k + i, f"Alk{i}", k, GO, "go", k + i))
                ions.append((k + i, volts, 1.0))
    return make_tables(
        spark, idl=idl, ms_method=methods, dataset=datasets, sample=samples, ionstats=ions,
        peaktable=peaks,
    )


def series_of(df, digits):
    return {
        inst: tuple(round(y, digits) for i, _, y in rows(df, "inst", "x", "y") if i == inst)
        for inst in ("PV1", "PV2")
    }


def test_detection_limits_and_voltage_changes_of_the_campaign(spark):
    t = campaign(spark)
    limits = derived.detection_limit_series(t)
    assert [r[0] for r in rows(limits, "x")] == [*OFFSETS, *OFFSETS]
    assert series_of(limits, 7) == LIMITS
    assert series_of(derived.optimized_voltage_change_series(t), 1) == VOLTAGE_CHANGES


def test_export_with_row_index(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ('a,"q"', 1), (None, 3), ("é", 4)], "name string, n int")
    path = str(tmp_path / "report")
    derived.export_report(df, path, ["n"])
    back = read_csv(spark, path, "row_index bigint, name string, n int")
    assert sorted(rows(back)) == [(0, 'a,"q"', 1), (1, "b", 2), (2, None, 3), (3, "é", 4)]
    assert [f.name for f in tmp_path.iterdir()] == ["report"]
    mine = tmp_path / "other_index"
    mine.mkdir()
    (mine / "notes.txt").write_text("kept")
    derived.export_report(df, str(tmp_path / "other"), ["n"])
    assert (mine / "notes.txt").read_text() == "kept"
    plain = str(tmp_path / "plain")
    derived.export_report(df, plain)
    assert read_csv(spark, plain, "name string, n int").columns == ["name", "n"]


def test_tabulated_statistics(spark, tmp_path):
    t = make_tables(
        spark, ms_method=[method("m0", 150), method("m1", 0)],
        dataset=[dataset("A"), dataset("B", ms="m1")], sample=[sample(1, "A"), sample(2, "B")],
        peaktable=[peak(1, "Eicosane (C20)", area=10), peak(2, "Eicosane", area=30)],
    )
    stats = derived.tabulated_statistics(t, "C20", 0.02, str(tmp_path))
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stats.schema)
    path = str(tmp_path / "Eicosane_0.02pg_TabulatedResults")
    back = read_csv(spark, path, f"row_index bigint, {types}")
    columns = ("row_index", "inst", "det_offset", "ave_area", "stddev_area")
    assert sorted(rows(back, *columns)) == [(0, "PV1", 0, 30.0, 0.0), (1, "PV1", 150, 10.0, 0.0)]
