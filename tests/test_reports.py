"""Reports on hand-made tables: the corners the driver's tables do not reach."""

import random
import struct

import pytest

from tests.fixtures import dataset, make_tables, method, peak, rows, sample
from voltdrift.operators.replicates import Measure, merged_stats, moment_states, replicate_stats
from voltdrift.plans import derived, reports

DM, GO = "Detector Measurement", "Gain Optimization"


def float4(x):
    return struct.unpack("f", struct.pack("f", x))[0]


@pytest.mark.parametrize("pg", [0.02, 0.1, 0.5, "0.02"])
def test_concentration_is_compared_as_float4(spark, pg):
    t = make_tables(
        spark, ms_method=[method()], dataset=[dataset("OFN1")], sample=[sample(1, "OFN1")],
        peaktable=[peak(1, pg=float(pg), area=10), peak(1, pg=0.3, area=99)],
    )
    assert rows(reports.ofn_replicate_stats(t, pg), "ave_area") == [(10.0,)]


def test_concentration_read_from_a_table_selects_its_rows(spark):
    t = make_tables(
        spark, ms_method=[method()], dataset=[dataset("OFN1")], sample=[sample(1, "OFN1")],
        peaktable=[peak(1, pg=0.1, area=10)],
    )
    [(pg,)] = rows(reports.unique_concentrations(t, "OFN"))
    assert pg == float4(0.1)
    assert rows(reports.ofn_replicate_stats(t, pg), "ave_area") == [(10.0,)]


def test_unique_concentrations_sorted_and_distinct(spark):
    t = make_tables(
        spark,
        peaktable=[peak(1, pg=p) for p in (0.5, 0.02, 0.5, None)] + [peak(1, "Eicosane", pg=9.0)],
    )
    found = [r[0] for r in rows(reports.unique_concentrations(t, "OFN"))]
    assert found == [float4(0.02), 0.5, None]


def test_replicates_masks_and_missing_deviation(spark):
    t = make_tables(
        spark,
        ms_method=[method("m0", 0), method("m1", 150)],
        dataset=[dataset("OFN1", "PV1", "m0"), dataset("OFN2", "PV2", "m1")],
        sample=[sample(1, "OFN1"), sample(2, "OFN2")],
        peaktable=[
            peak(1, "OFN", "Target", area=100, height=0, quant_sn=10, similairity=500),
            peak(1, "Perfluoronaphthalene", "Target", area=300, height=0, quant_sn=20),
            peak(1, "OFN", "Unknown", area=9999, height=9999, quant_sn=9999, similairity=800),
            peak(1, "OFN", None, area=200, height=0, quant_sn=30, similairity=600),
            peak(1, "Tetradecane", area=7),
            # one replicate, and every similarity masked
            peak(2, "OFN", "Target", area=50, height=5, quant_sn=5, similairity=700),
        ],
    )
    first, second = reports.ofn_replicate_stats(t, 0.02).collect()
    assert (first.inst, first.det_offset) == ("PV1", 0)
    assert (first.ave_area, first.stddev_area, first.rsd_area) == (200.0, 100.0, 50.0)
    # zero mean: no %RSD instead of an error
    assert (first.ave_height, first.stddev_height, first.rsd_height) == (0.0, 0.0, None)
    assert (first.ave_quant_sn, first.stddev_quant_sn) == (20.0, 10.0)
    assert (first.ave_similarity, first.stddev_similarity) == (700.0, 141.4)
    assert (second.inst, second.det_offset, second.ave_area) == ("PV2", 150, 50.0)
    assert (second.stddev_area, second.rsd_area) == (None, None)
    assert (second.ave_similarity, second.rsd_similarity) == (None, None)
    filled = derived.zero_filled(reports.ofn_replicate_stats(t, 0.02)).collect()[1]
    assert (filled.stddev_area, filled.ave_similarity) == (0.0, 0.0)


def test_one_analyte_name_is_enough(spark):
    t = make_tables(
        spark, ms_method=[method()], dataset=[dataset("A")], sample=[sample(1, "A")],
        peaktable=[peak(1, "Eicosane", pg=5.0, area=3)],
    )
    assert rows(reports.analyte_replicate_stats(t, ["Eicosane"], 5), "ave_area") == [(3.0,)]


def test_presets_use_their_analytes(spark):
    t = make_tables(
        spark, ms_method=[method()], dataset=[dataset("A")], sample=[sample(1, "A")],
        peaktable=[
            peak(1, "Tetradecane", pg=0.5, area=1), peak(1, "Tetradecane (C14)", pg=0.5, area=3),
            peak(1, "OFN", pg=0.5, area=100),
        ],
    )
    assert rows(reports.tetradecane_replicate_stats(t), "ave_area") == [(2.0,)]
    assert rows(reports.ofn_replicate_stats(t, 0.5), "ave_area") == [(100.0,)]


def measurements(kind, dataset_id, values, first_id=1, start=0):
    """(sample, ionstats) rows of one type: values are (voltage, area per ion)."""
    ids = range(first_id, first_id + len(values))
    return (
        [sample(i, dataset_id, start + i, kind, f"{kind} {i}", i) for i in ids],
        [(i, v, a) for i, (v, a) in zip(ids, values)],
    )


def test_buckets_of_three(spark):
    samples, ions = measurements(
        DM, "Alk1", [(1500.0, 1.0), (1500.0, 2.0), (1550.0, 6.0), (1550.0, 8.0)]
    )
    other, other_ions = measurements(DM, "OFN1", [(1400.0, 5.0)], first_id=10)
    t = make_tables(
        spark, dataset=[dataset("Alk1"), dataset("OFN1")],
        sample=samples + other + [sample(20, "Alk1", 2, GO, "go", 1), sample(21, "Alk1", 0, DM)],
        ionstats=ions + other_ions,
    )
    result = reports.detector_measurement_means(t)
    # the first bucket was measured at two voltages; a sample without ion statistics is out
    assert rows(result, "setname", "dm_api_group", "detectorvoltage", "ave_api") == [
        ("Alk1", 0, 1500.0, 1.5), ("Alk1", 0, 1550.0, 6.0), ("Alk1", 1, 1550.0, 8.0),
    ]
    by_two = reports.detector_measurement_means(t, bucket_size=2)
    assert rows(by_two, "dm_api_group", "ave_api") == [(0, 1.5), (1, 7.0)]


def test_buckets_follow_time_then_id_with_unknown_times_last(spark):
    t = make_tables(
        spark, dataset=[dataset("Alk1")],
        sample=[
            sample(5, "Alk1", None, DM, "e", 5), sample(4, "Alk1", 7, DM, "d", 4),
            sample(3, "Alk1", 7, DM, "c", 3), sample(2, "Alk1", 1, DM, "b", 2),
            sample(1, "Alk1", 9, DM, "a", 1),
        ],
        ionstats=[(i, 1.0, float(i)) for i in range(1, 6)],
    )
    result = reports.detector_measurement_means(t, bucket_size=1)
    assert [r[0] for r in rows(result, "ave_api")] == [2.0, 3.0, 4.0, 1.0, 5.0]


def test_injection_replicates(spark):
    names = ["Alk-1pg:1", "Alk-1pg:2", "Alk-1pg:3", "Alk-5pg", "Blank", "Alk-9pg:10"]
    t = make_tables(
        spark, ms_method=[method(offset=250)], dataset=[dataset("Set1"), dataset("Set2")],
        sample=[sample(i + 1, "Set1", i, name=n) for i, n in enumerate(names)]
        + [sample(50, "Set2", 0, name="Alk-1pg:1"), sample(51, None, 0, name="Alk-1pg")],
    )
    result = reports.injection_replicates(t, with_first=True)
    assert rows(result) == [
        # seq is the sum of acquisition numbers: 4 comes before 1+2+3
        ("Set1", "PV1", 250, "Alk-5pg", 1, 4, 4),
        ("Set1", "PV1", 250, "Alk-9pg:10", 1, 5, 5),
        ("Set1", "PV1", 250, "Alk-1pg", 3, 6, 1),
        ("Set2", "PV1", 250, "Alk-1pg", 1, 1, 1),
    ]


def test_gain_optimization_start_and_end(spark):
    s1, i1 = measurements(GO, "Alk1", [(1500.0, 1.0), (1510.0, 2.0), (1600.0, 9.0)])
    s2, i2 = measurements(GO, "Alk2", [(1400.0, 3.0)], first_id=10)
    s3, i3 = measurements(GO, "OFN1", [(1.0, 1.0)], first_id=20)
    t = make_tables(
        spark, ms_method=[method(offset=150)], dataset=[dataset(d) for d in ("Alk1", "Alk2", "OFN1")],
        sample=s1 + s2 + s3, ionstats=i1 + i2 + i3,
    )
    assert rows(reports.gain_optimization_start_end(t)) == [
        ("Alk1", "PV1", 150, 1500.0, 1.0, 1510.0, 2.0),
        ("Alk2", "PV1", 150, 1400.0, 3.0, None, None),
    ]


def test_measurement_and_optimization_summary(spark):
    dm, dm_ions = measurements(DM, "OFN1", [(1500.0, x) for x in (1.0, 2.0, 3.0, 10.0, 20.0)])
    two, two_ions = measurements(DM, "OFN2", [(1500.0, 1.0), (1600.0, 2.0)], first_id=10)
    alone, alone_ions = measurements(DM, "OFN3", [(1500.0, 1.0)], first_id=20)
    g1, gi1 = measurements(GO, "OFN1", [(1490.0, 7.0), (1500.0, 8.0)], first_id=30)
    g2, gi2 = measurements(GO, "OFN2", [(1480.0, 9.0)], first_id=40)
    t = make_tables(
        spark, ms_method=[method(offset=150)],
        dataset=[dataset("OFN1", "PV1"), dataset("OFN2", "PV2"), dataset("OFN3", "PV3")],
        sample=dm + two + alone + g1 + g2, ionstats=dm_ions + two_ions + alone_ions + gi1 + gi2,
    )
    result = reports.measurement_and_optimization_summary(t)
    # OFN3 lacks the optimization side; OFN2 has a row per voltage
    assert sorted(rows(result)) == [
        ("PV1", 150, 1490.0, 7.0, 2.0, 15.0, 1500.0, 8.0),
        ("PV2", 150, 1480.0, 9.0, 1.0, None, None, None),
        ("PV2", 150, 1480.0, 9.0, 2.0, None, None, None),
    ]


def test_sensitivity_masks_and_drops_sets_without_limit(spark):
    t = make_tables(
        spark, idl=[(7, 0.25, 0.02)], ms_method=[method()],
        dataset=[dataset("OFN1", idl_id=7), dataset("OFN2")],
        sample=[sample(1, "OFN1"), sample(2, "OFN2")],
        peaktable=[
            peak(1, "OFN", area=10, quant_sn=4, similairity=0),
            peak(1, "Perfluoronaphthalene", area=30, quant_sn=8, similairity=600),
            peak(1, "OFN", "Unknown", area=999, quant_sn=999, similairity=800),
            peak(1, "OFN", pg=0.5, area=5), peak(2, "OFN", area=1),
        ],
    )
    [row] = reports.sensitivity(t).collect()
    assert (row.inst, row.offset_volts, row.idl) == ("PV1", 0, 0.25)
    assert (row.ave_area, row.rsd_area) == (20.0, 70.711)
    assert row.stddev_area == pytest.approx(14.142135623730951)
    assert (row.ave_quant_sn, row.rsd_quant_sn) == (6.0, 47.14)
    assert (row.ave_similarity, row.rsd_similarity) == (700.0, 20.203)


def test_linearity_drops_sets_without_range(spark):
    t = make_tables(
        spark, dynamicrange=[(3, 4.5, 0.5, 1000.0, 0.5)], ms_method=[method(offset=350)],
        dataset=[dataset("A", dr_id=3), dataset("B")],
    )
    assert rows(reports.linearity(t)) == [("PV1", 350, 4.5, 0.5, 1000.0, 0.5)]


def test_merged_states_equal_the_values_themselves(spark):
    """Any grouping of the values gives the same statistics; large means do not eat small deviations."""
    r = random.Random(12)
    keys = ["a", "b", None]
    data = [
        (r.choice(keys), r.randrange(7), r.choice([None, 10**9 + r.randrange(3), r.randrange(9)]) if g else 10**15 + r.randrange(4), r.choice([None, 1e9 + r.random(), -2.5]))
        for g in (0, 1) for _ in range(300)
    ]
    data += [("one", 0, 5, None), ("none", 0, None, None)]
    df = spark.createDataFrame(data, "key string, part int, whole long, real double").repartition(4)
    measures = [Measure("whole"), Measure("real")]
    expected = {x.key: x for x in replicate_stats(df, ["key"], measures).collect()}
    for parts in (["key", "part"], ["key"]):
        found = {x.key: x for x in merged_stats(moment_states(df, parts, ["whole", "real"]), ["key"], measures).collect()}
        assert found.keys() == expected.keys()
        for key, row in expected.items():
            for a, b in zip(found[key], row, strict=True):
                assert a == b or a == pytest.approx(b, rel=1e-9, abs=0.005)
