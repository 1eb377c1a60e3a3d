"""Loading hand-written exports: linking, keys, quirks, rejection, repetition."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from tests.fixtures import rows
from voltdrift.operators.integrity import duplicate_keys, missing_parents
from voltdrift.plans import ingest, reports
from voltdrift.session import materialize, remove_folder
from voltdrift.sources import tables as warehouse
from voltdrift.sources.csv_frames import POSITION, read_export, read_frame
from voltdrift.sources.schema import FOREIGN_KEYS, FRAMES, PRIMARY_KEYS, TABLES
from voltdrift.sources.tables import InstrumentTables

SAMPLES = [
    # index, Type, Name, Status, GC, MS, DateTime, DataSet, Instrument, voltage, area per ion
    ("0", "Sample", "Alk-1pg:1", "Done", "gc 1", "ms 1", "2018-01-15 08:00:00", "?", "False", "", ""),
    ("1", "Detector Measurement", "DM", "Done", "gc 2", "ms 2", "2018-01-15 08:10:00", "?", "PV2", "1500.5", "12.25"),
    ("2", "Gain Optimization", "GO", "Done", "gc 1", "ms 1", "2018-01-15 08:20:00", "?", "PV1", "1510", "13"),
    ("3", "Sample", "Alk-1pg:2", "Done", "gc 1", "ms 1", "2018-01-15 08:30:00", "?", "PV2", "junk", ""),
    ("4", "Sample", "Alk-1pg:2", "Done", "gc 1", "ms 1", "2018-01-15 08:40:00", "?", "False", "", ""),
]
PEAKS = [
    # Name, Type, Area, Height, FWHH, Similarity, RT1, RT2, Peak S/N, Quant S/N, Sample, pg
    ("OFN", "Target", "100", "10.0", "0.5", "", "1.5", "", "7", "8", "Alk-1pg:1", "0.02"),
    ("it's, \"quoted\"", "Unknown", "3000000000", "20", "", "800", "", "", "", "", "Alk-1pg:2", "0.5"),
    ("OFN", "Target", "5", "5", "", "", "", "", "", "", "no such sample", "0.02"),
]
GC = [("gc 1", "10", "1D", "7.5"), ("gc 9", "20", "2D", "9")]
MS = [("ms 1", "17", "50", "500", "30", "250")]
IDL = [("0.02", "0.004696"), ("0.02", "9")]
DR = [("4.5", "0.5", "1000", "0.999")]


def write(folder, frame, lines, name=None):
    folder.mkdir(parents=True, exist_ok=True)
    with open(folder / f"{name or frame}.csv", "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(FRAMES[frame])
        out.writerows(lines)


def export(root, dataset_id, idl=IDL, dr=DR, gc=GC, ms=MS, samples=SAMPLES, peaks=PEAKS):
    frames = {"Sample": samples, "PeakTable": peaks, "GC": gc, "MS": ms, "IDL": idl, "DR": dr}
    for frame, lines in frames.items():
        if lines is not None:
            write(root / dataset_id, frame, lines)


@pytest.fixture
def store(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    warehouse.bootstrap(spark, root)
    return root


def load(spark, root, path, name, **options):
    return ingest.load_export(spark, root, read_export(spark, str(path)), name, **options)


def stored(spark, root):
    return InstrumentTables.from_warehouse(spark, root)


def test_bootstrap_gives_empty_typed_tables(spark, store):
    t = stored(spark, store)
    for name, schema in TABLES.items():
        df = getattr(t, name)
        assert df.count() == 0
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema]


def test_one_export(spark, store, tmp_path):
    export(tmp_path / "in", "Alk 1 +250V")
    report = load(spark, store, tmp_path / "in", "a").first()
    t = stored(spark, store)
    # first GC and MS method, last distinct instrument by first appearance
    assert rows(t.dataset) == [("Alk 1 +250V", "PV1", 1, "gc 1", "ms 1", 1)]
    assert rows(t.idl) == [(1, pytest.approx(0.004696), pytest.approx(0.02))]
    assert rows(t.dynamicrange)[0][:3] == (1, 4.5, 0.5)
    assert rows(t.gc_method) == [("gc 1", 10, "1D", 7.5)]
    assert rows(t.ms_method) == [("ms 1", 17, 50, 500, 30.0, 250)]
    assert sorted(rows(t.ionstats)) == [(1, 1500.5, 12.25), (2, 1510.0, 13.0)]
    samples = sorted(rows(t.sample, "sample_id", "samplename", "sampletype", "ionstats_id"))
    assert samples == [
        (1, "Alk-1pg:1", "Sample", None), (2, "DM", "Detector Measurement", 1),
        (3, "GO", "Gain Optimization", 2), (4, "Alk-1pg:2", "Sample", None),
        (5, "Alk-1pg:2", "Sample", None),
    ]
    assert str(t.sample.orderBy("sample_id").first().datetimestamp) == "2018-01-15 08:00:00"
    # the orphan is dropped, the peak of the repeated name is there twice
    peaks = sorted(rows(t.peaktable, "sample_id", "analyte", "area", "height", "similairity"))
    assert peaks == [
        (1, "OFN", 100, 10, None), (4, "it's, \"quoted\"", 3000000000, 20, 800),
        (5, "it's, \"quoted\"", 3000000000, 20, 800),
    ]
    assert len({r[0] for r in rows(t.peaktable, "peaktable_id")}) == 3
    assert (report.n_datasets, report.n_samples, report.n_peaks) == (1, 5, 3)
    assert (report.n_orphan_peaks, report.n_repeated_names, report.n_bad_rows) == (1, 1, 0)


def test_optional_frames_and_missing_instrument(spark, store, tmp_path):
    no_instrument = [(*s[:8], "False", *s[9:]) for s in SAMPLES]
    export(tmp_path / "in", "S1", idl=None, dr=None, samples=no_instrument)
    report = load(spark, store, tmp_path / "in", "a").first()
    assert rows(stored(spark, store).dataset) == [("S1", None, None, "gc 1", "ms 1", None)]
    assert report.n_without_instrument == 1


def test_many_exports_and_loads(spark, store, tmp_path):
    for i in range(4):
        export(tmp_path / "one", f"S{i}", idl=IDL if i % 2 else None)
    load(spark, store, tmp_path / "one", "one")
    known = [("ms 1", "99", "1", "2", "3", "4"), ("ms 5", "1", "1", "2", "3", "4")]
    for i in (3, 4, 5):
        export(tmp_path / "two", f"S{i}", ms=known, gc=GC)
    report = load(spark, store, tmp_path / "two", "two").first()
    assert (report.n_datasets, report.n_rejected_datasets) == (2, 1)

    t = stored(spark, store)
    assert sorted(r[0] for r in rows(t.dataset)) == [f"S{i}" for i in range(6)]
    # a known method stays as it was first loaded
    assert rows(t.ms_method) == [("ms 1", 17, 50, 500, 30.0, 250)]
    for table, n in {"idl": 4, "dynamicrange": 6, "ionstats": 12, "sample": 30, "peaktable": 18}.items():
        ids = sorted(r[0] for r in rows(getattr(t, table), PRIMARY_KEYS[table]))
        assert ids == list(range(1, n + 1)), table
    # peaks of a later load have higher ids
    by_set = dict(rows(t.peaktable.join(t.sample, "sample_id").groupBy("dataset_id").agg(F.max("peaktable_id"))))
    assert max(by_set[f"S{i}"] for i in range(4)) == 12 and min(by_set[f"S{i}"] for i in (4, 5)) > 12
    for child, key, parent in FOREIGN_KEYS:
        assert missing_parents(getattr(t, child), key, getattr(t, parent), PRIMARY_KEYS[parent]).isEmpty()
    for table, key in PRIMARY_KEYS.items():
        assert duplicate_keys(getattr(t, table), key).isEmpty()
    names = t.sample.join(t.peaktable, "sample_id").groupBy("dataset_id").count()
    assert {r[1] for r in rows(names)} == {3}


def test_repetition_adds_nothing(spark, store, tmp_path):
    export(tmp_path / "in", "S1")
    first = load(spark, store, tmp_path / "in", "a").first()
    assert load(spark, store, tmp_path / "in", "a").first() == first
    again = load(spark, store, tmp_path / "in", "b").first()
    assert (again.n_datasets, again.n_rejected_datasets) == (0, 1)
    assert stored(spark, store).sample.count() == 5
    with pytest.raises(ingest.RejectedLoad, match="loaded already"):
        load(spark, store, tmp_path / "in", "c", on_duplicate="fail")
    export(tmp_path / "more", "S2")
    load(spark, store, tmp_path / "more", "d")
    assert sorted(r[0] for r in rows(stored(spark, store).sample, "sample_id")) == list(range(1, 11))


def test_bad_cells_reject_the_whole_load(spark, store, tmp_path):
    bad = [("OFN", "Target", "many", *PEAKS[0][3:])]
    export(tmp_path / "in", "S1", peaks=PEAKS + bad)
    with pytest.raises(ingest.RejectedLoad, match="1 rows with cells"):
        load(spark, store, tmp_path / "in", "a")
    assert stored(spark, store).dataset.count() == 0
    report = load(spark, store, tmp_path / "in", "a", strict=False).first()
    assert (report.n_bad_rows, report.n_peaks) == (1, 4)


def quarantine(spark, root):
    kept = warehouse.read_quarantine(spark, root)
    return sorted((r.load, r.frame, r.dataset_id, tuple(r.problems), r.cells, r.text) for r in kept.collect())


def test_quarantine_keeps_the_text_of_rows_that_do_not_fit(spark, store, tmp_path):
    header = list(FRAMES["PeakTable"])
    bad = [
        ("OFN", "Target", "many", "20", "wide", *PEAKS[0][5:]),
        ("OFN", "Target", "many", *PEAKS[1][3:]),  # its name is there twice
        ("OFN", "Target", "1", *PEAKS[0][3:10], "nowhere", "a lot"),
    ]
    samples = [*SAMPLES, (*SAMPLES[1][:6], "at noon", *SAMPLES[1][7:9], "high", "5")]
    export(tmp_path / "in", "S1", samples=samples, peaks=[PEAKS[0], *bad], dr=[("wide", "", "1", "1")])
    with open(tmp_path / "in" / "S1" / "IDL.csv", "a", encoding="utf-8") as f:
        f.write("1,2,3,4\r\n")

    def cells(frame, line):
        return {h: x or None for h, x in zip(FRAMES[frame], line, strict=True)}

    shown = cells("Sample", samples[-1]) | {"DataSet": "?"}
    expected = sorted([
        ("IDL", "S1", (), {"Concentration": "1", "IDL": "2"}, "1,2,3,4"),
        ("DR", "S1", ("OrdersOfMagnitude",), cells("DR", ("wide", "", "1", "1")), None),
        ("Sample", "S1", ("DateTime", "DetectorVoltage"), shown, None),
        ("PeakTable", "S1", ("Area", "FWHH (s)"), cells("PeakTable", bad[0]), None),
        ("PeakTable", "S1", ("Area",), cells("PeakTable", bad[1]), None),
        ("PeakTable", "S1", ("Concentration_pg", "Sample"), cells("PeakTable", bad[2]), None),
    ], key=repr)
    with pytest.raises(ingest.RejectedLoad):
        load(spark, store, tmp_path / "in", "a")
    assert sorted((x[1:] for x in quarantine(spark, store)), key=repr) == expected
    report = load(spark, store, tmp_path / "in", "a", strict=False).first()
    assert (report.n_orphan_peaks, report.n_peaks) == (1, 4)
    assert sorted((x[1:] for x in quarantine(spark, store)), key=repr) == expected
    # beside the peaks, not among their columns; a load without such rows has no quarantine
    assert header and stored(spark, store).peaktable.columns == list(TABLES["peaktable"].names)
    export(tmp_path / "more", "S2", peaks=[PEAKS[0]])
    load(spark, store, tmp_path / "more", "b")
    assert {x[0] for x in quarantine(spark, store)} == {"a"}


def crowded_export(folder, n, m):
    samples = [("0", "Sample", "twice", "Done", "gc 1", "ms 1", "", "?", "False", "", "")] * n
    export(folder, "S1", samples=samples, peaks=[("OFN", "Target", str(i), *PEAKS[0][3:10], "twice", "0.5") for i in range(m)])


def test_crowded_name_is_rejected_before_any_peak_is_written(spark, store, tmp_path):
    crowded_export(tmp_path / "in", 10_000, 10_000)
    with pytest.raises(ingest.RejectedLoad, match="10000 peaks under each of 10000 samples 'twice' of 'S1'"):
        load(spark, store, tmp_path / "in", "a")
    assert not (tmp_path / "warehouse" / "peaktable" / "load=a").exists()


def test_crowded_name_is_dealt_over_tasks(spark, tmp_path):
    """10,000 samples and 10,000 peaks of one name: 100 million rows, of which no task makes a large part."""
    samples = spark.range(10_000).selectExpr("'S1' AS dataset_id", "'twice' AS samplename", "id AS sample_id")
    samples = samples.union(spark.range(20_000, 20_100).selectExpr("'S1'", "concat('s', id)", "id"))
    peaks = spark.range(10_000).selectExpr(
        "'S1' AS dataset_id", "'twice' AS samplename", "'OFN' AS analyte", "id AS area", "0.5 AS concentration_pg",
        "'f' AS _file", "0L AS _block", "id AS _line",
    )
    peaks = peaks.union(peaks.selectExpr("dataset_id", "concat('s', 20000 + area)", "analyte", "area", "concentration_pg", "_file", "_block", "-1 - _line"))
    shared = materialize(ingest.fan_out(peaks, samples), str(tmp_path))
    assert rows(shared) == [("S1", "twice", 10_000, 10_000, 100_000_000, 100)]
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, setting in settings.items():
        spark.conf.set(key, setting)
    try:
        linked = ingest.link_peaks(peaks, samples, shared).select("samplename", "sample_id", "area", F.spark_partition_id().alias("task"))
        made = linked.groupBy("task").agg(F.count("sample_id").alias("n"), F.sum("area"), F.sum("sample_id")).collect()
    finally:
        for key, setting in before.items():
            spark.conf.set(key, setting)
    assert sum(r[1] or 0 for r in made) == 100_000_100
    assert max(r[1] for r in made) < 10_000_000
    each = sum(range(10_000))
    assert sum(r[2] for r in made) == 10_000 * each + each
    assert sum(r[3] or 0 for r in made) == 10_000 * each + sum(range(20_000, 20_100))


def test_few_peaks_of_a_repeated_name_are_the_same_with_salts(spark, tmp_path):
    samples = spark.range(60).selectExpr("'S1' AS dataset_id", "concat('n', id % 4) AS samplename", "id AS sample_id")
    peaks = spark.range(100).selectExpr(
        "'S1' AS dataset_id", "concat('n', id % 6) AS samplename", "'OFN' AS analyte", "id AS area", "0.5 AS concentration_pg",
        "'f' AS _file", "0L AS _block", "id AS _line",
    )
    plain = ingest.link_peaks(peaks, samples)
    salted = ingest.link_peaks(peaks, samples, ingest.fan_out(peaks, samples, 50))
    assert sorted(rows(plain, "area", "sample_id"), key=repr) == sorted(rows(salted, "area", "sample_id"), key=repr)


def test_measurement_without_number_rejects(spark, store, tmp_path):
    broken = [(*SAMPLES[1][:9], "", "5")]
    export(tmp_path / "in", "S1", samples=SAMPLES + broken)
    with pytest.raises(ingest.RejectedLoad):
        load(spark, store, tmp_path / "in", "a")


def test_unknown_method_rejects(spark, store, tmp_path):
    export(tmp_path / "in", "S1", gc=[("other", "1", "1D", "1")])
    with pytest.raises(ingest.RejectedLoad, match="gc_method without a row for 1"):
        load(spark, store, tmp_path / "in", "a")


def test_long_names_reject(spark, store, tmp_path):
    longer = [(*s[:8], "PV12" if s[8] == "PV1" else s[8], *s[9:]) for s in SAMPLES]
    export(tmp_path / "in", "S1", samples=longer, gc=[("gc 1", "10", "1D x", "7.5")])
    with pytest.raises(ingest.RejectedLoad, match="longer instrument.*longer chromatrography"):
        load(spark, store, tmp_path / "in", "a")


def row_by_row(exports):
    """What loading one export after the other, row by row, leaves behind."""
    t = {name: [] for name in TABLES}
    for dataset_id in sorted(exports):
        e = exports[dataset_id]
        keys = {}
        for frame, table, width in (("idl", "idl", 2), ("dr", "dynamicrange", 4)):
            if e[frame]:
                t[table].append((len(t[table]) + 1, *e[frame][0][:width]))
                keys[frame] = len(t[table])
        for frame, table in (("gc", "gc_method"), ("ms", "ms_method")):
            if e[frame][0][0] not in [m[0] for m in t[table]]:
                t[table].append(e[frame][0])
        instrument = None
        for name in dict.fromkeys(s[8] for s in e["samples"]):
            if name != "False":
                instrument = name
        first = e["samples"][0]
        t["dataset"].append(
            (dataset_id, instrument, keys.get("idl"), first[4], first[5], keys.get("dr"))
        )
        ion_ids = []
        for s in e["samples"]:
            if s[1] in ("Detector Measurement", "Gain Optimization"):
                t["ionstats"].append((len(t["ionstats"]) + 1, float(s[9]), float(s[10])))
                ion_ids.append(len(t["ionstats"]))
            else:
                ion_ids.append(None)
        for s, ion_id in zip(e["samples"], ion_ids):
            t["sample"].append((len(t["sample"]) + 1, s[1], s[2], ion_id, dataset_id))
            for p in e["peaks"]:
                if p[10] == s[2]:
                    t["peaktable"].append((p[0], int(p[2]), len(t["sample"])))
    return t


@pytest.mark.parametrize("seed", [1, 2])
def test_bulk_load_equals_row_by_row(spark, store, tmp_path, seed):
    r = random.Random(seed)
    kinds = ["Sample", "Detector Measurement", "Gain Optimization"]
    exports = {}
    for n in range(12):
        gc, ms = f"gc {r.randrange(4)}", f"ms {r.randrange(4)}"
        samples = [
            (str(i), r.choice(kinds), f"s{r.randrange(8)}", "Done", gc, ms, "2018-01-15 08:00:00",
             "?", r.choice(["False", "PV1", "PV2"]), str(r.randrange(9)), str(r.randrange(9)))
            for i in range(r.randrange(1, 12))
        ]
        peaks = [
            (r.choice(["OFN", "Eicosane"]), "Target", str(r.randrange(100)), *["1"] * 7,
             f"s{r.randrange(10)}", "0.5")
            for _ in range(r.randrange(0, 20))
        ]
        exports[f"set{n:02d}"] = dict(
            samples=samples, peaks=peaks, gc=[(gc, str(n), "1D", "1")],
            ms=[(ms, str(n), "1", "1", "1", str(n))],
            idl=[(str(n), "0.5"), ("9", "9")] if r.random() < 0.6 else None,
            dr=[(str(n), "1", "2", "3")] if r.random() < 0.6 else None,
        )
    for dataset_id, e in exports.items():
        # in the file, the amount comes before the limit
        idl = e["idl"] and [(pg, limit) for limit, pg in e["idl"]]
        export(tmp_path / "in", dataset_id, **{**e, "idl": idl})
    load(spark, store, tmp_path / "in", "a")
    t, expected = stored(spark, store), row_by_row(exports)

    def same(table, *columns, convert=None):
        found = sorted(rows(getattr(t, table), *columns), key=repr)
        wanted = [tuple(convert(v) for v in row) if convert else row for row in expected[table]]
        assert found == sorted(wanted, key=repr), table

    same("idl", convert=float)
    same("dynamicrange", convert=float)
    same("dataset")
    same("ionstats")
    methods = {m[0]: int(m[1]) for m in expected["gc_method"]}
    assert dict(rows(t.gc_method, "gc_method_id", "splitratio")) == methods
    offsets = {m[0]: int(m[5]) for m in expected["ms_method"]}
    assert dict(rows(t.ms_method, "ms_method_id", "detectoroffset_volts")) == offsets
    same("sample", "sample_id", "sampletype", "samplename", "ionstats_id", "dataset_id")
    same("peaktable", "analyte", "area", "sample_id")


def test_unfinished_load_stays_hidden_and_can_be_repeated(spark, store, tmp_path, monkeypatch):
    export(tmp_path / "in", "S1")
    export(tmp_path / "other", "S2")
    real = warehouse.each

    def dies(write, tables):
        real(write, ["sample", "dataset"])
        raise OSError("lost")

    for name in ("in", "other"):
        monkeypatch.setattr(warehouse, "each", dies)
        with pytest.raises(OSError):
            load(spark, store, tmp_path / name, name)
        monkeypatch.undo()
        assert stored(spark, store).sample.count() == 0
    # repeated under its name, it counts once
    load(spark, store, tmp_path / "in", "in")
    assert stored(spark, store).sample.count() == 5
    # repeated after its data sets came in otherwise, nothing of the first try shows
    load(spark, store, tmp_path / "other", "otherwise")
    report = load(spark, store, tmp_path / "other", "other").first()
    assert (report.n_datasets, report.n_rejected_datasets) == (0, 1)
    assert stored(spark, store).sample.count() == 10
    assert stored(spark, store).dataset.count() == 2


def test_peaks_are_written_once_and_nothing_stays_staged(spark, store, tmp_path, monkeypatch):
    export(tmp_path / "in", "S1")
    written = []
    real = ingest.write_rows

    def counting(root, load_, table, df):
        written.append(table)
        return real(root, load_, table, df)

    monkeypatch.setattr(ingest, "write_rows", counting)
    staged = []
    monkeypatch.setattr(
        ingest, "materialize", lambda df, folder: (staged.append(df.columns), materialize(df, folder))[1]
    )
    load(spark, store, tmp_path / "in", "a")
    assert written == ["peaktable"] and not any("analyte" in columns for columns in staged)
    assert not (tmp_path / "warehouse" / "_staging" / "a").exists()
    with pytest.raises(ingest.RejectedLoad):
        export(tmp_path / "bad", "S2", peaks=[("OFN", "Target", "many", *PEAKS[0][3:])])
        load(spark, store, tmp_path / "bad", "b")
    assert not (tmp_path / "warehouse" / "_staging" / "b").exists()
    assert not (tmp_path / "warehouse" / "peaktable" / "load=b").exists()


def test_peaks_of_a_new_data_set_without_samples_are_orphans(spark, store, tmp_path):
    export(tmp_path / "in", "S1")
    load(spark, store, tmp_path / "in", "a")
    write(tmp_path / "more" / "S2", "PeakTable", PEAKS)
    export(tmp_path / "more", "S1")
    report = load(spark, store, tmp_path / "more", "b").first()
    assert (report.n_datasets, report.n_rejected_datasets, report.n_orphan_peaks) == (0, 1, 3)


def test_reports_of_kept_states_equal_those_of_peaks(spark, store, tmp_path):
    for name, ids in (("one", (0, 1)), ("two", (2, 3))):
        for i in ids:
            export(tmp_path / name, f"OFN{i}", peaks=[*PEAKS, *([(*PEAKS[0][:2], str(i * 7), *PEAKS[0][3:])] * (i + 1))])
        load(spark, store, tmp_path / name, name)
    t = stored(spark, store)
    assert ingest.stored_states(spark, store).count() > 4

    def same():
        states = ingest.stored_states(spark, store)
        for found, expected in (
            (reports.analyte_stats_of_states(states, t, ["OFN"], 0.02), reports.analyte_replicate_stats(t, ["OFN"], 0.02)),
            (reports.sensitivity_of_states(states, t, with_set=True), reports.sensitivity(t, with_set=True)),
            (reports.unique_concentrations_of_states(states, "OFN"), reports.unique_concentrations(t, "OFN")),
        ):
            assert sorted(rows(found), key=repr) == sorted(rows(expected), key=repr) and rows(expected)

    same()
    # a load without states, as older ones are, has them taken from its peaks
    remove_folder(spark, f"{store}/peak_states/load=two")
    same()


def test_load_without_peaks(spark, store, tmp_path):
    export(tmp_path / "in", "S1", peaks=None)
    report = load(spark, store, tmp_path / "in", "a").first()
    assert (report.n_peaks, report.n_orphan_peaks, report.n_samples) == (0, 0, 5)


def test_reset_clears_under_dynamic_overwrite(spark, store, tmp_path):
    export(tmp_path / "in", "S1")
    load(spark, store, tmp_path / "in", "a")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        warehouse.bootstrap(spark, store)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert stored(spark, store).sample.count() == 0 and warehouse.read_loads(spark, store).count() == 0
    load(spark, store, tmp_path / "in", "a")
    assert stored(spark, store).sample.count() == 5


def test_finished_load_is_not_written_again(spark, store, tmp_path):
    export(tmp_path / "in", "S1")
    report = load(spark, store, tmp_path / "in", "a")
    with pytest.raises(ValueError, match="already"):
        warehouse.append_load(store, "a", {}, report)
    assert stored(spark, store).sample.count() == 5


def test_writes_keep_the_callers_properties(spark):
    context, seen = spark.sparkContext, []
    context.setLocalProperty("voltdrift.test", "here")
    warehouse.each(lambda _: seen.append(context.getLocalProperty("voltdrift.test")), ["a", "b"])
    context.setLocalProperty("voltdrift.test", None)
    assert seen == ["here", "here"]


def test_frame_layouts_and_broken_lines(spark, tmp_path):
    folder = tmp_path / "by_frame" / "IDL"
    folder.mkdir(parents=True)
    (folder / "part.csv").write_text("DataSet,Concentration,IDL\nS1,0.5,1\nS2,0.5\n,1,1\nS3, ,2\n")
    frame = read_frame(spark, str(tmp_path / "by_frame"), "IDL", "by_frame")
    found = sorted(rows(frame, "dataset_id", "concentration_pg", "idl_value", "_bad"), key=repr)
    assert found == [
        ("S1", 0.5, 1.0, False), ("S2", 0.5, None, True), ("S3", None, 2.0, False),
        (None, 1.0, 1.0, True),
    ]
    absent = read_frame(spark, str(tmp_path / "by_frame"), "DR", "by_frame")
    assert absent.count() == 0 and set(POSITION) <= set(absent.columns)
    with pytest.raises(Exception, match="header"):
        (folder / "part.csv").write_text("Wrong,Concentration,IDL\nS1,0.5,1\n")
        read_frame(spark, str(tmp_path / "by_frame"), "IDL", "by_frame").collect()


def test_other_time_format(spark, tmp_path):
    line = (*SAMPLES[0][:6], "1/15/2018 3:04:05 PM", *SAMPLES[0][7:])
    write(tmp_path / "S1", "Sample", [line])
    frame = read_frame(spark, str(tmp_path), "Sample", timestamp_format="M/d/yyyy h:mm:ss a")
    assert str(frame.first().datetimestamp) == "2018-01-15 15:04:05"


def test_positions_restore_file_order(spark, tmp_path):
    lines = [(str(i), "Sample", f"s{i}", "Done", "g", "m", "", "", "False", "", "") for i in range(20000)]
    write(tmp_path / "S1", "Sample", lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100_000)
    try:
        frame = read_frame(spark, str(tmp_path), "Sample")
        assert frame.rdd.getNumPartitions() > 3
        order = [int(r[0]) for r in frame.orderBy(*POSITION).select("index").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert order == list(range(20000))


def test_load_name_must_fit_a_folder(spark, store):
    with pytest.raises(ValueError):
        warehouse.append_load(store, "a/b", {}, spark.range(0))


def test_peaks_in_parts(spark, store, tmp_path, monkeypatch):
    """Peaks of a large export are linked part by part: the same peaks, dense ids, the same counts and quarantine."""
    peaks = [*PEAKS, ("OFN", "Target", "many", *PEAKS[0][3:])]
    for n in range(6):
        export(tmp_path / "in", f"S{n}", peaks=peaks)
    export(tmp_path / "in", "S6", samples=None, peaks=peaks)
    content = [c for c in TABLES["peaktable"].names if not c.endswith("_id")]
    whole = load(spark, store, tmp_path / "in", "a", strict=False).first()
    expected = sorted(rows(stored(spark, store).peaktable, *content), key=repr)

    def kept():
        return sorted(repr((r.frame, r.dataset_id, r.problems, sorted((r.cells or {}).items()), r.text)) for r in warehouse.read_quarantine(spark, store).collect())

    before = kept()
    appended, real = [], ingest.write_rows
    monkeypatch.setattr(ingest, "write_rows", lambda *args, **options: appended.append(options) or real(*args, **options))
    monkeypatch.setattr(ingest, "ROUND_BYTES", 1)
    warehouse.bootstrap(spark, store)
    assert load(spark, store, tmp_path / "in", "a", strict=False).first() == whole and len(appended) == ingest.ROUNDS
    t = stored(spark, store)
    assert sorted(rows(t.peaktable, *content), key=repr) == expected
    assert sorted(r.peaktable_id for r in t.peaktable.collect()) == list(range(1, len(expected) + 1))
    assert kept() == before and len(before) > 12


def test_loads_leave_no_export(spark, tmp_path, monkeypatch):
    """A query's export is compressed, and goes once it is loaded."""
    from voltdrift.driver import queries

    folders, real = [], queries.exported
    monkeypatch.setattr(queries, "scratch", lambda spark: str(tmp_path / str(len(list(tmp_path.iterdir())))))
    monkeypatch.setattr(queries, "exported", lambda spark, frames: folders.append(real(spark, frames)) or folders[-1])
    monkeypatch.setattr(queries.ingest, "load_export", lambda *args, **options: folders.append([f.name for f in (tmp_path / "0" / "GC").glob("part*")]))
    customer = spark.createDataFrame([(1, "c", 0, 1.0, "BUILDING")], queries.mapping.SCHEMAS["customer"])
    monkeypatch.setattr(queries.mapping, "damaged_frames", lambda spark, sf_dir: {"GC": customer})
    queries.i11_quarantine(spark, "")
    assert folders[1] and all(name.endswith(".csv.gz") for name in folders[1]) and not (tmp_path / "0").exists()
