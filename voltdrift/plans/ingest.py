"""Loading exports: frames -> linked tables -> staged, checked, appended.

Every step works on all data sets of the load at once. Generated keys are staged
in the warehouse (``_staging/<load>``, removed at the end) before anything refers
to them; peaks, which nothing refers to, are written once, where they stay.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from voltdrift.functions.columns import blank_to_null, text_to
from voltdrift.operators.integrity import (
    already_present,
    duplicate_keys,
    missing_parents,
    not_present,
)
from voltdrift.operators.sequence import number_rows
from voltdrift.plans.reports import peak_states
from voltdrift.session import materialize, release, remove_folder
from voltdrift.sources.csv_frames import POSITION, REJECTED, ExportFrames
from voltdrift.sources.schema import (
    DETECTOR_MEASUREMENT,
    FRAMES,
    GAIN_OPTIMIZATION,
    LENGTHS,
    NO_INSTRUMENT,
    PRIMARY_KEYS,
)
from voltdrift.sources.tables import (
    LOADS,
    InstrumentTables,
    append_load,
    check_load_name,
    conform,
    each,
    number_parts,
    read_loads,
    read_states,
    read_table,
    write_quarantine,
    write_rows,
    write_states,
)


LARGEST_FAN_OUT = 10_000_000  # peaks that one repeated sample name may make
ROUNDS, ROUND_BYTES = 4, 16 << 20  # parts, by data set, in which the peaks of large exports meet their samples; from how many bytes of peaks there is one more
STATE_ROUNDS = 4  # parts in which a load's states are made
TASK_ROWS = 1_000_000  # peaks of one repeated sample name that one task makes


class RejectedLoad(ValueError):
    """The load breaks a rule of the schema; nothing of it has become visible."""


@dataclass(frozen=True)
class LastIds:
    """The highest generated ids so far."""

    idl: int = 0
    dr: int = 0
    ionstats: int = 0
    sample: int = 0
    peaktable: int = 0


def load_export(
    spark: SparkSession, root: str, frames: ExportFrames, load: str,
    on_duplicate: str = "skip", strict: bool = True, largest_fan_out: int = LARGEST_FAN_OUT,
) -> DataFrame:
    """Load all data sets of ``frames`` into the warehouse at ``root``.

    All or nothing: the load shows once its report is written. A name already
    loaded is left alone and its report returned. Data sets the warehouse holds
    are skipped, or reject the load with ``on_duplicate="fail"``; cells that do
    not fit their type or length, or methods that are nowhere defined, reject it
    unless ``strict`` is off; so does a sample name that repeats so often that its
    peaks, one under each sample, would be more than ``largest_fan_out``, which is
    known before any peak is written. Rows that did not fit, and peaks without a sample,
    are in the quarantine with their text then, and also of a load that was
    rejected (see :func:`read_quarantine`); those of peaks are written in the pass
    that writes the peaks. One load at a time per warehouse.
    """
    check_load_name(load)
    loads = read_loads(spark, root)
    done = loads.filter(F.col("load") == load).drop("load")
    if not done.isEmpty():
        return done
    staging = f"{root}/_staging/{load}"
    remove_folder(spark, staging)
    try:
        return _load(spark, root, frames, load, loads, staging, on_duplicate, strict, largest_fan_out)
    finally:
        remove_folder(spark, staging)


def _load(
    spark: SparkSession, root: str, frames: ExportFrames, load: str, loads: DataFrame, staging: str,
    on_duplicate: str, strict: bool, largest_fan_out: int,
) -> DataFrame:
    existing = InstrumentTables.from_warehouse(spark, root)
    last = LastIds(
        *loads.agg(
            *[F.coalesce(F.max(f"last_{f.name}_id"), F.lit(0)) for f in fields(LastIds)]
        ).first()
    )
    # the one parse of all files but those of peaks
    staged: dict[str, DataFrame] = {}
    small = [f.name for f in fields(frames) if f.name != "peaktable"]
    each(lambda name: staged.__setitem__(name, materialize(getattr(frames, name), f"{staging}/{name}")), small)
    frames = replace(frames, **staged)
    incoming = frames.sample.select("dataset_id").distinct()
    n_incoming = incoming.count()
    n_rejected = already_present(incoming, existing.dataset, "dataset_id").count()
    if n_rejected and on_duplicate == "fail":
        raise RejectedLoad(f"{n_rejected} data sets are loaded already")
    if n_rejected == n_incoming and not _others_hold_new(frames, existing.dataset):
        return _nothing_loaded(spark, root, load, last, n_rejected)
    if n_rejected:
        frames = without_datasets(frames, existing.dataset)

    made: dict[str, DataFrame] = {}
    steps = {
        "samples": lambda: number_samples(frames.sample, staging, last.sample),
        "idl": lambda: first_row_per_dataset(
            frames.idl, ["idl_value", "concentration_pg"], "idl_id", staging, last.idl
        ),
        "dr": lambda: first_row_per_dataset(
            frames.dr,
            ["ordersofmagnitude", "concrange_pg_low", "concrange_pg_high", "correlation_coefficient_r"],
            "dr_id", staging, last.dr,
        ),
        "gc": lambda: materialize(new_methods(frames.gc, existing.gc_method, "gc_method"), staging),
        "ms": lambda: materialize(new_methods(frames.ms, existing.ms_method, "ms_method"), staging),
    }
    each(lambda name: made.__setitem__(name, steps[name]()), steps)
    samples, idl, dr, gc, ms = (made[name] for name in steps)
    if not n_rejected:
        remove_folder(spark, f"{staging}/sample")  # all of it is in the numbered samples
    release(spark)

    shared = materialize(fan_out(frames.peaktable, samples), staging)
    excess = shared.filter(F.col("rows") > largest_fan_out).orderBy(F.desc("rows")).limit(5).collect()
    if excess and strict:
        raise RejectedLoad("; ".join(
            f"{x.n_peaks} peaks under each of {x.n_samples} samples {x.samplename!r} of {x.dataset_id!r}" for x in excess
        ))

    watches: list[Observation] = []
    rounds = _rounds(frames.peaktable)

    def write_peaks() -> DataFrame:
        for n, part in enumerate(_parts(frames.peaktable, rounds)):
            watches.append(Observation())
            linked = _watched(link_peaks(part, samples, shared), watches[-1], n)
            written = write_rows(root, load, "peaktable", linked, **({"mode": "append"} if n else {}))
            release(spark)
        return spark.read.schema(written.schema).parquet(f"{root}/peaktable/load={load}")

    steps = {
        "dataset": lambda: materialize(dataset_rows(samples, idl, dr), staging),
        "ionstats": lambda: ionstats_rows(samples, staging, last.ionstats),
        "peaks": write_peaks,
    }
    each(lambda name: made.__setitem__(name, steps[name]()), steps)
    dataset, ionstats, peaks = (made[name] for name in steps)
    release(spark)
    steps = {
        "parts": lambda: number_parts(root, load, "peaktable", peaks, last.peaktable),
        "states": lambda: _keep_states(root, load, peaks),
    }
    each(lambda name: steps[name](), steps)
    release(spark)
    seen = _observed(watches)

    tables = {
        "idl": idl,
        "dynamicrange": dr,
        "gc_method": gc,
        "ms_method": ms,
        "dataset": dataset,
        "ionstats": ionstats,
        "sample": sample_rows(samples, ionstats),
        "peaktable": peaks,
    }
    n = _checked(tables, existing, samples, ionstats, frames)
    n["n_bad_rows"] += seen["n_bad"]
    n["n_orphan_peaks"] = seen["n_orphans"]
    problems = [
        f"{key.removesuffix('_id')} without a row for {count} method ids in use"
        for key in ("gc_method_id", "ms_method_id")
        if (count := n[f"missing dataset.{key}"])
    ]
    problems += [f"{count} keys of {table} are not unique" for table in PRIMARY_KEYS if (count := n.get(f"repeated {table}"))]
    problems += [
        f"{count} rows of {table} with a longer {column} than {length}"
        for table in ("dataset", "gc_method")
        for column, length in LENGTHS[table].items()
        if (count := n[f"long {table}.{column}"])
    ]
    if n["n_bad_rows"] or n["n_orphan_peaks"]:
        orphans = []
        if n["n_orphan_peaks"]:
            for part in _parts(frames.peaktable, rounds):
                found = _orphans(part, samples)
                orphans.append(materialize(found, staging) if rounds > 1 else found)
                release(spark)
        write_quarantine(root, load, quarantined(frames, samples, ionstats, peaks, orphans))
    if n["n_bad_rows"]:
        problems.append(f"{n['n_bad_rows']} rows with cells that do not fit")
    if problems and strict:
        remove_folder(spark, f"{root}/peaktable/load={load}")
        raise RejectedLoad("; ".join(problems))
    report = _report(spark, n, last, n_rejected)
    append_load(root, load, tables, report, written=["peaktable"])
    return report


def _keep_states(root: str, load: str, peaks: DataFrame) -> None:
    """The states of a load's peaks, in STATE_ROUNDS parts by data set: they are wider than
    the peaks, and nearly as many where few peaks repeat, so a part's shuffle goes before the next."""
    for n in range(STATE_ROUNDS):
        part = peaks.filter(F.pmod(F.xxhash64("_dataset_id"), F.lit(STATE_ROUNDS)) == n).withColumnRenamed("_dataset_id", "dataset_id")
        write_states(root, load, peak_states(part), "append" if n else "overwrite")
        release(peaks.sparkSession)


def stored_states(spark: SparkSession, root: str) -> DataFrame:
    """The states of all peaks in the warehouse: those that loads keep, and those of peaks from loads that keep none."""
    tables = InstrumentTables.from_warehouse(spark, root)
    schema = peak_states(tables.peaktable, tables.sample).schema
    kept = read_states(spark, root, schema)
    without = read_table(spark, root, "peaktable", with_load=True).join(
        F.broadcast(read_states(spark, root, schema).select("load").distinct()), "load", "left_anti"
    )
    return kept.drop("load").unionByName(peak_states(without, tables.sample))


def _others_hold_new(frames: ExportFrames, datasets: DataFrame) -> bool:
    """Whether a frame besides Sample brings a data set the warehouse lacks."""
    others = [getattr(frames, f.name).select("dataset_id") for f in fields(frames) if f.name != "sample"]
    ids = reduce(DataFrame.union, others).filter(F.col("dataset_id").isNotNull()).distinct()
    return not not_present(ids, datasets, "dataset_id").isEmpty()


def _rounds(peaks: DataFrame) -> int:
    """Into how many parts the peaks are dealt, by Spark's estimate of their size: what one part shuffles goes before the next."""
    size = int(str(peaks._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(1, min(ROUNDS, -(-size // ROUND_BYTES)))


def _parts(peaks: DataFrame, rounds: int) -> list[DataFrame]:
    """The peaks by data set; those without one are in one of the parts."""
    return [peaks.filter(F.pmod(F.xxhash64("dataset_id"), F.lit(rounds)) == n) for n in range(rounds)] if rounds > 1 else [peaks]


def _watched(peaks: DataFrame, watch: Observation, part: int = 0) -> DataFrame:
    """The peaks with a sample; those without, and bad rows, are counted while they pass. ``part``: their number among those a load writes."""
    orphan = F.col("sample_id").isNull()
    counted = peaks.observe(
        watch,
        F.count(F.when(orphan, 1)).alias("n_orphans"),
        F.count(F.when(F.col("_bad"), 1)).alias("n_bad"),
    )
    # the id is settled once the rows are written; the data set stands beside them, for their states
    place = F.monotonically_increasing_id() + F.lit(part << 61)  # tasks of other parts have other numbers
    return counted.filter(~orphan).withColumn("peaktable_id", place).withColumn("_dataset_id", F.col("dataset_id"))


def _observed(watches: list[Observation]) -> dict[str, int]:
    return {name: sum((watch.get or {}).get(name, 0) for watch in watches) for name in ("n_orphans", "n_bad")}


def _checked(
    tables: dict[str, DataFrame], existing: InstrumentTables, samples: DataFrame, ionstats: DataFrame, frames: ExportFrames
) -> dict[str, int]:
    """All counts of the report and of the rules that can fail, in one job.

    Serial keys are dense numbers, and the foreign keys that hold them come from
    joins with the rows that have them; of the other keys, methods can be missing.
    """
    count, bad = F.count(F.lit(1)), F.count(F.when(F.col("_bad"), 1))

    def longer(table: str) -> dict[str, Column]:
        return {f"long {table}.{c}": F.count(F.when(F.length(c) > n, 1)) for c, n in LENGTHS[table].items()}

    counted: list[tuple[DataFrame, dict[str, Column]]] = [
        (tables["dataset"], {
            "n_datasets": count, "n_without_instrument": F.count(F.when(F.col("instrument").isNull(), 1)), **longer("dataset")
        }),
        (tables["gc_method"], longer("gc_method")),
        (samples, {"n_samples": count, "n_bad_rows": bad}),
        (samples.groupBy("dataset_id", "samplename").count().filter("count > 1"), {"n_repeated_names": count}),
        (ionstats, {"n_ionstats": count, "n_bad_rows": bad}),
        (tables["peaktable"], {"n_peaks": count}),
        (tables["idl"], {"n_idl": count}),
        (tables["dynamicrange"], {"n_dr": count}),
        *((getattr(frames, frame), {"n_bad_rows": bad}) for frame in ("idl", "dr", "gc", "ms")),
        *((duplicate_keys(tables[t], PRIMARY_KEYS[t]), {f"repeated {t}": count}) for t in ("dataset", "gc_method", "ms_method")),
    ]
    for table in ("gc_method", "ms_method"):
        key = PRIMARY_KEYS[table]
        known = tables[table].select(key).union(getattr(existing, table).select(key))
        counted.append((missing_parents(tables["dataset"], key, known, key), {f"missing dataset.{key}": count}))
    counts = []
    for df, values in counted:
        pairs = F.array(*(F.struct(F.lit(name).alias("name"), F.col(f"_{i}").alias("n")) for i, name in enumerate(values)))
        counts.append(df.agg(*(value.alias(f"_{i}") for i, value in enumerate(values.values()))).select(F.inline(pairs)))
    found: dict[str, int] = {"n_bad_rows": 0}
    for name, n in reduce(DataFrame.union, counts).collect():
        found[name] = found.get(name, 0) + n
    return found


def quarantined(
    frames: ExportFrames, samples: DataFrame, ionstats: DataFrame, peaks: DataFrame, orphans: list[DataFrame]
) -> DataFrame:
    """The rows of a load that did not fit, as the quarantine holds them, one row each.

    Those among the peaks are read from beside the peaks just written. Only
    ``orphans``, peaks whose sample is nowhere (see :func:`_orphans`), were read from the export again.
    """
    found = [_kept_text(samples, "Sample"), _kept_text(peaks, "PeakTable"), _unmeasured(samples, ionstats)]
    found += [_kept_text(getattr(frames, name.lower()), name) for name in ("IDL", "GC", "MS", "DR")]
    found += orphans
    # a row can have problems of several kinds, and a peak stands under each sample of its name
    return reduce(DataFrame.unionByName, found).groupBy("frame", "file", "block", "line").agg(
        F.min("dataset_id").alias("dataset_id"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("problems")))).alias("problems"),
        F.max_by("cells", F.size(F.array_compact(F.map_values("cells")))).alias("cells"),
        F.max("text").alias("text"),
    )


def _kept_text(frame: DataFrame, name: str) -> DataFrame:
    """Rows with cells or lines that did not fit, from a frame that keeps their text; none from another."""
    if "_rejected" not in frame.columns:
        frame = frame.withColumn("_rejected", F.lit(None).cast(REJECTED))
    return frame.filter(F.col("_rejected").isNotNull()).select(F.lit(name).alias("frame"), "_rejected.*")


def _texts(columns: dict[str, str]) -> Column:
    return F.create_map(*(x for header, column in columns.items() for x in (F.lit(header), F.col(column).cast("string"))))


def _unmeasured(samples: DataFrame, ionstats: DataFrame) -> DataFrame:
    """Measurements whose voltage or area per ion is missing or no number."""
    bad = ionstats.filter("_bad").select("sample_id", "voltage", "areaperion")
    wrong = [F.when(bad[column].isNull(), header) for header, column in (("DetectorVoltage", "voltage"), ("AreaPerIon", "areaperion"))]
    cells = _texts({header: f"s.{column}" for header, (column, _) in FRAMES["Sample"].items() if column in samples.columns})
    return samples.alias("s").join(bad, "sample_id").select(
        F.lit("Sample").alias("frame"), "s.dataset_id", *(F.col(c).alias(c[1:]) for c in POSITION),
        F.array_compact(F.array(*wrong)).alias("problems"), cells.alias("cells"), F.lit(None).cast("string").alias("text"),
    )


def _orphans(peaks: DataFrame, samples: DataFrame) -> DataFrame:
    """Peaks that name no sample of their data set."""
    named = samples.select(F.col("dataset_id").alias("_set"), F.col("samplename").alias("_name"))
    lost = peaks.join(named, (peaks["dataset_id"] == named["_set"]) & (peaks["samplename"] == named["_name"]), "left_anti")
    cells = _texts({header: column for header, (column, _) in FRAMES["PeakTable"].items() if column in peaks.columns})
    kept = "_rejected" in peaks.columns
    return lost.select(
        F.lit("PeakTable").alias("frame"), "dataset_id", *(F.col(c).alias(c[1:]) for c in POSITION),
        (F.array_union(F.coalesce("_rejected.problems", F.array().cast("array<string>")), F.array(F.lit("Sample"))) if kept else F.array(F.lit("Sample"))).alias("problems"),
        (F.coalesce("_rejected.cells", cells) if kept else cells).alias("cells"),
        (F.col("_rejected.text") if kept else F.lit(None).cast("string")).alias("text"),
    )


def without_datasets(frames: ExportFrames, datasets: DataFrame) -> ExportFrames:
    """The frames' rows of other data sets than these."""
    return replace(
        frames,
        **{
            f.name: not_present(getattr(frames, f.name), datasets, "dataset_id")
            for f in fields(frames)
        },
    )


def first_row_per_dataset(
    frame: DataFrame, columns: list[str], id_name: str, folder: str, after: int = 0
) -> DataFrame:
    """The first row of each data set's frame, with a generated id.

    A data set without the frame has no row here and gets a NULL key later.
    """
    first = _first(frame, "dataset_id", columns)
    return number_rows(first, id_name, ["dataset_id"], folder, after)


def new_methods(frame: DataFrame, existing: DataFrame, table: str) -> DataFrame:
    """Methods the table lacks, one row per id; known methods stay as they are.

    Each export contributes its first row; of equal ids the first data set wins.
    """
    key = PRIMARY_KEYS[table]
    columns = [c for c in existing.columns if c != key]
    per_dataset = _first(frame, "dataset_id", [key, *columns])
    per_method = per_dataset.groupBy(key).agg(
        F.min_by(F.struct(*columns), F.col("dataset_id")).alias("_row")
    )
    new = not_present(per_method.filter(F.col(key).isNotNull()), existing, key)
    return conform(new.select(key, "_row.*"), table)


def dataset_rows(samples: DataFrame, idl: DataFrame, dr: DataFrame) -> DataFrame:
    """One row per data set: methods of its first sample, its instrument and
    the keys of its optional IDL and dynamic range rows (I4).

    The instrument is the last distinct name, by first appearance, other than
    the mark of samples without one; NULL if there is none.
    """
    seen = (
        samples.filter(F.col("dataset_id").isNotNull())
        .groupBy("dataset_id", "instrument")
        .agg(F.min("sample_id").alias("_seen"))
    )
    named = F.col("instrument") != NO_INSTRUMENT
    picked = seen.groupBy("dataset_id").agg(
        F.min("_seen").alias("_first"), F.max(F.when(named, F.col("_seen"))).alias("_last")
    )
    methods = picked.join(
        samples.select(F.col("sample_id").alias("_first"), "gc_method_id", "ms_method_id"), "_first"
    ).select("dataset_id", "gc_method_id", "ms_method_id")
    instruments = seen.filter(named).join(
        picked.select("dataset_id", F.col("_last").alias("_seen")), ["dataset_id", "_seen"]
    ).select("dataset_id", "instrument")
    return (
        methods.join(instruments, "dataset_id", "left")
        .join(idl.select("dataset_id", "idl_id"), "dataset_id", "left")
        .join(dr.select("dataset_id", "dr_id"), "dataset_id", "left")
    )


def number_samples(frame: DataFrame, folder: str, after: int = 0) -> DataFrame:
    """Sample rows with ids in the order of data set and file position."""
    return number_rows(frame, "sample_id", ["dataset_id", *POSITION], folder, after)


def ionstats_rows(samples: DataFrame, folder: str, after: int = 0) -> DataFrame:
    """Voltage and area per ion of the measurement samples, keyed."""
    voltage, area = (blank_to_null(F.col(c)) for c in ("detectorvoltage", "areaperion"))
    measured = samples.filter(
        F.col("sampletype").isin(DETECTOR_MEASUREMENT, GAIN_OPTIMIZATION)
    ).select(
        "sample_id",
        text_to(voltage, "float").alias("voltage"),
        text_to(area, "float").alias("areaperion"),
    )
    bad = F.col("voltage").isNull() | F.col("areaperion").isNull()
    return number_rows(measured.withColumn("_bad", bad), "ionstats_id", ["sample_id"], folder, after)


def sample_rows(samples: DataFrame, ionstats: DataFrame) -> DataFrame:
    """Samples in table form; those without a measurement have no ion statistics.

    Sorted within partitions by what the reports filter on, to skip row groups.
    """
    linked = samples.join(ionstats.select("sample_id", "ionstats_id"), "sample_id", "left")
    return conform(linked, "sample").sortWithinPartitions("sampletype", "dataset_id")


def fan_out(peaks: DataFrame, samples: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """For each sample name that repeats in its data set and has peaks: its samples, its peaks, their product, and ``salts``.

    One row per (data set, name), from counts combined before the shuffle. Peaks are
    only counted for names that repeat, and not read where none does. ``salts`` is
    into how many parts the join of the name is split, of ``task_rows`` rows or so.
    """
    key = ["dataset_id", "samplename"]
    repeated = samples.groupBy(*key).agg(F.count(F.lit(1)).alias("n_samples")).filter("n_samples > 1")
    counted = peaks.groupBy(*key).agg(F.count(F.lit(1)).alias("n_peaks"))
    if repeated.isEmpty():
        counted = counted.limit(0)
    rows = F.col("n_samples") * F.col("n_peaks")
    return repeated.join(counted, key).select(
        *key, "n_samples", "n_peaks", rows.alias("rows"), F.ceil(rows / task_rows).cast("int").alias("salts")
    )


def link_peaks(peaks: DataFrame, samples: DataFrame, shared: DataFrame | None = None) -> DataFrame:
    """Peaks with the key of the sample they name.

    A name that several samples share repeats its peaks under each of them; where
    ``shared`` (see :func:`fan_out`) says that these are many, the peaks are dealt
    over salts and their samples repeated for each, so that no task makes them all.
    A peak whose sample is missing keeps a NULL sample and is not loaded. Sorted by
    analyte and amount within a partition so that filters on these skip row groups.
    """
    named = samples.select("dataset_id", "samplename", "sample_id")
    key = ["dataset_id", "samplename"]
    crowded = shared.filter("salts > 1").select(*key, "salts") if shared is not None else None
    if crowded is not None and not crowded.isEmpty():
        key = [*key, "_salt"]
        dealt = peaks.join(crowded, key[:2], "left")
        peaks = dealt.withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(*POSITION), F.col("salts")), F.lit(0))).drop("salts")
        salts = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("salts") - 1, F.lit(0)).cast("long"))
        named = named.join(crowded, key[:2], "left").withColumn("_salt", F.explode(salts)).drop("salts")
    linked = peaks.join(named, key, "left").drop(*POSITION, "_salt")
    return linked.sortWithinPartitions("analyte", "concentration_pg")


def _first(frame: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The row of lowest position per key, reduced before the shuffle."""
    first = F.min_by(F.struct(*columns), F.struct(*POSITION)).alias("_row")
    return frame.groupBy(key).agg(first).select(key, "_row.*")


def _report(spark: SparkSession, n: dict[str, int], last: LastIds, n_rejected: int) -> DataFrame:
    """The load's row in the ``loads`` table."""
    values = {
        **n,
        "n_rejected_datasets": n_rejected,
        "last_idl_id": last.idl + n["n_idl"],
        "last_dr_id": last.dr + n["n_dr"],
        "last_ionstats_id": last.ionstats + n["n_ionstats"],
        "last_sample_id": last.sample + n["n_samples"],
        "last_peaktable_id": last.peaktable + n["n_peaks"],
    }
    return spark.createDataFrame([tuple(values[c] for c in LOADS.names)], LOADS)


def _nothing_loaded(
    spark: SparkSession, root: str, load: str, last: LastIds, n_rejected: int
) -> DataFrame:
    values = {f"last_{f.name}_id": getattr(last, f.name) for f in fields(last)}
    values["n_rejected_datasets"] = n_rejected
    report = spark.createDataFrame([tuple(values.get(c, 0) for c in LOADS.names)], LOADS)
    append_load(root, load, {}, report)
    return report
