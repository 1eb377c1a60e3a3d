"""The eight tables: reading them, creating them, appending loads to them.

A warehouse is one Parquet folder per table, partitioned by load. A load is
visible once its row is in the ``loads`` table, which is written last; until
then readers do not see any of it, and running the load again under the same
name overwrites what it left behind.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Collection, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from voltdrift.session import COMPRESSION, make_folder, remove_folder
from voltdrift.sources.schema import BIG, TABLES, TEXT, struct

# What a load did, and the last generated id of each kind for the next one.
LOADS = struct(
    n_datasets=BIG, n_rejected_datasets=BIG, n_without_instrument=BIG, n_samples=BIG,
    n_repeated_names=BIG, n_ionstats=BIG, n_peaks=BIG, n_orphan_peaks=BIG, n_bad_rows=BIG,
    last_idl_id=BIG, last_dr_id=BIG, last_ionstats_id=BIG, last_sample_id=BIG,
    last_peaktable_id=BIG,
)

# Rows of exports that did not fit: where they stood, the headers of the cells that did
# not, their cells, and the line where it was no CSV of the layout.
QUARANTINE = struct(
    frame=TEXT, dataset_id=TEXT, file=TEXT, block=BIG, line=BIG, problems=ArrayType(TEXT), cells=MapType(TEXT, TEXT), text=TEXT
)

# Columns that rows of a load keep in their files, beside the table's.
BESIDE = ("_rejected", "_dataset_id")

# Tables whose stored ids are places (task above, row below), read as dense ids by the
# first id of each task's part.
NUMBERED = {"peaktable": "peaktable_id"}
PARTS = struct(part=BIG, first_id=BIG)
PLACE_BITS = 33  # of monotonically_increasing_id


@dataclass(frozen=True)
class InstrumentTables:
    """The snowflake: peaktable -> sample -> {dataset -> dimensions, ionstats}.

    Any DataFrames with these columns will do, whether from files, the catalog
    or ``spark.read.jdbc``.
    """

    idl: DataFrame
    gc_method: DataFrame
    ms_method: DataFrame
    dynamicrange: DataFrame
    dataset: DataFrame
    ionstats: DataFrame
    sample: DataFrame
    peaktable: DataFrame

    @classmethod
    def from_warehouse(cls, spark: SparkSession, root: str) -> InstrumentTables:
        return cls(**{t: read_table(spark, root, t) for t in TABLES})

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str) -> InstrumentTables:
        return cls(**{t: spark.table(f"{database}.{t}") for t in TABLES})


def read_loads(spark: SparkSession, root: str) -> DataFrame:
    """One row per finished load."""
    schema = _with_load(LOADS)
    return spark.read.schema(schema).parquet(f"{root}/loads")


def read_table(spark: SparkSession, root: str, table: str, with_load: bool = False) -> DataFrame:
    """A table's rows of finished loads; ``with_load`` adds the load's name.

    The load names stay a table: a semi join on the partition column that keeps
    the folders of other loads out of the scan. A name is short and stands for a
    campaign brought in by hand, so the names are broadcast.
    """
    schema = _with_load(TABLES[table])
    df = spark.read.schema(schema).parquet(f"{root}/{table}")
    if table in NUMBERED:
        df = _with_ids(df, spark.read.schema(_with_load(PARTS)).parquet(f"{root}/{table}_parts"), NUMBERED[table])
    names = read_loads(spark, root).filter(F.length("load") > 0).select("load")
    found = df.join(F.broadcast(names), "load", "left_semi")
    return found if with_load else found.drop("load")


def _with_ids(df: DataFrame, parts: DataFrame, key: str) -> DataFrame:
    """Places as dense ids; rows of loads that brought their own ids keep them.

    The first ids are distinct per load and part, as the optimizer can tell, so it
    leaves the join out wherever ids are not asked for.
    """
    first = parts.groupBy(F.col("load").alias("_load"), F.col("part").alias("_part")).agg(F.min("first_id").alias("_first"))
    found = df.join(first, (F.col("load") == F.col("_load")) & (F.shiftright(key, PLACE_BITS) == F.col("_part")), "left")
    within = F.col(key).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    number = F.coalesce(F.col("_first") + within, F.col(key))
    return found.select(*(number.alias(c) if c == key else F.col(c) for c in df.columns))


def bootstrap(spark: SparkSession, root: str) -> None:
    """Create all tables empty, dropping what is there.

    The list of loads goes first and comes back last, so a reset that dies
    midway leaves no load whose tables are gone.
    """
    remove_folder(spark, f"{root}/loads")

    def create(table: str) -> None:
        remove_folder(spark, f"{root}/{table}")
        make_folder(spark, f"{root}/{table}")

    for table in [*TABLES, *(f"{t}_parts" for t in NUMBERED), "quarantine", "peak_states"]:
        create(table)
    make_folder(spark, f"{root}/loads")


def _no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def each(write: Callable[[str], None], tables: Iterable[str]) -> None:
    """Submit one independent write per table and wait for all; the first error is raised.

    The threads have this one's job group, pool and local properties.
    """
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max_workers=8) as pool:
        for done in [pool.submit(inherit(write), t) for t in tables]:
            done.result()


def _with_load(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField("load", StringType())])


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select a table's columns by name, in its types."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in TABLES[table].fields])


def check_load_name(load: str) -> None:
    if not re.fullmatch(r"[\w.-]+", load):
        raise ValueError(f"load name {load!r} is not fit for a folder name")


def append_load(
    root: str, load: str, tables: dict[str, DataFrame], report: DataFrame, written: Collection[str] = ()
) -> None:
    """Write one load's rows to every table, then the report that makes them count.

    A table not given gets no rows, so that nothing an unfinished run of this
    load left there can come to light; tables in ``written`` have theirs. A
    finished load is never written again.
    """
    check_load_name(load)
    if is_loaded(report.sparkSession, root, load):
        raise ValueError(f"load {load!r} is in the warehouse already")

    def write(table: str) -> None:
        df = tables[table] if table in tables else _no_rows(report.sparkSession, TABLES[table])
        write_rows(root, load, table, df)

    each(write, [t for t in TABLES if t not in written])
    report.select(*LOADS.names).write.mode("overwrite").parquet(f"{root}/loads/load={load}")


def is_loaded(spark: SparkSession, root: str, load: str) -> bool:
    return not read_loads(spark, root).filter(F.col("load") == load).isEmpty()


def write_rows(root: str, load: str, table: str, df: DataFrame, mode: str = "overwrite") -> DataFrame:
    """Put a load's rows into a table, unseen until the load is finished; the rows as written.

    Columns of BESIDE, if ``df`` has them, go into the same files in the same pass;
    readers of the table do not see them.
    """
    path = f"{root}/{table}/load={load}"
    fields = [*TABLES[table].fields, *(df.schema[c] for c in BESIDE if c in df.columns)]
    df.select(*[F.col(f.name).cast(f.dataType) for f in fields]).write.mode(mode).option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(StructType(fields)).parquet(path)


def write_states(root: str, load: str, states: DataFrame, mode: str = "overwrite") -> None:
    """Keep the states of a load's peaks, unseen until the load is finished."""
    states.write.mode(mode).option("compression", COMPRESSION).parquet(f"{root}/peak_states/load={load}")


def read_states(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The states that finished loads keep, with the load's name."""
    make_folder(spark, f"{root}/peak_states")
    states = spark.read.schema(_with_load(schema)).parquet(f"{root}/peak_states")
    return states.join(F.broadcast(read_loads(spark, root).select("load")), "load", "left_semi")


def number_parts(root: str, load: str, table: str, rows: DataFrame, after: int) -> None:
    """Give a load's rows dense ids from ``after + 1``.

    ``rows`` as written, where the id is a place: the number of the task that wrote
    the row, and the row's in that task. Only how many rows each task wrote is
    counted, and only that passes through a window without a key.
    """
    sizes = rows.select(F.shiftright(NUMBERED[table], PLACE_BITS).alias("part")).groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("n").over(before), F.lit(0)) + F.lit(after + 1)
    sizes.select("part", first.cast("long").alias("first_id")).write.mode("overwrite").parquet(f"{root}/{table}_parts/load={load}")


def write_quarantine(root: str, load: str, rows: DataFrame) -> None:
    rows.select(*QUARANTINE.names).write.mode("overwrite").option("compression", COMPRESSION).parquet(f"{root}/quarantine/load={load}")


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """The rows that did not fit, of finished and of rejected loads, with the load's name."""
    make_folder(spark, f"{root}/quarantine")
    return spark.read.schema(_with_load(QUARANTINE)).parquet(f"{root}/quarantine")
