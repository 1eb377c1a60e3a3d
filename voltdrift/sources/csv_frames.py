"""Reading the instrument's CSV exports as typed frames with row positions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from voltdrift.functions.columns import blank_to_null, text_to
from voltdrift.sources.schema import FRAMES

# Position of a row: file, start of the split in the file, order within the split.
POSITION = ["_file", "_block", "_line"]

# What is kept of a row that does not fit: its data set and place, the headers of the cells
# that do not (none where the line itself is no CSV of the layout), all its cells, the line.
REJECTED = (
    "struct<dataset_id: string, file: string, block: bigint, line: bigint,"
    " problems: array<string>, cells: map<string, string>, text: string>"
)


@dataclass(frozen=True)
class ExportFrames:
    """One DataFrame per exported frame, each with ``dataset_id`` and the
    position columns. IDL, GC, MS and DR may be empty."""

    peaktable: DataFrame
    sample: DataFrame
    idl: DataFrame
    gc: DataFrame
    ms: DataFrame
    dr: DataFrame


def read_export(
    spark: SparkSession, root: str, layout: str = "by_dataset", keep_text: bool = True, multi_line: bool = False
) -> ExportFrames:
    """All six frames under ``root``; the options as for :func:`read_frame`."""
    return ExportFrames(
        **{f.lower(): read_frame(spark, root, f, layout, keep_text=keep_text, multi_line=multi_line) for f in FRAMES}
    )


def read_frame(
    spark: SparkSession, root: str, frame: str, layout: str = "by_dataset",
    timestamp_format: str | None = None, keep_text: bool = False, multi_line: bool = False,
) -> DataFrame:
    """One frame of many datasets.

    ``by_dataset``: ``<root>/<dataset id>/<frame>*.csv``, one folder per export.
    ``by_frame``: ``<root>/<frame>/*.csv``, any number of datasets per file, the
    dataset id in a ``DataSet`` column (added in front, except that the Sample
    frame has its own).

    Cells are read as text, blank means NULL, and cells that do not fit their
    type become NULL with ``_bad`` set on the row, as on lines that are not CSV
    of this layout. ``keep_text`` adds ``_rejected`` (see REJECTED), NULL but on
    such rows, so that whoever writes the rows keeps their text in the same pass.
    With ``multi_line`` quoted cells may hold line breaks; a file is then read by one
    task, as only its start tells which quotes open, and a row's position is its
    place in the file.
    """
    columns = FRAMES[frame]
    headers = list(columns)
    if layout == "by_frame" and "DataSet" not in columns:
        headers = ["DataSet", *headers]
    schema = StructType()
    for header in [*headers, "_corrupt"]:
        schema = schema.add(header, StringType())
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("escape", '"')
        .option("multiLine", multi_line)
    )
    if layout == "by_dataset":
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", f"{frame}*.csv")
        path = root
    else:
        path = f"{root}/{frame}"
    try:
        raw = reader.csv(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        raw = spark.createDataFrame([], schema).withColumn("_metadata", _no_file())

    # The line counter must be taken in the same select as the scan.
    placed = raw.select(
        *[blank_to_null(F.col(f"`{h}`")).alias(f"raw_{i}") for i, h in enumerate(headers)],
        "_corrupt",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    dataset = F.col(f"raw_{headers.index('DataSet')}") if layout == "by_frame" else _folder_name()
    typed, bad = [], F.col("_corrupt").isNotNull() | dataset.isNull()
    unfit = [F.when(dataset.isNull(), "DataSet")]
    for i, header in enumerate(headers):
        if header not in columns:
            continue
        name, type_name = columns[header]
        cell = F.col(f"raw_{i}")
        if type_name == "timestamp_ntz" and timestamp_format:
            value = F.try_to_timestamp(cell, F.lit(timestamp_format)).cast("timestamp_ntz")
        else:
            value = text_to(cell, type_name)
        typed.append(value.alias(name))
        if type_name != "string":
            bad = bad | (cell.isNotNull() & value.isNull())
            unfit.append(F.when(cell.isNotNull() & value.isNull(), header))
    kept = []
    if keep_text:
        cells = F.create_map(*(x for i, header in enumerate(headers) for x in (F.lit(header), F.col(f"raw_{i}"))))
        problems = F.when(F.col("_corrupt").isNull(), F.array_compact(F.array(*unfit)))
        rejected = F.struct(dataset, *(F.col(c) for c in POSITION), F.coalesce(problems, F.array().cast("array<string>")), cells, "_corrupt")
        kept = [F.when(bad, rejected.cast(REJECTED)).alias("_rejected")]
    return placed.select(dataset.alias("dataset_id"), *typed, bad.alias("_bad"), *kept, *POSITION)


def _folder_name():
    """The name of the folder a file lies in, with URI escapes undone."""
    folder = F.regexp_extract("_file", "([^/]+)/[^/]+$", 1)
    return F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))


def _no_file():
    return F.struct(
        F.lit("").alias("file_path"), F.lit(0).cast("bigint").alias("file_block_start")
    )
