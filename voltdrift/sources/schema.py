"""The snowflake schema and the layout of the CSV frames that feed it.

Fixed values: table, column and header names (with their spellings) are those
of the instrument database and its exports.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

TEXT, REAL, SMALL, INT, BIG = StringType(), FloatType(), ShortType(), IntegerType(), LongType()
TIMESTAMP = TimestampNTZType()


def struct(**columns: DataType) -> StructType:
    return StructType([StructField(name, type_) for name, type_ in columns.items()])


TABLES: dict[str, StructType] = {
    "idl": struct(idl_id=BIG, idl_value=REAL, concentration_pg=REAL),
    "gc_method": struct(
        gc_method_id=TEXT, splitratio=SMALL, chromatrography=TEXT, runtime_min=REAL
    ),
    "ms_method": struct(
        ms_method_id=TEXT, acquisitionrate=SMALL, massrange_bottom=SMALL, massrange_top=SMALL,
        extractionfrequency=REAL, detectoroffset_volts=SMALL,
    ),
    "dynamicrange": struct(
        dr_id=BIG, ordersofmagnitude=REAL, concrange_pg_low=REAL, concrange_pg_high=REAL,
        correlation_coefficient_r=REAL,
    ),
    "dataset": struct(
        dataset_id=TEXT, instrument=TEXT, idl_id=BIG, gc_method_id=TEXT, ms_method_id=TEXT,
        dr_id=BIG,
    ),
    "ionstats": struct(ionstats_id=BIG, voltage=REAL, areaperion=REAL),
    "sample": struct(
        sample_id=BIG, datetimestamp=TIMESTAMP, sampletype=TEXT, samplename=TEXT,
        ionstats_id=BIG, dataset_id=TEXT,
    ),
    "peaktable": struct(
        peaktable_id=BIG, analyte=TEXT, dataprocessingtype=TEXT, area=BIG, height=BIG,
        fwhh_s=REAL, similairity=SMALL, rt_1d=REAL, rt_2d=REAL, peak_sn=INT, quant_sn=INT,
        concentration_pg=REAL, sample_id=BIG,
    ),
}

# Text columns of limited length.
LENGTHS: dict[str, dict[str, int]] = {
    "dataset": {"instrument": 3},
    "gc_method": {"chromatrography": 2},
}

PRIMARY_KEYS: dict[str, str] = {
    "idl": "idl_id",
    "gc_method": "gc_method_id",
    "ms_method": "ms_method_id",
    "dynamicrange": "dr_id",
    "dataset": "dataset_id",
    "ionstats": "ionstats_id",
    "sample": "sample_id",
    "peaktable": "peaktable_id",
}

# (child table, foreign key, parent table); the parent's primary key has the same name.
FOREIGN_KEYS: list[tuple[str, str, str]] = [
    ("dataset", "idl_id", "idl"),
    ("dataset", "gc_method_id", "gc_method"),
    ("dataset", "ms_method_id", "ms_method"),
    ("dataset", "dr_id", "dynamicrange"),
    ("sample", "ionstats_id", "ionstats"),
    ("sample", "dataset_id", "dataset"),
    ("peaktable", "sample_id", "sample"),
]

# CSV header -> (column, type) per exported frame. Detector voltage and area per
# ion stay text: only measurement samples carry numbers there.
FRAMES: dict[str, dict[str, tuple[str, str]]] = {
    "PeakTable": {
        "Name": ("analyte", "string"),
        "Type": ("dataprocessingtype", "string"),
        "Area": ("area", "bigint"),
        "Height": ("height", "bigint"),
        "FWHH (s)": ("fwhh_s", "float"),
        "Similarity": ("similairity", "smallint"),
        "RT_1D": ("rt_1d", "float"),
        "RT_2D": ("rt_2d", "float"),
        "Peak S/N": ("peak_sn", "int"),
        "Quant S/N": ("quant_sn", "int"),
        "Sample": ("samplename", "string"),
        "Concentration_pg": ("concentration_pg", "float"),
    },
    "Sample": {
        "index": ("index", "string"),
        "Type": ("sampletype", "string"),
        "Name": ("samplename", "string"),
        "Status": ("status", "string"),
        "Chromatographic Method": ("gc_method_id", "string"),
        "MS Method": ("ms_method_id", "string"),
        "DateTime": ("datetimestamp", "timestamp_ntz"),
        "DataSet": ("dataset", "string"),
        "Instrument": ("instrument", "string"),
        "DetectorVoltage": ("detectorvoltage", "string"),
        "AreaPerIon": ("areaperion", "string"),
    },
    "IDL": {
        "Concentration": ("concentration_pg", "float"),
        "IDL": ("idl_value", "float"),
    },
    "GC": {
        "GC_Method_id": ("gc_method_id", "string"),
        "SplitRatio": ("splitratio", "smallint"),
        "Chromatography": ("chromatrography", "string"),
        "RunTime_min": ("runtime_min", "float"),
    },
    "MS": {
        "MS_Method_id": ("ms_method_id", "string"),
        "AcquisitionRate": ("acquisitionrate", "smallint"),
        "MassRange_Bottom": ("massrange_bottom", "smallint"),
        "MassRange_Top": ("massrange_top", "smallint"),
        "ExtractionFrequency": ("extractionfrequency", "float"),
        "DetectorOffset_Volts": ("detectoroffset_volts", "smallint"),
    },
    "DR": {
        "OrdersOfMagnitude": ("ordersofmagnitude", "float"),
        "ConcRange_pg_Low": ("concrange_pg_low", "float"),
        "ConcRange_pg_High": ("concrange_pg_high", "float"),
        "Correlation_Coefficient_r": ("correlation_coefficient_r", "float"),
    },
}

# Words the instrument software writes.
DETECTOR_MEASUREMENT = "Detector Measurement"
GAIN_OPTIMIZATION = "Gain Optimization"
TARGET = "Target"
UNKNOWN = "Unknown"
NO_INSTRUMENT = "False"
