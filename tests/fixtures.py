"""Small hand-made tables in the real schema."""

from datetime import datetime, timedelta

from voltdrift.sources.schema import TABLES
from voltdrift.sources.tables import InstrumentTables

START = datetime(2018, 1, 15, 8, 0, 0)


def at(minutes):
    return START + timedelta(minutes=minutes)


def make_tables(spark, **rows):
    """Tables from lists of tuples (or dicts); the tables not named are empty."""
    frames = {}
    for name, schema in TABLES.items():
        given = [
            tuple(r.get(c) for c in schema.names) if isinstance(r, dict) else r
            for r in rows.get(name, [])
        ]
        frames[name] = spark.createDataFrame(given, schema)
    return InstrumentTables(**frames)


def peak(sample_id, analyte="OFN", kind="Target", pg=0.02, **values):
    return {
        "sample_id": sample_id, "analyte": analyte, "dataprocessingtype": kind,
        "concentration_pg": pg, **values,
    }


def sample(sample_id, dataset_id, minutes=0, kind="Sample", name="s", ionstats_id=None):
    return (sample_id, None if minutes is None else at(minutes), kind, name, ionstats_id, dataset_id)


def dataset(dataset_id, instrument="PV1", ms="m0", idl_id=None, dr_id=None):
    return (dataset_id, instrument, idl_id, None, ms, dr_id)


def method(ms_method_id="m0", offset=0):
    return (ms_method_id, 17, 50, 500, 30.0, offset)


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
