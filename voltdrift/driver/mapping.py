"""The driver's star-schema tables seen as instrument tables and exports.

Only expressions over whole tables; the SQL side states the same ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltdrift.sources.schema import FRAMES
from voltdrift.sources.tables import InstrumentTables


# Stated, so that opening a table costs no job.
SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE,"
    " c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,"
    " l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,"
    " l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def set_id(key: str) -> str:
    return (
        f"concat(if({key} % 2 = 0, 'Alk', 'OFN'), '-', lpad(cast({key} AS string), 6, '0'))"
    )


SAMPLE_TYPE = """decode(o_orderstatus,
    'F', 'Detector Measurement', 'O', 'Gain Optimization', 'P', 'Sample')"""
SAMPLE_NAME = """concat('Alk-', if(o_orderpriority < '3', '1', '5'), 'pg',
    if(o_orderkey % 3 = 0, '', concat(':', o_orderkey % 3)))"""
MEASURED = "o_orderstatus IN ('F', 'O')"
VOLTAGE = "1500 + o_custkey % 4 * 50"
INSTRUMENT = "if(c_mktsegment IN ('AUTOMOBILE', 'BUILDING'), 'PV1', 'PV2')"
ANALYTE = """decode(l_returnflag, 'A', 'OFN', 'R', 'Perfluoronaphthalene', 'N',
    decode(l_linenumber, 4, 'Tetradecane (C14)', 5, 'Eicosane (C20)', 6, 'Triacontane (C30)',
        'Tetradecane'))"""
PROCESSING = "decode(l_linestatus, 'O', 'Unknown', 'F', 'Target')"


def instrument_tables(spark: SparkSession, sf_dir: str) -> InstrumentTables:
    nation, customer = read(spark, sf_dir, "nation"), read(spark, sf_dir, "customer")
    return InstrumentTables(
        idl=customer.selectExpr(
            "c_custkey AS idl_id", "c_acctbal / 1000000 AS idl_value",
            "float(0.02) AS concentration_pg",
        ),
        gc_method=nation.selectExpr(
            "string(n_nationkey) AS gc_method_id", "smallint(NULL) AS splitratio", "'1D' AS chromatrography",
            "float(NULL) AS runtime_min",
        ),
        ms_method=nation.selectExpr(
            "n_nationkey AS ms_method_id", "smallint(NULL) AS acquisitionrate",
            "smallint(NULL) AS massrange_bottom", "smallint(NULL) AS massrange_top",
            "float(NULL) AS extractionfrequency", "n_regionkey * 100 AS detectoroffset_volts",
        ),
        dynamicrange=read(spark, sf_dir, "supplier").selectExpr(
            "s_suppkey AS dr_id", "s_acctbal / 1000 AS ordersofmagnitude",
            "s_acctbal / 100000 AS concrange_pg_low", "s_acctbal * 2 AS concrange_pg_high",
            "s_acctbal / 10000 AS correlation_coefficient_r",
        ),
        dataset=customer.selectExpr(
            f"{set_id('c_custkey')} AS dataset_id", f"{INSTRUMENT} AS instrument",
            "if(c_custkey % 3 = 0, NULL, c_custkey) AS idl_id", "string(c_nationkey) AS gc_method_id",
            "c_nationkey AS ms_method_id", "if(c_custkey % 4 = 0, NULL, c_custkey % 10) AS dr_id",
        ),
        ionstats=ion_stats(spark, sf_dir),
        sample=samples(spark, sf_dir),
        peaktable=read(spark, sf_dir, "lineitem").selectExpr(
            "bigint(NULL) AS peaktable_id", f"{ANALYTE} AS analyte",
            f"{PROCESSING} AS dataprocessingtype", "floor(l_extendedprice) AS area",
            "bigint(l_quantity * 100) AS height", "float(l_tax) AS fwhh_s",
            "smallint((l_linenumber - 1) * 150) AS similairity", "float(NULL) AS rt_1d",
            "float(NULL) AS rt_2d", "int(l_suppkey) AS peak_sn", "int(l_partkey) AS quant_sn",
            "l_discount AS concentration_pg", "l_orderkey AS sample_id",
        ),
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS sample_id", "o_orderdate AS datetimestamp", f"{SAMPLE_TYPE} AS sampletype",
        f"{SAMPLE_NAME} AS samplename", f"if({MEASURED}, o_orderkey, NULL) AS ionstats_id",
        f"{set_id('o_custkey')} AS dataset_id",
    )


def ion_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").filter(MEASURED).selectExpr(
        "o_orderkey AS ionstats_id", f"double({VOLTAGE}) AS voltage", "o_totalprice AS areaperion"
    )


def export_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The same campaign as the instrument would export it, headers and all.

    Injections have names of their own here, since peaks refer to samples by
    name. Samples of status P come from no instrument. Data sets in debt have no
    detection limit, households no dynamic range.
    """
    nation, customer = read(spark, sf_dir, "nation"), read(spark, sf_dir, "customer")
    supplier, orders = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "orders")
    lineitem = read(spark, sf_dir, "lineitem")
    dataset = f"{set_id('c_custkey')} AS DataSet"
    with_nation = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    frames = {
        "Sample": orders.join(with_nation, orders.o_custkey == customer.c_custkey).selectExpr(
            "o_orderkey AS index", f"{SAMPLE_TYPE} AS Type",
            "concat('Inj-', o_orderkey) AS Name", "'Done' AS Status",
            "n_name AS `Chromatographic Method`", "concat('MS ', n_name) AS `MS Method`",
            "string(o_orderdate) AS DateTime", dataset,
            f"if({MEASURED}, {INSTRUMENT}, 'False') AS Instrument",
            f"if({MEASURED}, string({VOLTAGE}), NULL) AS DetectorVoltage",
            f"if({MEASURED}, string(o_totalprice), NULL) AS AreaPerIon",
        ),
        "PeakTable": lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).selectExpr(
            f"{set_id('o_custkey')} AS DataSet", f"{ANALYTE} AS Name", f"{PROCESSING} AS Type",
            "floor(l_extendedprice) AS Area", "bigint(l_quantity * 100) AS Height",
            "l_tax AS `FWHH (s)`", "(l_linenumber - 1) * 150 AS Similarity",
            "string(NULL) AS RT_1D", "string(NULL) AS RT_2D", "l_suppkey AS `Peak S/N`",
            "l_partkey AS `Quant S/N`", "concat('Inj-', l_orderkey) AS Sample",
            "l_discount AS Concentration_pg",
        ),
        "IDL": customer.filter("c_acctbal > 0").selectExpr(
            dataset, "0.02 AS Concentration", "c_acctbal / 1000000 AS IDL"
        ),
        "GC": with_nation.selectExpr(
            dataset, "n_name AS GC_Method_id", "10 AS SplitRatio", "'1D' AS Chromatography",
            "7.5 AS RunTime_min",
        ),
        "MS": with_nation.selectExpr(
            dataset, "concat('MS ', n_name) AS MS_Method_id", "17 AS AcquisitionRate",
            "50 AS MassRange_Bottom", "500 AS MassRange_Top", "30 AS ExtractionFrequency",
            "n_regionkey * 100 AS DetectorOffset_Volts",
        ),
        "DR": customer.filter("c_mktsegment <> 'HOUSEHOLD'")
        .join(supplier, customer.c_custkey % 10 == supplier.s_suppkey)
        .selectExpr(
            dataset, "s_acctbal / 1000 AS OrdersOfMagnitude",
            "s_acctbal / 100000 AS ConcRange_pg_Low", "s_acctbal * 2 AS ConcRange_pg_High",
            "s_acctbal / 10000 AS Correlation_Coefficient_r",
        ),
    }
    assert set(frames) == set(FRAMES)
    return frames


def damaged_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The campaign's export with cells that do not fit, and peaks of injections that are nowhere."""
    frames = export_frames(spark, sf_dir)
    number = "bigint(substring({name}, 5, 20))"
    sample, peak = number.format(name="Name"), number.format(name="Sample")
    return frames | {
        "Sample": frames["Sample"].withColumns(
            {
                "DateTime": F.expr(f"if({sample} % 50 = 0, concat('about ', DateTime), DateTime)"),
                "AreaPerIon": F.expr(f"if(AreaPerIon IS NOT NULL AND {sample} % 60 = 0, 'high', AreaPerIon)"),
            }
        ),
        "PeakTable": frames["PeakTable"].withColumns(
            {
                "Area": F.expr("if(`Quant S/N` % 40 = 0, concat('>', Area), string(Area))"),
                "Sample": F.expr(f"if({peak} % 70 = 0, concat('Lost-', {peak}), Sample)"),
            }
        ),
        "IDL": frames["IDL"].withColumn("IDL", F.expr("if(bigint(substring(DataSet, 5, 20)) % 30 = 0, 'none', string(IDL))")),
    }
