"""The same queries as SQL over the driver's tables, written independently."""

from __future__ import annotations


def set_id(key: str) -> str:
    return (
        f"(CASE WHEN {key} % 2 = 0 THEN 'Alk' ELSE 'OFN' END || '-' ||"
        f" lpad(CAST({key} AS VARCHAR), 6, '0'))"
    )


INSTRUMENT = "CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'PV1' ELSE 'PV2' END"
SAMPLE_TYPE = """CASE o_orderstatus WHEN 'F' THEN 'Detector Measurement'
        WHEN 'O' THEN 'Gain Optimization' WHEN 'P' THEN 'Sample' END"""
SAMPLE_NAME = """('Alk-' || CASE WHEN o_orderpriority < '3' THEN '1' ELSE '5' END || 'pg' ||
        CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE ':' || CAST(o_orderkey % 3 AS VARCHAR) END)"""
ANALYTE = """CASE l_returnflag WHEN 'A' THEN 'OFN' WHEN 'R' THEN 'Perfluoronaphthalene'
        WHEN 'N' THEN CASE l_linenumber WHEN 4 THEN 'Tetradecane (C14)' WHEN 5 THEN 'Eicosane (C20)'
            WHEN 6 THEN 'Triacontane (C30)' ELSE 'Tetradecane' END END"""

TABLES = f"""
m_method AS (
    SELECT n_nationkey AS ms_method_id, n_regionkey * 100 AS offset_volts FROM nation),
m_dataset AS (
    SELECT {set_id('c_custkey')} AS dataset_id, {INSTRUMENT} AS inst, c_nationkey AS ms_method_id,
        CASE WHEN c_custkey % 3 <> 0 THEN c_custkey END AS idl_id,
        CASE WHEN c_custkey % 4 <> 0 THEN c_custkey % 10 END AS dr_id
    FROM customer),
m_set AS (
    SELECT dataset_id, inst, offset_volts, idl_id, dr_id
    FROM m_dataset JOIN m_method USING (ms_method_id)),
m_idl AS (SELECT c_custkey AS idl_id, c_acctbal / 1000000 AS idl FROM customer),
m_sample AS (
    SELECT o_orderkey AS sample_id, o_orderdate AS ts, {SAMPLE_TYPE} AS sampletype,
        {SAMPLE_NAME} AS samplename, {set_id('o_custkey')} AS dataset_id,
        CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderkey END AS ionstats_id
    FROM orders),
m_ion AS (
    SELECT o_orderkey AS ionstats_id, CAST(1500 + (o_custkey % 4) * 50 AS DOUBLE) AS voltage,
        o_totalprice AS api
    FROM orders WHERE o_orderstatus IN ('F', 'O')),
m_peak AS (
    SELECT l_orderkey AS sample_id, {ANALYTE} AS analyte,
        CASE l_linestatus WHEN 'O' THEN 'Unknown' WHEN 'F' THEN 'Target' END AS kind,
        CAST(floor(l_extendedprice) AS BIGINT) AS area, CAST(l_quantity * 100 AS BIGINT) AS height,
        l_partkey AS quant_sn, (l_linenumber - 1) * 150 AS similarity, l_discount AS pg
    FROM lineitem)"""


def stats(concentration: float, analytes: str) -> str:
    """R2 as one CTE named ``report``."""
    masked = [
        ("area", "Unknown", 0, 0), ("height", "Unknown", 0, 0),
        ("quant_sn", "Unknown", 2, 3), ("similarity", "Target", 1, 1),
    ]
    value = {m: f"CASE WHEN kind = '{kind}' THEN NULL ELSE {m} END" for m, kind, _, _ in masked}
    columns = ",\n        ".join(
        f"round(avg({value[m]}), {a}) AS ave_{m}, round(stddev_samp({value[m]}), {s}) AS stddev_{m},"
        f" round(stddev_samp({value[m]}) / nullif(avg({value[m]}), 0) * 100, 2) AS rsd_{m}"
        for m, _, a, s in masked
    )
    return f"""WITH {TABLES},
report AS (
    SELECT inst, offset_volts AS det_offset,
        {columns}
    FROM m_peak JOIN m_sample USING (sample_id) JOIN m_set USING (dataset_id)
    WHERE analyte IN ({analytes}) AND pg = {concentration}
    GROUP BY inst, offset_volts)
"""


OFN = "'OFN', 'Perfluoronaphthalene'"
TETRADECANE = "'Tetradecane', 'Tetradecane (C14)'"

# Legends, axis labels, catalogue.
LEGEND = "CASE inst WHEN 'PV1' THEN 'Peg BT - PV1' WHEN 'PV2' THEN 'Peg BT - PV2' END"


def series(concentration: float, analytes: str, masses: str) -> str:
    points = "\nUNION ALL\n".join(
        f"SELECT inst, {LEGEND} AS series, det_offset AS x, '{metric}' AS metric,"
        f" '{label}' AS axis_label, '{masses}' AS quant_masses, '{kind}' AS kind,"
        f" coalesce({metric}, 0) AS y FROM report"
        for metric, label, kind in (
            ("ave_area", "Average Area", "Target"), ("ave_height", "Average Height", "Target"),
            ("ave_quant_sn", "Average Quant S/N", "Target"),
            ("ave_similarity", "Average Similarity", "Unknown"),
        )
    )
    return stats(concentration, analytes) + points


BUCKETS = f"""WITH {TABLES},
dm AS (
    SELECT dataset_id, voltage, api,
        row_number() OVER (PARTITION BY dataset_id ORDER BY ts, sample_id) AS rn
    FROM m_sample JOIN m_ion USING (ionstats_id)
    WHERE sampletype = 'Detector Measurement' AND dataset_id LIKE 'Alk%'),
buckets AS (
    SELECT dataset_id, voltage, CAST(floor((rn - 1) / 3) AS BIGINT) AS dm_api_group,
        round(avg(api), 4) AS ave_api
    FROM dm GROUP BY ALL),
named AS (
    SELECT dataset_id,
        CASE WHEN right(samplename, 2) LIKE ':%' THEN left(samplename, -2)
            ELSE samplename END AS s_name,
        row_number() OVER (PARTITION BY dataset_id ORDER BY ts, sample_id) AS rn
    FROM m_sample WHERE samplename LIKE 'Alk%'),
reps AS (
    SELECT dataset_id, s_name, count(s_name) AS reps, CAST(sum(rn) AS BIGINT) AS seq
    FROM named GROUP BY dataset_id, s_name),
injected AS (
    SELECT dataset_id, s_name,
        CAST(sum(reps) OVER w AS BIGINT) AS cumulative_inj,
        row_number() OVER (PARTITION BY dataset_id ORDER BY seq, s_name) AS position
    FROM reps
    WINDOW w AS (PARTITION BY dataset_id ORDER BY seq, s_name
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
curve AS (
    SELECT b.dataset_id AS dataset, inst, offset_volts, dm_api_group, s_name AS sample,
        coalesce(CAST(regexp_extract(s_name, '([0-9.]+)pg', 1) AS DOUBLE), 0) AS conc_pg,
        coalesce(CASE WHEN dm_api_group > names THEN total ELSE cumulative_inj END, 0) AS cumulative_inj,
        voltage AS det_volts, ave_api
    FROM buckets b JOIN m_set USING (dataset_id)
    LEFT JOIN injected i ON i.dataset_id = b.dataset_id AND i.position = b.dm_api_group
    LEFT JOIN (SELECT dataset_id, count(*) AS names, CAST(sum(reps) AS BIGINT) AS total
        FROM reps GROUP BY dataset_id) a ON a.dataset_id = b.dataset_id)
"""


def optimizations(prefix: str) -> str:
    return f"""go AS (
    SELECT dataset_id,
        sum(CASE WHEN rn = 1 THEN voltage END) AS starting_go_dv,
        sum(CASE WHEN rn = 1 THEN api END) AS starting_go_api,
        sum(CASE WHEN rn = 2 THEN voltage END) AS ending_go_dv,
        sum(CASE WHEN rn = 2 THEN api END) AS ending_go_api
    FROM (
        SELECT dataset_id, voltage, api,
            row_number() OVER (PARTITION BY dataset_id ORDER BY ts, sample_id) AS rn
        FROM m_sample JOIN m_ion USING (ionstats_id)
        WHERE sampletype = 'Gain Optimization' AND dataset_id LIKE '{prefix}%')
    GROUP BY dataset_id)"""


R7 = f"""WITH {TABLES}, {optimizations('Alk')},
report AS (
    SELECT dataset_id AS setname, inst, offset_volts, starting_go_dv, starting_go_api,
        ending_go_dv, ending_go_api
    FROM go JOIN m_set USING (dataset_id))
"""

R8_ROWS = f"""WITH {TABLES}, {optimizations('OFN')},
dm AS (
    SELECT dataset_id, voltage,
        CAST(avg(CASE WHEN rn <= 3 THEN api END) AS FLOAT) AS ave_start,
        CAST(avg(CASE WHEN rn >= 4 THEN api END) AS FLOAT) AS ave_end
    FROM (
        SELECT dataset_id, voltage, api,
            row_number() OVER (PARTITION BY dataset_id ORDER BY ts, sample_id) AS rn
        FROM m_sample JOIN m_ion USING (ionstats_id)
        WHERE sampletype = 'Detector Measurement' AND dataset_id LIKE 'OFN%')
    GROUP BY dataset_id, voltage),
report AS (
    SELECT inst, offset_volts, dataset_id AS setname, voltage AS dm_dv,
        starting_go_dv AS start_go_dv, starting_go_api AS start_go_api,
        round(ave_start, 1) AS ave_start_dm_api, round(ave_end, 1) AS ave_end_dm_api,
        ending_go_dv AS end_go_dv, ending_go_api AS end_go_api
    FROM dm JOIN go USING (dataset_id) JOIN m_set USING (dataset_id))
"""

R8 = R8_ROWS + "SELECT * EXCLUDE (setname, dm_dv) FROM report"


def _sensitivity() -> str:
    value = {
        "area": "CASE WHEN kind = 'Target' THEN area END",
        "quant_sn": "CASE WHEN kind = 'Target' THEN quant_sn END",
        "similarity": "nullif(similarity, 0)",
    }
    columns = ", ".join(
        f"avg({v}) AS a_{m}, stddev_samp({v}) AS s_{m}" for m, v in value.items()
    )
    shown = ", ".join(
        f"round(a_{m}, 4) AS ave_{m}, round(s_{m}, 4) AS stddev_{m},"
        f" round(s_{m} / nullif(a_{m}, 0) * 100, 3) AS rsd_{m}"
        for m in value
    )
    return f"""WITH {TABLES},
per_set AS (
    SELECT dataset_id, CASE WHEN analyte = 'Perfluoronaphthalene' THEN 'OFN' ELSE analyte END AS an,
        pg, {columns}
    FROM m_peak JOIN m_sample USING (sample_id)
    WHERE pg = 0.02 AND (analyte = 'OFN' OR analyte = 'Perfluoronaphthalene')
    GROUP BY 1, 2, 3),
report AS (
    SELECT inst, offset_volts, dataset_id AS setname, idl, {shown}
    FROM per_set JOIN m_set USING (dataset_id) JOIN m_idl USING (idl_id))
"""


R9 = _sensitivity()

ION_ROWS = f"""
    SELECT o_orderkey, {set_id('o_custkey')} AS dataset_id, {SAMPLE_TYPE} AS sampletype,
        {SAMPLE_NAME} AS samplename, o_orderdate AS datetimestamp, o_orderstatus,
        CAST(1500 + (o_custkey % 4) * 50 AS FLOAT) AS voltage,
        CAST(CAST(o_totalprice AS VARCHAR) AS FLOAT) AS areaperion
    FROM orders"""

ORACLES: dict[str, str] = {
    "r1_unique_concentrations": f"""WITH {TABLES}
SELECT DISTINCT pg AS concentration_pg FROM m_peak WHERE analyte = 'OFN' ORDER BY 1""",
    "r2_replicate_stats": stats(0.05, OFN) + "SELECT * FROM report ORDER BY det_offset, inst",
    "r3_ofn_stats": stats(0.02, OFN) + "SELECT * FROM report ORDER BY det_offset, inst",
    "r4_tetradecane_stats": stats(0.05, TETRADECANE)
    + "SELECT * FROM report ORDER BY det_offset, inst",
    "r5_dm_bucket_mean": BUCKETS
    + """SELECT dataset_id AS setname, voltage AS detectorvoltage, ave_api, dm_api_group
FROM buckets JOIN m_dataset USING (dataset_id)
ORDER BY setname, dm_api_group, detectorvoltage""",
    "r6_injection_reps": BUCKETS
    + """SELECT dataset_id AS setname, inst, offset_volts, s_name, reps, seq
FROM reps JOIN m_set USING (dataset_id) ORDER BY setname, seq, s_name""",
    "r7_go_start_end": R7 + "SELECT * FROM report ORDER BY inst, offset_volts, setname",
    "r8_dm_go_summary": R8,
    "r9_sensitivity": R9 + "SELECT * EXCLUDE (setname) FROM report ORDER BY offset_volts, inst",
    "r10_linearity": f"""WITH {TABLES}
SELECT inst, offset_volts, s_acctbal / 1000 AS orders, s_acctbal / 100000 AS concrange_pg_low,
    s_acctbal * 2 AS concrange_pg_high, s_acctbal / 10000 AS r
FROM m_set JOIN supplier ON s_suppkey = dr_id""",
    "d1_drift_curve": BUCKETS + "SELECT * FROM curve",
    "d2_metric_series": series(0.05, OFN, "Quant Mass = 271.99"),
    "d3_metric_series_preset": series(
        0.05, TETRADECANE, "Quant Masses = SUM(57.07, 71.09, 81.10)"
    ),
    "d4_analyte_catalogue": f"""WITH {TABLES},
catalogue (analyte_group, analyte, analyte_id, quant_masses) AS (VALUES
    ('OFN', 'OFN', 'OFN', 'Quant Mass = 271.99'),
    ('C14', 'Tetradecane (C14)', 'Tetradecane', 'Quant Masses = SUM(57.07, 71.09, 81.10)'),
    ('C20', 'Eicosane (C20)', 'Eicosane', 'Quant Masses = SUM(57.07, 71.09, 81.10)'),
    ('C30', 'Triacontane (C30)', 'Triacontane', 'Quant Masses = SUM(57.07, 71.09, 81.10)'))
SELECT DISTINCT analyte_group, analyte, analyte_id, quant_masses, pg AS concentration_pg
FROM m_peak JOIN catalogue USING (analyte)""",
    "d5_curve_labels": BUCKETS
    + """, third AS (
    SELECT dataset, 'Offset: +' || offset_volts || ' v = ' || det_volts || ' v' AS curve_label
    FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY dm_api_group, det_volts) AS n
          FROM curve)
    WHERE n = 3)
SELECT inst, dataset, curve_label, dm_api_group, cumulative_inj AS x, ave_api AS y
FROM curve LEFT JOIN third USING (dataset)""",
    "d6_idl_vs_offset": R9
    + f"""SELECT inst, {LEGEND} AS series, offset_volts AS x, round(idl, 8) AS y FROM report""",
    "d7_go_delta": R7
    + f"""SELECT inst, {LEGEND} AS series, offset_volts AS x,
    ending_go_dv - starting_go_dv AS y FROM report""",
    "d8_report_export": R7
    + """SELECT row_number() OVER (ORDER BY inst, offset_volts, setname) - 1 AS row_index, *
FROM report""",
    "d8_ostat": R8_ROWS
    + """SELECT row_number() OVER (ORDER BY offset_volts, inst, setname, dm_dv) - 1 AS row_index, *
FROM report""",
    "d8_olin": f"""WITH {TABLES},
report AS (
    SELECT inst, offset_volts, dataset_id AS setname, s_acctbal / 1000 AS orders,
        s_acctbal / 100000 AS concrange_pg_low, s_acctbal * 2 AS concrange_pg_high,
        s_acctbal / 10000 AS r
    FROM m_set JOIN supplier ON s_suppkey = dr_id)
SELECT row_number() OVER (ORDER BY inst, offset_volts, setname) - 1 AS row_index, * FROM report""",
    "d8_osen": R9
    + """SELECT row_number() OVER (ORDER BY offset_volts, inst, setname) - 1 AS row_index, *
FROM report""",
    "k1_csv_roundtrip": f"""
SELECT {set_id('o_custkey')} AS dataset_id, CAST(o_orderkey AS VARCHAR) AS index,
    {SAMPLE_TYPE} AS sampletype, 'Inj-' || o_orderkey AS samplename, 'Done' AS status,
    n_name AS gc_method_id, 'MS ' || n_name AS ms_method_id, o_orderdate AS datetimestamp,
    CASE WHEN o_orderstatus = 'P' THEN 'False' ELSE {INSTRUMENT} END AS instrument,
    CASE WHEN o_orderstatus <> 'P' THEN CAST(1500 + (o_custkey % 4) * 50 AS VARCHAR) END
        AS detectorvoltage,
    CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS VARCHAR) END AS areaperion,
    FALSE AS _bad
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""",
    "k4_append_roundtrip": f"""WITH {TABLES}
SELECT sample_id, ts AS datetimestamp, sampletype, samplename, ionstats_id, dataset_id
FROM m_sample""",
    "k7_bootstrap": """
SELECT 'idl' AS table_name, CAST(0 AS BIGINT) AS n_rows
UNION ALL SELECT 'gc_method', 0
UNION ALL SELECT 'dynamicrange', 0
UNION ALL SELECT 'ionstats', 0
UNION ALL SELECT 'ms_method', count(*) FROM nation
UNION ALL SELECT 'dataset', count(*) FROM customer
UNION ALL SELECT 'sample', count(*) FROM orders
UNION ALL SELECT 'peaktable', count(*) FROM lineitem""",
    "k7_reset": """
WITH filled AS (
    SELECT 'idl' AS table_name, count(*) AS n_rows FROM customer
    UNION ALL SELECT 'gc_method', count(*) FROM nation
    UNION ALL SELECT 'ms_method', count(*) FROM nation
    UNION ALL SELECT 'dynamicrange', count(*) FROM supplier
    UNION ALL SELECT 'dataset', count(*) FROM customer
    UNION ALL SELECT 'ionstats', count(*) FROM orders WHERE o_orderstatus IN ('F', 'O')
    UNION ALL SELECT 'sample', count(*) FROM orders
    UNION ALL SELECT 'peaktable', count(*) FROM lineitem)
SELECT 'filled' AS step, * FROM filled
UNION ALL SELECT 'reset', table_name, 0 FROM filled
UNION ALL SELECT 'filled again', * FROM filled""",
    "i1_i2_optional_dims": f"""
WITH idl AS (
    SELECT dataset_id, idl_value, 0.02::DOUBLE AS concentration_pg,
        row_number() OVER (ORDER BY dataset_id) AS idl_id
    FROM (SELECT {set_id('o_custkey')} AS dataset_id,
              arg_min(o_totalprice / 1000000, o_orderkey) AS idl_value
          FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)),
dr AS (
    SELECT {set_id('c_custkey')} AS dataset_id, s_acctbal / 1000 AS ordersofmagnitude,
        row_number() OVER (ORDER BY {set_id('c_custkey')}) AS dr_id
    FROM customer JOIN supplier ON s_suppkey = c_custkey % 10 WHERE c_mktsegment <> 'HOUSEHOLD')
SELECT {set_id('c_custkey')} AS dataset_id, idl_id, idl_value, concentration_pg, dr_id,
    ordersofmagnitude
FROM customer LEFT JOIN idl ON idl.dataset_id = {set_id('c_custkey')}
LEFT JOIN dr ON dr.dataset_id = {set_id('c_custkey')}""",
    "i3_methods_insert_if_absent": """
SELECT DISTINCT n_name AS ms_method_id, 17::SMALLINT AS acquisitionrate,
    50::SMALLINT AS massrange_bottom, 500::SMALLINT AS massrange_top,
    30::FLOAT AS extractionfrequency, CAST(n_regionkey * 100 AS SMALLINT) AS detectoroffset_volts
FROM nation JOIN customer ON c_nationkey = n_nationkey WHERE n_regionkey > 1""",
    "i4_dataset_row": f"""WITH {TABLES},
s AS (
    SELECT {set_id('o_custkey')} AS dataset_id, o_orderkey, o_orderpriority, {SAMPLE_TYPE} AS kind,
        CASE o_orderstatus WHEN 'P' THEN 'False' WHEN 'F' THEN 'PV1' ELSE 'PV2' END AS instrument
    FROM orders),
method AS (
    SELECT dataset_id, arg_min(o_orderpriority, o_orderkey) AS gc_method_id,
        arg_min(kind, o_orderkey) AS ms_method_id
    FROM s GROUP BY dataset_id),
seen AS (
    SELECT dataset_id, instrument, min(o_orderkey) AS first_seen FROM s
    WHERE instrument <> 'False' GROUP BY dataset_id, instrument),
inst AS (SELECT dataset_id, arg_max(instrument, first_seen) AS instrument FROM seen GROUP BY dataset_id)
SELECT dataset_id, gc_method_id, method.ms_method_id, instrument, idl_id, dr_id
FROM method LEFT JOIN inst USING (dataset_id) LEFT JOIN m_dataset USING (dataset_id)""",
    "i5_ionstats_extract": f"""
SELECT o_orderkey AS sample_id, voltage, areaperion,
    row_number() OVER (ORDER BY o_orderkey) AS ionstats_id
FROM ({ION_ROWS}) WHERE o_orderstatus IN ('F', 'O')""",
    "i6_sample_load": f"""
WITH numbered AS (
    SELECT *, row_number() OVER (ORDER BY dataset_id, o_orderkey) AS sample_id FROM ({ION_ROWS})),
ion AS (
    SELECT sample_id, row_number() OVER (ORDER BY sample_id) AS ionstats_id
    FROM numbered WHERE o_orderstatus IN ('F', 'O'))
SELECT sample_id, datetimestamp, sampletype, samplename, ionstats_id, dataset_id
FROM numbered LEFT JOIN ion USING (sample_id)""",
    "i7_peak_sample_join": f"""WITH {TABLES}
SELECT s.sample_id, p.analyte, p.area, p.quant_sn, p.pg AS concentration_pg
FROM m_peak p JOIN m_sample own ON own.sample_id = p.sample_id
JOIN m_sample s ON s.dataset_id = own.dataset_id AND s.samplename = own.samplename
WHERE s.ionstats_id IS NOT NULL""",
    "i8_duplicate_dataset": f"""WITH {TABLES}
SELECT DISTINCT dataset_id FROM m_sample
WHERE dataset_id IN (SELECT dataset_id FROM m_dataset WHERE inst = 'PV1')""",
    "i9_fk_violations": f"""WITH {TABLES}
SELECT 'sample' AS child, 'ionstats_id' AS fk, ionstats_id AS key_value, count(*) AS n_rows
FROM m_sample WHERE sampletype = 'Gain Optimization' GROUP BY ionstats_id
UNION ALL
SELECT 'peaktable', 'sample_id', p.sample_id, count(*)
FROM m_peak p JOIN m_sample s USING (sample_id) WHERE s.ionstats_id IS NULL GROUP BY p.sample_id
UNION ALL
SELECT 'dataset', 'dr_id', dr_id, count(*) FROM m_dataset
WHERE dr_id IS NOT NULL
    AND dr_id NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal / 1000 >= 5)
GROUP BY dr_id""",
    "i9_all_edges": f"""WITH {TABLES},
used AS (
    SELECT 'dataset' AS child, 'idl_id' AS fk, CAST(idl_id AS VARCHAR) AS key_value FROM m_dataset
    UNION ALL SELECT 'dataset', 'gc_method_id', CAST(ms_method_id AS VARCHAR) FROM m_dataset
    UNION ALL SELECT 'dataset', 'ms_method_id', CAST(ms_method_id AS VARCHAR) FROM m_dataset
    UNION ALL SELECT 'dataset', 'dr_id', CAST(dr_id AS VARCHAR) FROM m_dataset
        WHERE dr_id NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 3 <> 0)
    UNION ALL SELECT 'sample', 'ionstats_id', CAST(ionstats_id AS VARCHAR) FROM m_sample
    UNION ALL SELECT 'sample', 'dataset_id', dataset_id FROM m_sample
    UNION ALL SELECT 'peaktable', 'sample_id', CAST(sample_id AS VARCHAR) FROM m_peak)
SELECT child, fk, key_value, count(*) AS n_rows FROM used
WHERE key_value IS NOT NULL
    AND (fk = 'dr_id' OR CAST(regexp_extract(key_value, '[0-9]+$') AS BIGINT) % 3 = 0)
GROUP BY ALL""",
    "i11_loaded_tables": f"""WITH {TABLES},
sets AS (SELECT {set_id('c_custkey')} AS dataset_id, * FROM customer JOIN nation ON n_nationkey = c_nationkey),
idl AS (
    SELECT dataset_id, row_number() OVER (ORDER BY dataset_id) AS idl_id,
        CAST(c_acctbal / 1000000 AS FLOAT) AS idl_value
    FROM sets WHERE c_acctbal > 0),
dr AS (
    SELECT dataset_id, row_number() OVER (ORDER BY dataset_id) AS dr_id,
        CAST(s_acctbal / 1000 AS FLOAT) AS orders
    FROM sets JOIN supplier ON s_suppkey = c_custkey % 10 WHERE c_mktsegment <> 'HOUSEHOLD'),
shown AS (SELECT DISTINCT dataset_id FROM m_sample),
used AS (SELECT DISTINCT n_name, n_regionkey FROM sets),
numbered AS (
    SELECT sample_id AS old_id, dataset_id, sampletype,
        row_number() OVER (ORDER BY dataset_id, sample_id) AS sample_id
    FROM m_sample),
ion AS (
    SELECT n.sample_id, row_number() OVER (ORDER BY n.sample_id) AS ionstats_id, voltage
    FROM numbered n JOIN m_ion ON m_ion.ionstats_id = old_id)
SELECT 'idl' AS table_name, count(*) AS n_rows, min(idl_id) AS min_id, max(idl_id) AS max_id,
    CAST(sum(round(CAST(idl_value AS DOUBLE) * 1000000)) AS BIGINT) AS checksum FROM idl
UNION ALL SELECT 'gc_method', count(*), NULL, NULL, CAST(sum(10 + length(n_name)) AS BIGINT) FROM used
UNION ALL SELECT 'ms_method', count(*), NULL, NULL,
    CAST(sum(n_regionkey * 100 + 3 + length(n_name)) AS BIGINT) FROM used
UNION ALL SELECT 'dynamicrange', count(*), min(dr_id), max(dr_id),
    CAST(sum(round(CAST(orders AS DOUBLE) * 1000)) AS BIGINT) FROM dr
UNION ALL SELECT 'dataset', count(*), NULL, NULL,
    CAST(sum(coalesce(idl_id, 0) + 3 * coalesce(dr_id, 0) + 3 + length(n_name)) AS BIGINT)
    FROM shown JOIN sets USING (dataset_id) LEFT JOIN idl USING (dataset_id) LEFT JOIN dr USING (dataset_id)
UNION ALL SELECT 'ionstats', count(*), min(ionstats_id), max(ionstats_id),
    CAST(sum(voltage) AS BIGINT) FROM ion
UNION ALL SELECT 'sample', count(*), min(sample_id), max(sample_id),
    CAST(sum(length(dataset_id) + 3 * (4 + length(CAST(old_id AS VARCHAR)))
        + CASE WHEN ionstats_id IS NULL THEN 0 ELSE 7 END) AS BIGINT)
    FROM numbered LEFT JOIN ion USING (sample_id)
UNION ALL SELECT 'peaktable', count(*), NULL, NULL,
    CAST(sum(area + 3 * height + similarity + 7 * quant_sn) AS BIGINT)
    FROM m_peak""",
    "k1_all_frames": f"""WITH {TABLES},
sets AS (SELECT {set_id('c_custkey')} AS dataset_id, * FROM customer JOIN nation ON n_nationkey = c_nationkey),
dr AS (SELECT CAST(s_acctbal / 1000 AS FLOAT) AS orders FROM sets JOIN supplier ON s_suppkey = c_custkey % 10 WHERE c_mktsegment <> 'HOUSEHOLD')
SELECT 'sample' AS frame, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_bad, CAST(sum(
    CASE WHEN o_orderkey % 10 = 0 THEN 20 + length(CAST(o_orderkey AS VARCHAR)) ELSE 4 END
    + 4 + length(CAST(o_orderkey AS VARCHAR)) + length(n_name)) AS BIGINT) AS checksum
FROM orders JOIN sets ON o_custkey = c_custkey
UNION ALL SELECT 'peaktable', count(*), 0, CAST(sum(floor(l_extendedprice) + CAST(l_quantity * 100 AS BIGINT)
    + (l_linenumber - 1) * 150 + l_suppkey + l_partkey) AS BIGINT) FROM lineitem JOIN orders ON l_orderkey = o_orderkey
UNION ALL SELECT 'idl', count(*), 0, CAST(sum(round(CAST(CAST(c_acctbal / 1000000 AS FLOAT) AS DOUBLE) * 1000000)) AS BIGINT)
    FROM customer WHERE c_acctbal > 0
UNION ALL SELECT 'gc', count(*), 0, CAST(sum(10 + length(n_name)) AS BIGINT) FROM sets
UNION ALL SELECT 'ms', count(*), 0, CAST(sum(n_regionkey * 100 + 500) AS BIGINT) FROM sets
UNION ALL SELECT 'dr', count(*), 0, CAST(sum(round(CAST(orders AS DOUBLE) * 1000)) AS BIGINT) FROM dr""",
    "i11_quarantine": f"""
SELECT 'Sample' AS frame, {set_id('o_custkey')} AS dataset_id, 'DateTime' AS header, 'Inj-' || o_orderkey AS named,
    'about ' || CAST(o_orderdate AS VARCHAR) AS text FROM orders WHERE o_orderkey % 50 = 0
UNION ALL SELECT 'Sample', {set_id('o_custkey')}, 'AreaPerIon', 'Inj-' || o_orderkey, 'high'
FROM orders WHERE o_orderkey % 60 = 0 AND o_orderstatus IN ('F', 'O')
UNION ALL SELECT 'PeakTable', {set_id('o_custkey')}, 'Area', CASE WHEN l_orderkey % 70 = 0 THEN 'Lost-' ELSE 'Inj-' END || l_orderkey,
    '>' || CAST(floor(l_extendedprice) AS BIGINT) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_partkey % 40 = 0
UNION ALL SELECT 'PeakTable', {set_id('o_custkey')}, 'Sample', 'Lost-' || l_orderkey, 'Lost-' || l_orderkey
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_orderkey % 70 = 0
UNION ALL SELECT 'IDL', {set_id('c_custkey')}, 'IDL', NULL, 'none' FROM customer WHERE c_acctbal > 0 AND c_custkey % 30 = 0""",
    # An instrument is known only for data sets with a measurement.
    "i11_staged_load": stats(0.05, OFN).replace(
        "FROM m_dataset JOIN m_method",
        """FROM (
        SELECT * REPLACE (CASE WHEN dataset_id IN (
            SELECT dataset_id FROM m_sample_key WHERE measured) THEN inst END AS inst)
        FROM m_dataset) JOIN m_method""",
    ).replace(
        "m_set AS (",
        f"""m_sample_key AS (
    SELECT {set_id('o_custkey')} AS dataset_id, o_orderstatus IN ('F', 'O') AS measured
    FROM orders),
m_set AS (""",
    )
    + "SELECT * REPLACE (CAST(det_offset AS SMALLINT) AS det_offset) FROM report",
}

# The same reports from the states that loads keep.
ORACLES |= {
    "a12_r1_of_states": ORACLES["r1_unique_concentrations"],
    "a12_r2_of_states": ORACLES["r2_replicate_stats"],
    "a12_r4_of_states": ORACLES["r4_tetradecane_stats"],
    "a12_r9_of_states": ORACLES["r9_sensitivity"],
}
