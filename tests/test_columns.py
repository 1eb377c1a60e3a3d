"""Column expressions one by one."""

import pytest
from pyspark.sql import functions as F

from voltdrift.functions import columns as c


def value(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()[0]


@pytest.mark.parametrize(
    "name, expected",
    [("Alk-1pg:2", "Alk-1pg"), ("Alk-1pg", "Alk-1pg"), ("Alk-1pg:12", "Alk-1pg:12"),
     (":2", ""), (":", ""), ("", ""), (None, None), ("a:b", "a")],
)
def test_replicate_suffix(spark, name, expected):
    assert value(spark, c.without_replicate_suffix(F.lit(name).cast("string"))) == expected


@pytest.mark.parametrize(
    "name, pair, pg",
    [("Alk1-0.5pg", "Alk1,0.5", 0.5), ("Alk 10 pg", "Alk,10", 10.0), ("Blank", ",", None)],
)
def test_sample_name(spark, name, pair, pg):
    assert value(spark, c.parse_sample_name(F.lit(name))) == pair
    assert value(spark, c.parsed_concentration(F.lit(name))) == pg


def test_sample_name_pattern_is_a_parameter(spark):
    assert value(spark, c.parsed_concentration(F.lit("Alk 7 fg"), r"^(\w+) (\d+) fg")) == 7.0


@pytest.mark.parametrize(
    "text, type_name, expected",
    [("123", "bigint", 123), ("123.0", "bigint", 123), ("2.5", "int", 3), ("-2.5", "int", -3),
     ("1.2e3", "bigint", 1200), ("40000", "smallint", None), ("x", "int", None),
     ("9000000000", "bigint", 9000000000), ("0.5", "float", 0.5), ("n/a", "float", None),
     ("x", "string", "x"), (None, "int", None)],
)
def test_text_to_type(spark, text, type_name, expected):
    assert value(spark, c.text_to(F.lit(text).cast("string"), type_name)) == expected


def test_blank_and_synonym_and_rsd(spark):
    assert value(spark, c.blank_to_null(F.lit("  "))) is None
    assert value(spark, c.blank_to_null(F.lit(" a"))) == " a"
    assert value(spark, c.synonym(F.lit("b"), {"b": "a", "c": "a"})) == "a"
    assert value(spark, c.synonym(F.lit("d"), {"b": "a"})) == "d"
    assert value(spark, c.rsd_percent(F.lit(1.0), F.lit(0.0))) is None
    assert value(spark, c.masked_when(F.lit(None).cast("boolean"), F.lit(3))) == 3
