"""Column expressions the reports share. All are built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# "<anything> <number>pg": the concentration in a sample name, e.g. "Alk-0.5pg:2".
SAMPLE_NAME_PATTERN = r"^(.*?)[-_ ]*(\d+(?:\.\d+)?)\s*pg"


def equals_as(df: DataFrame, column: str, value) -> Column:
    """Compare a column with a value given as text or number in the column's type.

    A 4-byte column holds 0.02 as 0.0199999996, so the value must be narrowed
    first; the cast folds to a literal and the filter still reaches the scan.
    """
    return F.col(column) == F.lit(value).cast(df.schema[column].dataType)


def masked_when(condition: Column, value: Column) -> Column:
    """``value`` where the condition fails or is unknown, else NULL."""
    return F.when(condition, None).otherwise(value)


def kept_when(condition: Column, value: Column) -> Column:
    return F.when(condition, value)


def rsd_percent(sd: Column, mean: Column) -> Column:
    """Relative standard deviation in percent; NULL on a zero mean."""
    return F.try_divide(sd, mean) * 100


def rounded(value: Column, digits: int | None) -> Column:
    return value if digits is None else F.round(value, digits)


def without_replicate_suffix(name: Column) -> Column:
    """Drop a one-character replicate mark: ``"Alk-5pg:2"`` -> ``"Alk-5pg"``."""
    without_mark = name.substr(F.lit(1), F.length(name) - 2)
    return F.when(F.right(name, F.lit(2)).like(":%"), without_mark).otherwise(name)


def parse_sample_name(name: Column, pattern: str = SAMPLE_NAME_PATTERN) -> Column:
    """``"<dataset>,<concentration>"`` read off a sample name.

    Where the pattern does not match, the concentration part is empty.
    """
    return F.concat_ws(",", F.regexp_extract(name, pattern, 1), F.regexp_extract(name, pattern, 2))


def split_pair(pair: Column, position: int) -> Column:
    """The first or second part of ``"a,b"``, NULL when missing or empty."""
    return F.nullif(F.try_element_at(F.split(pair, ","), F.lit(position)), F.lit(""))


def parsed_concentration(name: Column, pattern: str = SAMPLE_NAME_PATTERN) -> Column:
    return split_pair(parse_sample_name(name, pattern), 2).try_cast("double")


def blank_to_null(text: Column) -> Column:
    return F.when(F.trim(text) == "", None).otherwise(text)


def synonym(column: Column, synonyms: dict[str, str]) -> Column:
    """Replace each alternative name by its canonical one."""
    result = column
    for name, canonical in synonyms.items():
        result = F.when(column == name, canonical).otherwise(result)
    return result


def text_to(column: Column, type_name: str) -> Column:
    """Read a text cell as a database type; NULL when it does not fit.

    Whole numbers may carry a fraction in the export ("123.0") and are rounded.
    """
    if type_name in ("smallint", "int", "bigint"):
        return F.round(column.try_cast("decimal(30,8)"), 0).try_cast(type_name)
    return column if type_name == "string" else column.try_cast(type_name)
