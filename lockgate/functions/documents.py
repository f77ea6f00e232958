"""Brazilian person (11 digits) and company (14 digits) numbers with their check digits.

The digits build on each other, so the steps are separate projections: as one expression the base would
be repeated for every digit of every check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Check-digit weights and the printed groups.
PERSON_WEIGHTS = ([10, 9, 8, 7, 6, 5, 4, 3, 2], [11, 10, 9, 8, 7, 6, 5, 4, 3, 2])
COMPANY_WEIGHTS = ([5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2], [6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2])
PERSON_GROUPS = [(3, "."), (3, "."), (3, "-"), (2, "")]
COMPANY_GROUPS = [(2, "."), (3, "."), (3, "/"), (4, "-"), (2, "")]
PERSON_SHAPE = r"\A\d{3}\.\d{3}\.\d{3}-\d{2}\z"
COMPANY_SHAPE = r"\A\d{2}\.\d{3}\.\d{3}/\d{4}-\d{2}\z"


def _person_digit(total: str) -> str:
    """Ten times the sum modulo 11, where 10 counts as 0."""
    return f"({total}) * 10 % 11 % 10"


def _company_digit(total: str) -> str:
    """What is missing to a multiple of 11, where 10 and 11 count as 0."""
    return f"(11 - ({total}) % 11) % 11 % 10"


def _append_digit(df: DataFrame, digits: str, weights: list[int], rule) -> DataFrame:
    total = " + ".join(f"{w} * CAST(substring({digits}, {i + 1}, 1) AS INT)" for i, w in enumerate(weights))
    return df.withColumn(digits, F.expr(f"concat({digits}, CAST({rule(total)} AS STRING))"))


def _completed(df: DataFrame, digits: str, base: Column, weights, rule) -> DataFrame:
    """Add ``digits``: the zero-padded base followed by its two check digits."""
    df = df.withColumn(digits, F.lpad(base.cast("string"), len(weights[0]), "0"))
    for w in weights:
        df = _append_digit(df, digits, w, rule)
    return df


def _printed(digits: str, groups: list[tuple[int, str]]) -> Column:
    parts, at = [], 1
    for width, tail in groups:
        parts += [f"substring({digits}, {at}, {width})", f"'{tail}'"]
        at += width
    return F.expr(f"concat({', '.join(parts)})")


def _with_number(df: DataFrame, name: str, base: Column, weights, rule, groups) -> DataFrame:
    return _completed(df, "_digits", base, weights, rule).withColumn(name, _printed("_digits", groups)).drop("_digits")


def with_cpf(df: DataFrame, name: str, base: Column) -> DataFrame:
    """Add ddd.ddd.ddd-dd for a number below 10^9."""
    return _with_number(df, name, base, PERSON_WEIGHTS, _person_digit, PERSON_GROUPS)


def with_cnpj(df: DataFrame, name: str, base: Column) -> DataFrame:
    """Add dd.ddd.ddd/dddd-dd for a number below 10^12."""
    return _with_number(df, name, base, COMPANY_WEIGHTS, _company_digit, COMPANY_GROUPS)


def _with_validity(df: DataFrame, name: str, text: str, shape: str, weights, rule, groups) -> DataFrame:
    width = len(weights[0])
    well_formed = F.coalesce(F.col(text).rlike(shape), F.lit(False))
    base = F.when(well_formed, F.substring(F.regexp_replace(text, "[^0-9]", ""), 1, width))
    made = _with_number(df, "_made", base, weights, rule, groups)
    return made.withColumn(name, F.coalesce(F.col("_made") == F.col(text), F.lit(False))).drop("_made")


def with_cpf_valid(df: DataFrame, name: str, text: str) -> DataFrame:
    """Add whether a text column holds a well-formed person number with right check digits."""
    return _with_validity(df, name, text, PERSON_SHAPE, PERSON_WEIGHTS, _person_digit, PERSON_GROUPS)


def with_cnpj_valid(df: DataFrame, name: str, text: str) -> DataFrame:
    return _with_validity(df, name, text, COMPANY_SHAPE, COMPANY_WEIGHTS, _company_digit, COMPANY_GROUPS)
