"""Comma-list filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_list(df: DataFrame, column: str, names: str) -> DataFrame:
    """Keep rows whose column is in 'a, b, c'; an empty list keeps all."""
    if not names.strip():
        return df
    return df.filter(F.col(column).isin([n.strip() for n in names.split(",")]))
