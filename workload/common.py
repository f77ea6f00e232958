"""Loading the given tables, and a plain form of results that any engine prints alike."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATALOG = "prod"
RUN_TS = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
AS_OF = dt.date(2024, 6, 30)


class Tables:
    """The parquet tables of one directory by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._frames = spark, sf_dir, {}

    def path(self, name: str) -> str:
        return f"{self.sf_dir.rstrip('/')}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(self.path(name))
        return self._frames[name]

    def sql(self, text: str) -> DataFrame:
        """SQL with {table} placeholders; the same text with plain names runs in the other engine."""
        names = [n for n in TABLE_NAMES if "{" + n + "}" in text]
        return self.spark.sql(text, **{n: getattr(self, n) for n in names})


TABLE_NAMES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(text: str) -> str:
    """The same SQL with the placeholders replaced by table names."""
    return text.format(**{n: n for n in TABLE_NAMES})


def plain(df: DataFrame) -> DataFrame:
    """Dates, timestamps and decimals as text."""
    kinds = (T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("string").alias(f.name) if isinstance(f.dataType, kinds) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def plain_sql(text: str, *columns: str) -> str:
    """The same on the SQL side, for the named columns."""
    if not columns:
        return text
    casts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({casts}) FROM ({text})"
