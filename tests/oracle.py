"""Run a registered query and its SQL side by side."""

from __future__ import annotations

from collections import Counter

import duckdb

from workload.common import TABLE_NAMES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(repr(r[c]) for c in names) for r in df.collect())


def duck_rows(con, sql: str) -> tuple[list[str], Counter]:
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    names = sorted(columns)
    places = [columns.index(n) for n in names]
    return names, Counter(tuple(repr(row[p]) for p in places) for row in found.fetchall())


def differences(df, con, sql: str) -> str:
    """'' if both give the same columns and the same multiset of values."""
    left, right = spark_rows(df), duck_rows(con, sql)
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if not left[1]:
        return "no rows"
    only_left, only_right = left[1] - right[1], right[1] - left[1]
    if only_left or only_right:
        return f"{sum(left[1].values())} / {sum(right[1].values())} rows; only Spark {list(only_left)[:3]}; only SQL {list(only_right)[:3]}"
    return ""
