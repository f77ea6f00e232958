"""Roll-ups of reports and the gate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lockgate.sources.tables import union_all


class ReconciliationError(AssertionError):
    """Source and target differ."""


def rollup(reports: dict[str, DataFrame]) -> DataFrame:
    """OK, different and failed rows per check: all reports stacked, one aggregate."""
    stacked = union_all([r.select(F.lit(name).alias("check"), "status") for name, r in reports.items()])
    return stacked.groupBy("check").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("status") == "OK").alias("n_ok"),
        F.count_if(~F.col("status").isin("OK", "ERROR")).alias("n_different"),
        F.count_if(F.col("status") == "ERROR").alias("n_error"),
    )


def gate(report: DataFrame, fail_on_mismatch: bool = True) -> int:
    """Number of rows that are not OK; raises if there are any and it should."""
    bad = report.agg(F.count_if(F.coalesce(F.col("status") != "OK", F.lit(True)))).first()[0]
    if bad and fail_on_mismatch:
        raise ReconciliationError(f"{bad} checks failed")
    return bad


CHECKS = {"table": "values", "bucket": "fingerprints", "partition": "partitions", "column": "columns"}


def gate_rows(findings: DataFrame, schema: DataFrame, tolerance_pct: float = 0.0) -> DataFrame:
    """(src_table, check, n_checks, n_failed, detail, status): what of each table passes.

    ``counts`` allows a difference of ``tolerance_pct`` percent of the source's rows; every other check of the findings
    (values, fingerprints, partitions, columns) and the schema allows none. A table that could not be read has one row
    ``readable`` that failed.
    """
    s, t = F.col("src_value").try_cast("bigint"), F.col("tgt_value").try_cast("bigint")
    is_count = (F.col("scope") == "table") & (F.col("metric") == "rows")
    near = F.when(s > 0, F.abs(s - t) * 100 <= s * F.lit(float(tolerance_pct))).otherwise(s == t)
    names = F.create_map(*[F.lit(x) for pair in CHECKS.items() for x in pair])
    readable = F.col("status") == "ERROR"
    check = F.when(readable, "readable").when(is_count, "counts").otherwise(F.try_element_at(names, F.col("scope")))
    passed = F.coalesce(F.when(is_count & ~readable, near).otherwise(F.col("status") == "OK"), F.lit(False))
    shown = F.when(is_count, F.concat_ws(" / ", "src_value", "tgt_value")).when(readable, F.col("tgt_value"))
    rows = findings.select("src_table", check.alias("check"), passed.alias("passed"), shown.alias("detail"))
    drift = schema.select(F.col("table_name").alias("src_table"), F.lit("schema").alias("check"), (F.col("status") == "OK").alias("passed"), F.col("error_message").alias("detail"))
    summed = rows.unionByName(drift).groupBy("src_table", "check").agg(
        F.count("*").alias("n_checks"), F.count_if(~F.col("passed")).alias("n_failed"), F.max("detail").alias("detail")
    )
    return summed.withColumn("status", F.when(F.col("n_failed") == 0, "OK").otherwise("FAILED"))


def log_summary(log: DataFrame) -> DataFrame:
    """Tables, seconds and rows per status of a migration log."""
    return log.groupBy("status").agg(
        F.count("*").alias("n_tables"),
        F.sum("duration_sec").alias("total_sec"),
        F.sum("rows_copied").alias("total_rows"),
    )


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first rows to look at, by a total order: each task keeps n rows, so nothing is sorted as a whole."""
    return df.orderBy(*order).limit(n)
