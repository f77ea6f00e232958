"""Migration risk of each inventory row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lockgate import constants as K
from lockgate.functions import names, sqltext


def _member(column: str, values: list[str]) -> Column:
    return F.coalesce(F.col(column).isin(values), F.lit(False))


def _complexity() -> Column:
    kind, delta = F.col("object_type"), F.col("is_delta")
    return (
        F.when(kind == K.ERROR, K.ERROR)
        .when(kind == K.VIEW, "MEDIUM")
        .when(kind.isin(K.MANAGED, K.EXTERNAL) & delta, "LOW")
        .when(~delta, "HIGH")
        .otherwise("MEDIUM")
    )


def strategy() -> Column:
    """What to do with the object, as a code."""
    kind, delta = F.col("object_type"), F.col("is_delta")
    return (
        F.when(kind == K.ERROR, K.ERROR)
        .when((kind == K.MANAGED) & delta, K.DEEP_COPY)
        .when((kind == K.EXTERNAL) & delta, K.REGISTER_IN_PLACE)
        .when(kind == K.VIEW, K.RECREATE_VIEW)
        .when(~delta, K.CONVERT)
        .otherwise(K.REVIEW)
    )


def apply_rules(inv: DataFrame) -> DataFrame:
    """The inventory plus ten check columns: two narrow projections, no shuffle."""
    checked = inv.withColumns(
        {
            "check_name_db": names.name_check(F.col("database_name")),
            "check_name_table": names.name_check(F.col("table_name")),
            "check_reserved_db": names.reserved_check(F.col("database_name")),
            "check_reserved_table": names.reserved_check(F.col("table_name")),
            "needs_format_conversion": ~F.col("is_delta"),
            "unsupported_serde": _member("serde_library", K.UNSUPPORTED_SERDES),
            "unsupported_input_format": _member("input_format", K.UNSUPPORTED_INPUT_FORMATS),
            "migration_complexity": _complexity(),
            "recommended_strategy": strategy(),
        }
    )
    failed = [F.col(c) != "OK" for c in ("check_name_db", "check_name_table", "check_reserved_db", "check_reserved_table")]
    return checked.withColumn(
        "has_issues",
        failed[0] | failed[1] | failed[2] | failed[3] | F.col("unsupported_serde") | F.col("unsupported_input_format"),
    )


def readable_format(provider: Column) -> Column:
    """Whether files of this format can be read and converted; others need a look."""
    return F.coalesce(F.lower(provider).isin(K.FORMATS_TO_CONVERT), F.lit(False))


def problems(checks: DataFrame) -> DataFrame:
    """One row per failed check of an object."""

    def entry(check: str, failed: Column, detail: Column) -> Column:
        return F.when(failed, F.struct(F.lit(check).alias("check"), detail.alias("detail")))

    entries = F.array(
        *[entry(c, F.col(c) != "OK", F.col(c)) for c in ("check_name_db", "check_name_table", "check_reserved_db", "check_reserved_table")],
        entry("unsupported_serde", F.col("unsupported_serde"), F.col("serde_library")),
        entry("unsupported_input_format", F.col("unsupported_input_format"), F.col("input_format")),
    )
    return checks.filter("has_issues").select(
        "database_name", "table_name", F.explode(F.array_compact(entries)).alias("p")
    ).select("database_name", "table_name", "p.check", "p.detail")


def view_refs(views: DataFrame) -> DataFrame:
    """References to other databases in views (database_name, table_name, ddl), one row each."""
    return (
        views.select("database_name", "table_name", "ddl", F.explode(sqltext.pairs(F.col("ddl"))).alias("ref"))
        .filter(F.col("ref.db") != F.col("database_name"))
        .select(
            F.col("database_name").alias("view_database"),
            F.col("table_name").alias("view_name"),
            F.col("ref.db").alias("ref_database"),
            F.col("ref.tbl").alias("ref_table"),
            F.col("ddl").alias("ddl_snippet"),
        )
    )


def formats(inv: DataFrame) -> DataFrame:
    """(data_provider, convertible, n_objects) of what has to be converted."""
    todo = inv.filter((strategy() == K.CONVERT) & F.col("object_type").isin(K.MANAGED, K.EXTERNAL))
    by = todo.groupBy(F.lower("data_provider").alias("data_provider")).agg(F.count("*").alias("n_objects"))
    return by.select("data_provider", readable_format(F.col("data_provider")).alias("convertible"), "n_objects")


def plan(checks: DataFrame) -> DataFrame:
    return checks.groupBy("recommended_strategy", "migration_complexity").agg(F.count("*").alias("n_objects"))


def summary(checks: DataFrame) -> DataFrame:
    """Objects with and without issues, in one pass."""
    return checks.agg(
        F.count("*").alias("n_objects"),
        F.count_if("has_issues").alias("n_with_issues"),
        F.count_if(~F.col("has_issues")).alias("n_without_issues"),
    )
