"""Grants as tables: map them to the target, compare expected with actual, revoke."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lockgate import constants as K
from lockgate.functions import filters, names


def privilege(source: Column) -> Column:
    """Target privilege; an unknown one passes through in upper case."""
    table = F.create_map(*[F.lit(x) for pair in K.PRIVILEGES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.upper(source)), F.upper(source))


def _schemas(mapping: DataFrame, key: str) -> DataFrame:
    return mapping.select(F.col("src_database").alias(key), F.col("tgt_schema").alias("mapped_schema"))


def map_grants(grants: DataFrame, mapping: DataFrame, catalog: str) -> DataFrame:
    """Each source grant with its target object, privilege and statement (NULL where it has no target)."""
    kind, source = F.col("src_object_type"), F.upper("privilege")
    schema, cat = F.coalesce("mapped_schema", "src_database"), F.lit(catalog)
    leaf = F.substring_index("src_object", ".", -1)
    of_schema, of_table, of_view = kind == "DATABASE", kind.isin(K.MANAGED, K.EXTERNAL), kind == K.VIEW
    target = (
        F.when(of_schema, names.dotted(cat, schema))
        .when(of_table | of_view, names.dotted(cat, schema, leaf))
    )
    securable = (
        F.when(of_schema, F.concat(F.lit("SCHEMA "), names.quoted(cat, schema)))
        .when(of_table, F.concat(F.lit("TABLE "), names.quoted(cat, schema, leaf)))
        .when(of_view, F.concat(F.lit("VIEW "), names.quoted(cat, schema, leaf)))
    )
    granted = F.when(of_schema & source.isin("USAGE", "CREATE"), "USE SCHEMA").otherwise(privilege(F.col("privilege")))
    mapped = grants.join(_schemas(mapping, "src_database"), "src_database", "left").select(
        *grants.columns,
        target.alias("tgt_object"),
        granted.alias("tgt_privilege"),
        securable.alias("securable"),
    )
    statement = F.concat(
        F.lit("GRANT "), "tgt_privilege", F.lit(" ON "), "securable", F.lit(" TO `"), "principal", F.lit("`")
    )
    return mapped.withColumn("grant_sql", statement).drop("securable")


def statements(mapped: DataFrame) -> DataFrame:
    """The distinct statements to run: several source privileges may give one target privilege."""
    return (
        mapped.filter(F.col("grant_sql").isNotNull())
        .select("tgt_object", "principal", "tgt_privilege", "grant_sql")
        .distinct()
    )


def unmapped(mapped: DataFrame) -> DataFrame:
    return mapped.filter(F.col("grant_sql").isNull())


def log(mapped: DataFrame, status: str = "DRY_RUN") -> DataFrame:
    """The permission log: one row per mapped grant."""
    return mapped.filter(F.col("grant_sql").isNotNull()).select(
        "src_object",
        "tgt_object",
        "principal",
        F.col("privilege").alias("src_privilege"),
        "tgt_privilege",
        "grant_sql",
        F.lit(status).alias("status"),
        F.lit(None).cast("string").alias("error_message"),
    )


def owners(inv: DataFrame, mapping: DataFrame, catalog: str, databases: str = "") -> DataFrame:
    """Owner statements for the objects that have an owner."""
    owned = filters.in_list(inv, "database_name", databases).filter(
        F.col("table_owner").isNotNull() & (F.col("table_owner") != "")
    )
    rows = owned.join(_schemas(mapping, "database_name"), "database_name", "left")
    schema, cat = F.coalesce("mapped_schema", "database_name"), F.lit(catalog)
    verb = F.when(F.col("object_type") == K.VIEW, "ALTER VIEW ").otherwise("ALTER TABLE ")
    return rows.select(
        names.dotted(cat, schema, F.col("table_name")).alias("tgt_object"),
        F.col("table_owner").alias("owner"),
        F.concat(
            verb, names.quoted(cat, schema, F.col("table_name")), F.lit(" SET OWNER TO `"), "table_owner", F.lit("`")
        ).alias("owner_sql"),
    )


def coverage(actual: DataFrame) -> DataFrame:
    """Grants by object type and by privilege, and the number of principals: (dimension, value, n)."""
    pairs = F.array(
        F.struct(F.lit("object_type").alias("dimension"), F.col("object_type").alias("value")),
        F.struct(F.lit("privilege").alias("dimension"), F.col("privilege").alias("value")),
    )
    counts = (
        actual.select(F.explode(pairs).alias("p"))
        .groupBy("p.dimension", "p.value")
        .agg(F.count("*").alias("n"))
        .select("dimension", "value", "n")
    )
    principals = actual.agg(F.count_distinct("principal").alias("n")).select(
        F.lit("principals").alias("dimension"), F.lit("distinct").alias("value"), "n"
    )
    return counts.unionByName(principals)


def uncovered(mapping: DataFrame, actual: DataFrame) -> DataFrame:
    """Mapped schemas on which nobody holds a grant."""
    schemas = mapping.select(names.dotted(F.col("tgt_catalog"), F.col("tgt_schema")).alias("object_name")).distinct()
    granted = actual.filter(F.col("object_type") == "SCHEMA").select("object_name").distinct()
    return schemas.join(granted, "object_name", "left_anti")


def diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Grants (object_name, principal, privilege) on one side only, each once.

    Both EXCEPT directions in one shuffle: the sides are stacked, and the map side already drops repeats.
    """
    columns = ["object_name", "principal", "privilege"]
    sides = expected.select(*columns, F.lit(True).alias("wanted")).unionByName(
        actual.select(*columns, F.lit(False).alias("wanted"))
    )
    return (
        sides.groupBy(*columns)
        .agg(F.bool_or("wanted").alias("is_expected"), F.bool_or(~F.col("wanted")).alias("is_actual"))
        .filter(~(F.col("is_expected") & F.col("is_actual")))
        .select(*columns, F.when(F.col("is_expected"), "MISSING").otherwise("UNEXPECTED").alias("finding"))
    )


def expected(permission_log: DataFrame) -> DataFrame:
    """What the log says was or would be granted."""
    return permission_log.filter(F.col("status").isin("SUCCESS", "PLANNED", "DRY_RUN")).select(
        F.col("tgt_object").alias("object_name"), "principal", F.col("tgt_privilege").alias("privilege")
    )


def missing(expected_grants: DataFrame, actual: DataFrame) -> DataFrame:
    return diff(expected_grants, actual).filter(F.col("finding") == "MISSING").drop("finding")


def unexpected(expected_grants: DataFrame, actual: DataFrame) -> DataFrame:
    return diff(expected_grants, actual).filter(F.col("finding") == "UNEXPECTED").drop("finding")


def of_principal(actual: DataFrame, principal: str, schemas: list[str] | None = None) -> DataFrame:
    """A principal's privileges on schemas, all or the given ones."""
    held = actual.filter((F.col("principal") == principal) & (F.col("object_type") == "SCHEMA"))
    return held.filter(F.col("object_name").isin(schemas)) if schemas else held


def revoke(grant_sql: Column) -> Column:
    """The statement that takes a grant back; only the final TO changes, so names may hold ' TO '."""
    started = F.regexp_replace(grant_sql, r"\AGRANT ", "REVOKE ")
    return F.regexp_replace(started, r"(?s)\A(.*) TO (`[^`]*`)\z", "$1 FROM $2")
