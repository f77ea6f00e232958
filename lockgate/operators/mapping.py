"""Target names: schemas for databases, and storage roots for external paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lockgate import constants as K
from lockgate.functions import names


def schema_mapping(inv: DataFrame, catalog: str, existing: DataFrame | None = None, dry_run: bool = True) -> DataFrame:
    """One row per source database. ``existing`` lists target schemas (tgt_schema) that are there already."""
    mapped = inv.select(F.col("database_name").alias("src_database")).distinct().select(
        "src_database",
        F.lit(catalog).alias("tgt_catalog"),
        names.sanitize(F.col("src_database")).alias("tgt_schema"),
    )
    fresh = F.lit("DRY_RUN" if dry_run else "CREATED")
    if existing is None:
        mapped = mapped.withColumn("status", fresh)
    else:
        known = existing.select("tgt_schema", F.lit(True).alias("known")).distinct()
        mapped = mapped.join(known, "tgt_schema", "left").withColumn(
            "status", F.when(F.col("known"), "ALREADY_EXISTS").otherwise(fresh)
        )
    return mapped.select(
        "src_database",
        "tgt_catalog",
        "tgt_schema",
        F.coalesce(F.col("tgt_schema") != F.col("src_database"), F.lit(True)).alias("name_changed"),
        "status",
    )


def collisions(mapping: DataFrame) -> DataFrame:
    """Target schemas claimed by more than one database, which would silently merge."""
    return (
        mapping.groupBy("tgt_catalog", "tgt_schema")
        .agg(F.count("*").alias("n_sources"), F.min("src_database").alias("first_source"), F.max("src_database").alias("last_source"))
        .filter("n_sources > 1")
    )


def storage_roots(inv: DataFrame) -> DataFrame:
    """Distinct roots of the external tables that have a path, sorted.

    DISTINCT combines on the map side, so a root that holds most tables still moves one row per task.
    """
    return (
        inv.filter((F.col("object_type") == K.EXTERNAL) & (F.col("table_location") != ""))
        .select(names.storage_root(F.col("table_location")).alias("storage_path"))
        .distinct()
        .orderBy("storage_path")
    )


def locations(roots: DataFrame, credential: str, dry_run: bool = True) -> DataFrame:
    return roots.select(
        names.location_name(F.col("storage_path")).alias("location_name"),
        "storage_path",
        F.lit(credential).alias("credential"),
        F.lit("DRY_RUN" if dry_run else "CREATED").alias("status"),
    )


def location_collisions(made: DataFrame) -> DataFrame:
    """Names that several paths share: squeezing may make two paths equal."""
    return made.groupBy("location_name").agg(F.count_distinct("storage_path").alias("n_paths")).filter("n_paths > 1")


def told_apart(made: DataFrame) -> DataFrame:
    """The same locations, where each of the paths that share a name has a hash of its path at the end of it."""
    shared = location_collisions(made).select("location_name", F.lit(True).alias("shared"))
    name = F.when(F.col("shared"), names.hashed_name(F.col("location_name"), F.col("storage_path"))).otherwise(F.col("location_name"))
    return made.join(shared, "location_name", "left").select(name.alias("location_name"), "storage_path", "credential", "status")
