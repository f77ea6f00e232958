"""Rollback plan: what to revoke and drop, and whether the sources are still there."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lockgate import constants as K
from lockgate import schemas
from lockgate.functions import filters, names
from lockgate.operators import grants
from lockgate.sources import tables

DROPPED = "DROPPED"
SCOPES = ("FULL", "TABLES_ONLY", "VIEWS_ONLY", "GRANTS_ONLY")


def guard(dry_run: bool, confirm: bool) -> None:
    if not dry_run and not confirm:
        raise PermissionError("a real rollback needs dry_run=False and confirm=True")


def integrity(spark: SparkSession, sources: dict[str, Callable[[], DataFrame]], max_parallel: int = 4) -> DataFrame:
    """Each source counted by its own job, so that one that is gone does not hide the others."""

    def check(item: tuple[str, Callable[[], DataFrame]]) -> tuple:
        name, load = item
        try:
            return name, load().count(), "OK", None
        except Exception as error:  # noqa: BLE001 - the failure is the finding
            return name, -1, "MISSING_OR_ERROR", str(error)

    with ThreadPoolExecutor(max_parallel) as pool:
        return tables.frame(spark, pool.map(check, sources.items()), schemas.INTEGRITY)


def target_objects(inv: DataFrame, mapping: DataFrame) -> DataFrame:
    """Objects of the mapped schemas with their type as the inventory knows it."""
    rows = inv.join(mapping.withColumnRenamed("src_database", "database_name"), "database_name")
    return rows.select(
        "tgt_catalog",
        "tgt_schema",
        F.col("table_name").alias("object_name"),
        F.when(F.col("object_type") == K.VIEW, "VIEW").otherwise("TABLE").alias("object_type"),
        F.col("database_name").alias("src_database"),
    )


def _planned(df: DataFrame, step: int, action: Column, target: Column, source: Column, statement: Column) -> DataFrame:
    return df.select(
        F.lit(step).alias("step"),
        action.alias("action"),
        target.alias("tgt_object"),
        source.alias("src_object"),
        statement.alias("statement"),
    )


def drops(objects: DataFrame, scope: str = "FULL", databases: str = "") -> DataFrame:
    objects = filters.in_list(objects, "src_database", databases)
    if scope == "TABLES_ONLY":
        objects = objects.filter(F.col("object_type") == "TABLE")
    elif scope == "VIEWS_ONLY":
        objects = objects.filter(F.col("object_type") == "VIEW")
    path = [F.col("tgt_catalog"), F.col("tgt_schema"), F.col("object_name")]
    return _planned(
        objects,
        2,
        F.concat(F.lit("DROP_"), "object_type"),
        names.dotted(*path),
        names.dotted(F.col("src_database"), F.col("object_name")),
        F.concat(F.lit("DROP "), "object_type", F.lit(" IF EXISTS "), names.quoted(*path)),
    )


def container_drops(mapping: DataFrame) -> DataFrame:
    """Drops of the schemas, then of their catalogs. What was there before the run stays."""
    cat, schema = F.col("tgt_catalog"), F.col("tgt_schema")
    none = F.lit(None).cast("string")
    before = F.coalesce(F.col("status") == "ALREADY_EXISTS", F.lit(False))
    fresh = mapping.groupBy("tgt_catalog").agg(F.bool_or(before).alias("before")).filter("NOT before")
    by_schema = _planned(
        mapping.filter(~before).select("tgt_catalog", "tgt_schema").distinct(),
        3,
        F.lit("DROP_SCHEMA"),
        names.dotted(cat, schema),
        none,
        F.concat(F.lit("DROP SCHEMA IF EXISTS "), names.quoted(cat, schema), F.lit(" CASCADE")),
    )
    by_catalog = _planned(
        fresh.select("tgt_catalog"),
        4,
        F.lit("DROP_CATALOG"),
        cat,
        none,
        F.concat(F.lit("DROP CATALOG IF EXISTS "), names.quoted(cat), F.lit(" CASCADE")),
    )
    return by_schema.unionByName(by_catalog)


def revokes(permission_log: DataFrame, databases: str = "") -> DataFrame:
    """Revokes of the grants that were really made, of all source databases or the given ones."""
    made = permission_log.filter(F.col("status") == "SUCCESS").withColumn("src_database", F.substring_index("src_object", ".", 1))
    return _planned(
        filters.in_list(made, "src_database", databases),
        1,
        F.lit("REVOKE"),
        F.col("tgt_object"),
        F.col("src_object"),
        grants.revoke(F.col("grant_sql")),
    ).distinct()


def plan(
    objects: DataFrame,
    mapping: DataFrame,
    permission_log: DataFrame | None = None,
    scope: str = "FULL",
    databases: str = "",
    dry_run: bool = True,
    confirm: bool = False,
) -> DataFrame:
    """Rows (step, action, tgt_object, src_object, statement, status), to be run in step order.

    Revokes come first; schemas and catalogs go only in a full rollback of every database.
    """
    guard(dry_run, confirm)
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}")
    parts = []
    if scope in ("FULL", "GRANTS_ONLY") and permission_log is not None:
        parts.append(revokes(permission_log, databases))
    if scope != "GRANTS_ONLY":
        parts.append(drops(objects, scope, databases))
    if scope == "FULL" and not databases.strip():
        parts.append(container_drops(mapping))
    if not parts:
        parts.append(drops(objects.limit(0), scope))
    return tables.union_all(parts).withColumn("status", F.lit("DRY_RUN" if dry_run else "PLANNED"))


def last_states(history: DataFrame, made: Sequence[str] = ("SUCCESS",)) -> DataFrame:
    """(src_table, tgt_table, strategy) of every object that the log says is there.

    ``history`` holds the rows of all runs (src_table, tgt_table, strategy, status, migrated_at). Only rows that changed
    something count: a success makes an object, DROPPED takes it away; a dry run, a failure or a table nobody registered
    leaves what was there. The last such row of an object decides; at one moment a drop comes after a success.
    """
    changed = history.filter(F.col("status").isin([*made, DROPPED]))
    moment = F.struct("migrated_at", (F.col("status") == DROPPED).alias("gone"))
    last = changed.groupBy("tgt_table").agg(
        F.max_by("status", moment).alias("status"), F.max_by("src_table", moment).alias("src_table"), F.max_by("strategy", moment).alias("strategy")
    )
    return last.filter(F.col("status") != DROPPED).select("src_table", "tgt_table", "strategy")


def plan_from_log(
    history: DataFrame,
    mapping: DataFrame | None = None,
    permission_log: DataFrame | None = None,
    view_layers: DataFrame | None = None,
    scope: str = "FULL",
    databases: str = "",
    dry_run: bool = True,
    confirm: bool = False,
    made: Sequence[str] = ("SUCCESS",),
) -> DataFrame:
    """Rows (step, place, action, tgt_object, src_object, statement, status), to be run by step and place.

    Only what the log says the runs made is dropped. Views go before tables and before the views they read:
    ``view_layers`` (view, layer) comes from ``viewsql.order``. Containers follow only in a full rollback of every
    database, and only where ``mapping`` says that the run created them.
    """
    guard(dry_run, confirm)
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}")
    kind = F.when(F.col("strategy") == K.RECREATE_VIEW, "VIEW").otherwise("TABLE")
    cut = F.split("tgt_table", "[.]", 3)
    objects = last_states(history, made).select(
        F.element_at(cut, 1).alias("tgt_catalog"),
        F.element_at(cut, 2).alias("tgt_schema"),
        F.element_at(cut, 3).alias("object_name"),
        kind.alias("object_type"),
        F.substring_index("src_table", ".", 1).alias("src_database"),
    )
    planned = plan(objects, mapping if mapping is not None else _no_mapping(history), permission_log, scope, databases, dry_run, confirm)
    if view_layers is None:
        layered = planned.withColumn("layer", F.lit(None).cast("int"))
    else:
        layered = planned.join(view_layers.select(F.col("view").alias("src_object"), "layer"), "src_object", "left")
    # Views of a circle have no layer and go first; nothing that was placed reads them.
    place = F.when(F.col("action") == "DROP_VIEW", -1 - F.coalesce("layer", F.lit(1 << 20))).otherwise(0)
    return layered.select("step", place.cast("int").alias("place"), "action", "tgt_object", "src_object", "statement", "status")


def _no_mapping(like: DataFrame) -> DataFrame:
    return tables.frame(like.sparkSession, [], schemas.SCHEMA_MAPPING)


def dropped(planned: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Rows of the migration log for objects whose drops were carried out, so that a later replay knows they are gone."""
    done = planned.filter(F.col("action").isin("DROP_TABLE", "DROP_VIEW"))
    values = {
        "src_table": F.col("src_object"),
        "tgt_table": F.col("tgt_object"),
        "strategy": F.when(F.col("action") == "DROP_VIEW", K.RECREATE_VIEW).otherwise(K.DEEP_COPY),
        "status": F.lit(DROPPED),
        "migrated_at": F.lit(run_ts),
    }
    none = F.lit(None)
    return done.select(*[values.get(f.name, none).cast(f.dataType).alias(f.name) for f in schemas.MIGRATION_LOG.fields])


def log(planned: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return planned.select(
        "action", "tgt_object", "src_object", "statement", "status", F.lit(run_ts).alias("planned_at")
    )
