"""The whole migration as one function: inventory, rules, names, copies, views, grants, reconciliation, gate, logs, rollback plan."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lockgate import constants as K
from lockgate import schemas
from lockgate.functions import filters
from lockgate.operators import compat, grants, hashtree, incremental, mapping, move, profile, reconcile, reports, rollback, viewsql
from lockgate.operators.move import Moved
from lockgate.operators.profile import TableSource
from lockgate.sources import published, scratch, tables
from lockgate.sources.runlog import RunLog

#: How a copy treats an earlier one: fail, take its place, or move only changed files (where the source has known files).
CREATE, REPLACE, INCREMENTAL = "create", "replace", "incremental"


@dataclass
class Options:
    """``run_id`` and ``log_root`` go together: the logs of the run are published there, once, at the end."""

    catalog: str
    base_path: str
    run_ts: dt.datetime
    fmt: str = "parquet"
    databases: str = ""
    table_names: str = ""
    dry_run: bool = True
    max_parallel: int = 4
    buckets: int = 16
    mode: str = CREATE
    run_id: str | None = None
    log_root: str | None = None
    tolerance_pct: float = 0.0
    fail_on_mismatch: bool = False
    keep_trees: bool = False


@dataclass
class Result:
    """Reports of a run; each is a DataFrame with a fixed schema."""

    inventory: DataFrame
    checks: DataFrame
    mapping: DataFrame
    log: DataFrame
    schema: DataFrame
    findings: DataFrame
    unmigrated: DataFrame
    rollback: DataFrame
    views: DataFrame
    permissions: DataFrame
    owners: DataFrame
    grant_diff: DataFrame
    gate: DataFrame
    drilldown: DataFrame


def _stored_path(options: Options, row: Row) -> str:
    _, schema, table = row["tgt_table"].split(".", 2)
    return move.target_path(options.base_path, schema, table)


def _by_file(options: Options, source: TableSource) -> bool:
    return options.mode == INCREMENTAL and bool(source.path) and source.schema is not None and source.provider in ("parquet", "orc", "csv")


def _copied(spark: SparkSession, source: TableSource, path: str, options: Options) -> Moved:
    if _by_file(options, source):
        done = incremental.update(spark, source.path, source.provider, path, source.schema, source.partition_columns)
        return Moved(done.rows, done.bytes)
    make = move.copy if options.mode == CREATE else move.replace
    return make(source.load(), path, options.fmt, source.partition_columns)


def _target(spark: SparkSession, path: str, fmt: str, source: StructType, partition_by: Sequence[str]) -> DataFrame:
    """A copy with the columns and types its own files declare; only partition columns, as folder names, take the source's."""
    own = source
    if fmt in ("parquet", "orc"):
        try:
            own = spark.read.format(fmt).load(path).schema
        except AnalysisException:
            pass  # a partitioned table without rows has no file that could tell
    found = {f.name: f for f in own.fields}
    fields = [source[c] if c in partition_by else found[c] for c in source.fieldNames() if c in found]
    fields += [f for f in own.fields if f.name not in source.fieldNames()]
    return tables.read(spark, path, fmt, StructType(fields))


def _made(spark: SparkSession, source: TableSource, path: str, options: Options, schema: StructType) -> DataFrame:
    """What a run left at ``path``."""
    if _by_file(options, source):
        return incremental.read(spark, path, schema)
    if options.mode != CREATE:
        path = published.latest(spark, path) or path
    return _target(spark, path, options.fmt, schema, source.partition_columns)


def _merged(rows: Sequence[Row]) -> set[str]:
    """Sources that share their target with another one; copied, they would be merged into one folder."""
    claims = Counter(row["tgt_table"].lower() for row in rows)
    return {row["src_table"] for row in rows if claims[row["tgt_table"].lower()] > 1}


def _views(spark: SparkSession, views: DataFrame | None, known: DataFrame, options: Options, create) -> tuple[DataFrame, DataFrame | None]:
    """The checked views of the run, and the layers in which they read each other."""
    if views is None:
        return tables.frame(spark, [], schemas.VIEW_LOG), None
    wanted = filters.in_list(filters.in_list(views, "database_name", options.databases), "table_name", options.table_names)
    layers = scratch.materialize(viewsql.order(wanted), "layers")
    recreated = viewsql.recreate(wanted, known, options.catalog, options.dry_run)
    in_turn = recreated.join(layers.select(F.col("view").alias("src_view"), "layer"), "src_view", "left").orderBy(F.col("layer").asc_nulls_last(), "src_view")
    # Views are created one after another where something creates them, as later layers read earlier ones.
    done = viewsql.checked(spark, in_turn, create, options.dry_run, options.max_parallel if create is None else 1)
    return scratch.materialize(done, "views"), layers


def _view_rows(views: DataFrame, run_ts: dt.datetime) -> DataFrame:
    values = {
        "src_table": F.col("src_view"), "tgt_table": F.col("tgt_view"), "strategy": F.lit(K.RECREATE_VIEW), "status": F.col("status"),
        "duration_sec": F.lit(0.0), "rows_copied": F.lit(0), "bytes_copied": F.lit(0), "error_message": F.col("error_message"), "migrated_at": F.lit(run_ts),
    }
    return views.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in schemas.MIGRATION_LOG.fields])


def _drilled(spark: SparkSession, name: str, source: TableSource, src: DataFrame, tgt: DataFrame, folder: str, place: str) -> None:
    """Store the trees of both sides below ``place``, and the keys in which they differ as rows of one report."""
    shared = [c for c in src.columns if c in tgt.columns]
    trees = [hashtree.build(df, f"{place}/{side}", source.key, columns=shared) for df, side in ((src, "src"), (tgt, "tgt"))]
    key = F.to_json(F.struct(*trees[0].key), {"ignoreNullFields": "false"})
    found = hashtree.diff(*trees).select(F.lit(name).alias("src_table"), key.alias("key"), "n_src", "n_tgt", "finding")
    found.write.parquet(folder)


def migrate(
    spark: SparkSession,
    sources: Sequence[TableSource],
    options: Options,
    register: Callable[[Row, TableSource], Moved] | None = None,
    views: DataFrame | None = None,
    source_grants: DataFrame | None = None,
    target_grants: DataFrame | None = None,
    create_view: Callable[[str], object] | None = None,
) -> Result:
    """Move ``sources`` and reconcile every copy that succeeded.

    The driver sees one row per table or view; all data work runs as Spark jobs, several tables at once. Tables
    that are only registered stay where they are; ``register`` declares them in a metastore (``move.SessionCatalog``),
    and what it can ``load`` again is reconciled like a copy. Without it they are logged as NOT_REGISTERED and count as
    unmigrated. Sources that claim one target are ERROR rows; the others go on.

    ``views`` (database_name, table_name, ddl) are rewritten and parsed in the order in which they read each other,
    ``source_grants`` are mapped to the target and compared with ``target_grants``. ``keep_trees`` stores a fingerprint tree of
    each side beside the copies and names the rows that differ. The gate raises only after all logs are published.
    """
    by_name = {f"{s.database}.{s.name}": s for s in sources}
    inv = scratch.materialize(profile.inventory(spark, sources, isolate=True), "inventory")
    checks = compat.apply_rules(inv)
    known = inv.select("database_name")
    if views is not None:
        known = known.union(filters.in_list(views, "database_name", options.databases).select("database_name"))
    known = scratch.materialize(mapping.schema_mapping(known, options.catalog, dry_run=options.dry_run), "mapping")
    todo = move.worklist(inv, known, options.catalog, databases=options.databases, table_names=options.table_names)
    rows = todo.collect()
    merged = _merged(rows)

    def act(row: Row) -> Moved:
        source = by_name[row["src_table"]]
        if row["src_table"] in merged:
            raise ValueError(f"several tables have one target: {row['tgt_table']}")
        if row["strategy"] == K.REGISTER_IN_PLACE:
            return register(row, source) if register else Moved(0, 0, "NOT_REGISTERED")
        return _copied(spark, source, _stored_path(options, row), options)

    log = move.run(spark, rows, act, options.run_ts, options.dry_run, options.max_parallel)
    done = {r["src_table"] for r in log.filter("status = 'SUCCESS'").select("src_table").collect()}
    again = [r for r in rows if r["src_table"] in done and (r["strategy"] != K.REGISTER_IN_PLACE or hasattr(register, "load"))]
    pairs: dict[str, tuple[DataFrame, DataFrame]] = {}
    errors, reported, drilled = [], [], []
    folder, deeper = scratch.new_folder(spark, "findings"), scratch.new_folder(spark, "drilldown")
    trees = f"{options.base_path.rstrip('/')}/_trees/{options.run_id or scratch.name()}"

    def check(item: tuple[int, Row]) -> None:
        """One job per table; one that cannot be read is an ERROR row and stops no other."""
        place, row = item
        name, source = row["src_table"], by_name[row["src_table"]]
        try:
            src = source.load()
            if row["strategy"] == K.REGISTER_IN_PLACE:
                tgt = register.load(row)
            else:
                tgt = _made(spark, source, _stored_path(options, row), options, src.schema)
            report = reconcile.one_pass(src, tgt, list(source.partition_columns), options.buckets)
            report.select(F.lit(name).alias("src_table"), "*").write.parquet(f"{folder}/{place}")
            pairs[name] = (src, tgt)
            reported.append(f"{folder}/{place}")
            if options.keep_trees:
                _drilled(spark, name, source, src, tgt, f"{deeper}/{place}", f"{trees}/{place}-{source.name}")
                drilled.append(f"{deeper}/{place}")
        except Exception as failure:  # noqa: BLE001 - the failure is the finding
            errors.append((name, "table", "all", "error", None, f"{type(failure).__name__}: {failure}", "ERROR"))

    with ThreadPoolExecutor(options.max_parallel) as pool:
        list(pool.map(check, enumerate(again)))
    findings = tables.frame(spark, errors, schemas.FINDINGS)
    if reported:
        findings = findings.unionByName(spark.read.schema(schemas.FINDINGS).parquet(*reported))
    drilldown = spark.read.schema(schemas.DRILLDOWN).parquet(*drilled) if drilled else tables.frame(spark, [], schemas.DRILLDOWN)
    schema = reconcile.schema_diff(
        profile.columns(spark, {n: p[0] for n, p in pairs.items()}),
        profile.columns(spark, {n: p[1] for n, p in pairs.items()}),
    )
    made_views, layers = _views(spark, views, known, options, create_view)
    log = log.unionByName(_view_rows(made_views, options.run_ts))
    permissions, grant_diff = _permissions(spark, source_grants, target_grants, known, options)
    gate = scratch.materialize(_gate(findings, schema, made_views, grant_diff if target_grants is not None else None, options), "gate")
    made = ("DRY_RUN", "DRY_RUN_OK") if options.dry_run else ("SUCCESS",)
    back = rollback.plan_from_log(log, known, permissions.filter("status = 'SUCCESS'"), layers, databases=options.databases, made=made)
    result = Result(
        inventory=inv,
        checks=checks,
        mapping=known,
        log=log,
        schema=schema,
        findings=findings,
        unmigrated=reconcile.unmigrated(inv, log),
        rollback=back,
        views=made_views,
        permissions=permissions,
        owners=grants.owners(inv, known, options.catalog, options.databases),
        grant_diff=grant_diff,
        gate=gate,
        drilldown=drilldown,
    )
    if options.run_id and options.log_root:
        publish(spark, result, options)
    reports.gate(gate, options.fail_on_mismatch)
    return result


def _permissions(spark, source_grants, target_grants, known, options) -> tuple[DataFrame, DataFrame]:
    """The permission log, and the grants on one side only."""
    log = tables.frame(spark, [], schemas.PERMISSION_LOG)
    if source_grants is not None:
        wanted = filters.in_list(source_grants, "src_database", options.databases)
        log = grants.log(grants.map_grants(wanted, known, options.catalog), "DRY_RUN" if options.dry_run else "PLANNED")
        log = scratch.materialize(log, "permissions")
    none = tables.frame(spark, [], schemas.struct("object_name string, principal string, privilege string"))
    return log, grants.diff(grants.expected(log), target_grants if target_grants is not None else none)


def _gate(findings, schema, views, grant_diff, options) -> DataFrame:
    """The gate of the data, with one row more for the views and one for the grants."""
    rows = reports.gate_rows(findings, schema, options.tolerance_pct)
    bad = F.col("status").isin("ERROR", "DRY_RUN_SYNTAX_ERROR", "EXTRACTION_ERROR")
    parts = [("views", views, F.count("*"), F.count_if(bad))]
    if grant_diff is not None:
        parts.append(("grants", grant_diff, F.count("*"), F.count("*")))
    for check, df, n, failed in parts:
        one = df.agg(n.alias("n_checks"), failed.alias("n_failed")).filter("n_checks > 0")
        status = F.when(F.col("n_failed") == 0, "OK").otherwise("FAILED")
        values = {"src_table": F.lit("*"), "check": F.lit(check), "detail": F.lit(None).cast("string"), "status": status}
        rows = rows.unionByName(one.withColumns(values))
    return rows


def publish(spark: SparkSession, result: Result, options: Options) -> int:
    """All logs of the run in the history, at once; a repeated run id takes the place of its earlier rows."""
    logs = {
        "migration": result.log, "views": result.views, "permissions": result.permissions, "findings": result.findings,
        "gate": result.gate, "drilldown": result.drilldown, "rollback": rollback.log(result.rollback, options.run_ts),
    }
    return RunLog(spark, options.log_root).publish(options.run_id, logs)


def overview(result: Result) -> DataFrame:
    """One row per table of the work list: what was done and how many checks failed."""
    failed = (
        result.findings.groupBy("src_table")
        .agg(F.count("*").alias("n_checks"), F.count_if(F.col("status") != "OK").alias("n_failed"))
    )
    schema = result.schema.select(F.col("table_name").alias("src_table"), F.col("status").alias("schema_status"))
    return (
        result.log.filter(F.col("strategy") != K.RECREATE_VIEW)
        .select("src_table", "tgt_table", "strategy", "status", "rows_copied")
        .join(failed, "src_table", "left")
        .join(schema, "src_table", "left")
    )
