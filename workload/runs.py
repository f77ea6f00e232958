"""Queries over whole runs: stored logs, repeated copies, drill-down, views, grants, the gate and the way back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lockgate import constants as K
from lockgate import schemas
from lockgate.operators import hashtree, incremental, rollback, viewsql
from lockgate.operators.profile import TableSource
from lockgate.plans import migration
from lockgate.sources import scratch, tables
from lockgate.sources.runlog import RunLog
from workload import derived as D
from workload import metadata as M
from workload.common import CATALOG, RUN_TS, Tables, duck, plain, plain_sql

QUERIES, ORACLES = {}, {}


def query(name: str, oracle: str | None = None, *as_text: str):
    def add(function):
        QUERIES[name] = lambda spark, sf_dir: plain(function(Tables(spark, sf_dir)))
        if oracle:
            ORACLES[name] = plain_sql(oracle, *as_text)
        return function

    return add


def source(t: Tables, database: str, name: str, **more) -> TableSource:
    return TableSource(database, name, lambda: getattr(t, name), K.MANAGED, "delta", t.path(name), **more)


# ---------------------------------------------------------------- history


def counted(run: str, database: str, name: str, status: str = "SUCCESS") -> str:
    rows = f"(SELECT count(*) FROM {name})" if status == "SUCCESS" else "0"
    return f"SELECT '{run}' AS run_id, '{database}.{name}' AS src_table, '{status}' AS status, {rows} AS rows_copied"


@query(
    "q_log_history",
    " UNION ALL ".join(
        [counted("r1", "Web", "supplier"), counted("r1", "Web", "customer"), counted("r2", "Shop", "part"), counted("r2", "x-1", "nation", "ERROR"), counted("r2", "x_1", "nation", "ERROR")]
    ),
)
def q_log_history(t: Tables) -> DataFrame:
    """Two runs and a repeat of the first one, which had failed for a table; two sources of the second claim one target."""
    root = scratch.new_folder(t.spark, "history")

    def run(run_id: str, sources: list[TableSource]) -> None:
        base = scratch.new_folder(t.spark, "target")
        migration.migrate(t.spark, sources, migration.Options(CATALOG, base, RUN_TS, dry_run=False, run_id=run_id, log_root=root))

    broken = source(t, "Web", "customer")
    loads = iter([t.customer])
    broken.load = lambda: next(loads)  # counted once, gone when it is to be copied
    run("r1", [source(t, "Web", "supplier"), broken])
    run("r2", [source(t, "Shop", "part"), source(t, "x-1", "nation"), source(t, "x_1", "nation")])
    run("r1", [source(t, "Web", "supplier"), source(t, "Web", "customer")])
    history = RunLog(t.spark, root).read("migration", schemas.MIGRATION_LOG)
    return history.select("run_id", "src_table", "status", "rows_copied")


@query(
    "q_copy_incremental",
    """SELECT 1 AS step, true AS moved_files, count(*) AS moved_rows, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders
UNION ALL SELECT 2, false, 0, count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders
UNION ALL SELECT 3, true, count(*) FILTER (o_orderstatus = 'P' AND o_orderkey % 2 = 0), count(*) FILTER (o_orderstatus <> 'P' OR o_orderkey % 2 = 0),
CAST(sum(o_orderkey) FILTER (o_orderstatus <> 'P' OR o_orderkey % 2 = 0) AS BIGINT) FROM orders""",
)
def q_copy_incremental(t: Tables) -> DataFrame:
    """A copy, a rerun without changes, and a rerun after the files of one partition were replaced."""
    src, base = scratch.new_folder(t.spark, "src"), scratch.new_folder(t.spark, "copy")
    keys = ["o_orderstatus"]
    tables.write(tables.spread(t.orders, keys), src, "orc", keys)
    seen = []

    def step(number: int) -> None:
        done = incremental.update(t.spark, src, "orc", base, t.orders.schema, keys)
        now = incremental.read(t.spark, base, t.orders.schema).agg(F.count("*"), F.sum("o_orderkey")).first()
        seen.append((number, done.copied > 0, done.rows, now[0], now[1]))

    step(1)
    step(2)
    left = t.orders.filter("o_orderstatus = 'P' AND o_orderkey % 2 = 0").drop("o_orderstatus")
    left.write.mode("overwrite").orc(f"{src}/o_orderstatus=P")
    step(3)
    return tables.frame(t.spark, seen, schemas.struct("step int, moved_files boolean, moved_rows bigint, n_rows bigint, key_sum bigint"))


# ---------------------------------------------------------------- drill-down

LINE_KEY = ["l_orderkey", "l_linenumber"]
LOST, RAISED = "l_orderkey % 1000 = 7", "l_orderkey % 1000 = 8"
LINES = "SELECT l_orderkey, l_linenumber, CAST({} AS VARCHAR) AS v FROM {} l"
BAD = f"(SELECT * REPLACE (CASE WHEN {RAISED} THEN l_tax + 0.01 ELSE l_tax END AS l_tax) FROM lineitem WHERE NOT ({LOST}))"


def by_key(t: str) -> str:
    return f"SELECT l_orderkey, l_linenumber, count(*) AS n, list_sort(list(CAST(l AS VARCHAR))) AS v FROM {t} l GROUP BY 1, 2"


@query(
    "q_drilldown",
    f"""SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, coalesce(a.l_linenumber, b.l_linenumber) AS l_linenumber,
coalesce(a.n, 0) AS n_src, coalesce(b.n, 0) AS n_tgt, CASE WHEN b.n IS NULL THEN 'ONLY_SOURCE' WHEN a.n IS NULL THEN 'ONLY_TARGET' ELSE 'CHANGED' END AS finding
FROM ({by_key("lineitem")}) a FULL JOIN ({by_key(BAD)}) b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber
WHERE a.v IS DISTINCT FROM b.v""",
)
def q_drilldown(t: Tables) -> DataFrame:
    """The keys that a faulty copy lost or changed, out of the stored trees alone: the source is not read again."""
    kept, tax = scratch.new_folder(t.spark, "tree"), F.col("l_tax")
    hashtree.build(t.lineitem, kept, LINE_KEY)
    path = scratch.new_folder(t.spark, "copy")
    bad = t.lineitem.filter(f"NOT ({LOST})").withColumn("l_tax", F.when(F.expr(RAISED), tax + 0.01).otherwise(tax))
    tables.write(bad, path)
    copy = tables.read(t.spark, path, "parquet", t.lineitem.schema)
    return hashtree.diff(hashtree.load(t.spark, kept), hashtree.build(copy, scratch.new_folder(t.spark, "tree"), LINE_KEY))


# ---------------------------------------------------------------- views and grants in a run


def dry_run(t: Tables, **more) -> migration.Result:
    options = migration.Options(CATALOG, scratch.new_folder(t.spark, "target"), RUN_TS)
    return migration.migrate(t.spark, [source(t, "Sales_0", "nation")], options, views=t.sql(D.VIEWS), **more)


@query(
    "q_run_views",
    f"""SELECT d || '.' || v AS src_view, '{CATALOG}.' || lower(d) || '.' || v AS tgt_view,
CASE c_mktsegment WHEN 'FURNITURE' THEN 'EXTRACTION_ERROR' WHEN 'MACHINERY' THEN 'DRY_RUN_SYNTAX_ERROR' ELSE 'DRY_RUN_OK' END AS status,
c_mktsegment IN ('FURNITURE', 'MACHINERY') AS has_error FROM ({duck(D.VIEW_NAMES)})""",
)
def q_run_views(t: Tables) -> DataFrame:
    views = dry_run(t).views
    return views.select("src_view", "tgt_view", "status", F.col("error_message").isNotNull().alias("has_error"))


#: The run maps the databases it has seen: those of its tables and views.
SEEN = "SELECT DISTINCT 'Sales_' || c_nationkey AS src_database, 'sales_' || c_nationkey AS tgt_schema FROM customer UNION SELECT 'Sales_0', 'sales_0'"
RUN_EXPECTED = M.EXPECTED.replace(duck(D.SALES_MAPPING), SEEN)


@query(
    "q_run_grants",
    f"SELECT *, 'MISSING' AS finding FROM ({RUN_EXPECTED} EXCEPT {M.ACTUAL_KEYS}) UNION ALL SELECT *, 'UNEXPECTED' FROM ({M.ACTUAL_KEYS} EXCEPT {RUN_EXPECTED})",
)
def q_run_grants(t: Tables) -> DataFrame:
    found = dry_run(t, source_grants=t.sql(D.GRANTS), target_grants=t.sql(D.ACTUAL_GRANTS)).grant_diff
    return found.select("object_name", "principal", "privilege", "finding")


# ---------------------------------------------------------------- gate

GROWN = "o_orderkey % 50 = 0"


@query(
    "q_run_gate",
    f"""SELECT 'Web.orders' AS src_table, 'counts' AS "check", a || ' / ' || b AS detail, CASE WHEN (a - b) * 100 <= a * 3.0 THEN 'OK' ELSE 'FAILED' END AS status
FROM (SELECT count(*) AS a, count(*) FILTER (NOT ({GROWN})) AS b FROM orders)
UNION ALL SELECT 'Web.orders', c, NULL, CASE WHEN c = 'schema' OR n = 0 THEN 'OK' ELSE 'FAILED' END
FROM (SELECT count(*) FILTER ({GROWN}) AS n FROM orders), (VALUES ('values'), ('fingerprints'), ('partitions'), ('schema')) v(c)
UNION ALL SELECT 'Web.nation', 'counts', (SELECT count(*) || ' / ' || count(*) FROM nation), 'OK'
UNION ALL SELECT 'Web.nation', c, NULL, 'OK' FROM (VALUES ('values'), ('fingerprints'), ('schema')) v(c)""",
)
def q_run_gate(t: Tables) -> DataFrame:
    """A source that grows between the copy and its check: within the tolerance for counts, but not for values."""
    early = t.orders.filter(f"NOT ({GROWN})")
    states = iter([early, early])
    growing = source(t, "Web", "orders", partition_columns=["o_orderstatus"])
    growing.load = lambda: next(states, t.orders)
    options = migration.Options(CATALOG, scratch.new_folder(t.spark, "target"), RUN_TS, dry_run=False, tolerance_pct=3.0)
    gate = migration.migrate(t.spark, [growing, source(t, "Web", "nation")], options).gate
    return gate.select("src_table", "check", "detail", "status")


# ---------------------------------------------------------------- order of views

#: One view a part. Seven in a row read each other; in every fifth row the first also reads the last.
CHAIN = """
SELECT 'lake' AS database_name, 'v_' || CAST(p_partkey AS STRING) AS table_name,
       'CREATE VIEW x AS SELECT * FROM `lake`.`v_' || CAST(CASE WHEN p_partkey % 7 = 0 THEN CASE WHEN p_partkey % 35 = 0 THEN p_partkey + 6 ELSE -1 END ELSE p_partkey - 1 END AS STRING)
       || '` a JOIN lake.base_' || CAST(p_size AS STRING) || ' b ON a.id = b.id' AS ddl
FROM {part}
"""


@query(
    "q_view_order",
    """WITH RECURSIVE needs AS (SELECT p_partkey AS v, CASE WHEN p_partkey % 7 <> 0 THEN p_partkey - 1 WHEN p_partkey % 35 = 0 THEN p_partkey + 6 END AS r FROM part),
walk AS (SELECT v, 0 AS layer FROM needs WHERE r IS NULL OR r NOT IN (SELECT p_partkey FROM part)
  UNION ALL SELECT n.v, w.layer + 1 FROM needs n JOIN walk w ON n.r = w.v)
SELECT 'lake.v_' || p_partkey AS "view", layer, CASE WHEN layer IS NULL THEN 'CYCLE' ELSE 'ORDERED' END AS status FROM part LEFT JOIN walk ON v = p_partkey""",
)
def q_view_order(t: Tables) -> DataFrame:
    return viewsql.order(t.sql(CHAIN))


# ---------------------------------------------------------------- rollback out of the log

#: One log row an order: the table or view of its customer, made, dropped, or only tried.
HISTORY = """
SELECT 'Sales_' || CAST(o_custkey % 30 AS STRING) || '.t_' || CAST(o_custkey AS STRING) AS src_table,
       'prod.sales_' || CAST(o_custkey % 30 AS STRING) || '.t_' || CAST(o_custkey AS STRING) AS tgt_table,
       CASE WHEN o_custkey % 4 = 0 THEN 'RECREATE_VIEW' ELSE 'DEEP_COPY' END AS strategy,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'DROPPED' WHEN o_orderstatus = 'F' THEN 'SUCCESS' WHEN o_orderstatus = 'O' THEN 'DRY_RUN' ELSE 'ERROR' END AS status,
       o_orderdate AS migrated_at
FROM {orders}
"""
ALIVE = f"""SELECT tgt_table, src_table, strategy FROM (
SELECT *, row_number() OVER (PARTITION BY tgt_table ORDER BY migrated_at DESC, status) AS n FROM ({duck(HISTORY)}) WHERE status IN ('SUCCESS', 'DROPPED'))
WHERE n = 1 AND status = 'SUCCESS'"""
BACK = f"""SELECT 2 AS step, CASE WHEN strategy = 'RECREATE_VIEW' THEN -1 - CAST(split_part(src_table, '_', 3) AS INTEGER) % 5 ELSE 0 END AS place,
'DROP_' || k AS action, tgt_table AS tgt_object, src_table AS src_object, 'DROP ' || k || ' IF EXISTS `' || replace(tgt_table, '.', '`.`') || '`' AS statement, 'DRY_RUN' AS status
FROM (SELECT *, CASE WHEN strategy = 'RECREATE_VIEW' THEN 'VIEW' ELSE 'TABLE' END AS k FROM ({ALIVE}))"""
CONTAINERS = f"""SELECT DISTINCT 3, 0, 'DROP_SCHEMA', tgt_catalog || '.' || tgt_schema, NULL, 'DROP SCHEMA IF EXISTS `' || tgt_catalog || '`.`' || tgt_schema || '` CASCADE', 'DRY_RUN' FROM ({duck(D.SALES_MAPPING)})
UNION ALL SELECT 4, 0, 'DROP_CATALOG', 'prod', NULL, 'DROP CATALOG IF EXISTS `prod` CASCADE', 'DRY_RUN'"""


def layers(t: Tables) -> DataFrame:
    named = t.sql(HISTORY).filter("strategy = 'RECREATE_VIEW'").select(F.col("src_table").alias("view")).distinct()
    return named.withColumn("layer", F.element_at(F.split("view", "_"), -1).cast("int") % 5)


@query("q_rollback_from_log", f"{BACK} UNION ALL {CONTAINERS}")
def q_rollback_from_log(t: Tables) -> DataFrame:
    """The history replayed to the last state of each object: only what is there is dropped, views before what they read."""
    return rollback.plan_from_log(t.sql(HISTORY), t.sql(D.SALES_MAPPING), view_layers=layers(t))


FILTERED = "split_part(src_object, '.', 1) IN ('Sales_3', 'Sales_8')"


@query(
    "q_rollback_filtered",
    f"""SELECT * FROM ({BACK}) WHERE {FILTERED}
UNION ALL SELECT step, 0, action, tgt_object, src_object, statement, 'DRY_RUN' FROM ({M.REVOKES}) WHERE {FILTERED}""",
)
def q_rollback_filtered(t: Tables) -> DataFrame:
    """Two databases only: their grants and objects go, their containers stay."""
    return rollback.plan_from_log(t.sql(HISTORY), t.sql(D.SALES_MAPPING), M.permission_log(t), layers(t), databases="Sales_3, Sales_8")
