"""Queries over the odd cases: what sums cannot see, nested NULLs, drift, samples of exact size, JSON with faults, damaged tables, dry runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lockgate import constants as K
from lockgate import schemas
from lockgate.operators import compat, move, profile, reconcile
from lockgate.plans import migration
from lockgate.sources import scratch, tables
from lockgate.sources.runlog import RunLog
from workload import data
from workload import metadata as M
from workload.common import CATALOG, RUN_TS, TABLE_NAMES, Tables, plain, plain_sql
from workload.runs import source

QUERIES, ORACLES = {}, {}


def query(name: str, oracle: str | None = None, *as_text: str):
    def add(function):
        QUERIES[name] = lambda spark, sf_dir: plain(function(Tables(spark, sf_dir)))
        if oracle:
            ORACLES[name] = plain_sql(oracle, *as_text)
        return function

    return add


# ---------------------------------------------------------------- what sums cannot see

#: Per column: the value, and what the copy holds instead for a few orders.
ODD = {
    "swapped": ("CASE WHEN o_orderkey % 100 = 3 THEN double('NaN') ELSE o_totalprice END", "CASE WHEN o_orderkey % 100 = 3 THEN double('Infinity') ELSE o_totalprice END"),
    "same_odd": ("CASE WHEN o_orderkey % 100 = 3 THEN double('NaN') WHEN o_orderkey % 100 = 4 THEN double('-Infinity') ELSE o_totalprice END",) * 2,
    "huge": ("CAST('90000000000000000000000000000000000000' AS DECIMAL(38,0)) + o_orderkey", "CAST('90000000000000000000000000000000000000' AS DECIMAL(38,0)) + if(o_orderkey % 100 = 5, o_orderkey + 1, o_orderkey)"),
    "lost": ("CASE WHEN o_orderkey % 100 = 6 THEN 0.0D ELSE o_totalprice END", "CASE WHEN o_orderkey % 100 = 6 THEN CAST(NULL AS DOUBLE) ELSE o_totalprice END"),
    "tiny": ("o_totalprice", "CASE WHEN o_orderkey % 100 = 7 THEN o_totalprice + 0.00000001D ELSE o_totalprice END"),
}
HIT = {"swapped": 3, "huge": 5, "lost": 6, "tiny": 7}


def odd(t: Tables, side: int) -> DataFrame:
    return t.orders.select("o_orderkey", *[F.expr(pair[side]).alias(name) for name, pair in ODD.items()])


def touched(rest: int) -> str:
    return f"(SELECT count(*) FROM orders WHERE o_orderkey % 100 = {rest}) > 0"


@query(
    "q_checksums_edge",
    " UNION ALL ".join(
        [f"SELECT '{c}' AS column_name, 'sum' AS metric, CASE WHEN {touched(HIT[c]) if c in HIT else 'false'} THEN 'CHECKSUM_MISMATCH' ELSE 'OK' END AS status FROM (SELECT 1)" for c in ODD]
        + [f"SELECT 'swapped', 'max', CASE WHEN {touched(3)} THEN 'CHECKSUM_MISMATCH' ELSE 'OK' END"]
    ),
)
def q_checksums_edge(t: Tables) -> DataFrame:
    """NaN against infinity, the same of both, sums beyond any decimal, lost zeros and changes below six decimals."""
    report = reconcile.checksums(odd(t, 0), data.stored(t, odd(t, 1)), list(ODD))
    return report.filter("metric = 'sum' OR (metric = 'max' AND column_name = 'swapped')").select("column_name", "metric", "status")


NESTED = {
    "s": ("named_struct('a', o_custkey, 'b', CAST(NULL AS STRING))", "if(o_orderkey % 50 = 1, named_struct('a', CAST(NULL AS BIGINT), 'b', CAST(NULL AS STRING)), named_struct('a', o_custkey, 'b', CAST(NULL AS STRING)))"),
    "l": ("array(o_custkey, NULL)", "if(o_orderkey % 50 = 2, array(NULL, o_custkey), array(o_custkey, NULL))"),
    "m": ("map('x', o_orderstatus, 'y', o_orderpriority)", "if(o_orderkey % 50 = 3, map('x', o_orderstatus), map('y', o_orderpriority, 'x', o_orderstatus))"),
    "o": ("if(o_orderkey % 50 = 4, NULL, named_struct('z', o_orderkey))", "if(o_orderkey % 50 = 4, named_struct('z', CAST(NULL AS BIGINT)), named_struct('z', o_orderkey))"),
}


def nested(t: Tables, side: int) -> DataFrame:
    orders = t.orders.withColumns({c: F.col(c).cast("bigint") for c in ("o_orderkey", "o_custkey")})
    return orders.select("o_orderkey", *[F.expr(pair[side]).alias(name) for name, pair in NESTED.items()])


@query("q_row_diff_nested", "SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, 1 AS n_src, 1 AS n_tgt, 'CHANGED' AS finding FROM orders WHERE o_orderkey % 50 IN (1, 2, 3, 4)")
def q_row_diff_nested(t: Tables) -> DataFrame:
    """NULLs inside structs, moved NULLs in arrays, lost entries of maps; another order of a map's entries is no difference."""
    return reconcile.row_diff(nested(t, 0), data.stored(t, nested(t, 1)), ["o_orderkey"])


@query(
    "q_one_pass_drift",
    """SELECT 'column' AS scope, 'o_orderpriority' AS item, 'present' AS metric, 'MISMATCH' AS status UNION ALL SELECT 'column', 'extra', 'present', 'MISMATCH'
UNION ALL SELECT 'table', 'all', 'rows', 'OK' UNION ALL SELECT 'table', 'all', m || '(' || c || ')', 'OK' FROM (VALUES ('sum'), ('min'), ('max')) v(m), (VALUES ('o_orderkey'), ('o_custkey')) w(c)
UNION ALL SELECT 'table', 'all', 'min(o_totalprice)', 'OK'
UNION ALL SELECT 'table', 'all', m || '(o_totalprice)', CASE WHEN (SELECT count(*) FROM orders WHERE o_orderkey % 100 = 3) > 0 THEN 'MISMATCH' ELSE 'OK' END FROM (VALUES ('sum'), ('max')) v(m)""",
)
def q_one_pass_drift(t: Tables) -> DataFrame:
    """A copy that lost a column, won another, and holds NaN for a few prices."""
    price = F.when(F.col("o_orderkey") % 100 == 3, F.lit(float("nan"))).otherwise(F.col("o_totalprice"))
    bad = t.orders.withColumn("o_totalprice", price).drop("o_orderpriority").withColumn("extra", F.lit(1))
    report = reconcile.one_pass(t.orders, data.stored(t, bad), buckets=16)
    return report.filter("scope <> 'bucket'").select("scope", "item", "metric", "status")


# ---------------------------------------------------------------- a sample of exact size

SAMPLED = 300
LAST = f"(SELECT max(k) FROM (SELECT DISTINCT k FROM ({data.HASHED_SRC}) ORDER BY k LIMIT {SAMPLED}))"
IN_SAMPLE = f"SELECT * FROM ({{}}) WHERE k <= {LAST}"


@query("q_sample_k", data.KEY_DIFF.format(src=IN_SAMPLE.format(data.HASHED_SRC), tgt=IN_SAMPLE.format(data.HASHED_TGT)))
def q_sample_k(t: Tables) -> DataFrame:
    """The same 300 keys of both sides, however they are partitioned."""
    return reconcile.sample_k(data.orders(t), data.faulty_copy(t).repartition(7), ["o_orderkey"], SAMPLED, "portable")


# ---------------------------------------------------------------- JSON with faults

TORN, NEW_FIELD, WRONG = "event_id % 97 = 1", "event_id % 97 = 2", "event_id % 97 = 3"


@query(
    "q_convert_json",
    f"""SELECT event_id, user_id, event_type, value, props, NULL AS reason, NULL AS line_start FROM events WHERE NOT ({TORN} OR {NEW_FIELD} OR {WRONG})
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, CASE WHEN {NEW_FIELD} THEN 'UNKNOWN_FIELD' ELSE 'MALFORMED' END, '{{"event_id":' || event_id || ',' FROM events WHERE {TORN} OR {NEW_FIELD} OR {WRONG}""",
)
def q_convert_json(t: Tables) -> DataFrame:
    """Lines that are torn, hold another type, or a field that the schema lacks, are set aside whole; the rest is converted."""
    kept = t.events.select("event_id", "user_id", "event_type", "value", "props")
    whole = F.to_json(F.struct(*kept.columns))
    line = (
        F.when(F.expr(TORN), F.expr("substring(whole, 1, length(whole) - 3)"))
        .when(F.expr(NEW_FIELD), F.expr("concat(substring(whole, 1, length(whole) - 1), ',\"late\":1}')"))
        .when(F.expr(WRONG), F.expr("concat(substring_index(whole, ',', 1), ',\"user_id\":\"none\"}')"))
        .otherwise(F.col("whole"))
    )
    raw, good, bad = (scratch.new_folder(t.spark, n) for n in ("json", "good", "bad"))
    kept.withColumn("whole", whole).select(line.alias("line")).write.text(raw)
    move.convert_json(t.spark, raw, good, bad, kept.schema)
    rows = tables.read(t.spark, good, "parquet", kept.schema)
    aside = tables.read(t.spark, bad, "parquet", move.QUARANTINE)
    start = F.concat(F.substring_index("line", ",", 1), F.lit(","))
    return rows.unionByName(aside.select("reason", start.alias("line_start")), allowMissingColumns=True)


@query(
    "q_formats",
    f"""SELECT lower(data_provider) AS data_provider, lower(data_provider) IN ({M.values(K.FORMATS_TO_CONVERT)}) AS convertible, count(*) AS n_objects
FROM ({M.CHECKS}) WHERE recommended_strategy = 'CONVERT' AND object_type IN ('MANAGED', 'EXTERNAL') GROUP BY 1, 2""",
)
def q_formats(t: Tables) -> DataFrame:
    return compat.formats(M.objects(t))


# ---------------------------------------------------------------- catalogue, dry run, stored rollback


@query(
    "q_catalog_inventory",
    """SELECT 'orders' AS table_name, 'EXTERNAL' AS object_type, 'parquet' AS data_provider, count(*) AS estimated_rows, true AS has_bytes, true AS has_partitions, 6 AS num_columns, false AS failed FROM orders
UNION ALL SELECT 'customer', 'EXTERNAL', 'orc', count(*), true, false, 5, false FROM customer
UNION ALL SELECT 'rich', 'VIEW', '', count(*), false, false, 5, false FROM customer WHERE c_acctbal > 5000
UNION ALL SELECT 'torn', 'ERROR', '', -1, false, false, 0, true""",
)
def q_catalog_inventory(t: Tables) -> DataFrame:
    """Registered tables and a view, one table with a file that is no Parquet file; each is measured by a job of its own."""
    db = f"inventory_{scratch.name()[:12]}"
    t.spark.sql(f"CREATE DATABASE {db}")
    folders = {n: scratch.new_folder(t.spark, n) for n in ("orders", "customer", "torn")}
    tables.write(tables.spread(t.orders, ["o_orderstatus"]), folders["orders"], "parquet", ["o_orderstatus"])
    tables.write(t.customer, folders["customer"], "orc")
    t.customer.select(F.col("c_name").alias("value")).write.text(folders["torn"])
    tables.declare_external(t.spark, f"{db}.orders", folders["orders"], "parquet", t.orders.schema, ["o_orderstatus"])
    tables.declare_external(t.spark, f"{db}.customer", folders["customer"], "orc", t.customer.schema)
    tables.declare_external(t.spark, f"{db}.torn", folders["torn"], "parquet", t.customer.schema)
    t.spark.sql(f"CREATE VIEW {db}.rich AS SELECT * FROM {db}.customer WHERE c_acctbal > 5000")
    found = profile.inventory(t.spark, profile.catalog_sources(t.spark, db), isolate=True)
    found = scratch.materialize(found, "inventory")
    t.spark.sql(f"DROP DATABASE {db} CASCADE")
    return found.select(
        "table_name", "object_type", "data_provider", "estimated_rows", (F.col("estimated_bytes") > 0).alias("has_bytes"), "has_partitions",
        "num_columns", F.col("error_message").isNotNull().alias("failed"),
    )


LIMIT = 5
NUMERIC_TYPES = "data_type IN ('BIGINT', 'INTEGER', 'DOUBLE', 'FLOAT', 'SMALLINT', 'TINYINT') OR data_type LIKE 'DECIMAL%'"


@query(
    "q_numeric_columns",
    f"""SELECT table_name, column_name, CAST(n AS INTEGER) AS place FROM (
SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY ordinal_position) AS n FROM information_schema.columns
WHERE table_name IN ({M.values(TABLE_NAMES)}) AND ({NUMERIC_TYPES})) WHERE n <= {LIMIT}""",
)
def q_numeric_columns(t: Tables) -> DataFrame:
    """The first five numeric columns of each given table."""
    rows = [(n, c, i + 1) for n in TABLE_NAMES for i, c in enumerate(reconcile.numeric_columns(getattr(t, n).schema, LIMIT))]
    return tables.frame(t.spark, rows, schemas.struct("table_name string, column_name string, place int"))


@query(
    "q_dry_run",
    " UNION ALL ".join(
        f"SELECT 'Web.{n}' AS src_table, 'prod.web.{n}' AS tgt_table, 'DEEP_COPY' AS strategy, 'DRY_RUN' AS status, count(*) AS rows_copied, true AS has_bytes FROM {n}"
        for n in ("orders", "customer", "events", "part")
    ),
)
def q_dry_run(t: Tables) -> DataFrame:
    """What would be copied, from measured rows and bytes; nothing is written to the target."""
    sources = [source(t, "Web", n) for n in ("orders", "customer", "events", "part")]
    options = migration.Options(CATALOG, scratch.new_folder(t.spark, "target"), RUN_TS)
    log = migration.migrate(t.spark, sources, options).log
    return log.select("src_table", "tgt_table", "strategy", "status", "rows_copied", (F.col("bytes_copied") > 0).alias("has_bytes"))


@query(
    "q_rollback_log",
    f"""SELECT DISTINCT 'DROP_TABLE' AS action, 'prod.web.part' AS tgt_object, 'DROP TABLE IF EXISTS `prod`.`web`.`part`' AS statement, 'DRY_RUN' AS status, '{RUN_TS:%Y-%m-%d %H:%M:%S}' AS planned_at, 'r' AS run_id FROM part
UNION ALL SELECT 'DROP_SCHEMA', 'prod.web', 'DROP SCHEMA IF EXISTS `prod`.`web` CASCADE', 'DRY_RUN', '{RUN_TS:%Y-%m-%d %H:%M:%S}', 'r'
UNION ALL SELECT 'DROP_CATALOG', 'prod', 'DROP CATALOG IF EXISTS `prod` CASCADE', 'DRY_RUN', '{RUN_TS:%Y-%m-%d %H:%M:%S}', 'r'""",
)
def q_rollback_log(t: Tables) -> DataFrame:
    """The rollback plan as a run has stored it."""
    root = scratch.new_folder(t.spark, "history")
    options = migration.Options(CATALOG, scratch.new_folder(t.spark, "target"), RUN_TS, dry_run=False, run_id="r", log_root=root)
    migration.migrate(t.spark, [source(t, "Web", "part")], options)
    return RunLog(t.spark, root).read("rollback", schemas.ROLLBACK_LOG).select("action", "tgt_object", "statement", "status", "planned_at", "run_id")
