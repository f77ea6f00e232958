"""Queries that move and compare the given tables themselves."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lockgate import constants as K
from lockgate.operators import move, reconcile, reports
from lockgate.operators.profile import TableSource
from lockgate.operators.reconcile import Pair
from lockgate.plans import analytics, migration
from lockgate.sources import scratch, tables
from workload.common import CATALOG, RUN_TS, Tables, plain, plain_sql

QUERIES, ORACLES = {}, {}


def query(name: str, oracle: str | None = None, *as_text: str):
    """Register; ``as_text`` names the oracle columns that are printed as text on both sides."""

    def add(function):
        QUERIES[name] = lambda spark, sf_dir: plain(function(Tables(spark, sf_dir)))
        if oracle:
            ORACLES[name] = plain_sql(oracle, *as_text)
        return function

    return add


# ---------------------------------------------------------------- moving


def stored(t: Tables, df: DataFrame, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> DataFrame:
    """The rows after a round trip through files."""
    path = scratch.new_folder(t.spark, "copy")
    move.copy(df, path, fmt, partition_by)
    return tables.read(t.spark, path, fmt, df.schema)


@query("q_copy_parquet", "SELECT * FROM orders", "o_orderdate")
def q_copy_parquet(t: Tables) -> DataFrame:
    return stored(t, t.orders, "parquet", ("o_orderstatus",))


@query("q_copy_orc", "SELECT * FROM events", "ts")
def q_copy_orc(t: Tables) -> DataFrame:
    return stored(t, t.events, "orc", ("event_type",))


@query("q_copy_csv", "SELECT * FROM documents")
def q_copy_csv(t: Tables) -> DataFrame:
    """Texts with separators, quotes and line breaks."""
    return stored(t, t.documents, "csv")


@query(
    "q_convert",
    """SELECT event_id, ts, user_id, event_type, value,
CASE WHEN event_type = 'click' THEN NULL WHEN event_type = 'view' THEN '' ELSE props END AS props FROM events""",
    "ts",
)
def q_convert(t: Tables) -> DataFrame:
    """CSV with NULL and empty texts into partitioned Parquet."""
    kept = F.when(F.col("event_type") == "view", "").when(F.col("event_type") != "click", F.col("props"))
    src = t.events.withColumn("props", kept)
    raw, final = scratch.new_folder(t.spark, "csv"), scratch.new_folder(t.spark, "parquet")
    tables.write(src, raw, "csv")
    move.convert(t.spark, raw, "csv", final, "parquet", src.schema, ("event_type",))
    return tables.read(t.spark, final, "parquet", src.schema)


@query("q_register", "SELECT * FROM orders", "o_orderdate")
def q_register(t: Tables) -> DataFrame:
    """Partitioned ORC files declared as a table where they are."""
    path = scratch.new_folder(t.spark, "orc")
    tables.write(tables.spread(t.orders, ["o_orderpriority"]), path, "orc", ["o_orderpriority"])
    return move.register(t.spark, f"ext_{uuid.uuid4().hex}", path, "orc", t.orders.schema, ["o_orderpriority"])


@query("q_managed_table", "SELECT * FROM customer")
def q_managed_table(t: Tables) -> DataFrame:
    """A table saved, then replaced together with its schema."""
    name, path = f"managed_{uuid.uuid4().hex}", scratch.new_folder(t.spark, "managed")
    tables.save_table(t.customer.select("c_custkey"), name, path=path)
    tables.save_table(t.customer, name, path=path)
    return tables.read(t.spark, name)


@query(
    "q_append_evolving",
    """SELECT event_id, event_type, CAST(NULL AS BIGINT) AS user_id FROM events WHERE event_type IN ('click', 'view')
UNION ALL SELECT event_id, event_type, user_id FROM events WHERE event_type NOT IN ('click', 'view')""",
)
def q_append_evolving(t: Tables) -> DataFrame:
    """Two appends, the second with one column more."""
    path = scratch.new_folder(t.spark, "log")
    early = F.col("event_type").isin("click", "view")
    tables.append_evolving(t.events.filter(early).select("event_id", "event_type"), path)
    tables.append_evolving(t.events.filter(~early).select("event_id", "event_type", "user_id"), path)
    return tables.read_evolving(t.spark, path).select("event_id", "event_type", "user_id")


@query("q_compact", "SELECT * FROM lineitem", "l_shipdate")
def q_compact(t: Tables) -> DataFrame:
    """Many small files rewritten as few."""
    small, big = scratch.new_folder(t.spark, "small"), scratch.new_folder(t.spark, "big")
    tables.write(t.lineitem, small, max_records_per_file=20_000)
    move.compact(t.spark, small, big, schema=t.lineitem.schema)
    return tables.read(t.spark, big, "parquet", t.lineitem.schema)


COPIED = ["orders", "customer", "lineitem"]


@query(
    "q_copy_metrics",
    " UNION ALL ".join(f"SELECT 'src.{n}' AS src_table, 'SUCCESS' AS status, count(*) AS rows_copied, true AS has_bytes FROM {n}" for n in COPIED)
    + " UNION ALL SELECT 'src.gone', 'ERROR', 0, false",
)
def q_copy_metrics(t: Tables) -> DataFrame:
    """Rows and bytes counted while writing, four tables at once, one of which fails."""
    todo = [
        {"src_table": f"src.{n}", "tgt_table": f"{CATALOG}.src.{n}", "strategy": K.DEEP_COPY, "estimated_rows": 0, "estimated_bytes": 0}
        for n in [*COPIED, "gone"]
    ]
    base = scratch.new_folder(t.spark, "metrics")

    def act(row) -> move.Moved:
        name = row["src_table"].split(".")[1]
        return move.copy(getattr(t, name), move.target_path(base, "src", name))

    log = move.run(t.spark, todo, act, RUN_TS)
    return log.select("src_table", "status", "rows_copied", (F.col("bytes_copied") > 0).alias("has_bytes"))


# ---------------------------------------------------------------- faults

KEPT, RAISED = "o_totalprice >= 6000", "o_totalprice > 495000"


def orders(t: Tables) -> DataFrame:
    """Orders in types every engine prints alike, so that hashes can be recomputed elsewhere."""
    return t.orders.withColumns(
        {"o_totalprice": F.col("o_totalprice").cast("decimal(18,2)"), "o_orderdate": F.col("o_orderdate").cast("date")}
    )


def faulty(df: DataFrame) -> DataFrame:
    """Cheap orders lost, the dearest ones raised by 1."""
    price = F.when(F.expr(RAISED), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return df.filter(KEPT).withColumn("o_totalprice", price.cast(df.schema["o_totalprice"].dataType))


ORDERS = "SELECT * REPLACE (CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders"
FAULTY = f"SELECT * REPLACE (CAST(CASE WHEN {RAISED} THEN o_totalprice + 1 ELSE o_totalprice END AS DECIMAL(18,2)) AS o_totalprice) FROM ({ORDERS}) WHERE {KEPT}"


def md5_sql(*parts: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 15) AS BIGINT)"


def text_sql(c: str) -> str:
    return f"length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR)"


ROW = md5_sql(
    "o_orderkey", "o_custkey", text_sql("o_orderstatus"), "o_totalprice", text_sql("o_orderdate"), text_sql("o_orderpriority")
)
KEY = md5_sql("o_orderkey")
HASHED_SRC = f"SELECT *, {ROW} AS h, {KEY} AS k FROM ({ORDERS})"
HASHED_TGT = f"SELECT *, {ROW} AS h, {KEY} AS k FROM ({FAULTY})"


def faulty_copy(t: Tables, fmt: str = "orc") -> DataFrame:
    return stored(t, faulty(orders(t)), fmt, ("o_orderstatus",))


# ---------------------------------------------------------------- reconciling


def metric_sql(scope: str, item: str, metric: str, expression: str, group: str = "") -> str:
    """One metric of both sides, joined by item."""
    side = "SELECT {item} AS item, CAST({e} AS VARCHAR) AS v FROM ({t}) {g}"
    s = side.format(item=item, e=expression, t=HASHED_SRC, g=group)
    d = side.format(item=item, e=expression, t=HASHED_TGT, g=group)
    return f"""SELECT '{scope}' AS scope, coalesce(a.item, b.item) AS item, '{metric}' AS metric, a.v AS src_value, b.v AS tgt_value,
CASE WHEN a.v IS NOT DISTINCT FROM b.v THEN 'OK' ELSE 'MISMATCH' END AS status FROM ({s}) a FULL JOIN ({d}) b ON a.item = b.item"""


PART_ITEM = """'{"o_orderstatus":"' || o_orderstatus || '"}'"""
NUMERIC = ["o_orderkey", "o_custkey", "o_totalprice"]
ONE_PASS = " UNION ALL ".join(
    [metric_sql("table", "'all'", "rows", "count(*)")]
    + [metric_sql("table", "'all'", f"{m}({c})", f"{m}({c})") for c in NUMERIC for m in ("sum", "min", "max")]
    + [metric_sql("bucket", "CAST(k % 16 AS VARCHAR)", "fingerprint", "sum(h)", "GROUP BY 1")]
    + [metric_sql("partition", PART_ITEM, "rows", "count(*)", "GROUP BY 1")]
)


@query("q_one_pass", ONE_PASS)
def q_one_pass(t: Tables) -> DataFrame:
    """Count, checksums, partitions and fingerprints of a faulty copy, one scan per side."""
    return reconcile.one_pass(orders(t), faulty_copy(t), ["o_orderstatus"], 16, ["o_orderkey"], "portable")


def count_row_sql(name: str, s: str, d: str, tolerance: float) -> str:
    return f"""SELECT '{name}' AS table_name, {tolerance} AS tolerance, s AS n_src, d AS n_tgt, abs(s - d) AS diff,
CASE WHEN s > 0 THEN round(abs(s - d) / s * 100, 6) WHEN d = 0 THEN 0.0 ELSE 100.0 END AS diff_pct,
CASE WHEN (s > 0 AND abs(s - d) / s * 100 <= {tolerance}) OR (s = 0 AND d = 0) THEN 'OK' ELSE 'COUNT_MISMATCH' END AS status
FROM (SELECT (SELECT count(*) FROM {s}) AS s, (SELECT count(*) FROM {d}) AS d)"""


COUNT_PAIRS = {
    "orders": ("orders", f"(SELECT * FROM orders WHERE {KEPT})"),
    "customer": ("customer", "customer"),
    "events": ("events", "(SELECT * FROM events WHERE event_type <> 'error')"),
    "both_empty": ("(SELECT * FROM orders WHERE o_orderstatus = 'none')", "(SELECT * FROM customer WHERE c_custkey < 0)"),
    "source_empty": ("(SELECT * FROM orders WHERE o_orderstatus = 'none')", "lineitem"),
}


@query(
    "q_count_check",
    "SELECT * REPLACE (CAST(tolerance AS DOUBLE) AS tolerance, CAST(diff_pct AS DOUBLE) AS diff_pct) FROM ("
    + " UNION ALL ".join(count_row_sql(n, s, d, tol) for n, (s, d) in COUNT_PAIRS.items() for tol in (0.0, 2.0))
    + ") UNION ALL SELECT 'gone', tol, n, -1, -1, -1.0, 'ERROR' FROM (SELECT count(*) AS n FROM orders), (VALUES (CAST(0.0 AS DOUBLE)), (CAST(2.0 AS DOUBLE))) v(tol)",
)
def q_count_check(t: Tables) -> DataFrame:
    none = t.orders.filter("o_orderstatus = 'none'")
    pairs = [
        Pair("orders", t.orders, stored(t, t.orders.filter(KEPT))),
        Pair("customer", t.customer, stored(t, t.customer, "orc")),
        Pair("events", t.events, t.events.filter("event_type <> 'error'")),
        Pair("both_empty", none, t.customer.filter("c_custkey < 0")),
        Pair("source_empty", none, t.lineitem),
        Pair("gone", t.orders, lambda: t.spark.read.parquet(t.path("gone"))),
    ]
    counted = scratch.materialize(reconcile.counts(t.spark, pairs).select("table_name", "n_src", "n_tgt"), "counts")
    return tables.union_all([reconcile.with_count_status(counted, tol).withColumn("tolerance", F.lit(tol)) for tol in (0.0, 2.0)])


LINE_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
BAD_LINES = "SELECT * REPLACE (CASE WHEN l_quantity = 50 THEN l_discount + 0.01 ELSE l_discount END AS l_discount) FROM lineitem"


def checksum_sql(column: str, metric: str) -> str:
    value = f"CAST(CAST({metric}(CAST({column} AS DECIMAL(38,6))) AS DECIMAL(38,6)) AS VARCHAR)"
    return f"""SELECT '{column}' AS column_name, '{metric}' AS metric, a AS src_value, b AS tgt_value,
CASE WHEN a = b THEN 'OK' ELSE 'CHECKSUM_MISMATCH' END AS status
FROM (SELECT (SELECT {value} FROM lineitem) AS a, (SELECT {value} FROM ({BAD_LINES})) AS b)"""


@query("q_checksums", " UNION ALL ".join(checksum_sql(c, m) for c in LINE_NUMERIC for m in ("sum", "min", "max")))
def q_checksums(t: Tables) -> DataFrame:
    bad = t.lineitem.withColumn("l_discount", F.when(F.col("l_quantity") == 50, F.col("l_discount") + 0.01).otherwise(F.col("l_discount")))
    report = reconcile.checksums(t.lineitem, stored(t, bad))

    def even(c: str) -> Column:
        return F.col(c).cast("decimal(38,6)").cast("string").alias(c)

    return report.select("column_name", "metric", even("src_value"), even("tgt_value"), "status")


@query(
    "q_partition_check",
    f"""SELECT coalesce(a.p, b.p) AS o_orderstatus, coalesce(s, 0) AS n_src, coalesce(d, 0) AS n_tgt,
CASE WHEN s = d THEN 'OK' WHEN d IS NULL THEN 'MISSING' WHEN s IS NULL THEN 'EXTRA' ELSE 'DIFFERENT' END AS status
FROM (SELECT o_orderstatus AS p, count(*) AS s FROM orders GROUP BY 1) a
FULL JOIN (SELECT CASE o_orderstatus WHEN 'P' THEN 'X' ELSE o_orderstatus END AS p, count(*) AS d FROM orders WHERE o_orderstatus <> 'F' OR {KEPT} GROUP BY 1) b
ON a.p = b.p""",
)
def q_partition_check(t: Tables) -> DataFrame:
    """One partition lost, one that should not be there, one incomplete."""
    bad = t.orders.filter(f"o_orderstatus <> 'F' OR {KEPT}").withColumn(
        "o_orderstatus", F.when(F.col("o_orderstatus") == "P", "X").otherwise(F.col("o_orderstatus"))
    )
    return reconcile.partitions(t.orders, stored(t, bad, "parquet", ("o_orderstatus",)), ["o_orderstatus"])


KEY_DIFF = """SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
CASE WHEN a.h IS NULL THEN 0 ELSE 1 END AS n_src, CASE WHEN b.h IS NULL THEN 0 ELSE 1 END AS n_tgt,
CASE WHEN b.h IS NULL THEN 'ONLY_SOURCE' WHEN a.h IS NULL THEN 'ONLY_TARGET' ELSE 'CHANGED' END AS finding
FROM ({src}) a FULL JOIN ({tgt}) b ON a.o_orderkey = b.o_orderkey WHERE a.h IS DISTINCT FROM b.h"""
SAMPLE = "SELECT * FROM ({}) WHERE k % 1000000 < 100000"


@query("q_sampled_hash", KEY_DIFF.format(src=SAMPLE.format(HASHED_SRC), tgt=SAMPLE.format(HASHED_TGT)))
def q_sampled_hash(t: Tables) -> DataFrame:
    return reconcile.sampled_hash(orders(t), faulty_copy(t, "parquet"), ["o_orderkey"], 0.1, "portable")


@query(
    "q_fingerprint",
    f"SELECT CAST(k % 16 AS INTEGER) AS bucket, count(*) AS n_rows, CAST(sum(h) AS VARCHAR) AS fingerprint FROM ({HASHED_SRC}) GROUP BY 1",
)
def q_fingerprint(t: Tables) -> DataFrame:
    return reconcile.fingerprint(orders(t), 16, ["o_orderkey"], hash_kind="portable")


BUCKETED = "SELECT k % 4096 AS b, count(*) AS n, sum(h) AS f FROM ({}) GROUP BY 1"


@query(
    "q_fingerprint_diff",
    f"""SELECT CAST(coalesce(x.b, y.b) AS INTEGER) AS bucket, coalesce(x.n, 0) AS n_src, coalesce(y.n, 0) AS n_tgt,
CAST(x.f AS VARCHAR) AS src_fingerprint, CAST(y.f AS VARCHAR) AS tgt_fingerprint,
CASE WHEN x.n = y.n AND x.f = y.f THEN 'OK' ELSE 'DIFFERENT' END AS status
FROM ({BUCKETED.format(HASHED_SRC)}) x FULL JOIN ({BUCKETED.format(HASHED_TGT)}) y ON x.b = y.b""",
)
def q_fingerprint_diff(t: Tables) -> DataFrame:
    return reconcile.fingerprint_diff(orders(t), faulty_copy(t), 4096, ["o_orderkey"], "portable")


@query("q_row_diff", KEY_DIFF.format(src=HASHED_SRC, tgt=HASHED_TGT))
def q_row_diff(t: Tables) -> DataFrame:
    return reconcile.row_diff(orders(t), faulty_copy(t), ["o_orderkey"])


@query("q_row_diff_drill", KEY_DIFF.format(src=HASHED_SRC, tgt=HASHED_TGT))
def q_row_diff_drill(t: Tables) -> DataFrame:
    """The same over differing buckets only."""
    return reconcile.row_diff(orders(t), faulty_copy(t), ["o_orderkey"], buckets=65_536)


LOST_LINES, DOUBLED_LINES = "l_tax = 0.08 AND l_quantity = 1", "l_tax = 0.0 AND l_quantity = 50"
BAD_COPY = f"SELECT * FROM lineitem WHERE NOT ({LOST_LINES}) UNION ALL SELECT * FROM lineitem WHERE {DOUBLED_LINES}"
MULTISET = f"""SELECT * EXCLUDE (is_src, is_tgt), sum(is_src)::BIGINT AS n_src, sum(is_tgt)::BIGINT AS n_tgt
FROM (SELECT *, 1 AS is_src, 0 AS is_tgt FROM lineitem UNION ALL SELECT *, 0, 1 FROM ({BAD_COPY})) GROUP BY ALL HAVING sum(is_src) <> sum(is_tgt)"""


def bad_lines(t: Tables) -> DataFrame:
    return stored(t, t.lineitem.filter(f"NOT ({LOST_LINES})").union(t.lineitem.filter(DOUBLED_LINES)))


@query("q_multiset_diff", MULTISET, "l_shipdate")
def q_multiset_diff(t: Tables) -> DataFrame:
    """Lost and doubled rows of a table without a key."""
    return reconcile.multiset_diff(t.lineitem, bad_lines(t))


@query("q_multiset_diff_drill", MULTISET, "l_shipdate")
def q_multiset_diff_drill(t: Tables) -> DataFrame:
    return reconcile.multiset_diff(t.lineitem, bad_lines(t), buckets=65_536)


@query(
    "q_recon_rollup",
    f"""SELECT 'partitions' AS "check", count(*) AS n_rows, count(*) FILTER (s = d) AS n_ok, count(*) FILTER (s <> d) AS n_different, 0 AS n_error
FROM (SELECT o_orderstatus, count(*) AS s, count(*) FILTER ({KEPT}) AS d FROM orders GROUP BY 1)
UNION ALL SELECT 'fingerprints', count(*), count(*) FILTER (status = 'OK'), count(*) FILTER (status <> 'OK'), 0 FROM (
  SELECT CASE WHEN x.n = y.n AND x.f = y.f THEN 'OK' ELSE 'DIFFERENT' END AS status
  FROM ({BUCKETED.format(HASHED_SRC)}) x FULL JOIN ({BUCKETED.format(HASHED_TGT)}) y ON x.b = y.b)
UNION ALL SELECT 'counts', 2, 0, 1, 1""",
)
def q_recon_rollup(t: Tables) -> DataFrame:
    src, tgt = orders(t), faulty_copy(t)
    pairs = [Pair("orders", src, tgt), Pair("gone", src, lambda: t.spark.read.parquet(t.path("gone")))]
    return reports.rollup(
        {
            "counts": reconcile.counts(t.spark, pairs),
            "partitions": reconcile.partitions(src, tgt, ["o_orderstatus"]),
            "fingerprints": reconcile.fingerprint_diff(src, tgt, 4096, ["o_orderkey"], "portable"),
        }
    )


@query("q_first_rows", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_custkey, o_orderkey LIMIT 20")
def q_first_rows(t: Tables) -> DataFrame:
    return reports.first_rows(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), 20, "o_custkey", "o_orderkey")


# ---------------------------------------------------------------- analytic views


@query(
    "q_active_parties",
    """SELECT 'PF' AS tipo_cliente, c_custkey AS id_cliente, c_name AS documento, c_name AS razao_nome, c_nationkey AS score_bureau,
c_mktsegment AS faixa_score, c_mktsegment AS uf, c_acctbal AS capacidade_financeira, c_custkey AS dt_cadastro FROM customer WHERE c_acctbal > 0
UNION ALL SELECT 'PJ', s_suppkey, s_name, s_name, s_nationkey, 'none', 'none', s_acctbal, s_suppkey FROM supplier WHERE s_acctbal > 0""",
)
def q_active_parties(t: Tables) -> DataFrame:
    active = F.when(F.col("capacity") > 0, "ATIVO").otherwise("INATIVO")
    persons = t.customer.withColumn("capacity", F.col("c_acctbal")).select(
        F.col("c_custkey").alias("id_cliente"), F.col("c_name").alias("cpf"), F.col("c_name").alias("nome"),
        F.col("c_nationkey").alias("score_bureau"), F.col("c_mktsegment").alias("faixa_score"),
        F.col("c_mktsegment").alias("uf_nascimento"), F.col("capacity").alias("renda_mensal"),
        F.col("c_custkey").alias("dt_cadastro"), active.alias("status"),
    )
    companies = t.supplier.withColumn("capacity", F.col("s_acctbal")).select(
        F.col("s_suppkey").alias("id_empresa"), F.col("s_name").alias("cnpj"), F.col("s_name").alias("razao_social"),
        F.col("s_nationkey").alias("score_bureau"), F.lit("none").alias("faixa_score"), F.lit("none").alias("uf_sede"),
        F.col("capacity").alias("faturamento_anual"), F.col("s_suppkey").alias("dt_cadastro"), active.alias("status"),
    )
    return analytics.active_parties(persons, companies)


@query(
    "q_latest_order",
    """SELECT o_custkey, o_orderkey, o_totalprice, c_name, c_acctbal
FROM (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS newest FROM orders)
LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') ON o_custkey = c_custkey WHERE newest = 1""",
)
def q_latest_order(t: Tables) -> DataFrame:
    current = analytics.latest(t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"), "o_custkey", "o_orderdate")
    building = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_acctbal")
    return current.join(building, "o_custkey", "left").drop("o_orderdate")


@query(
    "q_open_exposure",
    """SELECT o_custkey AS id_cliente, count(*) FILTER (o_orderstatus = 'O') AS qtd_ocorrencias,
CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'O') AS VARCHAR) AS total_divida, o_custkey AS max_dias_atraso,
CAST(min(o_orderdate) FILTER (o_orderstatus = 'O') AS VARCHAR) AS primeira_ocorrencia, CAST(max(o_orderdate) FILTER (o_orderstatus = 'O') AS VARCHAR) AS ultima_ocorrencia,
count(DISTINCT o_orderpriority) FILTER (o_orderstatus = 'O') AS qtd_credores, count(*) FILTER (o_orderstatus = 'P') AS qtd_protestos,
CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'P'), 0) AS VARCHAR) AS total_protestado
FROM orders GROUP BY o_custkey HAVING count(*) FILTER (o_orderstatus = 'O') > 0""",
)
def q_open_exposure(t: Tables) -> DataFrame:
    named = t.orders.select(
        F.col("o_orderkey").alias("id_ocorrencia"),
        F.col("o_custkey").alias("id_cliente"),
        F.col("o_totalprice").alias("valor_atualizado"),
        F.col("o_totalprice").alias("valor_protestado"),
        F.col("o_custkey").alias("dias_atraso"),
        F.col("o_orderdate").alias("dt_ocorrencia"),
        F.col("o_orderpriority").alias("credor"),
        F.when(F.col("o_orderstatus") == "O", "ATIVA").when(F.col("o_orderstatus") == "P", "ATIVO").alias("status"),
    )
    return analytics.open_defaults(named, named)


@query(
    "q_price_band",
    """SELECT o_orderkey AS id, o_orderpriority AS nome, score, CASE WHEN score >= 800 THEN 'Excelente' WHEN score >= 500 THEN 'Bom' ELSE 'Regular' END AS faixa
FROM (SELECT *, o_totalprice / 500 AS score FROM orders WHERE o_orderstatus = 'F')""",
)
def q_price_band(t: Tables) -> DataFrame:
    clients = t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("nome"), (F.col("o_totalprice") / 500).alias("score"), F.col("o_orderstatus").alias("uf")
    )
    letters = F.element_at(F.create_map(F.lit(0), F.lit("A"), F.lit(1), F.lit("B"), F.lit(2), F.lit("C")), F.col("r_regionkey"))
    text = F.element_at(F.create_map(F.lit(0), F.lit("Excelente"), F.lit(1), F.lit("Bom"), F.lit(2), F.lit("Regular")), F.col("r_regionkey"))
    bands = t.region.select(letters.alias("codigo"), text.alias("descricao"))
    return analytics.clients_by_band(clients, bands, "F")


# ---------------------------------------------------------------- a whole run


@query(
    "q_migration_run",
    """SELECT 'Sales-EU.orders' AS src_table, 'prod.sales_eu.orders' AS tgt_table, 'CONVERT' AS strategy, 'SUCCESS' AS status, (SELECT count(*) FROM orders) AS rows_copied, 0 AS n_failed, 'OK' AS schema_status
UNION ALL SELECT 'Sales-EU.documents', 'prod.sales_eu.documents', 'CONVERT', 'SUCCESS', (SELECT count(*) FROM documents), 0, 'OK'
UNION ALL SELECT 'Sales-EU.lineitem', 'prod.sales_eu.lineitem', 'CONVERT', 'SUCCESS', (SELECT count(*) FROM lineitem), 0, 'OK'
UNION ALL SELECT 'web.events', 'prod.web.events', 'DEEP_COPY', 'SUCCESS', (SELECT count(*) FROM events), 0, 'OK'
UNION ALL SELECT 'web.part', 'prod.web.part', 'REGISTER_IN_PLACE', 'NOT_REGISTERED', 0, NULL, NULL""",
)
def q_migration_run(t: Tables) -> DataFrame:
    """Five tables in three formats, one of them to be registered by nobody, and one that is gone."""
    orc, csv = scratch.new_folder(t.spark, "orc"), scratch.new_folder(t.spark, "csv")
    tables.write(tables.spread(t.orders, ["o_orderstatus"]), orc, "orc", ["o_orderstatus"])
    tables.write(t.documents, csv, "csv")
    sources = [
        TableSource("Sales-EU", "orders", lambda: tables.read(t.spark, orc, "orc", t.orders.schema), K.EXTERNAL, "orc", orc, partition_columns=["o_orderstatus"]),
        TableSource("Sales-EU", "documents", lambda: tables.read(t.spark, csv, "csv", t.documents.schema), K.EXTERNAL, "csv", csv),
        TableSource("Sales-EU", "lineitem", lambda: t.lineitem, K.MANAGED, "parquet", t.path("lineitem")),
        TableSource("web", "events", lambda: t.events, K.MANAGED, "delta", t.path("events"), partition_columns=["event_type"]),
        TableSource("web", "part", lambda: t.part, K.EXTERNAL, "delta", t.path("part")),
        TableSource("web", "gone", lambda: t.spark.read.parquet(t.path("gone")), K.MANAGED, "parquet", t.path("gone")),
    ]
    options = migration.Options(CATALOG, scratch.new_folder(t.spark, "target"), RUN_TS, dry_run=False)
    return migration.overview(migration.migrate(t.spark, sources, options)).drop("n_checks")
