"""Queries over derived metadata: profile, rules, names, work lists, view text, grants, rollback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lockgate import constants as K
from lockgate.functions import names, sqltext
from lockgate.functions.stats import parse_stats
from lockgate.operators import compat, grants, mapping, move, profile, reconcile, reports, rollback, viewsql
from workload import derived as D
from workload.common import CATALOG, TABLE_NAMES, Tables, duck

QUERIES, ORACLES = {}, {}


def query(name: str, oracle: str | None = None):
    def add(function):
        QUERIES[name] = lambda spark, sf_dir: function(Tables(spark, sf_dir))
        if oracle:
            ORACLES[name] = oracle
        return function

    return add


def values(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


# ---------------------------------------------------------------- derived frames


def objects(t: Tables) -> DataFrame:
    return t.sql(D.OBJECTS).withColumn("is_delta", profile.is_delta(F.col("data_provider"), F.col("serde_library")))


OBJECTS = f"""
SELECT *, lower(data_provider) LIKE '%delta%' OR coalesce(serde_library LIKE '%DeltaSource%', false) AS is_delta
FROM ({duck(D.OBJECTS)})"""


def object_mapping(t: Tables) -> DataFrame:
    return mapping.schema_mapping(objects(t), CATALOG, existing_schemas(t), dry_run=False)


def existing_schemas(t: Tables) -> DataFrame:
    return t.part.select(F.lower("p_type").alias("tgt_schema")).unionByName(
        t.part.select(F.regexp_replace(F.lower("p_brand"), "#1", "_1").alias("tgt_schema"))
    )


def sanitize_sql(c: str) -> str:
    clean = f"regexp_replace({c}, '[^a-zA-Z0-9_]', '_', 'g')"
    return f"nullif(lower(CASE WHEN regexp_matches({clean}, '^[0-9]') THEN '_' || {clean} ELSE {clean} END), '')"


MAPPING = f"""
SELECT m.src_database, '{CATALOG}' AS tgt_catalog, m.tgt_schema,
       coalesce(m.tgt_schema <> m.src_database, true) AS name_changed,
       CASE WHEN m.tgt_schema IN (SELECT lower(p_type) FROM part UNION SELECT replace(lower(p_brand), '#1', '_1') FROM part)
            THEN 'ALREADY_EXISTS' ELSE 'CREATED' END AS status
FROM (SELECT DISTINCT database_name AS src_database, {sanitize_sql('database_name')} AS tgt_schema FROM ({OBJECTS})) m"""

# ---------------------------------------------------------------- profile


@query(
    "q_profile_inventory",
    " UNION ALL ".join(
        f"SELECT 'src' AS database_name, '{n}' AS table_name, 'EXTERNAL' AS object_type, 'parquet' AS data_provider, "
        f"(SELECT count(*) FROM information_schema.columns WHERE table_name = '{n}') AS num_columns, "
        f"(SELECT count(*) FROM {n}) AS estimated_rows, false AS is_delta, false AS has_partitions"
        for n in TABLE_NAMES
    ),
)
def q_profile_inventory(t: Tables) -> DataFrame:
    return profile.inventory(t.spark, given_sources(t)).select(
        "database_name", "table_name", "object_type", "data_provider", "num_columns", "estimated_rows", "is_delta", "has_partitions"
    )


def given_sources(t: Tables) -> list[profile.TableSource]:
    return [
        profile.TableSource("src", n, lambda n=n: getattr(t, n), path=t.path(n), partition_columns=[]) for n in TABLE_NAMES
    ]


COLUMN_TABLES = TABLE_NAMES
TYPE_NAMES = "CASE data_type WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>' ELSE lower(data_type) END"


@query(
    "q_profile_columns",
    f"""SELECT c.table_name, column_name, CAST(ordinal_position - 1 AS INTEGER) AS ordinal, {TYPE_NAMES} AS data_type, n AS estimated_rows
FROM information_schema.columns c JOIN ({" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in COLUMN_TABLES)}) r
  ON c.table_name = r.table_name""",
)
def q_profile_columns(t: Tables) -> DataFrame:
    measured = profile.inventory(t.spark, [s for s in given_sources(t) if s.name in COLUMN_TABLES])
    columns = profile.columns(t.spark, {n: getattr(t, n) for n in COLUMN_TABLES})
    return columns.join(measured.select("table_name", "estimated_rows"), "table_name")


DIMENSIONS = ["object_type", "data_provider", "database_name", "is_delta", "has_partitions"]


@query(
    "q_profile_summary",
    " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, count(*) AS n_objects FROM ({OBJECTS}) GROUP BY {d}" for d in DIMENSIONS
    ),
)
def q_profile_summary(t: Tables) -> DataFrame:
    return profile.summary(objects(t))


@query(
    "q_profile_buckets",
    f"""SELECT CASE WHEN object_type = 'VIEW' THEN 'views' WHEN NOT is_delta THEN 'non_delta'
  WHEN object_type = 'MANAGED' THEN 'delta_managed' WHEN object_type = 'EXTERNAL' THEN 'delta_external' ELSE 'other' END AS bucket,
  count(*) AS n_objects FROM ({OBJECTS}) GROUP BY 1""",
)
def q_profile_buckets(t: Tables) -> DataFrame:
    return profile.buckets(objects(t))


def stats_sql(unit: str) -> str:
    return f"CASE WHEN failed THEN -1 ELSE coalesce(CAST(nullif(regexp_extract(stats, '(\\d+) {unit}', 1), '') AS BIGINT), 0) END"


@query("q_parse_stats", f"SELECT o_orderkey, {stats_sql('rows')} AS n_rows, {stats_sql('bytes')} AS n_bytes FROM ({duck(D.STATS)})")
def q_parse_stats(t: Tables) -> DataFrame:
    rows, size = parse_stats(F.col("stats"), F.col("failed"))
    return t.sql(D.STATS).select("o_orderkey", rows.alias("n_rows"), size.alias("n_bytes"))


# ---------------------------------------------------------------- rules


def name_check_sql(c: str) -> str:
    return f"""CASE WHEN coalesce({c}, '') = '' THEN 'INVALID_EMPTY'
  WHEN NOT regexp_full_match({c}, '[a-zA-Z0-9_]+') THEN 'INVALID_CHARS: ' || {c}
  WHEN length({c}) > 255 THEN 'INVALID_TOO_LONG' ELSE 'OK' END"""


def reserved_sql(c: str) -> str:
    return f"CASE WHEN lower({c}) IN ({values(K.RESERVED_WORDS)}) THEN 'RESERVED_WORD: ' || {c} ELSE 'OK' END"


CHECKS = f"""
SELECT *, check_name_db <> 'OK' OR check_name_table <> 'OK' OR check_reserved_db <> 'OK' OR check_reserved_table <> 'OK'
       OR unsupported_serde OR unsupported_input_format AS has_issues
FROM (SELECT *,
  {name_check_sql('database_name')} AS check_name_db, {name_check_sql('table_name')} AS check_name_table,
  {reserved_sql('database_name')} AS check_reserved_db, {reserved_sql('table_name')} AS check_reserved_table,
  NOT is_delta AS needs_format_conversion,
  coalesce(serde_library IN ({values(K.UNSUPPORTED_SERDES)}), false) AS unsupported_serde,
  coalesce(input_format IN ({values(K.UNSUPPORTED_INPUT_FORMATS)}), false) AS unsupported_input_format,
  CASE WHEN object_type = 'ERROR' THEN 'ERROR' WHEN object_type = 'VIEW' THEN 'MEDIUM' WHEN is_delta THEN 'LOW' ELSE 'HIGH' END AS migration_complexity,
  CASE WHEN object_type = 'ERROR' THEN 'ERROR' WHEN object_type = 'VIEW' THEN 'RECREATE_VIEW' WHEN NOT is_delta THEN 'CONVERT'
       WHEN object_type = 'MANAGED' THEN 'DEEP_COPY' ELSE 'REGISTER_IN_PLACE' END AS recommended_strategy
FROM ({OBJECTS}))"""
CHECK_COLUMNS = [
    "database_name", "table_name", "object_type", "check_name_db", "check_name_table", "check_reserved_db",
    "check_reserved_table", "needs_format_conversion", "unsupported_serde", "unsupported_input_format",
    "migration_complexity", "recommended_strategy", "has_issues",
]


@query(
    "q_name_checks",
    f"""SELECT n AS name, {name_check_sql('n')} AS name_check, {reserved_sql('n')} AS reserved_check, {sanitize_sql('n')} AS clean_name
FROM (SELECT url AS n FROM pages UNION ALL SELECT o_orderpriority FROM orders UNION ALL SELECT table_name FROM ({OBJECTS})
      UNION ALL SELECT database_name FROM ({OBJECTS}))""",
)
def q_name_checks(t: Tables) -> DataFrame:
    o = objects(t)
    given = (
        t.pages.select(F.col("url").alias("name"))
        .union(t.orders.select("o_orderpriority"))
        .union(o.select("table_name"))
        .union(o.select("database_name"))
    )
    n = F.col("name")
    return given.select(
        n, names.name_check(n).alias("name_check"), names.reserved_check(n).alias("reserved_check"), names.sanitize(n).alias("clean_name")
    )


@query("q_compat_rules", f"SELECT {', '.join(CHECK_COLUMNS)} FROM ({CHECKS})")
def q_compat_rules(t: Tables) -> DataFrame:
    return compat.apply_rules(objects(t)).select(*CHECK_COLUMNS)


NAME_CHECKS = ["check_name_db", "check_name_table", "check_reserved_db", "check_reserved_table"]


@query(
    "q_compat_problems",
    " UNION ALL ".join(
        [f"SELECT database_name, table_name, '{c}' AS \"check\", {c} AS detail FROM ({CHECKS}) WHERE {c} <> 'OK'" for c in NAME_CHECKS]
        + [
            f"SELECT database_name, table_name, '{c}', {d} FROM ({CHECKS}) WHERE {c}"
            for c, d in [("unsupported_serde", "serde_library"), ("unsupported_input_format", "input_format")]
        ]
    ),
)
def q_compat_problems(t: Tables) -> DataFrame:
    return compat.problems(compat.apply_rules(objects(t)))


@query(
    "q_compat_plan",
    f"SELECT recommended_strategy, migration_complexity, count(*) AS n_objects FROM ({CHECKS}) GROUP BY 1, 2",
)
def q_compat_plan(t: Tables) -> DataFrame:
    return compat.plan(compat.apply_rules(objects(t)))


@query(
    "q_compat_summary",
    f"""SELECT count(*) AS n_objects, count(*) FILTER (has_issues) AS n_with_issues,
count(*) FILTER (NOT has_issues) AS n_without_issues FROM ({CHECKS})""",
)
def q_compat_summary(t: Tables) -> DataFrame:
    return compat.summary(compat.apply_rules(objects(t)))


PAIR = "`([^`]+)`\\.`([^`]+)`"


@query(
    "q_view_refs",
    f"""SELECT database_name AS view_database, table_name AS view_name, regexp_extract(ref, '{PAIR}', 1) AS ref_database,
regexp_extract(ref, '{PAIR}', 2) AS ref_table, ddl AS ddl_snippet
FROM (SELECT *, unnest(regexp_extract_all(ddl, '{PAIR}', 0)) AS ref FROM ({duck(D.VIEWS)}))
WHERE regexp_extract(ref, '{PAIR}', 1) <> database_name""",
)
def q_view_refs(t: Tables) -> DataFrame:
    return compat.view_refs(t.sql(D.VIEWS))


# ---------------------------------------------------------------- names


@query("q_name_mapping", MAPPING)
def q_name_mapping(t: Tables) -> DataFrame:
    return object_mapping(t)


@query(
    "q_name_collisions",
    f"""SELECT tgt_catalog, tgt_schema, count(*) AS n_sources, min(src_database) AS first_source, max(src_database) AS last_source
FROM ({MAPPING}) GROUP BY 1, 2 HAVING count(*) > 1""",
)
def q_name_collisions(t: Tables) -> DataFrame:
    return mapping.collisions(object_mapping(t))


def root_sql(c: str) -> str:
    return "coalesce(" + ", ".join(f"nullif(regexp_extract({c}, '{p}', 1), '')" for p in K.STORAGE_ROOTS) + f", {c})"


ROOTS = f"SELECT DISTINCT {root_sql('table_location')} AS storage_path FROM ({OBJECTS}) WHERE object_type = 'EXTERNAL' AND table_location <> ''"


@query("q_storage_roots", ROOTS)
def q_storage_roots(t: Tables) -> DataFrame:
    return mapping.storage_roots(objects(t))


def location_sql(c: str) -> str:
    return f"substr(lower(trim(regexp_replace(regexp_replace({c}, '[^a-zA-Z0-9_]', '_', 'g'), '_+', '_', 'g'), '_')), 1, 127)"


@query(
    "q_location_names",
    f"""SELECT {location_sql('storage_path')} AS location_name, storage_path, 'main' AS credential, 'DRY_RUN' AS status
FROM (SELECT storage_path FROM ({ROOTS}) UNION ALL SELECT url FROM pages)""",
)
def q_location_names(t: Tables) -> DataFrame:
    roots = mapping.storage_roots(objects(t)).union(t.pages.select("url"))
    return mapping.locations(roots, "main")


# ---------------------------------------------------------------- work list, log, completeness


@query(
    "q_worklist",
    f"""SELECT concat_ws('.', database_name, table_name) AS src_table,
concat_ws('.', '{CATALOG}', coalesce(tgt_schema, database_name), table_name) AS tgt_table, recommended_strategy AS strategy,
data_provider, estimated_rows
FROM ({CHECKS}) LEFT JOIN (SELECT * FROM ({MAPPING}) WHERE name_changed) m ON database_name = src_database
WHERE recommended_strategy IN ('DEEP_COPY', 'REGISTER_IN_PLACE', 'CONVERT')""",
)
def q_worklist(t: Tables) -> DataFrame:
    o = objects(t).withColumn("partition_columns", F.array().cast("array<string>"))
    return move.worklist(o, object_mapping(t).filter("name_changed"), CATALOG).select(
        "src_table", "tgt_table", "strategy", "data_provider", "estimated_rows"
    )


@query(
    "q_worklist_filtered",
    f"""SELECT concat_ws('.', database_name, table_name) AS src_table, recommended_strategy AS strategy
FROM ({CHECKS}) WHERE recommended_strategy IN ('DEEP_COPY', 'CONVERT') AND database_name IN ('brand_12', 'catalog', 'Brand#7')""",
)
def q_worklist_filtered(t: Tables) -> DataFrame:
    o = objects(t).withColumn("partition_columns", F.array().cast("array<string>"))
    todo = move.worklist(o, object_mapping(t), CATALOG, [K.DEEP_COPY, K.CONVERT], " brand_12, catalog ,Brand#7")
    return todo.select("src_table", "strategy")


@query(
    "q_log_summary",
    f"""SELECT status, count(*) AS n_tables, sum(duration_sec) AS total_sec, CAST(sum(rows_copied) AS BIGINT) AS total_rows
FROM ({duck(D.LOG)}) GROUP BY 1""",
)
def q_log_summary(t: Tables) -> DataFrame:
    return reports.log_summary(t.sql(D.LOG))


@query(
    "q_unmigrated",
    f"""SELECT o.* FROM (SELECT concat_ws('.', database_name, table_name) AS src_table, object_type, data_provider, is_delta FROM ({OBJECTS})) o
WHERE NOT EXISTS (SELECT 1 FROM ({OBJECTS}) l WHERE l.is_delta AND concat_ws('.', l.database_name, l.table_name) = o.src_table)""",
)
def q_unmigrated(t: Tables) -> DataFrame:
    o = objects(t)
    done = F.when(F.col("is_delta"), "SUCCESS").otherwise("ERROR")
    log = o.select(names.dotted(F.col("database_name"), F.col("table_name")).alias("src_table"), done.alias("status"))
    return reconcile.unmigrated(o, log)


@query(
    "q_schema_diff",
    f"""
SELECT table_name, count(s) AS num_cols_src, count(d) AS num_cols_tgt,
       coalesce(string_agg(CASE WHEN d IS NULL THEN c END, ',' ORDER BY c), '') AS missing_cols,
       coalesce(string_agg(CASE WHEN s IS NULL THEN c END, ',' ORDER BY c), '') AS extra_cols,
       coalesce(string_agg(CASE WHEN bad THEN c || ': src=' || st || ' / tgt=' || dt END, ',' ORDER BY c), '') AS type_mismatches,
       coalesce(string_agg(CASE WHEN s IS NOT NULL AND d IS NOT NULL THEN c END, ',' ORDER BY s)
        <> string_agg(CASE WHEN s IS NOT NULL AND d IS NOT NULL THEN c END, ',' ORDER BY d), false) AS order_mismatch,
       CASE WHEN count(s) = 0 OR count(d) = 0 THEN 'ERROR'
            WHEN bool_or(bad) OR bool_or(s IS NULL) OR bool_or(d IS NULL) OR order_mismatch THEN 'MISMATCH' ELSE 'OK' END AS status
FROM (
  SELECT coalesce(a.table_name, b.table_name) AS table_name, coalesce(a.column_name, b.column_name) AS c,
         a.ordinal AS s, b.ordinal AS d, a.data_type AS st, b.data_type AS dt,
         coalesce(replace(replace(lower(a.data_type), ' ', ''), 'long', 'bigint') <> replace(replace(lower(b.data_type), ' ', ''), 'long', 'bigint'), false) AS bad
  FROM ({duck(D.SRC_COLUMNS)}) a FULL JOIN ({duck(D.TGT_COLUMNS)}) b ON a.table_name = b.table_name AND a.column_name = b.column_name
) GROUP BY table_name""",
)
def q_schema_diff(t: Tables) -> DataFrame:
    report = reconcile.schema_diff(t.sql(D.SRC_COLUMNS), t.sql(D.TGT_COLUMNS))
    drift = F.transform(F.map_entries("type_mismatches"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return report.select(
        "table_name",
        "num_cols_src",
        "num_cols_tgt",
        F.array_join("missing_cols", ",").alias("missing_cols"),
        F.array_join("extra_cols", ",").alias("extra_cols"),
        F.array_join(drift, ",").alias("type_mismatches"),
        "order_mismatch",
        "status",
    )


# ---------------------------------------------------------------- view text

BODY = f"CASE c_mktsegment WHEN 'MACHINERY' THEN 'nothing to see' ELSE {D.VIEW_BODY} END"
NEW_PIECES = {
    **D.VIEW_PIECES,
    "ref_1": f"'`{CATALOG}`.`' || lower(d) || '`.`orders`'",
    "ref_2": f"'`{CATALOG}`.`extra_' || c_mktsegment || '`.`refs`'",
    "ref_3": f"'`{CATALOG}`.`sales_' || CAST((c_nationkey + 1) % 25 AS STRING) || '`.`items`'",
}
ADAPTED = f"CASE c_mktsegment WHEN 'MACHINERY' THEN 'nothing to see' ELSE {' || '.join(NEW_PIECES.values())} END"
NAMED = f"({duck(D.VIEW_NAMES)})"


@query("q_view_body", f"SELECT d AS database_name, v AS table_name, CASE WHEN c_mktsegment <> 'FURNITURE' THEN {BODY} END AS body FROM {NAMED}")
def q_view_body(t: Tables) -> DataFrame:
    return t.sql(D.VIEWS).select("database_name", "table_name", sqltext.view_body(F.col("ddl")).alias("body"))


@query("q_view_rewrite", f"SELECT d AS database_name, v AS table_name, {ADAPTED} AS adapted FROM {NAMED} WHERE c_mktsegment <> 'FURNITURE'")
def q_view_rewrite(t: Tables) -> DataFrame:
    bodies = t.sql(D.VIEWS).filter("ddl IS NOT NULL").withColumn("body", sqltext.view_body(F.col("ddl")))
    return viewsql.rewrite_refs(bodies, t.sql(D.SALES_MAPPING), CATALOG)


@query(
    "q_view_recreate",
    f"""SELECT d || '.' || v AS src_view, '{CATALOG}.' || lower(d) || '.' || v AS tgt_view,
CASE WHEN c_mktsegment <> 'FURNITURE' THEN 'CREATE OR REPLACE VIEW `{CATALOG}`.`' || lower(d) || '`.`' || v || '`' || chr(10) || 'AS' || chr(10) || {ADAPTED} END AS create_sql,
CASE c_mktsegment WHEN 'FURNITURE' THEN 'EXTRACTION_ERROR' WHEN 'MACHINERY' THEN 'DRY_RUN_SYNTAX_ERROR' ELSE 'DRY_RUN_OK' END AS status
FROM {NAMED}""",
)
def q_view_recreate(t: Tables) -> DataFrame:
    return viewsql.recreate(t.sql(D.VIEWS), t.sql(D.SALES_MAPPING), CATALOG).drop("adapted")


# ---------------------------------------------------------------- grants

PRIVILEGE_CASE = "CASE upper(privilege) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.PRIVILEGES.items()) + " ELSE upper(privilege) END"
MAPPED_GRANTS = f"""
SELECT *, 'GRANT ' || tgt_privilege || ' ON ' || securable || ' TO `' || principal || '`' AS grant_sql FROM (
  SELECT *,
    CASE src_object_type WHEN 'DATABASE' THEN '{CATALOG}.' || s WHEN 'FUNCTION' THEN NULL ELSE '{CATALOG}.' || s || '.' || leaf END AS tgt_object,
    CASE WHEN src_object_type = 'DATABASE' AND privilege IN ('USAGE', 'CREATE') THEN 'USE SCHEMA' ELSE {PRIVILEGE_CASE} END AS tgt_privilege,
    CASE src_object_type WHEN 'DATABASE' THEN 'SCHEMA `{CATALOG}`.`' || s || '`' WHEN 'FUNCTION' THEN NULL
         WHEN 'VIEW' THEN 'VIEW `{CATALOG}`.`' || s || '`.`' || leaf || '`' ELSE 'TABLE `{CATALOG}`.`' || s || '`.`' || leaf || '`' END AS securable
  FROM (SELECT g.*, coalesce(m.tgt_schema, g.src_database) AS s, regexp_extract(g.src_object, '[^.]*$') AS leaf
        FROM ({duck(D.GRANTS)}) g LEFT JOIN ({duck(D.SALES_MAPPING)}) m ON g.src_database = m.src_database))"""


def mapped_grants(t: Tables) -> DataFrame:
    return grants.map_grants(t.sql(D.GRANTS), t.sql(D.SALES_MAPPING), CATALOG)


@query("q_grant_map", f"SELECT src_object_type, src_object, principal, privilege, tgt_object, tgt_privilege, grant_sql FROM ({MAPPED_GRANTS})")
def q_grant_map(t: Tables) -> DataFrame:
    return mapped_grants(t).select("src_object_type", "src_object", "principal", "privilege", "tgt_object", "tgt_privilege", "grant_sql")


@query(
    "q_grant_sql",
    f"SELECT DISTINCT tgt_object, principal, tgt_privilege, grant_sql FROM ({MAPPED_GRANTS}) WHERE grant_sql IS NOT NULL",
)
def q_grant_sql(t: Tables) -> DataFrame:
    return grants.statements(mapped_grants(t))


@query(
    "q_grants_unmapped",
    f"SELECT src_object_type, src_object, principal, privilege FROM ({MAPPED_GRANTS}) WHERE grant_sql IS NULL",
)
def q_grants_unmapped(t: Tables) -> DataFrame:
    return grants.unmapped(mapped_grants(t)).select("src_object_type", "src_object", "principal", "privilege")


@query(
    "q_owners",
    f"""SELECT concat_ws('.', '{CATALOG}', coalesce(tgt_schema, database_name), table_name) AS tgt_object, table_owner AS owner,
'ALTER ' || CASE WHEN object_type = 'VIEW' THEN 'VIEW' ELSE 'TABLE' END || ' `{CATALOG}`.`' || coalesce(tgt_schema, database_name) || '`.`' || table_name || '` SET OWNER TO `' || table_owner || '`' AS owner_sql
FROM ({OBJECTS}) LEFT JOIN ({MAPPING}) m ON database_name = src_database WHERE coalesce(table_owner, '') <> ''""",
)
def q_owners(t: Tables) -> DataFrame:
    return grants.owners(objects(t), object_mapping(t), CATALOG)


ACTUAL = duck(D.ACTUAL_GRANTS)


@query(
    "q_grant_coverage",
    f"""SELECT 'object_type' AS dimension, object_type AS value, count(*) AS n FROM ({ACTUAL}) GROUP BY 2
UNION ALL SELECT 'privilege', privilege, count(*) FROM ({ACTUAL}) GROUP BY 2
UNION ALL SELECT 'principals', 'distinct', count(DISTINCT principal) FROM ({ACTUAL})""",
)
def q_grant_coverage(t: Tables) -> DataFrame:
    return grants.coverage(t.sql(D.ACTUAL_GRANTS))


EXPECTED = f"SELECT tgt_object AS object_name, principal, tgt_privilege AS privilege FROM ({MAPPED_GRANTS}) WHERE grant_sql IS NOT NULL"
ACTUAL_KEYS = f"SELECT object_name, principal, privilege FROM ({ACTUAL})"


def expected(t: Tables) -> DataFrame:
    return grants.expected(grants.log(mapped_grants(t)))


@query("q_grants_missing", f"{EXPECTED} EXCEPT {ACTUAL_KEYS}")
def q_grants_missing(t: Tables) -> DataFrame:
    return grants.missing(expected(t), t.sql(D.ACTUAL_GRANTS))


@query("q_grants_unexpected", f"{ACTUAL_KEYS} EXCEPT {EXPECTED}")
def q_grants_unexpected(t: Tables) -> DataFrame:
    return grants.unexpected(expected(t), t.sql(D.ACTUAL_GRANTS))


@query(
    "q_schemas_uncovered",
    f"""SELECT DISTINCT 'prod.' || tgt_schema AS object_name FROM ({duck(D.SALES_MAPPING)})
WHERE 'prod.' || tgt_schema NOT IN (SELECT object_name FROM ({ACTUAL}) WHERE object_type = 'SCHEMA')""",
)
def q_schemas_uncovered(t: Tables) -> DataFrame:
    return grants.uncovered(t.sql(D.SALES_MAPPING), t.sql(D.ACTUAL_GRANTS))


@query(
    "q_principal_grants",
    f"SELECT object_name, principal, privilege FROM ({ACTUAL}) WHERE principal = 'user 7' AND object_type = 'SCHEMA'",
)
def q_principal_grants(t: Tables) -> DataFrame:
    return grants.of_principal(t.sql(D.ACTUAL_GRANTS), "user 7").select("object_name", "principal", "privilege")


# ---------------------------------------------------------------- rollback


def permission_log(t: Tables) -> DataFrame:
    done = F.when(F.col("tgt_privilege") == "MODIFY", "ERROR").otherwise("SUCCESS")
    return grants.log(mapped_grants(t)).withColumn("status", done)


REVOKES = f"""SELECT DISTINCT 1 AS step, 'REVOKE' AS action, tgt_object, src_object,
'REVOKE ' || tgt_privilege || ' ON ' || securable || ' FROM `' || principal || '`' AS statement
FROM ({MAPPED_GRANTS}) WHERE grant_sql IS NOT NULL AND tgt_privilege <> 'MODIFY'"""


@query("q_rollback_revokes", REVOKES)
def q_rollback_revokes(t: Tables) -> DataFrame:
    return rollback.revokes(permission_log(t))


KIND = "CASE WHEN object_type = 'VIEW' THEN 'VIEW' ELSE 'TABLE' END"
DROPS = f"""SELECT 2 AS step, 'DROP_' || {KIND} AS action, concat_ws('.', tgt_catalog, tgt_schema, table_name) AS tgt_object,
concat_ws('.', database_name, table_name) AS src_object,
'DROP ' || {KIND} || ' IF EXISTS `' || tgt_catalog || '`.`' || tgt_schema || '`.`' || table_name || '`' AS statement
FROM ({OBJECTS}) JOIN ({MAPPING}) m ON database_name = src_database"""


@query(
    "q_rollback_plan",
    f"""SELECT *, 'DRY_RUN' AS status FROM ({REVOKES} UNION ALL {DROPS}
UNION ALL SELECT DISTINCT 3, 'DROP_SCHEMA', tgt_catalog || '.' || tgt_schema, NULL, 'DROP SCHEMA IF EXISTS `' || tgt_catalog || '`.`' || tgt_schema || '` CASCADE' FROM ({MAPPING}) WHERE status <> 'ALREADY_EXISTS'
UNION ALL SELECT 4, 'DROP_CATALOG', tgt_catalog, NULL, 'DROP CATALOG IF EXISTS `' || tgt_catalog || '` CASCADE' FROM ({MAPPING}) GROUP BY tgt_catalog HAVING count(*) FILTER (status = 'ALREADY_EXISTS') = 0)""",
)
def q_rollback_plan(t: Tables) -> DataFrame:
    m = object_mapping(t)
    return rollback.plan(rollback.target_objects(objects(t), m), m, permission_log(t))


@query("q_rollback_views_only", f"SELECT *, 'DRY_RUN' AS status FROM ({DROPS}) WHERE action = 'DROP_VIEW' AND src_object LIKE 'brand\\_12.%' ESCAPE '\\'")
def q_rollback_views_only(t: Tables) -> DataFrame:
    m = object_mapping(t)
    return rollback.plan(rollback.target_objects(objects(t), m), m, None, "VIEWS_ONLY", "brand_12")


@query(
    "q_rollback_integrity",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows, 'OK' AS status FROM {n}" for n in TABLE_NAMES)
    + " UNION ALL SELECT 'gone', -1, 'MISSING_OR_ERROR'",
)
def q_rollback_integrity(t: Tables) -> DataFrame:
    sources = {n: (lambda n=n: getattr(t, n)) for n in TABLE_NAMES}
    sources["gone"] = lambda: t.spark.read.parquet(t.path("gone"))
    return rollback.integrity(t.spark, sources).select("table_name", "n_rows", "status")
