"""View text, grants and rollback plans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lockgate.functions import sqltext
from lockgate.operators import compat, grants, rollback, viewsql

DATABASES = ["clientes", "credito", "financeiro"]


@pytest.fixture(scope="module")
def mapping(spark):
    rows = [(d, "prod", f"{d}_new" if d == "financeiro" else d, False, "CREATED") for d in DATABASES]
    return spark.createDataFrame(rows, "src_database string, tgt_catalog string, tgt_schema string, name_changed boolean, status string")


def rewrite(spark, mapping, text):
    views = spark.createDataFrame([("db", "v", text)], "database_name string, table_name string, body string")
    return viewsql.rewrite_refs(views, mapping, "prod").first().adapted


@pytest.mark.parametrize(
    "text, expected",
    [
        ("SELECT * FROM `clientes`.`pf`", "SELECT * FROM `prod`.`clientes`.`pf`"),
        ("SELECT * FROM `financeiro`.`t`", "SELECT * FROM `prod`.`financeiro_new`.`t`"),
        ("SELECT * FROM `unknown`.`t`", "SELECT * FROM `prod`.`unknown`.`t`"),
        ("SELECT `a`.`b` FROM clientes.pf a", "SELECT `a`.`b` FROM `prod`.`clientes`.`pf` a"),
        ("SELECT a.b FROM unknown.pf a", "SELECT a.b FROM unknown.pf a"),
        ("SELECT * FROM `prod`.`clientes`.`pf`", "SELECT * FROM `prod`.`clientes`.`pf`"),
        ("SELECT x.clientes.pf FROM t", "SELECT x.clientes.pf FROM t"),
        ("SELECT 1", "SELECT 1"),
        ("`clientes`.`pf`", "`prod`.`clientes`.`pf`"),
        (
            "SELECT c.n, s.v\n FROM `clientes`.`pf` c\n JOIN `credito`.`score` s\n ON c.id = s.id",
            "SELECT c.n, s.v\n FROM `prod`.`clientes`.`pf` c\n JOIN `prod`.`credito`.`score` s\n ON c.id = s.id",
        ),
    ],
)
def test_rewrite(spark, mapping, text, expected):
    once = rewrite(spark, mapping, text)
    assert once == expected
    assert rewrite(spark, mapping, once) == once


def test_rewrite_many_references_in_order(spark, mapping):
    text = ", ".join(f"clientes.t{i} $1\\{i}" for i in range(50))
    assert rewrite(spark, mapping, text) == ", ".join(f"`prod`.`clientes`.`t{i}` $1\\{i}" for i in range(50))


def test_view_body(spark):
    cases = {
        "CREATE VIEW v AS SELECT 1": "SELECT 1",
        "create view v as\n  select a as b  \n": "select a as b",
        "no body": "no body",
        "CREATE VIEW v AS\n": "",
        "class basic": "class basic",
    }
    df = spark.createDataFrame([(k,) for k in cases], "d string")
    assert {r.d: r.b for r in df.select("d", sqltext.view_body(F.col("d")).alias("b")).collect()} == cases


def test_view_refs(spark):
    ddl = "CREATE VIEW `a`.`v` AS SELECT * FROM `a`.`t` JOIN `b`.`u` JOIN `c`.`w`" + " " * 600
    views = spark.createDataFrame([("a", "v", ddl)], "database_name string, table_name string, ddl string")
    found = compat.view_refs(views).collect()
    assert {(r.ref_database, r.ref_table) for r in found} == {("b", "u"), ("c", "w")}
    assert found[0].ddl_snippet == ddl


def test_recreate(spark, mapping):
    rows = [
        ("clientes", "good", "CREATE VIEW x AS SELECT * FROM clientes.pf"),
        ("clientes", "bad", "CREATE VIEW x AS nonsense"),
        ("lost", "none", None),
    ]
    views = spark.createDataFrame(rows, "database_name string, table_name string, ddl string")
    got = {r.src_view: r for r in viewsql.recreate(views, mapping, "prod").collect()}
    assert got["clientes.good"].status == "DRY_RUN_OK"
    assert got["clientes.good"].create_sql == "CREATE OR REPLACE VIEW `prod`.`clientes`.`good`\nAS\nSELECT * FROM `prod`.`clientes`.`pf`"
    assert got["clientes.bad"].status == "DRY_RUN_SYNTAX_ERROR"
    assert (got["lost.none"].status, got["lost.none"].tgt_view, got["lost.none"].create_sql) == ("EXTRACTION_ERROR", "prod.lost.none", None)
    real = {r.src_view: r.status for r in viewsql.recreate(views, mapping, "prod", dry_run=False).collect()}
    assert real == {"clientes.good": "SUCCESS", "clientes.bad": "ERROR", "lost.none": "EXTRACTION_ERROR"}


GRANTS = "src_object_type string, src_database string, src_object string, principal string, privilege string, grant_option boolean"


def mapped(spark, mapping, *rows):
    return grants.map_grants(spark.createDataFrame([(*r, False) for r in rows], GRANTS), mapping, "prod")


@pytest.mark.parametrize(
    "privilege, expected",
    [
        ("SELECT", "SELECT"),
        ("select", "SELECT"),
        ("INSERT", "MODIFY"),
        ("UPDATE", "MODIFY"),
        ("DELETE", "MODIFY"),
        ("MODIFY", "MODIFY"),
        ("ALL PRIVILEGES", "ALL PRIVILEGES"),
        ("ALL", "ALL PRIVILEGES"),
        ("CREATE", "CREATE TABLE"),
        ("USAGE", "USE SCHEMA"),
        ("READ_METADATA", "BROWSE"),
        ("CUSTOM_PRIV", "CUSTOM_PRIV"),
        ("custom_priv", "CUSTOM_PRIV"),
    ],
)
def test_privileges(spark, mapping, privilege, expected):
    assert mapped(spark, mapping, ("MANAGED", "clientes", "clientes.pf", "ana", privilege)).first().tgt_privilege == expected


def test_grant_objects(spark, mapping):
    rows = mapped(
        spark,
        mapping,
        ("DATABASE", "financeiro", "financeiro", "p1", "CREATE"),
        ("EXTERNAL", "clientes", "clientes.pf", "p2", "INSERT"),
        ("VIEW", "other", "other.v", "p3", "SELECT"),
        ("FUNCTION", "clientes", "clientes.f", "p4", "SELECT"),
    )
    got = {r.principal: (r.tgt_object, r.grant_sql) for r in rows.collect()}
    assert got == {
        "p1": ("prod.financeiro_new", "GRANT USE SCHEMA ON SCHEMA `prod`.`financeiro_new` TO `p1`"),
        "p2": ("prod.clientes.pf", "GRANT MODIFY ON TABLE `prod`.`clientes`.`pf` TO `p2`"),
        "p3": ("prod.other.v", "GRANT SELECT ON VIEW `prod`.`other`.`v` TO `p3`"),
        "p4": (None, None),
    }


def test_statements_are_distinct(spark, mapping):
    rows = [("MANAGED", "clientes", "clientes.pf", "ana", p) for p in ("INSERT", "UPDATE", "DELETE")]
    assert grants.statements(mapped(spark, mapping, *rows)).count() == 1


def test_revoke_changes_the_last_to_only(spark):
    grant = "GRANT SELECT ON TABLE `prod`.`GRANT TO x`.`t` TO `road TO rome`"
    df = spark.createDataFrame([(grant,)], "g string")
    assert df.select(grants.revoke(F.col("g"))).first()[0] == "REVOKE SELECT ON TABLE `prod`.`GRANT TO x`.`t` FROM `road TO rome`"


def test_diff_is_distinct_and_null_safe(spark):
    schema = "object_name string, principal string, privilege string"
    want = spark.createDataFrame([("a", "p", "S"), ("a", "p", "S"), ("b", "p", "S"), (None, "p", "S")], schema)
    have = spark.createDataFrame([("a", "p", "S"), (None, "p", "S"), ("c", "p", "S"), ("c", "p", "S")], schema)
    assert {(r.object_name, r.finding) for r in grants.diff(want, have).collect()} == {("b", "MISSING"), ("c", "UNEXPECTED")}
    assert grants.diff(want, have).count() == 2


OBJECTS = "tgt_catalog string, tgt_schema string, object_name string, object_type string, src_database string"


@pytest.fixture(scope="module")
def objects(spark):
    return spark.createDataFrame([("prod", "clientes", "pf", "TABLE", "clientes"), ("prod", "clientes", "v", "VIEW", "clientes")], OBJECTS)


def test_rollback_scopes(spark, mapping, objects):
    log = grants.log(mapped(spark, mapping, ("MANAGED", "clientes", "clientes.pf", "ana", "SELECT")), "SUCCESS")

    def actions(scope, databases=""):
        return [r.action for r in rollback.plan(objects, mapping, log, scope, databases).orderBy("step", "action").collect()]

    assert actions("FULL") == ["REVOKE", "DROP_TABLE", "DROP_VIEW", *["DROP_SCHEMA"] * 3, "DROP_CATALOG"]
    assert actions("FULL", "clientes") == ["REVOKE", "DROP_TABLE", "DROP_VIEW"]
    assert actions("FULL", "credito") == []
    assert actions("TABLES_ONLY") == ["DROP_TABLE"]
    assert actions("VIEWS_ONLY") == ["DROP_VIEW"]
    assert actions("GRANTS_ONLY") == ["REVOKE"]
    assert rollback.plan(objects, mapping, None, "GRANTS_ONLY").count() == 0
    with pytest.raises(ValueError):
        rollback.plan(objects, mapping, log, "EVERYTHING")


def test_rollback_keeps_what_was_there_before(spark, mapping, objects):
    mixed = mapping.withColumn("status", F.when(F.col("src_database") == "credito", "ALREADY_EXISTS").otherwise("CREATED"))
    actions = [(r.action, r.tgt_object) for r in rollback.plan(objects, mixed).filter("step > 2").orderBy("tgt_object").collect()]
    assert actions == [("DROP_SCHEMA", "prod.clientes"), ("DROP_SCHEMA", "prod.financeiro_new")]


def test_rewrite_keeps_views_without_text(spark, mapping):
    views = spark.createDataFrame([("db", "v", None), ("db", "w", "SELECT 1")], "database_name string, table_name string, body string")
    assert {r.table_name: r.adapted for r in viewsql.rewrite_refs(views, mapping, "prod").collect()} == {"v": None, "w": "SELECT 1"}


def test_long_location_names_stay_apart(spark):
    from lockgate.functions import names

    df = spark.createDataFrame([("s3://" + "x" * 200 + tail,) for tail in "ab"], "p string")
    found = [r[0] for r in df.select(names.location_name(F.col("p"))).collect()]
    assert len(set(found)) == 2 and {len(n) for n in found} == {127}


def test_rollback_texts(spark, mapping, objects):
    got = {r.action: r.statement for r in rollback.plan(objects, mapping).collect()}
    assert got["DROP_TABLE"] == "DROP TABLE IF EXISTS `prod`.`clientes`.`pf`"
    assert got["DROP_VIEW"] == "DROP VIEW IF EXISTS `prod`.`clientes`.`v`"
    assert got["DROP_CATALOG"] == "DROP CATALOG IF EXISTS `prod` CASCADE"
    log = rollback.log(rollback.plan(objects, mapping), dt.datetime(2024, 1, 1))
    assert "planned_at" in log.columns


def test_rollback_guard(spark, mapping, objects):
    with pytest.raises(PermissionError):
        rollback.plan(objects, mapping, dry_run=False)
    assert {r.status for r in rollback.plan(objects, mapping, dry_run=False, confirm=True).collect()} == {"PLANNED"}


def test_integrity(spark):
    sources = {"here": lambda: spark.range(3), "gone": lambda: spark.read.parquet("/no/such/path")}
    got = {r.table_name: (r.n_rows, r.status) for r in rollback.integrity(spark, sources).collect()}
    assert got == {"here": (3, "OK"), "gone": (-1, "MISSING_OR_ERROR")}
