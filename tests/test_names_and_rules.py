"""Name rules, risk classes, name mapping, storage roots, statistics texts."""

import re

import pytest
from pyspark.sql import functions as F

from lockgate import constants as K
from lockgate.functions import filters, names
from lockgate.functions.stats import parse_stats
from lockgate.operators import compat, mapping


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "v string").select(expression(F.col("v")).alias("r")).first()[0]


@pytest.mark.parametrize(
    "name, expected",
    [
        ("clientes_pf", "OK"),
        ("tabela_2024", "OK"),
        ("a" * 255, "OK"),
        ("a" * 256, "INVALID_TOO_LONG"),
        ("", "INVALID_EMPTY"),
        (None, "INVALID_EMPTY"),
        ("minha-tabela", "INVALID_CHARS: minha-tabela"),
        ("minha tabela", "INVALID_CHARS: minha tabela"),
        ("db.table", "INVALID_CHARS: db.table"),
        ("tabela\n", "INVALID_CHARS: tabela\n"),
        ("-" * 256, "INVALID_CHARS: " + "-" * 256),
    ],
)
def test_name_check(spark, name, expected):
    assert one(spark, name, names.name_check) == expected


def test_reserved_words(spark):
    for word in ["catalog", "schema", "TABLE", "View", "COLUMN"]:
        assert one(spark, word, names.reserved_check) == f"RESERVED_WORD: {word}"
    for word in ["clientes", "catalogs", "", None]:
        assert one(spark, word, names.reserved_check) == "OK"


@pytest.mark.parametrize(
    "name, expected",
    [
        ("clientes_pf", "clientes_pf"),
        ("minha-tabela", "minha_tabela"),
        ("minha tabela", "minha_tabela"),
        ("MinhaTabela", "minhatabela"),
        ("2024_vendas", "_2024_vendas"),
        ("tabela@#especial!", "tabela__especial_"),
        ("", None),
        (None, None),
    ],
)
def test_sanitize(spark, name, expected):
    assert one(spark, name, names.sanitize) == expected


@pytest.mark.parametrize(
    "path, root, location",
    [
        ("abfss://c@a.dfs.core.windows.net/d/e/f", "abfss://c@a.dfs.core.windows.net/d", "abfss_c_a_dfs_core_windows_net_d"),
        ("wasbs://c@a.blob.core.windows.net/d/e", "wasbs://c@a.blob.core.windows.net/d", "wasbs_c_a_blob_core_windows_net_d"),
        ("s3a://bucket/x/y", "s3a://bucket", "s3a_bucket"),
        ("s3://bucket/x/y", "s3://bucket", "s3_bucket"),
        ("gs://bucket/x", "gs://bucket", "gs_bucket"),
        ("dbfs:/mnt/lake/x", "dbfs:/mnt/lake", "dbfs_mnt_lake"),
        ("dbfs:/user/x", "dbfs:/user/x", "dbfs_user_x"),
        ("x-s3://b/c", "x-s3://b/c", "x_s3_b_c"),
    ],
)
def test_storage_roots(spark, path, root, location):
    assert one(spark, path, names.storage_root) == root
    assert one(spark, root, names.location_name) == location


def test_long_location_names_are_cut_and_stay_apart(spark):
    """A name over the limit keeps its start and ends in a hash of the whole path."""
    paths = ["/" + "a" * 300, "/" + "a" * 301, "/" + "a" * 127 + "/x", "/" + "a" * 127 + "/y", "/" + "a" * 127]
    found = [one(spark, p, names.location_name) for p in paths]
    assert found[-1] == "a" * 127
    assert all(len(n) == 127 and re.fullmatch(r"a{110}_[0-9a-f]{16}", n) for n in found[:-1])
    assert len(set(found)) == len(paths)


def test_paths_that_share_a_location_name_are_told_apart(spark):
    paths = ["s3://a-b", "s3://a_b", "s3://a/b", "s3://c", "s3://d"]
    roots = spark.createDataFrame([(p,) for p in [*paths, "s3://c"]], "storage_path string")
    made = mapping.locations(roots, "main")
    assert {(r.location_name, r.n_paths) for r in mapping.location_collisions(made).collect()} == {("s3_a_b", 3)}
    apart = {r.storage_path: r.location_name for r in mapping.told_apart(made).collect()}
    assert len(set(apart.values())) == len(paths)
    assert apart["s3://c"] == "s3_c" and all(re.fullmatch("s3_a_b_[0-9a-f]{16}", apart[p]) for p in paths[:3])


def test_parse_stats(spark):
    df = spark.createDataFrame([("12 bytes, 3 rows", False), ("12 bytes", False), (None, False), ("1 rows", True)], "s string, f boolean")
    rows, size = parse_stats(F.col("s"), F.col("f"))
    assert [tuple(r) for r in df.select(rows, size).collect()] == [(3, 12), (0, 12), (0, 0), (-1, -1)]


def test_in_list(spark):
    df = spark.createDataFrame([("a",), ("b",), ("ab",)], "n string")
    assert filters.in_list(df, "n", "  ").count() == 3
    assert {r.n for r in filters.in_list(df, "n", " a , b").collect()} == {"a", "b"}


INVENTORY = "database_name string, table_name string, object_type string, is_delta boolean, serde_library string, input_format string"


def inventory(spark, *rows):
    return spark.createDataFrame(list(rows), INVENTORY)


@pytest.mark.parametrize(
    "kind, delta, complexity, strategy",
    [
        ("MANAGED", True, "LOW", K.DEEP_COPY),
        ("EXTERNAL", True, "LOW", K.REGISTER_IN_PLACE),
        ("VIEW", False, "MEDIUM", K.RECREATE_VIEW),
        ("VIEW", True, "MEDIUM", K.RECREATE_VIEW),
        ("MANAGED", False, "HIGH", K.CONVERT),
        ("EXTERNAL", False, "HIGH", K.CONVERT),
        ("OTHER", True, "MEDIUM", K.REVIEW),
        ("ERROR", False, "ERROR", K.ERROR),
    ],
)
def test_complexity_and_strategy(spark, kind, delta, complexity, strategy):
    row = compat.apply_rules(inventory(spark, ("db", "t", kind, delta, None, None))).first()
    assert (row.migration_complexity, row.recommended_strategy) == (complexity, strategy)
    assert row.needs_format_conversion is not delta
    assert row.has_issues is False


def test_issues_and_problems(spark):
    rows = [
        ("db", "ok", "MANAGED", True, None, None),
        ("db", "bad-name", "MANAGED", True, "", ""),
        ("Catalog", "t", "MANAGED", True, K.UNSUPPORTED_SERDES[1], K.UNSUPPORTED_INPUT_FORMATS[0]),
    ]
    checks = compat.apply_rules(inventory(spark, *rows))
    assert {r.table_name for r in checks.filter("has_issues").collect()} == {"bad-name", "t"}
    assert {(r.table_name, r.check) for r in compat.problems(checks).collect()} == {
        ("bad-name", "check_name_table"),
        ("t", "check_reserved_db"),
        ("t", "unsupported_serde"),
        ("t", "unsupported_input_format"),
    }
    assert tuple(compat.summary(checks).first()) == (3, 2, 1)


def test_mapping_status_and_collisions(spark):
    inv = inventory(spark, *[(d, "t", "MANAGED", True, None, None) for d in ("My-DB", "my_db", "other", "other")])
    existing = spark.createDataFrame([("other",)], "tgt_schema string")
    rows = {r.src_database: r for r in mapping.schema_mapping(inv, "prod", existing, dry_run=False).collect()}
    assert {k: (r.tgt_schema, r.name_changed, r.status) for k, r in rows.items()} == {
        "My-DB": ("my_db", True, "CREATED"),
        "my_db": ("my_db", False, "CREATED"),
        "other": ("other", False, "ALREADY_EXISTS"),
    }
    dry = mapping.schema_mapping(inv, "prod")
    assert {r.status for r in dry.collect()} == {"DRY_RUN"}
    assert [(r.tgt_schema, r.n_sources) for r in mapping.collisions(dry).collect()] == [("my_db", 2)]
