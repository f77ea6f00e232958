"""Reconciliation, with injected faults of known size."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lockgate.operators import profile, reports
from lockgate.operators import reconcile as R
from lockgate.sources import scratch


def status(spark, s, t, tolerance=0.0):
    row = R.with_count_status(spark.createDataFrame([(s, t)], "n_src bigint, n_tgt bigint"), tolerance).first()
    return row.status, row.diff, row.diff_pct


@pytest.mark.parametrize(
    "s, t, tolerance, expected",
    [
        (1000, 1000, 0.0, ("OK", 0, 0.0)),
        (1000, 999, 0.0, ("COUNT_MISMATCH", 1, 0.1)),
        (1000, 991, 1.0, ("OK", 9, 0.9)),
        (1000, 980, 1.0, ("COUNT_MISMATCH", 20, 2.0)),
        (0, 0, 0.0, ("OK", 0, 0.0)),
        (200, 190, 0.0, ("COUNT_MISMATCH", 10, 5.0)),
        (0, 5, 0.0, ("COUNT_MISMATCH", 5, 100.0)),
        (0, 5, 100.0, ("COUNT_MISMATCH", 5, 100.0)),
        (3, 2, 0.0, ("COUNT_MISMATCH", 1, 33.333333)),
        (-1, 5, 0.0, ("ERROR", -1, -1.0)),
        (5, None, 0.0, ("ERROR", -1, -1.0)),
    ],
)
def test_count_status(spark, s, t, tolerance, expected):
    assert status(spark, s, t, tolerance) == expected


def test_counts_of_pairs(spark):
    pairs = [R.Pair("same", spark.range(5), spark.range(5)), R.Pair("gone", spark.range(5), lambda: spark.read.parquet("/no/path"))]
    assert {r.table_name: r.status for r in R.counts(spark, pairs).collect()} == {"same": "OK", "gone": "ERROR"}
    assert R.counts(spark, []).count() == 0


def schema_report(spark, src, tgt):
    return R.schema_diff(
        profile.columns(spark, {"t": spark.createDataFrame([], src)}), profile.columns(spark, {"t": spark.createDataFrame([], tgt)})
    ).first()


def test_schema_diff(spark):
    same = schema_report(spark, "id bigint, nome string", "id bigint, nome string")
    assert same.status == "OK" and same.num_cols_src == 2
    missing = schema_report(spark, "id bigint, nome string", "id bigint")
    assert (missing.status, missing.missing_cols, missing.extra_cols) == ("MISMATCH", ["nome"], [])
    extra = schema_report(spark, "id bigint", "id bigint, b string, a string")
    assert (extra.status, extra.extra_cols) == ("MISMATCH", ["a", "b"])
    typed = schema_report(spark, "id bigint, v double", "id int, v double")
    assert (typed.status, typed.type_mismatches) == ("MISMATCH", {"id": "src=bigint / tgt=int"})
    order = schema_report(spark, "a int, b int, c int", "c int, x int, a int")
    assert (order.order_mismatch, order.missing_cols, order.extra_cols) == (True, ["b"], ["x"])
    kept = schema_report(spark, "a int, b int, c int", "a int, c int")
    assert kept.order_mismatch is False
    lost = schema_report(spark, "a int", T.StructType([]))
    assert (lost.status, lost.error_message) == ("ERROR", "target not found")


def test_type_aliases(spark):
    df = spark.createDataFrame([("INT",), ("integer",), ("long",), ("decimal(10, 2)",), ("bool",), ("float",)], "t string")
    got = [r[0] for r in df.select(R.normalized_type(F.col("t"))).collect()]
    assert got == ["integer", "integer", "bigint", "decimal(10,2)", "boolean", "real"]


def test_numeric_columns():
    fields = "a byte,b short,c int,d long,e float,f double,g decimal(5,2)".split(",")
    kinds = {"byte": T.ByteType(), "short": T.ShortType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType()}
    schema = T.StructType()
    for f in fields[:6]:
        name, kind = f.split()
        schema.add(name, kinds[kind])
    schema.add("g", T.DecimalType(5, 2)).add("h", T.ArrayType(T.IntegerType())).add("i", T.StringType()).add("j", T.DayTimeIntervalType())
    assert R.numeric_columns(schema) == list("abcdefg")
    assert R.numeric_columns(schema, 5) == list("abcde")


def checks(df):
    return {(r.column_name, r.metric): (r.src_value, r.tgt_value, r.status) for r in df.collect()}


def test_checksums(spark):
    src = spark.range(1, 11).selectExpr("id", "id * 1.5D AS valor", "'x' AS t")
    assert {v[2] for v in checks(R.checksums(src, src.repartition(3))).values()} == {"OK"}
    tgt = src.withColumn("valor", F.when(F.col("id") == 5, F.col("valor") + 1).otherwise(F.col("valor")))
    got = checks(R.checksums(src, tgt))
    assert got["valor", "sum"] == ("82.500000", "83.500000", "CHECKSUM_MISMATCH")
    assert got["valor", "max"][2] == got["id", "sum"][2] == "OK"
    lost = checks(R.checksums(src, src.drop("valor")))
    assert lost["valor", "sum"] == ("82.500000", None, "CHECKSUM_MISMATCH")
    assert R.checksums(src.select("t"), src).count() == 0


def test_sums_are_exact_at_the_extremes(spark):
    big = 2**63 - 1
    df = spark.createDataFrame([(big, 1e300, 0.1), (big, 1e30, 0.2), (-(2**63), None, float("nan")), (None, -1e30, None)], "a bigint, b double, c double")
    got = checks(R.checksums(df, df))
    assert got["a", "sum"][0] == str(2 * big - 2**63)
    assert got["b", "sum"][0] == "0.000000"
    assert got["c", "sum"][0] == "0.300000"
    assert {v[2] for v in got.values()} == {"OK"}
    negatives = spark.range(1000).selectExpr("-id * 1000000007 AS a", "-id / 8D AS b", "cast(-id as decimal(10,3)) AS c")
    got = checks(R.checksums(negatives, negatives))
    assert got["a", "sum"][0] == str(-499500 * 1000000007)
    assert got["b", "sum"][0] == "-62437.500000" and got["c", "sum"][0] == "-499500.000"


def test_empty_tables(spark):
    none = spark.createDataFrame([], "id bigint, v double, p string")
    some = spark.createDataFrame([(1, 1.0, "a")], none.schema)
    assert {r.status for r in R.one_pass(none, none, ["p"]).collect()} == {"OK"}
    assert "MISMATCH" in {r.status for r in R.one_pass(none, some, ["p"]).collect()}
    assert R.row_diff(none, none, ["id"]).count() == 0
    assert R.row_diff(some, none, ["id"], buckets=8).first().finding == "ONLY_SOURCE"


def test_partitions(spark):
    src = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("c", 1), (None, 1)], "p string, v int")
    tgt = spark.createDataFrame([("a", 1), ("b", 1), ("d", 1), (None, 1)], "p string, v int")
    got = {r.p: r.status for r in R.partitions(src, tgt, ["p"]).collect()}
    assert got == {"a": "DIFFERENT", "b": "OK", "c": "MISSING", "d": "EXTRA", None: "OK"}


NESTED = "id bigint, s string, d double, dt date, a array<int>, m map<string,int>, st struct<x:int,y:string>, b binary"


def test_hash_covers_every_type_and_null(spark):
    base = spark.sql("SELECT 1L AS id, 'a' AS s, 1.5D AS d, DATE'2024-01-01' AS dt, array(1,2) AS a, map('k',1,'l',2) AS m, struct(1 AS x,'y' AS y) AS st, X'01' AS b")
    changes = {
        "s": F.lit(""),
        "d": F.lit(1.25),
        "dt": F.lit(None).cast("date"),
        "a": F.expr("array(2,1)"),
        "m": F.expr("map('k',2,'l',2)"),
        "st": F.expr("struct(1 AS x, cast(null as string) AS y)"),
        "b": F.expr("X'02'"),
    }
    for kind in ("fast", "portable"):
        prints = {R.fingerprint(base, 1, hash_kind=kind).first().fingerprint}
        for column, value in changes.items():
            prints.add(R.fingerprint(base.withColumn(column, value), 1, hash_kind=kind).first().fingerprint)
        prints.add(R.fingerprint(base.withColumn("s", F.lit(None).cast("string")), 1, hash_kind=kind).first().fingerprint)
        assert len(prints) == len(changes) + 2
        swapped = base.withColumn("m", F.expr("map('l',2,'k',1)"))
        assert R.row_diff(base, swapped, ["id"], hash_kind=kind).count() == 0


def test_hash_tells_shifted_text_and_nulls_apart(spark):
    schema = "id bigint, a string, b string"
    rows = [("x|1:y", "z"), ("x", "1:y|z"), (None, "q"), ("q", None), ("N", "q"), ("", "q")]
    for kind in ("fast", "portable"):
        prints = {R.fingerprint(spark.createDataFrame([(1, *r)], schema), 1, hash_kind=kind).first().fingerprint for r in rows}
        assert len(prints) == len(rows)


def test_fingerprint_ignores_order_and_partitioning_but_not_duplicates(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 AS v")
    want = sorted(map(tuple, R.fingerprint(df, 8).collect()))
    assert sorted(map(tuple, R.fingerprint(df.orderBy(F.desc("id")).repartition(13), 8).collect())) == want
    twice = R.fingerprint_diff(df, df.union(df.filter("id = 3")), 8)
    assert twice.filter("status <> 'OK'").count() == 1


@pytest.mark.parametrize("buckets", [None, 64])
@pytest.mark.parametrize("kind", ["fast", "portable"])
def test_row_diff(spark, buckets, kind):
    src = spark.range(200).selectExpr("id", "id * 2 AS v", "if(id % 10 = 0, null, 'x') AS s")
    tgt = src.filter("id not in (7, 8)").withColumn("v", F.when(F.col("id") == 9, -1).otherwise(F.col("v")))
    tgt = tgt.withColumn("s", F.when(F.col("id") == 10, "").otherwise(F.col("s"))).union(spark.sql("SELECT 999L, 1L, 'x'"))
    tgt = tgt.union(src.filter("id = 20"))
    got = {r.id: (r.finding, r.n_src, r.n_tgt) for r in R.row_diff(src, tgt, ["id"], buckets, kind).collect()}
    assert got == {
        7: ("ONLY_SOURCE", 1, 0),
        8: ("ONLY_SOURCE", 1, 0),
        9: ("CHANGED", 1, 1),
        10: ("CHANGED", 1, 1),
        20: ("CHANGED", 1, 2),
        999: ("ONLY_TARGET", 0, 1),
    }


def test_row_diff_with_one_hot_key(spark):
    """A third of the rows share one key; one of them differs."""
    src = spark.range(30_000).selectExpr("if(id % 3 = 0, -1L, id) AS k", "id AS v")
    tgt = src.withColumn("v", F.when(F.col("v") == 2997, -5).otherwise(F.col("v")))
    got = R.row_diff(src, tgt, ["k"]).collect()
    assert [(r.k, r.n_src, r.n_tgt, r.finding) for r in got] == [(-1, 10_000, 10_000, "CHANGED")]


def test_sampled_hash(spark):
    src = spark.range(5000).selectExpr("id", "id AS v")
    tgt = src.withColumn("v", F.col("v") + 1)
    everything = {r.id for r in R.sampled_hash(src, tgt, ["id"], 1.0).collect()}
    assert everything == {r.id for r in R.row_diff(src, tgt, ["id"]).collect()} == set(range(5000))
    some = {r.id for r in R.sampled_hash(src, tgt, ["id"], 0.1).collect()}
    assert 350 < len(some) < 650
    assert some == {r.id for r in R.sampled_hash(src.repartition(7), tgt, ["id"], 0.1).collect()}
    assert R.sampled_hash(src, src.repartition(3), ["id"], 0.5).count() == 0


@pytest.mark.parametrize("buckets", [None, 16])
def test_multiset_diff_against_brute_force(spark, buckets):
    rng = random.Random(5)
    a = [(rng.randrange(6), rng.choice(["x", "y", None])) for _ in range(300)]
    b = a[20:] + [(rng.randrange(6), "z") for _ in range(15)]
    schema = "n int, s string"
    want = {k: (Counter(a)[k], Counter(b)[k]) for k in set(a) | set(b) if Counter(a)[k] != Counter(b)[k]}
    got = R.multiset_diff(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), buckets)
    assert {(r.n, r.s): (r.n_src, r.n_tgt) for r in got.collect()} == want


def test_one_pass_agrees_with_the_single_checks(spark):
    src = spark.range(500).selectExpr("id", "id / 4D AS v", "cast(id as decimal(12,2)) AS d", "concat('p', id % 3) AS p")
    tgt = src.filter("id % 50 <> 1")
    report = R.one_pass(src, tgt, ["p"], 4, ["id"])
    rows = {(r.scope, r.item, r.metric): (r.src_value, r.tgt_value, r.status) for r in report.collect()}
    assert rows["table", "all", "rows"] == ("500", "490", "MISMATCH")
    for (column, metric), (s, t, st) in checks(R.checksums(src, tgt)).items():
        assert rows["table", "all", f"{metric}({column})"] == (s, t, "OK" if st == "OK" else "MISMATCH")
    for r in R.partitions(src, tgt, ["p"]).collect():
        assert rows["partition", f'{{"p":"{r.p}"}}', "rows"][:2] == (str(r.n_src), str(r.n_tgt))
    for r in R.fingerprint_diff(src, tgt, 4, ["id"]).collect():
        assert rows["bucket", str(r.bucket), "fingerprint"][:2] == (str(r.src_fingerprint), str(r.tgt_fingerprint))


def test_one_pass_reads_for_each_scope_what_it_reports(spark):
    """Three roll-ups of stored cells: the sides are not scanned again, partitions read two columns, buckets five."""
    src = spark.range(300).selectExpr("id", "id / 4D AS v", "id * 2 AS `a b#c.d`", "concat('p', id % 3) AS p")
    report = R.one_pass(src, src.filter("id <> 7"), ["p"], 8, ["id"])
    scans = [line for line in report._jdf.queryExecution().executedPlan().toString().splitlines() if "Scan" in line or "Range" in line]
    assert len(scans) == 3 and all("FileScan parquet" in line for line in scans)
    widths = sorted(line.split("ReadSchema: struct<")[1].count(":") for line in scans)
    assert widths[0] <= 3 and widths[1] <= 5 < widths[2]
    rows = {(r.scope, r.item, r.metric): (r.src_value, r.tgt_value) for r in report.collect()}
    assert rows["table", "all", "sum(a b#c.d)"] == (str(299 * 300), str(299 * 300 - 14))
    assert rows["partition", '{"p":"p1"}', "rows"] == ("100", "99")


def test_gate_and_rollup(spark):
    good = spark.createDataFrame([("OK",), ("OK",)], "status string")
    bad = spark.createDataFrame([("OK",), ("COUNT_MISMATCH",), ("ERROR",), (None,)], "status string")
    assert reports.gate(good) == 0
    assert reports.gate(bad, fail_on_mismatch=False) == 3
    with pytest.raises(reports.ReconciliationError):
        reports.gate(bad)
    got = {r.check: (r.n_ok, r.n_different, r.n_error) for r in reports.rollup({"a": good, "b": bad}).collect()}
    assert got == {"a": (2, 0, 0), "b": (1, 1, 1)}


def test_unmigrated(spark):
    inv = spark.createDataFrame([("d", "a", "MANAGED", "parquet", False), ("d", "b", "VIEW", "", False)], "database_name string, table_name string, object_type string, data_provider string, is_delta boolean")
    log = spark.createDataFrame([("d.a", "SUCCESS"), ("d.b", "ERROR")], "src_table string, status string")
    assert [r.src_table for r in R.unmigrated(inv, log).collect()] == ["d.b"]


def test_default_hash_sees_nulls_inside_nested_values(spark):
    schema = "id int, a array<int>, s struct<a: int, b: int>, m array<map<string, int>>"
    left = spark.createDataFrame([(1, [1, None], (1, None), [{"x": 1, "y": 2}])], schema)
    right = spark.createDataFrame([(1, [1], (None, 1), [{"y": 2, "x": 1}])], schema)
    for one in ("a", "s"):
        assert R.row_diff(left.select("id", one), right.select("id", one), ["id"]).count() == 1
    assert R.row_diff(left.select("id", "m"), right.select("id", "m"), ["id"]).count() == 0


def test_a_sample_that_could_hold_nothing_is_refused(spark):
    df = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(ValueError):
        R.sampled_hash(df, df, ["id"], 1e-7)


@pytest.mark.parametrize(
    "kind, src, tgt",
    [
        ("double", [float("nan"), float("nan"), 1.0], [float("nan"), None, 1.0]),
        ("double", [float("inf"), 1.0], [float("nan"), 1.0]),
        ("double", [1e35, 5e34, 1.0], [1e35, 7e34, 1.0]),
        ("double", [0.1, 0.5, 0.9], [0.1, 0.5 + 2e-7, 0.9]),
        ("int", [0, 0, 1], [0, None, 1]),
    ],
)
def test_checksums_miss_no_value(spark, kind, src, tgt):
    """Values that a sum leaves out or rounds away: lost, changed, or beyond its range."""
    a, b = (spark.createDataFrame([(v,) for v in side], f"v {kind}") for side in (src, tgt))
    assert checks(R.checksums(a, b))["v", "sum"][2] == "CHECKSUM_MISMATCH"
    assert {r.status for r in R.one_pass(a, b, buckets=1).filter("metric = 'sum(v)'").collect()} == {"MISMATCH"}
    assert {v[2] for v in checks(R.checksums(a, a.repartition(2))).values()} == {"OK"}
    assert {r.status for r in R.one_pass(a, a, buckets=2).collect()} == {"OK"}


def test_checksums_of_overflowing_decimals(spark):
    def rows(last):
        return spark.sql(f"SELECT CAST(v AS DECIMAL(38,0)) AS v FROM VALUES ('{'9' * 38}'), ('{'9' * 38}'), ('1'), ('{last}') AS t(v)")

    assert checks(R.checksums(rows(5), rows(77)))["v", "sum"][2] == "CHECKSUM_MISMATCH"
    assert {v[2] for v in checks(R.checksums(rows(5), rows(5))).values()} == {"OK"}


def test_lost_and_extra_columns_are_findings(spark):
    src = spark.range(4).selectExpr("id", "id * 2 AS v", "if(id = 0, NULL, 'x') AS s")
    tgt = src.drop("s").withColumn("more", F.lit(1))
    got = {(r.scope, r.item): (r.src_value, r.tgt_value, r.status) for r in R.one_pass(src, tgt, key=["id"], buckets=1).collect() if r.scope != "table"}
    assert got["column", "s"] == ("present", None, "MISMATCH") and got["column", "more"] == (None, "present", "MISMATCH")
    assert got["bucket", "0"][2] == "OK"
    assert [r.id for r in R.row_diff(src, tgt, ["id"]).orderBy("id").collect()] == [1, 2, 3]
    assert R.multiset_diff(src, tgt).count() == 6
    assert {r.status for r in R.fingerprint_diff(src, tgt, 1).collect()} == {"DIFFERENT"}


@pytest.mark.parametrize("kind", ["fast", "portable"])
@pytest.mark.parametrize("k", [1, 50, 999, 5000])
def test_a_sample_of_exact_size(spark, kind, k):
    src = spark.range(1000).selectExpr("id % 900 AS k", "id AS v")
    bad = src.withColumn("v", F.col("v") + 1).unionByName(spark.range(1000, 1100).selectExpr("id AS k", "id AS v"))
    found = {r.k: r.finding for r in R.sample_k(src.repartition(5), bad, ["k"], k, kind).collect()}
    again = {r.k: r.finding for r in R.sample_k(src, bad.repartition(3), ["k"], k, kind).collect()}
    assert found == again
    assert sum(f == "CHANGED" for f in found.values()) == min(k, 900) and all((f == "ONLY_TARGET") == (key >= 900) for key, f in found.items())


def test_a_sample_of_an_empty_side(spark):
    some, none = spark.range(10).withColumn("v", F.lit(1)), spark.range(0).withColumn("v", F.lit(1))
    assert R.sample_k(some, some, ["id"], 3).count() == 0 and R.sample_k(none, none, ["id"], 3).count() == 0
    assert {r.finding for r in R.sample_k(none, some, ["id"], 3).collect()} == {"ONLY_TARGET"}
    assert R.sample_k(some, none, ["id"], 3).count() == 3


def test_counts_of_a_damaged_file_cost_one_pair(spark):
    path = scratch.new_folder(spark, "damaged")
    spark.range(5).selectExpr("CAST(id AS STRING) AS s").write.text(path)
    good = spark.range(4)
    pairs = [R.Pair("ok", good, good), R.Pair("bad", good, lambda: spark.read.schema("s string").parquet(path))]
    rows = {r.table_name: (r.n_src, r.n_tgt, r.status) for r in R.counts(spark, pairs, isolate=True).collect()}
    assert rows == {"ok": (4, 4, "OK"), "bad": (4, -1, "ERROR")}
