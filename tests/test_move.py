"""Copies, conversions, registration, compaction, logs, and the whole run."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lockgate import constants as K
from lockgate.operators import move, profile, reconcile, reports
from lockgate.plans import migration
from lockgate.sources import scratch, tables

NOW = dt.datetime(2024, 1, 1)


@pytest.fixture
def clients(spark):
    return spark.range(1, 201).selectExpr("id", "concat('cliente_', id) AS nome", "id * 10 AS score", "if(id % 2 = 0, 'SP', 'RJ') AS uf", "CAST(NULL AS DOUBLE) AS vazio")


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv"])
@pytest.mark.parametrize("parts", [[], ["uf"]])
def test_copy_keeps_rows_schema_and_partitions(spark, clients, fmt, parts):
    path = scratch.new_folder(spark, "copy")
    moved = move.copy(clients, path, fmt, parts)
    back = tables.read(spark, path, fmt, clients.schema)
    assert moved.rows == 200 and moved.bytes > 0
    assert [f.name for f in back.schema] == clients.columns
    assert reconcile.multiset_diff(clients, back).count() == 0
    found = [r[0] for r in back.select(F.input_file_name()).distinct().collect()]
    assert all(("uf=" in f) == bool(parts) for f in found)


def test_csv_is_lossless(spark):
    rows = [(1, ""), (2, None), (3, 'a;"b"\nc'), (4, "\\N x"), (5, " pad "), (6, "ç\t'"), (7, '"'), (8, "\\")]
    df = spark.createDataFrame(rows, "id bigint, s string").withColumn("t", F.lit("2024-01-01 01:02:03.123456").cast("timestamp_ntz"))
    path = scratch.new_folder(spark, "csv")
    move.copy(df, path, "csv")
    assert sorted(map(tuple, tables.read(spark, path, "csv", df.schema).collect())) == sorted(map(tuple, df.collect()))


def test_csv_escapes_come_back_and_files_split(spark):
    odd = ["\\N", "\\\\N", "a\nb", "\r\n", "\\n", "\\\\n\\", "x\\\ny", "\\r\r", '"\n";"', "\u2028", "", None, "\\"]
    df = spark.createDataFrame([(i, s, "p\\q\nr") for i, s in enumerate(odd)], "id bigint, s string, `odd name` string")
    path = scratch.new_folder(spark, "csv")
    move.copy(df, path, "csv")
    assert sorted(map(tuple, tables.read(spark, path, "csv", df.schema).collect())) == sorted(map(tuple, df.collect()))
    big = spark.range(200_000).selectExpr("id", "concat('line', chr(10), id) AS s").coalesce(1)
    path = scratch.new_folder(spark, "csv")
    move.copy(big, path, "csv")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        back = tables.read(spark, path, "csv", big.schema)
        assert len(back.inputFiles()) == 1 and back.rdd.getNumPartitions() > 4
        assert reconcile.multiset_diff(big, back).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_of_others_is_read_as_it_is(spark):
    path = scratch.new_folder(spark, "csv")
    foreign = {tables.ESCAPED: "false"}
    df = spark.createDataFrame([("a\\nb", 1), ("c\nd", 2)], "s string, n int")
    tables.write(df, path, "csv", options=foreign)
    assert sorted(map(tuple, tables.read(spark, path, "csv", df.schema, foreign).collect())) == [("a\\nb", 1), ("c\nd", 2)]


def test_write_spreads_a_hot_partition_value(spark):
    """REBALANCE leaves the number of tasks to the adaptive planner; nothing is tied to one value."""
    plan = tables.spread(spark.range(10).withColumn("p", F.lit(1)), ["p"])._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan


def test_convert_and_register(spark, clients):
    raw, final = scratch.new_folder(spark, "raw"), scratch.new_folder(spark, "final")
    tables.write(clients, raw, "orc", ["uf"])
    assert move.convert(spark, raw, "orc", final, "parquet", clients.schema, ["uf"]).rows == 200
    assert reconcile.row_diff(clients, tables.read(spark, final, "parquet", clients.schema), ["id"]).count() == 0
    name = "registered_clients"
    assert move.register(spark, name, raw, "orc", clients.schema, ["uf"]).count() == 200
    spark.sql(f"DROP TABLE {name}")
    assert tables.read(spark, raw, "orc", clients.schema).count() == 200


def test_register_csv(spark, clients):
    path = scratch.new_folder(spark, "csvreg")
    tables.write(clients, path, "csv")
    got = move.register(spark, "registered_csv", path, "csv", clients.schema)
    assert reconcile.multiset_diff(clients, got).count() == 0
    spark.sql("DROP TABLE registered_csv")


def test_compact(spark, clients):
    small, big = scratch.new_folder(spark, "small"), scratch.new_folder(spark, "big")
    clients.repartition(20).write.parquet(small)
    assert move.compact(spark, small, big).rows == 200
    assert tables.read(spark, big, "parquet").select(F.input_file_name()).distinct().count() == 1
    assert clients.count() == tables.read(spark, big, "parquet").distinct().count()
    size = tables.path_bytes(spark, small)
    packed = move.packed(spark, small, "parquet", clients.schema, size // 4)
    assert "Exchange" not in packed._jdf.queryExecution().executedPlan().toString()
    assert 4 <= packed.rdd.getNumPartitions() <= 7  # 20 files in packs of a quarter


def test_json_faults_are_set_aside(spark):
    raw, good, bad = (scratch.new_folder(spark, n) for n in ("raw", "good", "bad"))
    lines = ['{"a":1,"b":"x"}', '{"a":2}', '{"a":"three","b":"y"}', '{"a":4,"b":"z","c":1}', '{"a":5', "", "[1]", "null", '{"b":null,"a":null}', "{}"]
    spark.createDataFrame([(x,) for x in lines], "line string").write.text(raw)
    done = move.convert_json(spark, raw, good, bad, T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())]))
    rows = {tuple(r) for r in spark.read.parquet(good).collect()}
    assert rows == {(1, "x"), (2, None), (None, None)} and (done.moved.rows, done.quarantined, done.lines) == (4, 6, 10)
    aside = {(r.reason, r.line) for r in spark.read.parquet(bad).collect()}
    assert aside == {("UNKNOWN_FIELD", lines[3]), *(("MALFORMED", lines[i]) for i in (2, 4, 5, 6, 7))}
    inferred = move.convert_json(spark, raw, scratch.new_folder(spark, "good"), scratch.new_folder(spark, "bad"), sampling=1.0)
    assert inferred.lines == 10 and inferred.moved.rows + inferred.quarantined == 10

def test_append_evolving(spark):
    path = scratch.new_folder(spark, "log")
    tables.append_evolving(spark.createDataFrame([("a", "OK")], "t string, status string"), path)
    tables.append_evolving(spark.createDataFrame([("b", "OK", 3)], "t string, status string, n int"), path)
    assert sorted(map(tuple, tables.read_evolving(spark, path).select("t", "status", "n").collect())) == [("a", "OK", None), ("b", "OK", 3)]


def test_run_isolates_failures(spark):
    todo = [{"src_table": f"d.{n}", "tgt_table": f"p.d.{n}", "strategy": K.DEEP_COPY, "estimated_rows": 7, "estimated_bytes": 9} for n in "abc"]

    def act(row):
        if row["src_table"] == "d.b":
            raise ValueError("x" * 900)
        return move.Moved(5, 10)

    log = {r.src_table: r for r in move.run(spark, todo, act, NOW).collect()}
    assert (log["d.a"].status, log["d.a"].rows_copied) == ("SUCCESS", 5)
    assert log["d.b"].status == "ERROR" and "x" * 900 in log["d.b"].error_message
    dry = move.run(spark, todo, act, NOW, dry_run=True)
    assert {(r.status, r.rows_copied, r.duration_sec) for r in dry.collect()} == {("DRY_RUN", 7, 0.0)}
    assert move.run(spark, [], act, NOW).count() == 0
    assert {r.status: r.n_tables for r in reports.log_summary(move.run(spark, todo, act, NOW)).collect()} == {"SUCCESS": 2, "ERROR": 1}


def test_catalog_inventory(spark, clients):
    spark.sql("CREATE DATABASE IF NOT EXISTS inv_db")
    odd = clients.withColumnRenamed("nome", "Type").withColumnRenamed("score", "Owner")
    odd.write.mode("overwrite").partitionBy("uf").format("parquet").saveAsTable("inv_db.odd")
    ext = scratch.new_folder(spark, "ext")
    tables.write(clients, ext, "orc")
    move.register(spark, "inv_db.ext", ext, "orc", clients.schema)
    spark.sql("CREATE OR REPLACE VIEW inv_db.v AS SELECT * FROM inv_db.odd WHERE uf = 'SP'")
    clients.createOrReplaceTempView("temporary_one")
    rows = {r.table_name: r for r in profile.inventory(spark, profile.catalog_sources(spark, "inv_db")).collect()}
    assert set(rows) == {"odd", "ext", "v"}
    assert (rows["odd"].object_type, rows["odd"].data_provider, rows["odd"].partition_columns) == ("MANAGED", "parquet", ["uf"])
    assert (rows["odd"].estimated_rows, rows["odd"].num_columns, rows["odd"].has_partitions) == (200, 5, True)
    assert rows["odd"].estimated_bytes > 0
    assert (rows["ext"].object_type, rows["ext"].data_provider) == ("EXTERNAL", "orc")
    assert (rows["v"].object_type, rows["v"].estimated_rows) == ("VIEW", 100)


def test_inventory_error_rows(spark):
    def broken():
        raise OSError("disk on fire")

    sources = [profile.TableSource("d", "ok", lambda: spark.range(3)), profile.TableSource("d", "bad", broken)]
    for isolate in (False, True):
        rows = {r.table_name: r for r in profile.inventory(spark, sources, isolate).collect()}
        assert rows["ok"].estimated_rows == 3 and rows["ok"].error_message is None
        assert (rows["bad"].object_type, rows["bad"].estimated_rows, rows["bad"].is_delta) == ("ERROR", -1, False)
    assert profile.inventory(spark, []).count() == 0


def test_migration_end_to_end(spark, clients):
    raw = scratch.new_folder(spark, "src")
    tables.write(clients, raw, "orc", ["uf"])
    sources = [
        profile.TableSource("My-DB", "clientes", lambda: tables.read(spark, raw, "orc", clients.schema), K.EXTERNAL, "orc", raw, partition_columns=["uf"]),
        profile.TableSource("My-DB", "faixas", lambda: spark.createDataFrame([("A", "Excelente")], "codigo string, descricao string"), K.MANAGED),
        profile.TableSource("My-DB", "gone", lambda: spark.read.parquet("/no/path"), K.MANAGED),
    ]
    options = migration.Options("prod", scratch.new_folder(spark, "target"), NOW, dry_run=False)
    result = migration.migrate(spark, sources, options)
    got = {r.src_table: r for r in migration.overview(result).collect()}
    assert {n: (r.tgt_table, r.status, r.rows_copied, r.n_failed, r.schema_status) for n, r in got.items()} == {
        "My-DB.clientes": ("prod.my_db.clientes", "SUCCESS", 200, 0, "OK"),
        "My-DB.faixas": ("prod.my_db.faixas", "SUCCESS", 1, 0, "OK"),
    }
    assert [r.src_table for r in result.unmigrated.collect()] == ["My-DB.gone"]
    assert reports.gate(result.gate) == 0
    assert {r.src_object for r in result.rollback.filter("action = 'DROP_TABLE'").collect()} == {"My-DB.clientes", "My-DB.faixas"}
    assert tables.read(spark, raw, "orc", clients.schema).count() == 200
    dry = migration.migrate(spark, sources, migration.Options("prod", scratch.new_folder(spark, "dry"), NOW))
    assert {r.status for r in dry.log.collect()} == {"DRY_RUN"} and dry.findings.count() == 0


def test_migration_reports_drift_and_damage(spark, clients, monkeypatch):
    """A copy whose files lost a column and one that cannot be read; a table that nobody registers."""
    sources = [profile.TableSource("d", n, lambda: clients, K.MANAGED) for n in ("drifted", "damaged", "fine")]
    sources.append(profile.TableSource("d", "outside", lambda: clients, K.EXTERNAL, "delta"))
    copy = move.copy

    def faulty(df, path, *args):
        moved = copy(df.drop("nome") if "drifted" in path else df, path, *args)
        return move.Moved(moved.rows, moved.bytes)

    monkeypatch.setattr(move, "copy", faulty)
    one_pass = reconcile.one_pass
    monkeypatch.setattr(reconcile, "one_pass", lambda src, tgt, *a: 1 / 0 if "damaged" in tgt.inputFiles()[0] else one_pass(src, tgt, *a))
    result = migration.migrate(spark, sources, migration.Options("prod", scratch.new_folder(spark, "target"), NOW, dry_run=False))
    got = {r.src_table: r for r in migration.overview(result).collect()}
    assert (got["d.fine"].schema_status, got["d.fine"].n_failed) == ("OK", 0)
    assert got["d.drifted"].schema_status == "MISMATCH" and got["d.drifted"].n_failed > 0
    assert [r.status for r in result.findings.filter("src_table = 'd.damaged'").collect()] == ["ERROR"]
    assert got["d.outside"].status == "NOT_REGISTERED"
    assert [r.src_table for r in result.unmigrated.collect()] == ["d.outside"]
