"""Stored logs, repeated copies, drill-down, views and grants in a run, the gate, registration, and the way back."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lockgate import constants as K
from lockgate import schemas
from lockgate.operators import grants, hashtree, incremental, move, reconcile, reports, rollback, viewsql
from lockgate.operators.profile import TableSource
from lockgate.plans import migration
from lockgate.plans.migration import Options
from lockgate.sources import published, scratch, tables
from lockgate.sources.runlog import RunLog

NOW = dt.datetime(2024, 1, 1)


@pytest.fixture
def clients(spark):
    return spark.range(1, 201).selectExpr("id", "concat('c_', id) AS nome", "id * 10 AS score", "if(id % 2 = 0, 'SP', 'RJ') AS uf")


def log_rows(spark, *rows):
    """(src_table, status, day) as rows of a migration log."""
    full = [(s, f"prod.{s}", K.RECREATE_VIEW if s.split(".")[1].startswith("v") else K.DEEP_COPY, status, 1.0, 1, 1, None, dt.datetime(2024, 1, day)) for s, status, day in rows]
    return tables.frame(spark, full, schemas.MIGRATION_LOG)


# ---------------------------------------------------------------- published folders and the history


def test_readers_see_published_folders_only(spark):
    base = scratch.new_folder(spark, "pub")
    assert published.latest(spark, base) is None and published.numbers(spark, base) == []
    spark.range(3).write.parquet(published.staging(base))  # a writer that died
    assert published.latest(spark, base) is None
    for n in (1, 2):
        staged = published.staging(base)
        spark.range(n).write.parquet(staged)
        assert published.publish(spark, staged, base) == n
    assert published.numbers(spark, base) == [1, 2]
    assert spark.read.parquet(published.latest(spark, base)).count() == 2


def test_a_taken_number_is_never_replaced(spark, monkeypatch):
    base = scratch.new_folder(spark, "pub")
    for n in (1, 2):
        staged = published.staging(base)
        spark.range(n).write.parquet(staged)
        monkeypatch.setattr(published, "numbers", lambda *a: [])  # both writers believe to be the first
        assert published.publish(spark, staged, base) == n
    assert spark.read.parquet(published.place(base, 1)).count() == 1


def test_history_keeps_the_last_attempt_of_each_run(spark):
    log = RunLog(spark, scratch.new_folder(spark, "log"))
    assert log.read("migration", schemas.MIGRATION_LOG).count() == 0
    assert log.publish("a", {"migration": log_rows(spark, ("d.x", "ERROR", 1), ("d.y", "SUCCESS", 1))}) == 1
    log.publish("b", {"migration": log_rows(spark, ("d.z", "SUCCESS", 2)).withColumn("note", F.lit("new"))})
    assert log.publish("a", {"migration": log_rows(spark, ("d.x", "SUCCESS", 3))}) == 2
    rows = {(r.run_id, r.src_table, r.status, r.note) for r in log.read("migration", schemas.MIGRATION_LOG).collect()}
    assert rows == {("a", "d.x", "SUCCESS", None), ("b", "d.z", "SUCCESS", "new")}
    assert {tuple(r) for r in log.runs().collect()} == {("a", 2), ("b", 1)}
    assert log.read("rollback", schemas.ROLLBACK_LOG).columns == [*schemas.ROLLBACK_LOG.fieldNames(), "run_id"]
    assert log.prune() == 1 and log.prune() == 0
    assert log.read("migration", schemas.MIGRATION_LOG).count() == 2
    for bad in ("a/b", "", "_x", "../x"):
        with pytest.raises((ValueError, IndexError)):
            log.publish(bad, {})


def test_a_repeat_that_fails_leaves_the_history(spark):
    log = RunLog(spark, scratch.new_folder(spark, "log"))
    log.publish("a", {"migration": log_rows(spark, ("d.x", "SUCCESS", 1))})
    broken = log_rows(spark, ("d.x", "ERROR", 2)).withColumn("status", F.expr("raise_error('lost')"))
    with pytest.raises(Exception, match="lost"):
        log.publish("a", {"views": log_rows(spark, ("d.x", "ERROR", 2)), "migration": broken})
    assert [r.status for r in log.read("migration", schemas.MIGRATION_LOG).collect()] == ["SUCCESS"]


# ---------------------------------------------------------------- incremental copies


@pytest.mark.parametrize("fmt, parts", [("parquet", []), ("orc", ["uf"]), ("csv", [])])
def test_incremental_copy_moves_changed_files_only(spark, clients, fmt, parts):
    src, base = scratch.new_folder(spark, "src"), scratch.new_folder(spark, "base")
    schema = clients.schema
    tables.write(clients.filter("id <= 100"), src, fmt, parts)

    def same():
        now = incremental.read(spark, base, schema)
        assert reconcile.multiset_diff(tables.read(spark, src, fmt, schema), now).count() == 0
        return now.count()

    first = incremental.update(spark, src, fmt, base, schema, parts)
    assert (first.rows, first.kept, first.removed, same()) == (100, 0, 0, 100) and first.copied > 0
    again = incremental.update(spark, src, fmt, base, schema, parts)
    assert (again.copied, again.rows, again.removed, again.kept) == (0, 0, 0, first.copied)
    assert published.numbers(spark, f"{base}/manifest") == [1]
    tables.write(clients.filter("id > 100 AND id <= 150"), src, fmt, parts, mode="append")
    more = incremental.update(spark, src, fmt, base, schema, parts)
    assert (more.rows, more.kept, more.removed, same()) == (50, first.copied, 0, 150)
    tables.write(clients.filter("id > 190"), src, fmt, parts, mode="overwrite")
    last = incremental.update(spark, src, fmt, base, schema, parts)
    assert (last.rows, last.kept, last.removed, same()) == (10, 0, first.copied + more.copied, 10)
    assert 0 < incremental.prune(spark, base) <= first.copied + more.copied  # a file without rows left no folder
    assert incremental.prune(spark, base) == 0 and same() == 10


def test_incremental_copy_that_fails_shows_the_version_before(spark, clients, monkeypatch):
    src, base = scratch.new_folder(spark, "src"), scratch.new_folder(spark, "base")
    tables.write(clients, src)
    incremental.update(spark, src, "parquet", base, clients.schema)
    tables.write(clients, src, mode="append")

    def dies(*args):
        raise OSError("lost")

    publish = published.publish
    monkeypatch.setattr(published, "publish", dies)
    with pytest.raises(OSError):
        incremental.update(spark, src, "parquet", base, clients.schema)
    assert incremental.read(spark, base, clients.schema).count() == 200
    monkeypatch.setattr(published, "publish", publish)
    assert incremental.update(spark, src, "parquet", base, clients.schema).rows == 200
    assert incremental.read(spark, base, clients.schema).count() == 400


# ---------------------------------------------------------------- drill-down


def test_trees_name_the_changed_keys(spark):
    src = spark.range(20_000).selectExpr("id % 19000 AS k", "id AS v", "if(id % 3 = 0, NULL, named_struct('a', id, 'b', CAST(NULL AS INT))) AS n")
    bad = src.filter("k <> 5").withColumn("v", F.expr("if(k = 77, v + 1, v)")).unionByName(src.filter("k = 99")).unionByName(src.limit(1).withColumn("k", F.lit(-4).cast("bigint")))
    bad = bad.withColumn("n", F.expr("if(k = 18001, named_struct('a', 18001L, 'b', 7), n)"))
    folder = scratch.new_folder(spark, "tree")
    hashtree.build(src, folder, ["k"], fan=16, levels=3)
    kept, other = hashtree.load(spark, folder), hashtree.build(bad.repartition(7), scratch.new_folder(spark, "tree"), ["k"], fan=16, levels=3)
    found = {(r.k, r.n_src, r.n_tgt, r.finding) for r in hashtree.diff(kept, other).collect()}
    assert found == {(5, 2, 0, "ONLY_SOURCE"), (77, 2, 2, "CHANGED"), (99, 2, 4, "CHANGED"), (-4, 0, 1, "ONLY_TARGET"), (18001, 1, 1, "CHANGED")}
    steps = [(r.level, r.n_compared, r.n_differing) for r in hashtree.trace(kept, other).orderBy("level").collect()]
    assert [s[0] for s in steps] == [1, 2, 3] and steps[0][1] == 16
    assert all(s[2] <= 5 and s[1] <= 16 * 5 for s in steps)
    assert hashtree.diff(kept, hashtree.build(src.repartition(3), scratch.new_folder(spark, "tree"), ["k"], fan=16, levels=3)).count() == 0


def test_trees_without_a_key_compare_rows(spark):
    src = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "n int, s string")
    trees = [hashtree.build(df, scratch.new_folder(spark, "tree")) for df in (src, src.distinct().union(src.filter("n = 2")))]
    assert sorted((r.n_src, r.n_tgt, r.finding) for r in hashtree.diff(*trees).collect()) == [(1, 2, "CHANGED"), (2, 1, "CHANGED")]
    with pytest.raises(ValueError, match="fan"):
        hashtree.diff(trees[0], hashtree.build(src, scratch.new_folder(spark, "tree"), fan=8))
    empty = hashtree.build(src.limit(0), scratch.new_folder(spark, "tree"))
    assert hashtree.diff(empty, empty).count() == 0 and hashtree.diff(trees[0], empty).count() == 2


def test_a_drill_down_reads_pruned_folders(spark):
    src = spark.range(5000).withColumn("v", F.lit(1))
    trees = [hashtree.build(df, scratch.new_folder(spark, "tree"), ["id"]) for df in (src, src.withColumn("v", F.expr("if(id = 3, 2, 1)")))]
    found = hashtree.diff(*trees)
    assert [tuple(r) for r in found.collect()] == [(3, 1, 1, "CHANGED")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(top" in plan or "(top#" in plan.split("PartitionFilters")[1]


# ---------------------------------------------------------------- views


def test_views_are_parsed_by_spark(spark):
    views = spark.createDataFrame(
        [("d", "ok", "CREATE VIEW v AS SELECT `t`.`id` FROM `d`.`t`"), ("d", "words", "CREATE VIEW v AS SELECT FROM WHERE"), ("d", "none", None),
         ("d", "drop", "CREATE VIEW v AS DROP TABLE d.t"), ("d", "two", "CREATE VIEW v AS SELECT 1; SELECT 2"), ("d", "open", "CREATE VIEW v AS SELECT (1")],
        "database_name string, table_name string, ddl string",
    )
    known = spark.createDataFrame([("d", "prod", "d2")], "src_database string, tgt_catalog string, tgt_schema string")
    found = {r.src_view: r for r in viewsql.checked(spark, viewsql.recreate(views, known, "prod")).collect()}
    assert {k: r.status for k, r in found.items()} == {
        "d.ok": "DRY_RUN_OK", "d.words": "DRY_RUN_SYNTAX_ERROR", "d.none": "EXTRACTION_ERROR", "d.drop": "DRY_RUN_SYNTAX_ERROR",
        "d.two": "DRY_RUN_SYNTAX_ERROR", "d.open": "DRY_RUN_SYNTAX_ERROR",
    }
    assert all((r.error_message is None) == (r.status == "DRY_RUN_OK") for r in found.values())
    real = viewsql.recreate(views, known, "prod", dry_run=False)
    assert {r.status for r in viewsql.checked(spark, real, dry_run=False).collect()} == {"PLANNED", "ERROR", "EXTRACTION_ERROR"}
    made = []
    done = {r.src_view: r.status for r in viewsql.checked(spark, real, made.append, dry_run=False).collect()}
    assert done["d.ok"] == "SUCCESS" and made == ["CREATE OR REPLACE VIEW `prod`.`d2`.`ok`\nAS\nSELECT `t`.`id` FROM `prod`.`d2`.`t`"]
    assert {r.status for r in viewsql.checked(spark, real.filter("src_view = 'd.ok'"), lambda s: 1 / 0, dry_run=False).collect()} == {"ERROR"}


def test_the_driver_holds_a_batch_of_views(spark, monkeypatch):
    monkeypatch.setattr(viewsql, "BATCH", 3, raising=False)
    held, kept = [], tables.frame
    monkeypatch.setattr(tables, "frame", lambda spark, rows, schema: held.append(len(rows := list(rows))) or kept(spark, rows, schema))
    rows = [("d", f"v{i:02}", f"CREATE VIEW v AS SELECT {i} FROM `d`.`t`" + ")" * (i % 4 == 0)) for i in range(20)]
    rows += [("d", "none", None)]
    views = spark.createDataFrame(rows, "database_name string, table_name string, ddl string")
    known = spark.createDataFrame([("d", "prod", "d2")], "src_database string, tgt_catalog string, tgt_schema string")
    plain = viewsql.recreate(views, known, "prod", dry_run=False)
    again = plain.filter("src_view = 'd.v01'").withColumn("src_view", F.lit("d.again"))
    recreated = plain.unionByName(again).unionByName(again).repartition(5).orderBy(F.desc("src_view"))
    found = viewsql.checked(spark, recreated, dry_run=False).groupBy("status").count().collect()
    assert {r.status: r["count"] for r in found} == {"PLANNED": 17, "ERROR": 5, "EXTRACTION_ERROR": 1}
    made = []

    def create(statement: str) -> None:
        made.append(statement.split("`")[5])
        if made[-1] == "v07":
            raise ValueError("no room")

    done = viewsql.checked(spark, recreated, create, dry_run=False, max_parallel=1).collect()
    good = [f"v{i:02}" for i in range(19, 0, -1) if i % 4]
    assert made == good + ["v01", "v01"]
    assert {r.src_view: (r.status, r.error_message) for r in done}["d.v07"] == ("ERROR", "ValueError: no room")
    assert sorted(r.status for r in done) == ["ERROR"] * 6 + ["EXTRACTION_ERROR"] + ["SUCCESS"] * 16
    assert max(held) <= 3


def test_views_are_ordered_by_what_they_read(spark):
    reads = {"a": ["t"], "b": ["a", "t"], "c": ["b", "a"], "x": ["y"], "y": ["x"], "z": ["y", "a"], "self": ["self"]}
    rows = [("d", v, f"CREATE VIEW d.{v} AS SELECT * FROM " + " JOIN ".join(f"`d`.`{r}`" for r in refs)) for v, refs in reads.items()]
    found = {r.view: (r.layer, r.status) for r in viewsql.order(spark.createDataFrame(rows, "database_name string, table_name string, ddl string")).collect()}
    cycle = (None, "CYCLE")
    assert found == {"d.a": (0, "ORDERED"), "d.b": (1, "ORDERED"), "d.c": (2, "ORDERED"), "d.x": cycle, "d.y": cycle, "d.z": cycle, "d.self": cycle}


# ---------------------------------------------------------------- rollback out of the log


def test_replay_finds_what_is_there(spark):
    history = log_rows(
        spark, ("d.a", "SUCCESS", 1), ("d.a", "ERROR", 2), ("d.b", "SUCCESS", 1), ("d.b", "DROPPED", 2), ("d.c", "DROPPED", 1), ("d.c", "SUCCESS", 2),
        ("d.e", "ERROR", 1), ("d.f", "DRY_RUN", 1), ("d.g", "NOT_REGISTERED", 1), ("d.v1", "SUCCESS", 1), ("d.v2", "SUCCESS", 1), ("d.h", "SUCCESS", 3), ("d.h", "DROPPED", 3),
    )
    layers = spark.createDataFrame([("d.v1", 0), ("d.v2", 1)], "view string, layer int")
    planned = rollback.plan_from_log(history, view_layers=layers)
    rows = [(r.action, r.src_object) for r in planned.orderBy("step", "place", "src_object").collect()]
    assert rows == [("DROP_VIEW", "d.v2"), ("DROP_VIEW", "d.v1"), ("DROP_TABLE", "d.a"), ("DROP_TABLE", "d.c")]
    after = history.unionByName(rollback.dropped(planned, dt.datetime(2024, 2, 1)))
    assert rollback.plan_from_log(after).count() == 0
    with pytest.raises(PermissionError):
        rollback.plan_from_log(history, dry_run=False)
    assert {r.status for r in rollback.plan_from_log(history, dry_run=False, confirm=True).collect()} == {"PLANNED"}
    with pytest.raises(ValueError):
        rollback.plan_from_log(history, scope="ALL")


# ---------------------------------------------------------------- whole runs


def options(spark, **more):
    return Options("prod", more.pop("base", None) or scratch.new_folder(spark, "target"), NOW, dry_run=more.pop("dry_run", False), **more)


@pytest.mark.parametrize("mode", [migration.REPLACE, migration.INCREMENTAL])
def test_a_second_run_takes_the_place_of_the_first(spark, clients, mode):
    raw, base, root = (scratch.new_folder(spark, n) for n in ("raw", "base", "log"))
    tables.write(clients.filter("id <= 150"), raw, "orc", ["uf"])
    source = TableSource("d", "t", lambda: tables.read(spark, raw, "orc", clients.schema), K.EXTERNAL, "orc", raw, partition_columns=["uf"], schema=clients.schema)

    def run():
        result = migration.migrate(spark, [source], options(spark, base=base, mode=mode, run_id="nightly", log_root=root))
        row = migration.overview(result).first()
        assert (row.status, row.n_failed, row.schema_status) == ("SUCCESS", 0, "OK")
        return row.rows_copied

    assert run() == 150
    tables.write(clients.filter("id > 150"), raw, "orc", ["uf"], mode="append")
    assert run() == (50 if mode == migration.INCREMENTAL else 200)
    history = RunLog(spark, root)
    assert [r.status for r in history.read("migration", schemas.MIGRATION_LOG).collect()] == ["SUCCESS"]
    assert history.read("rollback", schemas.ROLLBACK_LOG).filter("action = 'DROP_TABLE'").count() == 1
    assert history.read("gate", schemas.GATE).filter("status <> 'OK'").count() == 0


def test_gate_drill_down_and_logs_of_a_run_that_fails(spark, clients):
    root, states = scratch.new_folder(spark, "log"), iter([clients, clients])
    grown = clients.union(clients.limit(1).withColumn("id", F.lit(999).cast("bigint")))
    source = TableSource("d", "t", lambda: next(states, grown), K.MANAGED, key=["id"])
    strict = options(spark, run_id="r", log_root=root, keep_trees=True, fail_on_mismatch=True, tolerance_pct=1.0)
    with pytest.raises(reports.ReconciliationError):
        migration.migrate(spark, [source], strict)
    log = RunLog(spark, root)
    status = {r.check: r.status for r in log.read("gate", schemas.GATE).collect()}
    assert (status["counts"], status["values"], status["fingerprints"], status["schema"]) == ("OK", "FAILED", "FAILED", "OK")
    assert [(json.loads(r.key), r.finding) for r in log.read("drilldown", schemas.DRILLDOWN).collect()] == [({"id": 999}, "ONLY_SOURCE")]


def test_registered_tables_are_reconciled(spark, clients):
    raw = scratch.new_folder(spark, "raw")
    tables.write(clients, raw, "orc", ["uf"])
    name = f"reg_{scratch.name()[:8]}"
    source = TableSource(name, "t", lambda: tables.read(spark, raw, "orc", clients.schema), K.EXTERNAL, "orc", raw, partition_columns=["uf"], serde="x.DeltaSource")
    catalog = move.SessionCatalog(spark)
    row = migration.overview(migration.migrate(spark, [source], options(spark), register=catalog)).first()
    assert (row.strategy, row.status, row.n_failed, row.schema_status) == (K.REGISTER_IN_PLACE, "SUCCESS", 0, "OK")
    other = scratch.new_folder(spark, "other")
    tables.write(clients, other, "orc", ["uf"])
    source.path = other
    moved = migration.migrate(spark, [source], options(spark), register=catalog)
    assert [(r.status, "there already" in r.error_message) for r in moved.log.collect()] == [("ERROR", True)]
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_colliding_tables_are_errors_and_the_others_go_on(spark, clients):
    sources = [TableSource(d, "t", lambda: clients, K.MANAGED) for d in ("x-1", "x_1", "y")]
    result = migration.migrate(spark, sources, options(spark))
    assert {r.src_table: r.status for r in result.log.collect()} == {"x-1.t": "ERROR", "x_1.t": "ERROR", "y.t": "SUCCESS"}
    assert {r.src_object for r in result.rollback.filter("action = 'DROP_TABLE'").collect()} == {"y.t"}


def test_views_and_grants_of_a_run(spark, clients):
    views = spark.createDataFrame(
        [("d", "low", "CREATE VIEW low AS SELECT * FROM `d`.`t`"), ("d", "top", "CREATE VIEW top AS SELECT * FROM `d`.`low`"), ("other", "v", "CREATE VIEW v AS SELECT 1")],
        "database_name string, table_name string, ddl string",
    )
    held = spark.createDataFrame([("DATABASE", "d", "d", "ana", "USAGE", False), ("VIEW", "d", "d.low", "ana", "SELECT", False)], schemas.GRANTS)
    actual = spark.createDataFrame([("SCHEMA", "prod.d", "ana", "USE SCHEMA"), ("TABLE", "prod.d.t", "bob", "SELECT")], "object_type string, object_name string, principal string, privilege string")
    made = []
    source = TableSource("d", "t", lambda: clients, K.MANAGED, owner="ana")
    result = migration.migrate(spark, [source], options(spark, databases="d"), views=views, source_grants=held, target_grants=actual, create_view=made.append)
    assert [m.split("`")[5] for m in made] == ["low", "top"]
    assert {r.src_view: r.status for r in result.views.collect()} == {"d.low": "SUCCESS", "d.top": "SUCCESS"}
    assert {(r.object_name, r.finding) for r in result.grant_diff.collect()} == {("prod.d.low", "MISSING"), ("prod.d.t", "UNEXPECTED")}
    assert {r.status for r in result.permissions.collect()} == {"PLANNED"}
    assert [r.owner_sql for r in result.owners.collect()] == ["ALTER TABLE `prod`.`d`.`t` SET OWNER TO `ana`"]
    assert {(r.check, r.status) for r in result.gate.filter("src_table = '*'").collect()} == {("views", "OK"), ("grants", "FAILED")}
    back = [(r.action, r.src_object) for r in result.rollback.filter("step = 2").orderBy("place").collect()]
    assert back == [("DROP_VIEW", "d.top"), ("DROP_VIEW", "d.low"), ("DROP_TABLE", "d.t")]


def test_a_dry_run_makes_nothing_and_shows_all(spark, clients):
    made = []
    views = spark.createDataFrame([("d", "v", "CREATE VIEW v AS SELECT 1")], "database_name string, table_name string, ddl string")
    result = migration.migrate(spark, [TableSource("d", "t", lambda: clients, K.MANAGED)], options(spark, dry_run=True), views=views, create_view=made.append)
    assert made == [] and {r.status for r in result.log.collect()} == {"DRY_RUN", "DRY_RUN_OK"}
    assert result.findings.count() == 0 and result.rollback.filter("step = 2").count() == 2
    assert grants.expected(result.permissions).count() == 0
