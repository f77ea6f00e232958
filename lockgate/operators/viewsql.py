"""Rewrite the references in view text to the new namespace, as joins over the references."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lockgate import schemas
from lockgate.functions import names, sqltext
from lockgate.sources import scratch, tables

#: Texts on the driver at a time.
BATCH = 1000


def rewrite_refs(
    views: DataFrame,
    mapping: DataFrame,
    catalog: str,
    text: str = "body",
    key: Sequence[str] = ("database_name", "table_name"),
) -> DataFrame:
    """``key`` columns and ``adapted``: the text with each reference moved to catalog.schema.table.

    References to mapped databases move wherever they stand; a quoted pair of an unmapped database
    moves only right after FROM or JOIN, as elsewhere it is an alias and a column. Each text is cut into
    gaps and references, the references join the mapping (any size, no driver loop), and the pieces of
    one text are put together again by its key, which must be unique. A NULL text stays NULL.
    """
    cut = views.select(
        *key,
        F.split(F.col(text), sqltext.REFERENCE, -1).alias("gap"),
        F.regexp_extract_all(F.col(text), F.lit(sqltext.REFERENCE), F.lit(0)).alias("ref"),
    )
    # There is one gap more than references: the last row holds the end of the text and no reference.
    piece = cut.select(*key, F.posexplode_outer(F.arrays_zip("gap", "ref")).alias("pos", "p")).select(*key, "pos", "p.gap", "p.ref")
    ticked = F.col("ref").startswith("`")
    named = piece.withColumns(
        {
            "db": F.when(ticked, F.regexp_extract("ref", sqltext.TICKED_PAIR, 1)).otherwise(F.substring_index("ref", ".", 1)),
            "tbl": F.when(ticked, F.regexp_extract("ref", sqltext.TICKED_PAIR, 2)).otherwise(F.substring_index("ref", ".", -1)),
        }
    )
    known = mapping.select(F.col("src_database").alias("db"), "tgt_schema")
    joined = named.join(known, "db", "left")
    moved = names.quoted(F.lit(catalog), F.coalesce("tgt_schema", "db"), F.col("tbl"))
    is_table = ticked & F.col("gap").rlike(sqltext.AFTER_FROM_OR_JOIN)
    new_ref = F.when(F.col("tgt_schema").isNotNull() | is_table, moved).otherwise(F.col("ref"))
    written = F.concat("gap", F.coalesce(new_ref, F.lit(""))).alias("written")
    pieces = F.array_sort(F.collect_list(F.struct("pos", written))).alias("pieces")
    whole = F.when(F.col("n_gaps") > 0, F.array_join(F.col("pieces.written"), "")).alias("adapted")
    return joined.groupBy(*key).agg(pieces, F.count("gap").alias("n_gaps")).select(*key, whole)


def _status(dry_run: bool) -> Column:
    query = r"(?i)\A[\s(]*(select|with|from|values|table)\b"
    readable = F.coalesce(F.col("adapted").rlike(query), F.lit(False))
    if dry_run:
        return (
            F.when(F.col("ddl").isNull(), "EXTRACTION_ERROR")
            .when(readable, "DRY_RUN_OK")
            .otherwise("DRY_RUN_SYNTAX_ERROR")
        )
    return F.when(F.col("ddl").isNull(), "EXTRACTION_ERROR").when(readable, "SUCCESS").otherwise("ERROR")


def recreate(views: DataFrame, mapping: DataFrame, catalog: str, dry_run: bool = True) -> DataFrame:
    """Statements that recreate views (database_name, table_name, ddl) in the target, with a status.

    A dry run reports what would happen; a view without DDL is an EXTRACTION_ERROR, a body that is
    no query a syntax error.
    """
    views = views.select("database_name", "table_name", "ddl", sqltext.view_body(F.col("ddl")).alias("body"))
    key = ["database_name", "table_name"]
    adapted = rewrite_refs(views.filter(F.col("ddl").isNotNull()), mapping, catalog)
    known = mapping.select(F.col("src_database").alias("database_name"), "tgt_schema")
    rows = views.join(adapted, key, "left").join(known, "database_name", "left")
    schema = F.coalesce("tgt_schema", "database_name")
    return rows.select(
        names.dotted(F.col("database_name"), F.col("table_name")).alias("src_view"),
        names.dotted(F.lit(catalog), schema, F.col("table_name")).alias("tgt_view"),
        "adapted",
        sqltext.create_view(F.lit(catalog), schema, F.col("table_name"), F.col("adapted")).alias("create_sql"),
        _status(dry_run).alias("status"),
    )


def strict_session(spark: SparkSession) -> SparkSession:
    """A session that keeps reserved words reserved, so that ``SELECT FROM WHERE`` is no query."""
    session = spark.newSession()
    session.conf.set("spark.sql.ansi.enabled", "true")
    session.conf.set("spark.sql.ansi.enforceReservedKeywords", "true")
    return session


def parse_errors(session: SparkSession, texts: Sequence[str]) -> list[str | None]:
    """What Spark's own parser has against each text under the settings of ``session``, or None."""
    active = session._jvm.org.apache.spark.sql.classic.SparkSession
    before = active.getActiveSession()
    active.setActiveSession(session._jsparkSession)
    parser = session._jsparkSession.sessionState().sqlParser()

    def error(text: str) -> str | None:
        try:
            parser.parsePlan(text)
            return None
        except (Py4JJavaError, PySparkException) as error:
            return " ".join(str(error).split()) or type(error).__name__

    try:
        return [error(text) for text in texts]
    finally:
        active.setActiveSession(before.get()) if before.isDefined() else active.clearActiveSession()


def _batches(rows: DataFrame) -> Iterator[list[Row]]:
    """The rows in their order, at most ``BATCH`` at a time: they are stored in files of that many, and files are read one by one."""
    spark, folder = rows.sparkSession, scratch.new_folder(rows.sparkSession, "batches")
    tables.write(rows, folder, max_records_per_file=BATCH)
    for file in scratch.part_files(spark, folder):
        yield spark.read.schema(rows.schema).parquet(file).collect()


def _failures(rows: DataFrame, key: str, fails: Callable[[list[Row]], Sequence[str | None]]) -> DataFrame:
    """(key, failure) of the rows with one. The driver holds a batch; its failures are stored before the next one."""
    spark, folder, stored = rows.sparkSession, scratch.new_folder(rows.sparkSession, "failures"), 0
    schema = StructType([rows.schema[key], StructField("failure", StringType())])
    for batch in _batches(rows):
        failed = [(row[key], failure) for row, failure in zip(batch, fails(batch)) if failure is not None]
        if failed:
            tables.frame(spark, failed, schema).write.mode("append").parquet(folder)
            stored += len(failed)
    return spark.read.schema(schema).parquet(folder) if stored else tables.frame(spark, [], schema)


def checked(
    spark: SparkSession,
    recreated: DataFrame,
    create: Callable[[str], object] | None = None,
    dry_run: bool = True,
    max_parallel: int = 4,
) -> DataFrame:
    """(src_view, tgt_view, create_sql, status, error_message) after every text went through Spark's parser.

    Texts meet the parser on the driver, equal ones once and ``BATCH`` at a time; what it has against them is stored and
    joined to the views. A dry run creates nothing: DRY_RUN_OK or DRY_RUN_SYNTAX_ERROR. Otherwise ``create`` runs each
    statement in the order of ``recreated``, SUCCESS or ERROR; without it good texts are PLANNED.
    """
    rows = scratch.materialize(recreated.withColumn("place", F.monotonically_increasing_id()), "recreated")
    session = strict_session(spark)

    def parsed(batch: list[Row]) -> list[str | None]:
        texts = [row["adapted"] for row in batch]
        with ThreadPoolExecutor(max_parallel) as pool:
            parts = pool.map(lambda part: parse_errors(session, part), [texts[i::max_parallel] for i in range(max_parallel)])
        found = dict(zip([t for i in range(max_parallel) for t in texts[i::max_parallel]], [e for part in parts for e in part]))
        return [found[text] for text in texts]

    refused = _failures(rows.filter(F.col("create_sql").isNotNull()).select("adapted").distinct(), "adapted", parsed)
    no_text = F.col("create_sql").isNull()
    no_query = F.when(F.col("status").isin("DRY_RUN_SYNTAX_ERROR", "ERROR"), "the text is no query")
    error = F.when(no_text, "the view has no text").otherwise(F.coalesce("failure", no_query))
    bad, good = ("DRY_RUN_SYNTAX_ERROR", "DRY_RUN_OK") if dry_run else ("ERROR", "PLANNED" if create is None else "SUCCESS")
    status = F.when(no_text, "EXTRACTION_ERROR").when(error.isNotNull(), bad).otherwise(good)
    # Stored messages hold whole texts and shrink on disk; by its size there the table would be broadcast through the driver.
    judged = rows.join(refused.hint("merge"), "adapted", "left").select(
        "place", "src_view", "tgt_view", "create_sql", status.alias("status"), error.alias("error_message")
    )
    if create is None or dry_run:
        return judged.select(*schemas.VIEW_LOG.names)
    judged = scratch.materialize(judged, "judged")

    def made(row: Row) -> str | None:
        try:
            create(row["create_sql"])
            return None
        except Exception as failure:  # noqa: BLE001 - one view must not stop the others
            return f"{type(failure).__name__}: {failure}"

    def run(batch: list[Row]) -> list[str | None]:
        with ThreadPoolExecutor(max_parallel) as pool:
            return list(pool.map(made, batch))

    broken = _failures(judged.filter(F.col("error_message").isNull()).select("place", "create_sql").orderBy("place"), "place", run)
    return judged.join(broken.hint("merge"), "place", "left").select(
        "src_view",
        "tgt_view",
        "create_sql",
        F.when(F.col("failure").isNull(), F.col("status")).otherwise(bad).alias("status"),
        F.coalesce("error_message", "failure").alias("error_message"),
    )


def references(views: DataFrame) -> DataFrame:
    """(view, needs): each object that the text of a view (database_name, table_name, ddl) names as a pair, once."""
    found = F.regexp_extract_all(sqltext.view_body(F.col("ddl")), F.lit(sqltext.REFERENCE), F.lit(0))
    rows = views.select(names.dotted(F.col("database_name"), F.col("table_name")).alias("view"), F.explode(found).alias("ref"))
    return rows.select("view", F.replace("ref", F.lit("`"), F.lit("")).alias("needs")).distinct()


def order(views: DataFrame) -> DataFrame:
    """(view, layer, status) of every view: the views it reads are all in lower layers, so layers can be created in turn.

    Views that read no view are layer 0. Each round places the views whose references are all placed, so there are as
    many rounds as layers. Views in a circle, and those that read one, are never placed: layer NULL, status CYCLE.
    """
    everyone = scratch.materialize(views.select(names.dotted(F.col("database_name"), F.col("table_name")).alias("view")).distinct(), "views")
    needs = references(views).join(everyone.withColumnRenamed("view", "needs"), "needs")
    needs = scratch.materialize(needs.select("view", "needs"), "needs")
    placed = scratch.materialize(
        everyone.join(needs.select("view").distinct(), "view", "left_anti").withColumn("layer", F.lit(0)), "placed"
    )
    layer, waiting = 0, needs
    while True:
        waiting = scratch.materialize(
            waiting.join(placed.filter(F.col("layer") == layer).select(F.col("view").alias("needs")), "needs", "left_anti").select("view", "needs"),
            "waiting",
        )
        layer += 1
        left = everyone.join(placed.select("view"), "view", "left_anti")
        ready = scratch.materialize(left.join(waiting.select("view").distinct(), "view", "left_anti").withColumn("layer", F.lit(layer)), "ready")
        if ready.isEmpty():
            break
        placed = scratch.materialize(placed.unionByName(ready), "placed")
    circular = everyone.join(placed.select("view"), "view", "left_anti").withColumn("layer", F.lit(None).cast("int"))
    status = F.when(F.col("layer").isNull(), "CYCLE").otherwise("ORDERED")
    return placed.unionByName(circular).withColumn("status", status)
