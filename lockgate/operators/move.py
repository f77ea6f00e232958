"""Copy, convert, register and compact tables, with a log row for each."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lockgate import constants as K
from lockgate import schemas
from lockgate.functions import filters, names
from lockgate.operators import compat
from lockgate.sources import published, tables


def worklist(
    inv: DataFrame,
    mapping: DataFrame,
    catalog: str,
    strategies: Sequence[str] = (K.DEEP_COPY, K.REGISTER_IN_PLACE, K.CONVERT),
    databases: str = "",
    table_names: str = "",
) -> DataFrame:
    """Objects to move with their target names; a database without a mapping keeps its own name.

    Managed tables in another format are converted like external ones, so that none is left behind.
    """
    todo = inv.withColumn("strategy", compat.strategy()).filter(F.col("strategy").isin(list(strategies)))
    todo = filters.in_list(filters.in_list(todo, "database_name", databases), "table_name", table_names)
    targets = mapping.select(F.col("src_database").alias("database_name"), "tgt_catalog", "tgt_schema")
    return todo.join(targets, "database_name", "left").select(
        names.dotted(F.col("database_name"), F.col("table_name")).alias("src_table"),
        names.dotted(
            F.coalesce("tgt_catalog", F.lit(catalog)), F.coalesce("tgt_schema", "database_name"), F.col("table_name")
        ).alias("tgt_table"),
        "strategy",
        "data_provider",
        "table_location",
        "partition_columns",
        "estimated_rows",
        "estimated_bytes",
    )


@dataclass
class Moved:
    rows: int
    bytes: int
    status: str = "SUCCESS"


def copy(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    options: dict[str, str] | None = None,
) -> Moved:
    """An independent copy with the same schema, partitioning and rows.

    Rows are counted while they are written, in the writing stage, so the source is read once.
    """
    seen = Observation()
    laid_out = tables.spread(df, partition_by).observe(seen, F.count(F.lit(1)).alias("rows"))
    tables.write(laid_out, path, fmt, partition_by, options=options)
    return Moved(seen.get["rows"], tables.path_bytes(df.sparkSession, path))


def replace(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    options: dict[str, str] | None = None,
) -> Moved:
    """A copy that takes the place of an earlier one: written aside, then published as the next version below ``path``.

    Readers of ``published.latest(path)`` see the version before until the new one is whole; a failed run changes nothing.
    """
    staged = published.staging(path)
    moved = copy(df, staged, fmt, partition_by, options)
    published.publish(df.sparkSession, staged, path)
    return moved


def convert(
    spark: SparkSession,
    src_path: str,
    fmt_in: str,
    path: str,
    fmt_out: str = "parquet",
    schema: StructType | None = None,
    partition_by: Sequence[str] = (),
    options: dict[str, str] | None = None,
) -> Moved:
    """Read one format, write another; partition columns are kept."""
    return copy(tables.read(spark, src_path, fmt_in, schema, options), path, fmt_out, partition_by)


def target_path(base: str, schema: str, table: str) -> str:
    return f"{base.rstrip('/')}/{schema}/{table}"


def register(
    spark: SparkSession,
    name: str,
    path: str,
    fmt: str,
    schema: StructType,
    partition_by: Sequence[str] = (),
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Make files a table where they are."""
    return tables.declare_external(spark, name, path, fmt, schema, partition_by, options)


class SessionCatalog:
    """Registers tables where they are, in the schema of the session's catalog that the target name asks for."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def name(self, row: Row) -> str:
        _, schema, table = row["tgt_table"].split(".", 2)
        return f"{tables.tick(schema)}.{tables.tick(table)}"

    def __call__(self, row: Row, source) -> Moved:
        schema = row["tgt_table"].split(".", 2)[1]
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {tables.tick(schema)}")
        register(self.spark, self.name(row), source.path, source.provider, source.load().schema, source.partition_columns)
        return Moved(0, 0)

    def load(self, row: Row) -> DataFrame:
        return self.spark.table(self.name(row))


def compact(
    spark: SparkSession,
    path: str,
    new_path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    target_bytes: int = 256 * 1024 * 1024,
    schema: StructType | None = None,
) -> Moved:
    """Rewrite many small files as few of about ``target_bytes``; the sizes come from file metadata.

    Without partition columns files are packed into groups of that size and each group is read and written by one task:
    no row moves between tasks. Partitioned tables are rebalanced per partition value, a large value over many tasks.
    """
    if partition_by:
        return copy(tables.read(spark, path, fmt, schema), new_path, fmt, partition_by)
    return copy(packed(spark, path, fmt, schema, target_bytes), new_path, fmt)


def packed(spark: SparkSession, path: str, fmt: str, schema: StructType | None, target_bytes: int) -> DataFrame:
    """The files below a path, read by one task for about every ``target_bytes`` of them.

    The reader packs files into tasks by their sizes; a session of its own tells it how large a pack may be.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    return tables.read(own, path, fmt, schema)


#: With any option set, the optimizer parses the whole line even where few fields are used, and so sees every fault in it.
PERMISSIVE = {"mode": "PERMISSIVE"}
QUARANTINE = schemas.struct("reason string, line string")


@dataclass
class Converted:
    """Rows that were converted, rows set aside, and the lines that were read; the first two add up to the last."""

    moved: Moved
    quarantined: int
    lines: int


def convert_json(
    spark: SparkSession,
    src_path: str,
    path: str,
    quarantine_path: str,
    schema: StructType | None = None,
    sampling: float = 0.1,
    fmt: str = "parquet",
) -> Converted:
    """JSON lines into a columnar format; a line that does not fit the schema goes to a quarantine table as it is.

    Without a schema one is inferred from a share of the lines. A line is set aside as MALFORMED if it is no JSON object
    or a value has another type than the schema says, as UNKNOWN_FIELD if it has a field that the schema lacks, so nothing
    that the sample missed is lost without a trace. Empty lines count as malformed. Raises if the counts do not add up.
    """
    schema = schema or spark.read.option("samplingRatio", sampling).option("primitivesAsString", "false").json(src_path).schema
    schema = StructType([f for f in schema.fields if f.name != "_corrupt_record"])
    parsed = StructType([*schema.fields, StructField("_corrupt_record", StringType())])
    lines = spark.read.text(src_path).select(F.col("value").alias("line"), F.from_json("value", parsed, PERMISSIVE).alias("row"))
    known = F.array(*[F.lit(f.name) for f in schema.fields]).cast("array<string>")
    unknown = F.size(F.array_except(F.coalesce(F.json_object_keys("line"), F.array().cast("array<string>")), known)) > 0
    broken = F.col("row").isNull() | F.col("row._corrupt_record").isNotNull() | F.json_object_keys("line").isNull()
    judged = lines.select("*", F.when(broken, "MALFORMED").when(unknown, "UNKNOWN_FIELD").alias("reason"))
    good = judged.filter("reason IS NULL").select(*[F.col("row").getField(f.name).alias(f.name) for f in schema.fields])
    moved = copy(good, path, fmt)
    aside = copy(judged.filter("reason IS NOT NULL").select("reason", "line"), quarantine_path, fmt)
    total = lines.count()
    if moved.rows + aside.rows != total:
        raise ValueError(f"{total} lines were read, {moved.rows} converted and {aside.rows} set aside")
    return Converted(moved, aside.rows, total)


def run(
    spark: SparkSession,
    todo: Iterable[Row],
    action: Callable[[Row], Moved],
    run_ts: dt.datetime,
    dry_run: bool = False,
    max_parallel: int = 4,
) -> DataFrame:
    """Carry out a work list, several tables at once, and return the log.

    Only the list itself (one row per table) is on the driver; each action is a distributed job. A table
    that fails gives an ERROR row, and the others go on. A dry run touches nothing.
    """

    def one(row: Row) -> tuple:
        start = time.monotonic()
        status, error, moved = "SUCCESS", None, Moved(0, 0)
        if dry_run:
            status, moved = "DRY_RUN", Moved(row["estimated_rows"], row["estimated_bytes"])
        else:
            try:
                moved = action(row)
                status = moved.status
            except Exception as failure:  # noqa: BLE001 - one table must not stop the others
                status, error = "ERROR", f"{type(failure).__name__}: {failure}"
        took = 0.0 if dry_run else time.monotonic() - start
        return (
            row["src_table"], row["tgt_table"], row["strategy"], status, took,
            moved.rows, moved.bytes, error, run_ts,
        )

    with ThreadPoolExecutor(max_parallel) as pool:
        return tables.frame(spark, pool.map(one, todo), schemas.MIGRATION_LOG)
