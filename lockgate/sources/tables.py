"""Readers and writers for Parquet, ORC and CSV tables, by path or by metastore name."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import CharType, StringType, StructType, VarcharType

from lockgate.functions.exactsum import tick

# Written and read with the same options, every string (also '' and NULL, quotes and line breaks, a text that looks like the
# mark of NULL) and every microsecond comes back unchanged. Line breaks and backslashes in texts are escaped, so a record is
# one line and files can be split. ESCAPED says so; files of others, without escapes, are read with ESCAPED = "false".
ESCAPED = "escaped"
CSV_OPTIONS = {
    "header": "true",
    "delimiter": ";",
    "nullValue": "\\N",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def format_options(fmt: str, options: dict[str, str] | None) -> dict[str, str]:
    given = {**(CSV_OPTIONS if fmt == "csv" else {}), **(options or {})}
    escaped = is_escaped(fmt, options)
    if fmt == "csv" and not escaped:
        given = {"multiLine": "true", **given}
    return {k: v for k, v in given.items() if k != ESCAPED}


def is_escaped(fmt: str, options: dict[str, str] | None) -> bool:
    return fmt == "csv" and (options or {}).get(ESCAPED, "true").lower() == "true"


def _texts(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    kinds = (StringType, CharType, VarcharType)
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]
    return df.select(*[change(F.col(tick(c))).alias(c) if c in names else F.col(tick(c)) for c in df.columns])


def escaped(df: DataFrame) -> DataFrame:
    """Backslashes doubled and line breaks as \\n and \\r, so no text breaks a line or looks like the mark of NULL."""

    def change(c: Column) -> Column:
        for plain, written in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
            c = F.replace(c, F.lit(plain), F.lit(written))
        return c

    return _texts(df, change)


def unescaped(df: DataFrame) -> DataFrame:
    """What ``escaped`` was given. Between doubled backslashes a single one marks a line break."""

    def change(c: Column) -> Column:
        pieces = F.split(c, r"\\\\", -1)
        read = F.transform(pieces, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
        return F.when(F.contains(c, F.lit("\\")), F.array_join(read, "\\")).otherwise(c)

    return _texts(df, change)


def read(
    spark: SparkSession,
    ref: str,
    fmt: str | None = None,
    schema: StructType | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A table by name (no ``fmt``) or the files under a path.

    With a schema the columns come back in its order, although partition columns are stored last.
    """
    if fmt is None:
        return spark.table(ref)
    reader = spark.read.format(fmt).options(**format_options(fmt, options))
    found = reader.load(ref) if schema is None else reader.schema(schema).load(ref).select(*[tick(c) for c in schema.fieldNames()])
    return unescaped(found) if is_escaped(fmt, options) else found


def spread(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring rows of one partition value together without tying a value to one task.

    REBALANCE lets the adaptive planner cut a value that holds most rows into many tasks and
    merge small ones; a plain repartition on the column would write each value in one task.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def write(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    mode: str = "errorifexists",
    options: dict[str, str] | None = None,
    max_records_per_file: int | None = None,
) -> None:
    """Write files. Without partition columns there is no shuffle."""
    if is_escaped(fmt, options):
        df = escaped(df)
    writer = df.write.format(fmt).mode(mode).options(**format_options(fmt, options))
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def save_table(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    path: str | None = None,
) -> None:
    """A metastore table, replaced with its schema on overwrite; external when a path is given."""
    writer = spread(df, partition_by).write.format(fmt).mode(mode)
    if fmt == "delta" and mode == "overwrite":
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def quoted(text: str) -> str:
    """A SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def location(spark: SparkSession, name: str) -> str:
    """Where the files of a metastore table lie."""
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {name} AS JSON").first()[0])["location"].rstrip("/")


def location_of(spark: SparkSession, path: str) -> str:
    """A path as the metastore writes it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString().rstrip("/")


def declare_external(
    spark: SparkSession,
    name: str,
    path: str,
    fmt: str,
    schema: StructType,
    partition_by: Sequence[str] = (),
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Register files where they are: declared schema, then partition discovery. No data is copied."""
    columns = ", ".join(f"{tick(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    option_list = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in format_options(fmt, options).items())
    clauses = [f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt}"]
    if option_list:
        clauses.append(f"OPTIONS ({option_list})")
    if partition_by:
        clauses.append(f"PARTITIONED BY ({', '.join(map(tick, partition_by))})")
    clauses.append(f"LOCATION {quoted(path)}")
    spark.sql(" ".join(clauses))
    there = location(spark, name)
    if there != location_of(spark, path):
        raise ValueError(f"{name} is there already, at {there}")
    if partition_by:
        spark.catalog.recoverPartitions(name)
    found = spark.table(name).select(*[tick(c) for c in schema.fieldNames()])
    return unescaped(found) if is_escaped(fmt, options) else found


def append_evolving(df: DataFrame, path: str) -> None:
    """Append to a log whose columns may grow; ``read_evolving`` shows all of them."""
    df.write.mode("append").parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def frame(spark: SparkSession, rows: Iterable, schema: StructType) -> DataFrame:
    """Driver rows (reports, small literals) as a DataFrame with a declared schema, in one partition."""
    return spark.createDataFrame(list(rows), schema).coalesce(1)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name, pairwise, so that many frames do not make a deep plan."""
    frames = list(frames)
    while len(frames) > 1:
        pairs = [frames[i : i + 2] for i in range(0, len(frames), 2)]
        frames = [p[0].unionByName(p[1]) if len(p) == 2 else p[0] for p in pairs]
    return frames[0]


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes under a path, from file metadata alone."""
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop_path):
        raise AnalysisException(f"path does not exist: {path}")
    return fs.getContentSummary(hadoop_path).getLength()
