"""Copies that are brought up to date: only files of the source that are new or changed are copied.

Layout of a target: ``data/copy_version=<n>/copy_file=<id>/...`` holds the rows of one source file, ``manifest/v=<n>`` lists for
every source file (path, length, time) where its rows are. A run writes the changed files into a new version and publishes
its manifest last, by one rename. Until then, and if the run fails, readers see the version before; rows of files that
changed or went away stay on disk, unread, until ``prune``.

The driver holds the paths of changed files, as any reader holds the paths of its files; rows move in tasks only. The
partition columns of the source stay folders below each file, so filters on them still prune.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lockgate import schemas
from lockgate.sources import published, tables

FILES = schemas.struct("path string, file_id bigint, length bigint, modified timestamp, version bigint")
VERSION, FILE = "copy_version", "copy_file"


@dataclass
class Update:
    """What a run did: files by fate, and the rows and bytes it moved."""

    copied: int
    kept: int
    removed: int
    rows: int
    bytes: int


def _file_id() -> Column:
    return F.xxhash64("_metadata.file_path")


def source_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, file_id, length, modified) of every file below a path, from metadata; no file is opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return listed.select(
        "path",
        _file_id().alias("file_id"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def manifest(spark: SparkSession, base: str) -> DataFrame:
    """The published files of a target; none before the first run."""
    last = published.latest(spark, f"{base}/manifest")
    return spark.read.schema(FILES).parquet(last) if last else tables.frame(spark, [], FILES)


def update(
    spark: SparkSession,
    src_path: str,
    fmt: str,
    base: str,
    schema: StructType,
    partition_by: Sequence[str] = (),
    options: dict[str, str] | None = None,
) -> Update:
    """Bring the copy below ``base`` up to the files below ``src_path``.

    A file counts as changed if its path, length or time differ from what the last published run saw, and is copied
    again as a whole. Two runs at a time do no harm: each writes a folder of its own and publishes a whole manifest.
    """
    version = max([0, *published.numbers(spark, f"{base}/manifest"), *_started(spark, base)]) + 1
    same = ["path", "file_id", "length", "modified"]
    last = manifest(spark, base)
    now = source_files(spark, src_path)
    joined = now.join(last.select(*same, F.col("version").alias("known")), same, "left")
    listed = joined.select(*same, F.coalesce("known", F.lit(version)).cast("bigint").alias("version"))
    staged = published.staging(f"{base}/manifest")
    listed.coalesce(1).write.parquet(staged)
    files = spark.read.schema(FILES).parquet(staged)
    changed = [r["path"] for r in files.filter(F.col("version") == version).select("path").collect()]
    kept = files.filter(F.col("version") < version).count()
    removed = last.join(now.select("path"), "path", "left_anti").count()
    rows = size = 0
    if changed:
        folder = f"{base}/data/{VERSION}={version}"
        seen = Observation()
        reader = spark.read.format(fmt).options(**tables.format_options(fmt, options)).option("basePath", src_path).schema(schema)
        found = reader.load(changed).select(*[tables.tick(c) for c in schema.fieldNames()], _file_id().alias(FILE))
        read = (tables.unescaped(found) if tables.is_escaped(fmt, options) else found).observe(seen, F.count(F.lit(1)).alias("rows"))
        read.write.partitionBy(FILE, *partition_by).parquet(folder)
        rows, size = seen.get["rows"], tables.path_bytes(spark, folder)
    if changed or removed or version == 1:
        published.publish(spark, staged, f"{base}/manifest")
    else:
        published.remove(spark, staged)
    return Update(len(changed), kept, removed, rows, size)


def _started(spark: SparkSession, base: str) -> list[int]:
    """Versions whose data somebody began to write, published or not."""
    return [int(n.removeprefix(f"{VERSION}=")) for n in published.names(spark, f"{base}/data")]


def read(spark: SparkSession, base: str, schema: StructType) -> DataFrame:
    """The rows of the published version. The join on the folder columns prunes folders that are not of it."""
    if not _started(spark, base):
        return tables.frame(spark, [], schema)
    stored = StructType([*schema.fields, *schemas.struct(f"{VERSION} bigint, {FILE} bigint").fields])
    current = manifest(spark, base).select(F.col("version").alias(VERSION), F.col("file_id").alias(FILE))
    rows = spark.read.schema(stored).parquet(f"{base}/data")
    return rows.join(current, [VERSION, FILE], "left_semi").select(*schema.fieldNames())


def prune(spark: SparkSession, base: str) -> int:
    """Delete folders of files that the published version does not list; how many. Not beside a running update."""
    wanted = {(r["version"], r["file_id"]) for r in manifest(spark, base).select("version", "file_id").collect()}
    gone = 0
    for version in _started(spark, base):
        folder = f"{base}/data/{VERSION}={version}"
        for name in published.names(spark, folder):
            if (version, int(name.removeprefix(f"{FILE}="))) not in wanted:
                gone += published.remove(spark, f"{folder}/{name}")
    return gone
