"""Folders for tables written between steps.

They live in the folder the cluster names in ``spark.checkpoint.dir``, which every executor
can reach, so a lost executor never loses a step's result. Only a local session may fall back
to a folder of its own.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.gettempdir()


def new_folder(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet; the writer creates it."""
    return f"{scratch_root(spark)}/lockgate-{label}-{uuid.uuid4().hex}"


def name() -> str:
    """A name nobody has used yet."""
    return uuid.uuid4().hex


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a (small) intermediate result once and read it back: cuts lineage, survives executor loss."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def part_files(spark: SparkSession, folder: str) -> list[str]:
    """The data files of a written folder by task and number, so that a sorted table's files follow each other."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = [s.getPath().toString() for s in place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)]
    numbered = [(re.search(r"/part-(\d+)-[^/]*?-c(\d+)[^/]*\Z", f), f) for f in found]
    return [f for _, f in sorted(((int(m[1]), int(m[2])), f) for m, f in numbered if m)]
