"""Folders that appear whole or not at all.

Data is written to a folder nobody reads and moved to its final, numbered place by one rename. Readers list the numbered
places only, so they never see half a result, and a writer that dies leaves nothing but an unread folder. A rename never
replaces: of two writers with one number the second takes the next number. File systems with an atomic rename of folders
(HDFS and local ones) give these promises in full; on plain object stores a catalogue has to take the place of the rename.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

NUMBER = "v"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders right below ``folder``, sorted; none if it does not exist. Hidden ones are left out."""
    files, place = _files(spark, folder), _path(spark, folder)
    if not files.exists(place):
        return []
    found = [s.getPath().getName() for s in files.listStatus(place) if s.isDirectory()]
    return sorted(n for n in found if n[:1] not in "._")


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """The numbers published in ``folder``, ascending."""
    marks = [n.removeprefix(f"{NUMBER}=") for n in names(spark, folder) if n.startswith(f"{NUMBER}=")]
    return sorted(int(m) for m in marks if m.isdigit())


def place(folder: str, number: int) -> str:
    return f"{folder.rstrip('/')}/{NUMBER}={number:06d}"


def latest(spark: SparkSession, folder: str) -> str | None:
    """The place published last."""
    found = numbers(spark, folder)
    return place(folder, found[-1]) if found else None


def staging(folder: str) -> str:
    """A folder beside the numbered ones that no reader takes."""
    return f"{folder.rstrip('/')}/_staged-{uuid.uuid4().hex}"


def publish(spark: SparkSession, staged: str, folder: str) -> int:
    """Move ``staged`` to the next number of ``folder`` and return that number."""
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, folder).toUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    number = max(numbers(spark, folder), default=0) + 1
    while True:
        target = place(folder, number)
        try:
            context.rename(_path(spark, staged), _path(spark, target), no_options)
            return number
        except Py4JJavaError:
            if not _files(spark, target).exists(_path(spark, target)):
                raise
            number += 1


def remove(spark: SparkSession, folder: str) -> bool:
    return _files(spark, folder).delete(_path(spark, folder), True)
