"""One history over all runs: migration, permission, reconciliation and rollback logs by run.

A run stages its logs and publishes them together. A run that is repeated under its id publishes a further attempt; the
history shows the last attempt of each run only, so repeated rows never double and a failed repeat changes nothing. Logs
may gain columns from run to run; older rows show NULL there.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lockgate import schemas
from lockgate.sources import published, tables

RUN = "run_id"
WRITERS = 4


class RunLog:
    """The logs below ``root``: runs/run_id=<id>/v=<attempt>/<kind>."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, f"{root.rstrip('/')}/runs"

    def _folder(self, run_id: str) -> str:
        if not re.match(r"[A-Za-z0-9_.-]+\Z", run_id) or run_id[0] in "._":
            raise ValueError(f"a run id holds letters, digits, '-', '_' and '.' only and starts with none of the last two: {run_id!r}")
        return f"{self.root}/{RUN}={run_id}"

    def publish(self, run_id: str, logs: dict[str, DataFrame]) -> int:
        """Store the logs of a run, all at once; the number of the attempt."""
        folder = self._folder(run_id)
        staged = published.staging(folder)
        with ThreadPoolExecutor(WRITERS) as pool:
            list(pool.map(lambda item: item[1].coalesce(1).write.parquet(f"{staged}/{item[0]}"), logs.items()))
        return published.publish(self.spark, staged, folder)

    def current(self) -> dict[str, str]:
        """The folder of the last attempt of each published run."""
        ids = [n.removeprefix(f"{RUN}=") for n in published.names(self.spark, self.root) if n.startswith(f"{RUN}=")]
        last = {i: published.latest(self.spark, self._folder(i)) for i in ids}
        return {i: folder for i, folder in last.items() if folder}

    def runs(self) -> DataFrame:
        """(run_id, attempts) of every published run."""
        rows = [(i, len(published.numbers(self.spark, self._folder(i)))) for i in self.current()]
        return tables.frame(self.spark, rows, schemas.struct(f"{RUN} string, attempts int"))

    def read(self, kind: str, like: T.StructType) -> DataFrame:
        """Rows of one kind over all runs, with their run_id; ``like`` is the schema where no run has any.

        All runs are read by one scan; their ids are taken from the folders, columns that only later runs have are NULL before.
        """
        folders = [f"{f}/{kind}" for f in self.current().values() if kind in published.names(self.spark, f)]
        if not folders:
            return tables.frame(self.spark, [], T.StructType([*like.fields, T.StructField(RUN, T.StringType())]))
        found = self.spark.read.option("mergeSchema", "true").parquet(*folders)
        run = F.regexp_extract(F.col("_metadata.file_path"), rf"/{RUN}=([^/]+)/", 1)
        rows = found.withColumn(RUN, run)
        return reduce(lambda df, f: df if f.name in df.columns else df.withColumn(f.name, F.lit(None).cast(f.dataType)), like.fields, rows)

    def prune(self) -> int:
        """Delete the attempts that a later one of the same run replaced; how many."""
        gone = 0
        for run_id in self.current():
            folder = self._folder(run_id)
            for number in published.numbers(self.spark, folder)[:-1]:
                gone += published.remove(self.spark, published.place(folder, number))
        return gone
