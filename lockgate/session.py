"""Session for tests and the bench. On a cluster the caller brings its own session."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(
    app: str, cores: int | str = 8, memory: str = "8g", shuffle_partitions: int = 8, **conf: str
) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
    )
    if "spark.checkpoint.dir" not in conf:
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="lockgate-"))
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
