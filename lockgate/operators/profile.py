"""Inventory of tables, its summaries, and the column profile."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lockgate import constants as K
from lockgate import schemas
from lockgate.sources import tables


@dataclass
class TableSource:
    """One object to catalogue. ``load`` gives its rows; ``path`` is where its files lie, if known.

    ``key`` names the columns that tell rows apart, where a drill-down shall name them. With a ``schema`` and a file
    format as provider, the files below ``path`` can be copied one by one.
    """

    database: str
    name: str
    load: Callable[[], DataFrame]
    object_type: str = K.EXTERNAL
    provider: str = "parquet"
    path: str = ""
    owner: str = ""
    database_location: str = ""
    database_owner: str = ""
    serde: str = ""
    input_format: str = ""
    output_format: str = ""
    properties: str = ""
    partition_columns: Sequence[str] = field(default_factory=list)
    key: Sequence[str] = field(default_factory=list)
    schema: StructType | None = None


def is_delta(provider: Column, serde: Column) -> Column:
    hit = F.lower(provider).contains("delta") | serde.contains("DeltaSource")
    return F.coalesce(hit, F.lit(False))


def _facts(source: TableSource) -> dict[str, object]:
    return {
        "database_name": source.database,
        "database_location": source.database_location,
        "database_owner": source.database_owner,
        "table_name": source.name,
        "object_type": source.object_type,
        "data_provider": source.provider,
        "table_location": source.path,
        "table_owner": source.owner,
        "serde_library": source.serde,
        "input_format": source.input_format,
        "output_format": source.output_format,
        "table_properties": source.properties,
    }


def _measured(spark: SparkSession, source: TableSource) -> DataFrame:
    df = source.load()
    size = tables.path_bytes(spark, source.path) if source.path else 0
    partitions = list(source.partition_columns)
    return df.agg(F.count("*").alias("estimated_rows")).select(
        *[F.lit(v).alias(k) for k, v in _facts(source).items()],
        F.array(*[F.lit(c) for c in partitions]).cast("array<string>").alias("partition_columns"),
        F.lit(len(df.columns)).cast("bigint").alias("num_columns"),
        "estimated_rows",
        F.lit(size).cast("bigint").alias("estimated_bytes"),
        is_delta(F.lit(source.provider), F.lit(source.serde)).alias("is_delta"),
        F.lit(bool(partitions)).alias("has_partitions"),
        F.lit(None).cast("string").alias("error_message"),
    )


def _failed(source: TableSource, error: Exception) -> tuple:
    return (
        source.database, source.database_location, source.database_owner, source.name, K.ERROR,
        "", "", "", "", "", "", "", [], 0, -1, -1, False, False,
        f"{type(error).__name__}: {error}",
    )


def inventory(
    spark: SparkSession, sources: Iterable[TableSource], isolate: bool = False, max_parallel: int = 4
) -> DataFrame:
    """One row per object with measured rows and bytes.

    Counts of all tables form one job that reads file footers only. An object that cannot be resolved
    gives an ERROR row and the scan goes on; ``isolate`` runs each count as its own job, so that also a
    damaged file costs no more than its own row.
    """

    def measure(source: TableSource) -> DataFrame | tuple:
        try:
            row = _measured(spark, source)
            return tuple(row.first()) if isolate else row
        except Exception as error:  # noqa: BLE001 - one bad table must not end the scan
            return _failed(source, error)

    with ThreadPoolExecutor(max_parallel) as pool:
        found = list(pool.map(measure, sources))
    known = tables.frame(spark, [f for f in found if isinstance(f, tuple)], schemas.INVENTORY)
    return tables.union_all([known, *[f for f in found if isinstance(f, DataFrame)]])


def catalog_sources(spark: SparkSession, databases: str = "", max_parallel: int = 4) -> list[TableSource]:
    """The metastore's tables and views; temporary ones are left out.

    Facts come from DESCRIBE ... AS JSON, so a column named "Type" or "Owner" is never taken for one.
    """
    wanted = {d.strip() for d in databases.split(",") if d.strip()}
    entries = [
        (db, entry)
        for db in spark.catalog.listDatabases()
        if not wanted or db.name in wanted
        for entry in spark.catalog.listTables(db.name)
        if not entry.isTemporary
    ]

    def described(pair: tuple) -> TableSource:
        db, entry = pair
        name = f"{tables.tick(db.name)}.{tables.tick(entry.name)}"
        try:
            facts = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {name} AS JSON").first()[0])
        except Exception:  # noqa: BLE001 - the load below fails too and makes the ERROR row
            facts = {}
        return TableSource(
            database=db.name,
            name=entry.name,
            load=lambda: spark.table(name),
            object_type=facts.get("type", entry.tableType or ""),
            provider=facts.get("provider", ""),
            path="" if facts.get("type") == K.VIEW else facts.get("location", ""),
            owner=facts.get("owner", ""),
            database_location=db.locationUri or "",
            serde=facts.get("serde_library", ""),
            input_format=facts.get("input_format", ""),
            output_format=facts.get("output_format", ""),
            properties=json.dumps(facts.get("table_properties", {})),
            partition_columns=facts.get("partition_columns", []),
        )

    with ThreadPoolExecutor(max_parallel) as pool:
        return list(pool.map(described, entries))


def summary(inv: DataFrame) -> DataFrame:
    """Objects by type, provider, database, delta or not, partitioned or not: one pass, one shuffle."""
    dimensions = ["object_type", "data_provider", "database_name", "is_delta", "has_partitions"]
    pairs = [F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions]
    return (
        inv.select(F.explode(F.array(*pairs)).alias("p"))
        .groupBy("p.dimension", "p.value")
        .agg(F.count("*").alias("n_objects"))
        .select("dimension", "value", "n_objects")
    )


def bucket_label() -> Column:
    delta, kind = F.col("is_delta"), F.col("object_type")
    return (
        F.when((kind == K.MANAGED) & delta, "delta_managed")
        .when((kind == K.EXTERNAL) & delta, "delta_external")
        .when(kind == K.VIEW, "views")
        .when(~delta, "non_delta")
        .otherwise("other")
    )


def buckets(inv: DataFrame) -> DataFrame:
    return inv.groupBy(bucket_label().alias("bucket")).agg(F.count("*").alias("n_objects"))


def columns(spark: SparkSession, sources: dict[str, DataFrame]) -> DataFrame:
    """Table, column, ordinal and type of each column; schemas only, no data is read."""
    rows = [
        (table, f.name, i, f.dataType.simpleString())
        for table, df in sources.items()
        for i, f in enumerate(df.schema.fields)
    ]
    return tables.frame(spark, rows, schemas.COLUMNS)
