"""Fingerprint trees: kept with a table, they name the rows in which two states of it differ without reading either.

``build`` reads a table once and stores, per key, the number of its rows and the exact sum of their hashes, laid out by
the buckets of the key's hash: ``FAN`` folders, each sorted by the finest buckets. Above them it stores the sums of every
bucket, level by level, ``fan`` buckets below each. ``diff`` compares two trees from the top: only children of buckets that
differ are looked at, and of the keys only the folders and buckets that differ are read. A source that is gone can still
be compared, as its tree stands for it.

Repeated keys are summed up before the shuffle, so a key that holds most rows is one row a task. What is collected or
broadcast is bounded by the parameters: ``fan`` folders, and finest buckets only up to ``BROADCAST`` of them.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lockgate import schemas
from lockgate.functions import exactsum
from lockgate.functions.exactsum import tick
from lockgate.operators import reconcile
from lockgate.sources import tables

BROADCAST = 1 << 20
LANES = exactsum.lane_names("hash")
ROW_HASH = "row_hash"
NODES = schemas.struct(", ".join(["node bigint", "n_rows bigint", *[f"{lane} bigint" for lane in LANES]]))
#: What two trees must share, and what is stored with one.
ABOUT = ("key", "columns", "fan", "levels", "hash_kind")


@dataclass
class Tree:
    """A stored tree; ``key`` is ``row_hash`` where the table has no key."""

    spark: SparkSession
    folder: str
    key: list[str]
    columns: list[str]
    fan: int
    levels: int
    hash_kind: str
    schema: dict

    def rows(self) -> DataFrame:
        """(key columns, leaf, n_rows, hash sums), in folders by ``top``."""
        return self.spark.read.schema(T.StructType.fromJson(self.schema)).parquet(f"{self.folder}/rows")

    def nodes(self, level: int) -> DataFrame:
        """(node, n_rows, hash sums) of one level; level 1 is below the root."""
        return self.spark.read.schema(NODES).parquet(f"{self.folder}/nodes/level={level}")


def _sums() -> list:
    return [F.sum("n_rows").alias("n_rows"), *[F.sum(tick(n)).alias(n) for n in LANES]]


def build(
    df: DataFrame,
    folder: str,
    key: Sequence[str] = (),
    fan: int = 64,
    levels: int = 2,
    hash_kind: str = "fast",
    columns: Sequence[str] | None = None,
) -> Tree:
    """Store the tree of a table; one scan and one shuffle of (key, hash), then sums of sums."""
    spark, columns = df.sparkSession, list(columns or df.columns)
    hashed = reconcile.hashed(df, list(key), columns, hash_kind)
    if not key:
        hashed = hashed.withColumn(ROW_HASH, F.col("_row"))
    by = list(key) or [ROW_HASH]
    leaf = F.expr(f"pmod(_place, {fan**levels})")
    summed = hashed.groupBy(*by, leaf.alias("leaf")).agg(F.count("*").alias("n_rows"), *map(F.expr, exactsum.lane_sums("_row", "hash")))
    laid = summed.withColumn("top", F.expr(f"CAST(leaf div {fan ** (levels - 1)} AS INT)")).hint("rebalance", "top")
    laid.sortWithinPartitions("top", "leaf").write.partitionBy("top").parquet(f"{folder}/rows")
    tree = Tree(spark, folder, by, columns, fan, levels, hash_kind, laid.schema.jsonValue())
    level = tree.rows().groupBy(F.col("leaf").alias("node")).agg(*_sums())
    for depth in range(levels, 0, -1):
        level.coalesce(1).write.parquet(f"{folder}/nodes/level={depth}")
        level = tree.nodes(depth).groupBy(F.expr(f"node div {fan}").alias("node")).agg(*_sums())
    about = {f: getattr(tree, f) for f in (*ABOUT, "schema")}
    tables.frame(spark, [(json.dumps(about),)], schemas.struct("about string")).write.parquet(f"{folder}/about")
    return tree


def load(spark: SparkSession, folder: str) -> Tree:
    """A tree stored earlier; its table need not exist any more."""
    about = json.loads(spark.read.parquet(f"{folder}/about").first()["about"])
    return Tree(spark, folder, **about)


def _comparable(src: Tree, tgt: Tree) -> None:
    for part in ABOUT:
        if getattr(src, part) != getattr(tgt, part):
            raise ValueError(f"the trees differ in their {part}: {getattr(src, part)} and {getattr(tgt, part)}")


def _both(src: DataFrame, tgt: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows and hash sums of both sides by ``by``, where they differ: n_src, n_tgt."""
    signed = src.withColumn("sign", F.lit(1)).unionByName(tgt.withColumn("sign", F.lit(-1)))
    n, sign = F.col("n_rows"), F.col("sign")
    summed = signed.groupBy(*by).agg(
        F.sum(F.when(sign > 0, n).otherwise(0)).alias("n_src"),
        F.sum(F.when(sign < 0, n).otherwise(0)).alias("n_tgt"),
        *[F.sum(F.col(tick(lane)) * sign).alias(lane) for lane in LANES],
    )
    differs = F.col("n_src") != F.col("n_tgt")
    for lane in LANES:
        differs = differs | (F.col(tick(lane)) != 0)
    return summed.withColumn("differs", differs).drop(*LANES)


def levels(src: Tree, tgt: Tree) -> list[DataFrame]:
    """Compared nodes (node, n_src, n_tgt, differs) of each level, from the top; below the first only where the parents differ."""
    _comparable(src, tgt)
    found: list[DataFrame] = []
    for level in range(1, src.levels + 1):
        sides = [tree.nodes(level) for tree in (src, tgt)]
        if found:
            parents = found[-1].filter("differs").select(F.col("node").alias("parent"))
            sides = [s.join(parents, F.expr(f"node div {src.fan}") == F.col("parent"), "left_semi") for s in sides]
        found.append(_both(*sides, ["node"]))
    return found


def trace(src: Tree, tgt: Tree) -> DataFrame:
    """(level, n_compared, n_differing): how narrow the search became."""
    counted = [
        df.agg(F.count("*").alias("n_compared"), F.count_if("differs").alias("n_differing")).select(F.lit(i + 1).alias("level"), "*")
        for i, df in enumerate(levels(src, tgt))
    ]
    return tables.union_all(counted)


def diff(src: Tree, tgt: Tree) -> DataFrame:
    """(key columns, n_src, n_tgt, finding) of every key whose rows differ: ONLY_SOURCE, ONLY_TARGET or CHANGED."""
    compared = levels(src, tgt)
    tops = [r["node"] for r in compared[0].filter("differs").select("node").collect()]
    leaves = compared[-1].filter("differs").select(F.col("node").alias("leaf"))
    if src.fan**src.levels <= BROADCAST:
        leaves = F.broadcast(leaves)
    sides = [tree.rows().filter(F.col("top").isin(tops)).join(leaves, "leaf", "left_semi").drop("top", "leaf") for tree in (src, tgt)]
    s, t = F.col("n_src"), F.col("n_tgt")
    finding = F.when(t == 0, "ONLY_SOURCE").when(s == 0, "ONLY_TARGET").otherwise("CHANGED")
    return _both(*sides, src.key).filter("differs").select(*src.key, "n_src", "n_tgt", finding.alias("finding"))
