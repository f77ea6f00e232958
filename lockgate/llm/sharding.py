"""Shards of near equal bytes by sampled splitters.

The key of a record is (hash of its text, hash of its id, a tie number), so equal texts are neighbours. Records are drawn into a
sample with a chance in proportion to their size; quantiles of the weighted sample cut the key space into
``shards * RANGES`` ranges. The true bytes of every range are then summed over all records, ranges of more than twice
the mean are cut again by a sample of their own records, and consecutive ranges are dealt to shards by cumulative bytes.
A cut moves to the start of its group of equal texts, unless the group fills a range or more: small groups stay whole
and large ones are spread. The sample is bounded by ``2 * shards * RANGES * DRAWS`` keys, whatever the input holds.

Slots are the rank in the range plus the rows of earlier ranges of the shard, so no shard is sorted as a whole.
Null text has no bytes and counts as an empty text; null and repeated ids are keys like any other, and rows that are equal
in id and text are told apart by the tie number. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from itertools import count

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lockgate.llm import common

OVERHEAD = 8
RANGES = 64
DRAWS = 32
_LOW = -(1 << 63)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Size, checksum and key of each record, stored: the tie number must not change when a task runs again."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("k1"),
        F.xxhash64(F.col(id_col)).alias("k2"),
        F.xxhash64(F.monotonically_increasing_id()).alias("k3"),
    )
    return common.stored(rows, "keys")


def _bytes(k1: np.ndarray, k2: np.ndarray, k3: np.ndarray) -> np.ndarray:
    """Keys as strings of 24 bytes in the order of the numbers."""
    flipped = np.stack([k1, k2, k3], 1).astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return np.ascontiguousarray(flipped.astype(">u8")).view("V24").reshape(-1).view("S24") if len(k1) else np.empty(0, "S24")


def with_range(rows: DataFrame, cuts: np.ndarray) -> DataFrame:
    """Adds ``range``: how many of the sorted cuts are at or below the key."""
    shared = rows.sparkSession.sparkContext.broadcast(_bytes(*cuts.T) if len(cuts) else np.empty(0, "S24"))

    @F.pandas_udf("int")
    def place(k1, k2, k3):
        import pandas as pd

        return pd.Series(np.searchsorted(shared.value, _bytes(k1.to_numpy(), k2.to_numpy(), k3.to_numpy()), side="right").astype(np.int32))

    return rows.withColumn("range", place("k1", "k2", "k3"))


def _draw(rows: DataFrame, draws: int, total: int, seed: int) -> np.ndarray:
    """Keys and weights (k1, k2, k3, weight) of a size-weighted sample of some ``draws`` records, and at most twice as many."""
    step = max(1.0, total / draws)
    chance = F.pmod(F.xxhash64("k1", "k2", "k3", F.lit(seed)), F.lit(1 << 40)) / (1 << 40)
    found = rows.filter(chance * step < F.col("size")).select("k1", "k2", "k3", F.greatest(F.col("size").cast("double"), F.lit(step)).alias("w"))
    taken = found.toPandas()
    order = np.lexsort([taken.k3, taken.k2, taken.k1])
    return taken.iloc[order]


def _quantiles(sample, parts: int) -> list[tuple[int, int, int]]:
    """``parts - 1`` keys of the sorted sample that cut its weight evenly."""
    if not len(sample) or parts < 2:
        return []
    passed = np.cumsum(sample.w.to_numpy())
    places = np.searchsorted(passed, passed[-1] * np.arange(1, parts) / parts)
    keys = sample[["k1", "k2", "k3"]].to_numpy()
    return [tuple(int(v) for v in keys[min(p, len(keys) - 1)]) for p in places]


def _snap(cuts: set[tuple[int, int, int]]) -> np.ndarray:
    """The first cut inside a group of equal texts moves to the start of the group; further cuts of it stay."""
    found: list[tuple[int, int, int]] = []
    for cut in sorted(cuts):
        found.append(cut if found and found[-1][0] == cut[0] else (cut[0], _LOW, _LOW))
    return np.array(sorted(set(found)), np.int64).reshape(-1, 3)


def splitters(rows: DataFrame, shards: int) -> tuple[np.ndarray, dict[int, tuple[int, int]]]:
    """The cuts, and for each range the bytes and rows it holds."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    if not total:
        return np.empty((0, 3), np.int64), {}
    wanted = shards * RANGES
    cuts = _snap(set(_quantiles(_draw(rows, wanted * DRAWS, total, 1), wanted)))
    for turn in count():
        placed = with_range(rows, cuts)
        sums = {r: (b, n) for r, b, n in placed.groupBy("range").agg(F.sum("size"), F.count("*")).collect()}
        full = {r: b for r, (b, n) in sums.items() if n > 1 and b > 2 * total / wanted}
        if not full:
            break
        inside = placed.filter(F.col("range").isin(list(full)))
        sample = _draw(inside, max(DRAWS, int(wanted * DRAWS * sum(full.values()) / total)), sum(full.values()), turn + 2)
        where = np.searchsorted(_bytes(*cuts.T), _bytes(sample.k1.to_numpy(), sample.k2.to_numpy(), sample.k3.to_numpy()), side="right") if len(cuts) else np.zeros(len(sample), int)
        more = {tuple(int(v) for v in c) for c in cuts}
        for r, size in full.items():
            more |= set(_quantiles(sample[where == r], int(np.ceil(size * wanted / total))))
        finer = _snap(more)
        if len(finer) == len(cuts):
            break  # what is left cannot be cut: single records, or records equal in every key
        cuts = finer
    return cuts, sums


def deal(sums: dict[int, tuple[int, int]], shards: int) -> list[tuple[int, int, int]]:
    """(range, shard, rows of earlier ranges of the shard): by the middle of the range on the line of all bytes."""
    total, passed, rows = sum(b for b, _ in sums.values()), 0, [0] * shards
    found = []
    for r in sorted(sums):
        size, n = sums[r]
        shard = min(shards - 1, int((passed + size / 2) * shards / total))
        found.append((r, shard, rows[shard]))
        rows[shard] += n
        passed += size
    return found


def assign(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null: the law is not by key) for each record."""
    rows = keyed(docs)
    cuts, sums = splitters(rows, shards)
    spark = docs.sparkSession
    dealt = spark.createDataFrame(deal(sums, shards), "range int, shard int, earlier long")
    placed = with_range(rows, cuts)
    order = Window.partitionBy("range").orderBy("k1", "k2", "k3")
    placed = placed.withColumn("rank", F.row_number().over(order))
    # one row for each range, a number that only the parameters set
    return placed.join(F.broadcast(dealt), "range").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("earlier") + F.col("rank") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 24) -> None:
    """All columns of ``docs`` as Parquet in folders ``shard=0`` and so on, range by range in key order."""
    cuts, sums = splitters(keyed(docs), shards)
    text = F.coalesce(F.col("text"), F.lit(""))
    placed = docs.withColumns({"k1": F.xxhash64(text), "k2": F.xxhash64("doc_id"), "k3": F.xxhash64(F.monotonically_increasing_id())})
    dealt = docs.sparkSession.createDataFrame([(r, s) for r, s, _ in deal(sums, shards)], "range int, shard int")
    placed = with_range(placed, cuts).join(F.broadcast(dealt), "range")
    placed.repartition("range").sortWithinPartitions("shard", "range", "k1", "k2").drop("range", "k1", "k2", "k3").write.partitionBy("shard").parquet(path)
