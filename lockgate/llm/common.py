"""What the operators share: whole texts as bytes inside Arrow tasks, word and shingle hashes, stored steps,
a key filter of bounded size and connected components.

Words are cut from UTF-8 bytes. ``bytes.split()`` cuts exactly at ``[\\x20\\x09-\\x0D]+`` and ``bytes.lower()``
changes exactly A-Z, which is what the contracts of the operators ask for.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lockgate.sources import scratch

MEMO_WORDS = 100_000
SLICE = 500
BUCKETS = 1 << 18
SHINGLE = 5
BATCH_BYTES = 4 << 20
Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: lineage ends there and survives lost executors."""
    return scratch.materialize(df, label)


def mapped(df: DataFrame, step: Callable[[Batches], Batches], schema: str) -> DataFrame:
    """``df`` through ``step`` in Arrow batches of at most ``BATCH_BYTES`` or one row; the session keeps that limit.

    Spark keeps Python workers for later tasks, so each gives what it has freed back to the system when a task ends.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)

    def task(rows: Batches) -> Batches:
        yield from step(rows)
        give_back()

    return df.mapInArrow(task, schema)


def give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(spark: SparkSession) -> None:
    """Between long steps: the driver drops the plans of what is done, and both its halves give memory back."""
    give_back()
    spark._jvm.System.gc()


def slices(rows: Batches) -> Batches:
    """The same rows in batches of at most ``SLICE``, so that what a worker holds besides its Arrow batch stays small."""
    for batch in rows:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def texts(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8 bytes; null becomes empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [t or b"" for t in column.cast(kind).to_pylist()]


class WordIds(dict):
    """64-bit hashes of words, remembered for the frequent ones; the memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < MEMO_WORDS:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64
)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit word."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def windows(ids: np.ndarray, size: int) -> np.ndarray:
    """One 64-bit hash for each run of ``size`` consecutive word hashes; none if there are fewer words."""
    n = len(ids) - size + 1
    if n < 1:
        return np.empty(0, np.uint64)
    total = ids[:n] * _FACTORS[0]
    for k in range(1, size):
        total = total + ids[k : k + n] * _FACTORS[k]
    return mix(total)


def shingles(ids: np.ndarray) -> np.ndarray:
    """Hashes of the 5-word shingles in text order; of the whole sequence where there are fewer words."""
    if 0 < len(ids) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(ids.tobytes(), seed=len(ids))], np.uint64)
    return windows(ids, SHINGLE)


def signature(shingle_set: np.ndarray) -> int:
    """One signed 64-bit number for a sorted set; with the size of the set it names its class."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingle_set.tobytes())).astype(np.int64))


def among(df: DataFrame, keys: DataFrame, name: str = "th") -> DataFrame:
    """Rows of ``df`` whose long column ``name`` may be among ``keys``; every row that is among them stays.

    A first filter before a join, so that texts nobody asks for are not shuffled. The keys fall into ``BUCKETS`` buckets,
    so what is broadcast has at most that many integers, however many keys there are.
    """
    bucket = F.pmod(F.col(name), F.lit(BUCKETS)).cast("int").alias("bucket")
    found = keys.select(bucket).distinct()
    return df.withColumn("bucket", bucket).join(F.broadcast(found), "bucket", "left_semi").drop("bucket")


CHUNK = 1 << 16


def chunks(counts: np.ndarray) -> pa.RecordBatch:
    """A task's table of counts as rows (chunk, counts), one byte for each; 255 stands for as many or more."""
    parts = np.minimum(counts, 255).astype(np.uint8).reshape(-1, CHUNK)
    return pa.RecordBatch.from_arrays(
        [pa.array(range(len(parts)), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["chunk", "counts"]
    )


def _sum_chunks(rows: Batches) -> Batches:
    """Sums of four bytes for each count, from rows of one byte or of four."""
    sums: dict[int, np.ndarray] = {}
    for batch in rows:
        for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            one = np.frombuffer(counts, np.uint8 if len(counts) == CHUNK else np.uint32)
            sums[chunk] = np.add(sums.get(chunk, 0), one, dtype=np.uint32)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["chunk", "counts"]
    )


def totals(rows: DataFrame) -> DataFrame:
    """The sums (chunk, counts) of all tasks' tables of counts, four bytes a count: a fixed size, whatever the corpus holds."""
    schema = "chunk int, counts binary"
    rows = mapped(rows.repartition("chunk", F.floor(F.rand(7) * 4)), _sum_chunks, schema)
    return mapped(rows.repartition("chunk"), _sum_chunks, schema)


def summed(rows: DataFrame, counters: int) -> np.ndarray:
    """``totals`` as one array on the driver."""
    total = np.zeros((counters // CHUNK, CHUNK), np.int64)
    for chunk, counts in totals(rows).collect():
        total[chunk] += np.frombuffer(counts, np.uint32)
    return total.reshape(-1)


def row_key(docs: DataFrame) -> Column:
    """A hash of what tells rows apart; rows that are equal in id, text, language and source share it."""
    return F.xxhash64(*[F.col(c) for c in ("text", "doc_id", "lang", "source") if c in docs.columns])


def without(docs: DataFrame, gone: DataFrame, again: DataFrame | None = None) -> DataFrame:
    """``docs`` less the rows whose key is in ``gone`` (rid), and with one of each whose key is in ``again`` (rid).

    Rows in none of the at most ``BUCKETS`` buckets of those keys pass without a shuffle; only the rest is joined.
    """
    gone = gone.select("rid").distinct()
    touched = gone if again is None else gone.union(again.select("rid").distinct())
    bucket = F.pmod(F.col("rid"), F.lit(BUCKETS)).cast("int").alias("bucket")
    buckets = stored(touched.select(bucket).distinct(), "buckets")
    keyed = docs.select(F.struct("*").alias("row"), row_key(docs).alias("rid")).withColumn("bucket", bucket)
    apart = keyed.join(F.broadcast(buckets), "bucket", "left_anti").select("row")
    near = keyed.join(F.broadcast(buckets), "bucket", "left_semi").drop("bucket").join(gone, "rid", "left_anti")
    if again is None:
        return apart.union(near.select("row")).select("row.*")
    once = near.join(again.select("rid").distinct(), "rid", "left_semi").groupBy("rid").agg(F.first("row").alias("row"))
    others = near.join(again.select("rid").distinct(), "rid", "left_anti")
    return apart.union(others.select("row")).union(once.select("row")).select("row.*")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the undirected ``edges`` (a, b): the smallest node it is connected with.

    Each round takes the smallest label among the neighbours and then the label of that label, so long chains
    halve. A hub's neighbours are pre-aggregated by Spark; no component is ever gathered in one place.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        least = labels.join(near, labels.node == near.a).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        least = stored(least, "labels")
        up = least.select(F.col("node").alias("parent"), F.col("label").alias("root"))
        jumped = stored(
            least.join(up, least.label == up.parent, "left").select("node", "old", F.coalesce("root", "label").alias("label")), "labels"
        )
        if jumped.filter("label != old").isEmpty():
            return jumped.select("node", "label")
        labels = jumped.select("node", "label")

