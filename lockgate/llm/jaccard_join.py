"""Exact Jaccard self-join on word shingles by size-aware heavy-light processing.

Each text is the set of its 5-word shingles. Texts with equal sets form one class; all later work is on classes.

* **Light sets** (at most ``boundary`` shingles) list all their subsets of the overlap size that a partner of a given
  size requires. Two light sets are linked exactly if they list the same subset, so no check follows.
* **Heavy sets** scan inverted lists. A set is entered under the shingles of its prefix only: with the shingles in one
  global order, linked sets share a shingle of their prefixes, so scanning those lists finds every partner. The order
  puts shingles last whose counter in a fixed-size table of counts is high, so lists of common phrases stay unused. Light
  sets that can have a heavy partner are entered too.
* **boundary** is the largest size up to which listing subsets costs no more than scanning, from the counts of set
  sizes and the mean list length over the whole corpus.

Pairs inside a list are never all made. First each list's smallest set is held against the others, and linked classes are
joined to components. Then only sets outside the largest component of a list are held against the rest of it, if sizes
and 1024-bit parity bitmaps (a lower bound of the symmetric difference) allow a link. A pair in one component needs
no test, so no link between components is lost. Bitmaps of long sets say nothing, as any two differ in half their bits:
pairs of sets from ``LONG`` shingles on must also be near by the counts of their shingles in ``CELLS`` cells, whose
absolute differences are a lower bound too. Candidates are checked on the whole texts with integers only.

Rows without words, empty or null texts have no shingles, link with nothing and are their own component. Null ids stay
null unless linked; repeated rows fall into one class; input columns other than id and text are not read.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lockgate.llm import common

NUM, DEN = 3, 7  # a link of sizes a and b needs an overlap of at least 3 / 7 of a + b: the same as a Jaccard similarity of 3 / 4
COUNTERS = 1 << 22
WORDS = 16  # of 64 bits in a parity bitmap
LONG = 700
CELLS = 2048
LARGEST_LIGHT = 14
SALT_ROWS = 50_000
MOST_SALTS = (1 << 16) - 1
RANKED = "chunk int, rank binary, salts binary, total long, squares double"
RECENT = 20_000


def least_overlap(a: int, b: int) -> int:
    return -(-NUM * (a + b) // DEN)


def partner_sizes(a: int) -> range:
    """Sizes that a set linked with one of size ``a`` can have."""
    return range(-(-3 * a // 4), 4 * a // 3 + 1)


def prefix_lengths(a: int) -> tuple[int, int]:
    """How many shingles a set is entered under, and with how many of them it can be the smaller of a pair."""
    return a - -(-3 * a // 4) + 1, a - -(-6 * a // 7) + 1


_BITS = [f"b{i}" for i in range(WORDS)]
PROFILE = "doc_id long, rid long, th long, n long, sig long, " + ", ".join(f"{b} long" for b in _BITS) + ", cells binary, chunk int, counts binary"
LISTED = "h long, salt int, key long, n long, small boolean, low long"
CHECK_COST = 8


def _parity(shingle_set: np.ndarray) -> np.ndarray:
    odd = np.bincount((shingle_set & np.uint64(64 * WORDS - 1)).astype(np.int64), minlength=64 * WORDS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _cell_counts(shingle_set: np.ndarray) -> bytes:
    """Shingles in each cell, one byte a cell; cutting at 255 on both sides only lowers differences."""
    counts = np.bincount((shingle_set >> np.uint64(10)).astype(np.int64) & (CELLS - 1), minlength=CELLS)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def _profile(rows: common.Batches) -> common.Batches:
    """One row for each text, then this task's table of counts."""
    ids, counts = common.WordIds(), np.zeros(COUNTERS, np.uint32)
    names = [f.split()[0] for f in PROFILE.split(", ")]
    for batch in common.slices(rows):
        n, sig, cells, bits = [], [], [], np.zeros((batch.num_rows, WORDS), np.int64)
        for i, text in enumerate(common.texts(batch.column(3))):
            found = np.unique(common.shingles(ids.of(text.lower().split())))
            n.append(len(found))
            sig.append(common.signature(found))
            cells.append(_cell_counts(found) if len(found) >= LONG else None)
            if len(found):
                bits[i] = _parity(found)
                np.add.at(counts, (found >> np.uint64(40)).astype(np.int64) & (COUNTERS - 1), 1)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(n, pa.int64()), pa.array(sig, pa.int64())]
            + [pa.array(bits[:, k]) for k in range(WORDS)]
            + [pa.array(cells, pa.binary()), pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.binary())],
            names,
        )
    table = common.chunks(counts)
    yield pa.RecordBatch.from_arrays([pa.nulls(table.num_rows, pa.int64())] * (5 + WORDS) + [pa.nulls(table.num_rows, pa.binary()), *table.columns], names)


def _histogram(rows: common.Batches) -> common.Batches:
    """How many counters of a chunk hold each count."""
    for batch in rows:
        for counts in batch.column(1).to_pylist():
            value, n = np.unique(np.frombuffer(counts, np.uint32), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value.astype(np.int64)), pa.array(n.astype(np.int64))], ["value", "n"])


def _ranked(usual: float):
    """Of each chunk of counts: the place of its shingles in the global order, and over how many tasks a list is dealt."""

    def step(rows: common.Batches) -> common.Batches:
        for batch in rows:
            for chunk, binary in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = np.frombuffer(binary, np.uint32).astype(np.int64)
                rank = np.floor(4 * np.log2(np.maximum(counts / usual, 1))).astype(np.uint8)
                excess = np.maximum(0, counts - 2 * int(usual))
                salts = np.minimum(1 + excess // SALT_ROWS, MOST_SALTS).astype(np.uint16)
                values = [[chunk], [rank.tobytes()], [salts.tobytes()], [int(counts.sum())], [float((excess.astype(float) ** 2).sum())]]
                kinds = [pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], [f.split()[0] for f in RANKED.split(", ")])

    return step


def order(counted: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """Ranks and salts by counter, and the mean length of a list, from the tables of counts of all tasks.

    The tables are summed and ranked chunk by chunk in tasks; the driver gets three bytes a counter, chunk by chunk.
    """
    totals = common.stored(common.totals(counted), "totals")
    histogram = common.mapped(totals, _histogram, "value long, n long").groupBy("value").agg(F.sum("n").alias("n"))
    usual = max(1.0, float(histogram.agg(F.percentile("value", 0.5, F.col("n"))).first()[0] or 0))
    ranked = common.stored(common.mapped(totals, _ranked(usual), RANKED), "ranked")
    rank, salts = np.zeros(COUNTERS, np.uint8), np.ones(COUNTERS, np.uint16)
    for row in ranked.select("chunk", "rank", "salts").toLocalIterator():
        place = slice(row["chunk"] * common.CHUNK, (row["chunk"] + 1) * common.CHUNK)
        rank[place] = np.frombuffer(row["rank"], np.uint8)
        salts[place] = np.frombuffer(row["salts"], np.uint16)
    total, squares = ranked.agg(F.sum("total"), F.sum("squares")).first()
    return rank, salts, max(1.0, ((squares or 0) / max(1, total or 0)) ** 0.5)


def _subset_plan(a: int, boundary: int) -> list[tuple[int, int, int]]:
    """For a light set: both sizes of the pairs it lists subsets for, and the size of the subsets. Equal sets are one class."""
    plan = [(min(a, b), max(a, b), least_overlap(a, b)) for b in partner_sizes(a) if b <= boundary]
    return [(low, high, size) for low, high, size in plan if size < high]


def choose_boundary(sizes: dict[int, int], mean_list: float) -> int:
    """The largest size of a light set, by least total cost.

    A light set costs a row for each subset. A heavy set, or a light one that can have a heavy partner, costs a row for each
    entry and a check for each set of the list it lands in. ``sizes``: how many classes have each size.
    """

    def cost(boundary: int) -> float:
        listed = sum(c * sum(comb(s, k) for _, _, k in _subset_plan(s, boundary)) for s, c in sizes.items() if s <= boundary)
        scanned = sum(c * prefix_lengths(s)[0] * (1 + CHECK_COST * mean_list) for s, c in sizes.items() if 4 * s >= 3 * (boundary + 1))
        return listed + scanned

    return min(range(LARGEST_LIGHT + 1), key=cost)


def _entries(shared, boundary: int):
    """Prefix entries of sets that scan lists, subsets of light sets. A set met again in the same task adds nothing."""

    def step(rows: common.Batches) -> common.Batches:
        ids, seen = common.WordIds(), set()
        rank, dealt = shared.value
        for batch in common.slices(rows):
            h, salt, key, n, small, low = [], [], [], [], [], []

            def add(hashes, salts, name, size, smaller, low_size, h=h, salt=salt, key=key, n=n, small=small, low=low):
                h.append(hashes)
                salt.append(salts)
                key.append(np.full(len(hashes), name, np.int64))
                n.append(np.full(len(hashes), size, np.int64))
                small.append(smaller)
                low.append(np.full(len(hashes), low_size, np.int64))

            for text in common.texts(batch.column(0)):
                found = np.unique(common.shingles(ids.of(text.lower().split())))
                size = len(found)
                if size == 0:
                    continue
                name = common.signature(found)
                if name in seen:
                    continue
                if len(seen) >= RECENT:
                    seen.clear()
                seen.add(name)
                if size <= boundary:
                    for lower, high, k in _subset_plan(size, boundary):
                        one = [np.array(s, np.uint64).tobytes() for s in combinations(found.tolist(), k)]
                        hashes = np.array([xxhash.xxh3_64_intdigest(s, seed=64 * lower + high) for s in one], np.uint64)
                        add(hashes, np.zeros(len(one), np.int32), name, size, np.ones(len(one), bool), lower)
                if 4 * size >= 3 * (boundary + 1):
                    counter = _counter(found)
                    probe, index = prefix_lengths(size)
                    order = np.argsort(rank[counter], kind="stable")[:probe]  # within a rank by hash: the set is sorted
                    salts = (name % dealt[counter[order]].astype(np.int64)).astype(np.int32)
                    add(found[order], salts, name, size, np.arange(len(order)) < index, 0)
            if h:
                columns = [np.concatenate(c) for c in (h, salt, key, n, small, low)]
                columns[0] = columns[0].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h", "salt", "key", "n", "small", "low"])

    return step


def _counter(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(40)).astype(np.int64) & (COUNTERS - 1)


def _shared_only(shared):
    """From entries sorted by (h, key): each entry once, without lists of one set. Salted lists stay whole.

    One entry is carried from batch to batch: the last one, with a note whether it was given out.
    """

    def step(rows: common.Batches) -> common.Batches:
        dealt = shared.value[1]
        last, given = None, False
        for batch in rows:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if last is None else [last, batch]).combine_chunks()
            h, key = table.column("h").to_numpy(), table.column("key").to_numpy()
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (key[1:] != key[:-1])
            table, h = table.filter(pa.array(new)), h[new]
            keep = dealt[_counter(h.view(np.uint64))] > 1
            same = h[1:] == h[:-1]
            keep[1:] |= same
            keep[:-1] |= same
            out = keep.copy()
            if given:
                out[0], keep[0] = False, True
            yield from table.filter(pa.array(out)).to_batches()
            given, last = bool(keep[-1]), table.slice(len(h) - 1).combine_chunks().to_batches()[0]

    return step


def _cells_allow(rows: common.Batches) -> common.Batches:
    """Of pairs (a, b, n_a, cells_a, n_b, cells_b) those whose cells allow a link; sets without cells are not judged."""
    for batch in common.slices(rows):
        kept = []
        for i, (n_a, x, n_b, y) in enumerate(zip(*[batch.column(k).to_pylist() for k in (2, 3, 4, 5)])):
            if x is None or y is None:
                kept.append(i)
                continue
            apart = np.abs(np.frombuffer(x, np.uint8).astype(np.int16) - np.frombuffer(y, np.uint8)).sum()
            if DEN * int(apart) <= n_a + n_b:
                kept.append(i)
        yield batch.select([0, 1]).take(pa.array(kept, pa.int64()))


def plausible(pairs: DataFrame, cells: DataFrame) -> DataFrame:
    """Pairs of classes (a, b) without those that the cells (key, n, cells) of their long sets rule out."""
    side = {x: cells.select(F.col("key").alias(x), F.col("n").alias(f"n_{x}"), F.col("cells").alias(f"cells_{x}")) for x in "ab"}
    joined = pairs.join(side["a"], "a", "left").join(side["b"], "b", "left")
    return common.mapped(joined.select("a", "b", "n_a", "cells_a", "n_b", "cells_b"), _cells_allow, "a long, b long")


def _check(rows: common.Batches) -> common.Batches:
    """Pairs whose sets are similar enough, counted on the whole texts."""
    ids = common.WordIds()

    def sets(column, names):
        one, of = None, None
        for text, name in zip(common.texts(column), names):
            if name != of:
                one, of = np.unique(common.shingles(ids.of(text.lower().split()))), name
            yield one

    for batch in common.slices(rows):
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        kept = []
        for i, (x, y) in enumerate(zip(sets(batch.column(2), a), sets(batch.column(3), b))):
            common_size = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * common_size >= 75 * (len(x) + len(y) - common_size):
                kept.append(i)
        yield batch.select([0, 1]).take(pa.array(kept, pa.int64()))


def similar(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Of candidate pairs of classes (a, b) those that are linked. Only texts that a filter of bounded size admits are moved."""
    needed = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct().join(classes.select("key", "th"), "key")
    needed = common.stored(needed, "needed")
    texts = common.among(docs.select(F.xxhash64("text").alias("th"), "text").filter("text IS NOT NULL"), needed)
    texts = common.stored(needed.join(texts, "th").groupBy("key").agg(F.first("text").alias("text")), "texts")
    side = {x: texts.select(F.col("key").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab"}
    joined = pairs.join(side["a"], "a").join(side["b"], "b").select("a", "b", "text_a", "text_b")
    return common.mapped(joined, _check, "a long, b long")


_DISTANCE = " + ".join(f"bit_count(x.{b} ^ y.{b})" for b in _BITS)
#: Sizes and bitmaps allow a link between x and y.
_POSSIBLE = f"4 * least(x.n, y.n) >= 3 * greatest(x.n, y.n) AND {DEN} * ({_DISTANCE}) <= x.n + y.n"


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, rid, n_shingles, component_id, stays) for each row of ``docs``.

    ``stays`` marks one row key of each component: of the smallest id, a null id last. Rows without words all stay.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), common.row_key(docs).alias("rid"), F.col(text_col).alias("text"))
    profile = common.stored(common.mapped(docs.select("doc_id", "rid", F.xxhash64("text").alias("th"), "text"), _profile, PROFILE), "profile")
    rank, salts, mean_list = order(profile.filter("chunk IS NOT NULL").select("chunk", "counts"))
    rows = profile.filter("chunk IS NULL")
    classes = common.stored(
        rows.filter("n > 0").groupBy(F.col("sig").alias("key")).agg(F.min(_first_row()).alias("least"), F.min("th").alias("th"), F.min("n").alias("n"), *[F.min(b).alias(b) for b in _BITS]),
        "classes",
    )
    cells = rows.filter("cells IS NOT NULL").groupBy(F.col("sig").alias("key")).agg(F.first("n").alias("n"), F.first("cells").alias("cells"))
    cells = common.stored(cells, "cells")
    shared = spark.sparkContext.broadcast((rank, salts))
    del rank, salts
    sizes = {int(n): int(c) for n, c in classes.filter(F.col("n") <= 2 * LARGEST_LIGHT).groupBy("n").count().collect()}
    boundary = choose_boundary(sizes, mean_list)

    entries = common.mapped(docs.select("text"), _entries(shared, boundary), LISTED)
    entries = entries.repartition(F.col("h"), F.col("salt")).sortWithinPartitions("h", "key")
    lists = common.stored(common.mapped(entries, _shared_only(shared), LISTED).drop("salt"), "lists")
    shared.destroy()  # the lists are written; nothing that follows reads the table again
    common.tidy(spark)

    subsets, scans = lists.filter("low > 0"), lists.filter("low = 0").drop("low")
    first = subsets.groupBy("h").agg(F.min(F.struct("n", "key")).alias("l"), F.min("low").alias("low")).filter("l.n = low")
    sure = subsets.join(first.select("h", F.col("l.key").alias("a")), "h").select("a", F.col("key").alias("b"))
    first = scans.filter("small").groupBy("h").agg(F.min(F.struct("n", "key")).alias("l"))
    stars = (
        scans.join(first, "h")
        .filter("key != l.key AND 3 * n <= 4 * l.n")
        .select(F.least("key", "l.key").alias("a"), F.greatest("key", "l.key").alias("b"))
        .distinct()
    )
    bits = classes.select("key", "n", *_BITS)
    stars = (
        stars.join(bits.alias("x"), F.expr("a = x.key"))
        .join(bits.alias("y"), F.expr("b = y.key"))
        .filter(_POSSIBLE)
        .select("a", "b")
    )
    edges = common.stored(similar(common.stored(plausible(stars, cells), "stars"), docs, classes).union(sure.filter("a != b")).distinct(), "links")
    labels = common.components(edges)

    # Sets outside the largest component of a list against the rest of the list.
    scans = scans.join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    by_label = scans.groupBy("h", "label").count()
    most = by_label.groupBy("h").agg(F.max_by("label", F.struct("count", "label")).alias("most"), F.count("*").alias("labels")).filter("labels > 1")
    mixed = common.stored(scans.join(most.select("h", "most"), "h").join(bits.drop("n"), "key"), "mixed")
    x, y = mixed.filter("label != most").alias("x"), mixed.alias("y")
    rest = (
        x.join(y, F.expr(f"x.h = y.h AND x.label != y.label AND (y.label = y.most OR x.key < y.key) AND (x.small OR x.n > y.n) AND (y.small OR y.n > x.n) AND {_POSSIBLE}"))
        .select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b"))
        .distinct()
    )
    more = similar(common.stored(plausible(rest, cells), "rest"), docs, classes)
    top = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    more = more.join(top, "a", "left").join(top.toDF("b", "lb"), "b", "left")
    higher = common.components(more.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))

    found = (
        classes.select("key", "least")
        .join(labels.toDF("key", "label"), "key", "left")
        .withColumn("label", F.coalesce("label", "key"))
        .join(higher.toDF("label", "top"), "label", "left")
        .withColumn("top", F.coalesce("top", "label"))
    )
    smallest = found.groupBy("top").agg(F.min("least").alias("least"))
    of_class = found.select("key", "top").join(smallest, "top").select("key", "least")
    return (
        rows.select("doc_id", "rid", F.col("n").alias("n_shingles"), F.col("sig").alias("key"))
        .join(of_class, "key", "left")
        .select(
            "doc_id",
            "rid",
            "n_shingles",
            F.when(F.col("n_shingles") > 0, F.col("least.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
            ((F.col("n_shingles") == 0) | (F.col("least.rid") == F.col("rid"))).alias("stays"),
        )
    )


def _first_row():
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one row of each component; rows without words stay."""
    found = common.stored(join(docs), "components")
    gone = found.filter("NOT stays").select("rid")
    again = found.filter("stays AND n_shingles > 0").groupBy("rid").count().filter("count > 1").select("rid")
    return common.without(docs, gone, again)


#: The same links and components in DuckDB, by all pairs that share a shingle.
ORACLE = """
WITH RECURSIVE d AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(list_slice(w, i, i + 4), ' ') FOR i IN range(1, len(w) - 3)] END) AS shingle
  FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * i >= 75 * (x.n + y.n - i)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, r.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = d.doc_id
"""
