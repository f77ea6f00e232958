"""Merkle manifest of a table: one digest over all rows, and for every row a proof that it belongs to it.

Each row is a leaf, the SHA-256 of its fields with their lengths. The leaves of a group stand in the order of their key;
``FAN`` neighbours become one node until one is left, the group's root; the roots of the groups, in their order, become
the root of the table in the same way.

Positions come from one sort by ranges, so a group that holds most rows spreads over many tasks: each task numbers what
it holds and the counts of the tasks before it are added. A leaf partition is a whole subtree of ``FAN ** LEVELS``
leaves. Its interior nodes are made in one step, then the partitions' own roots are grouped in the same way, so 10^11 rows
take four steps.

Proofs are made by an octopus multiproof: each leaf partition works out the smallest set of nodes that all its leaves lack
together, up to the root of the table, fetches these in one join, derives the shared inner nodes once, and expands the
proof of each leaf locally. Nodes near a root are fetched by many partitions; such a key has a row a partition, not a row
a leaf, and the adaptive planner splits it. What a partition derives must end in the published root.

Nulls are marked in the leaf, a null group or key comes first, an empty text differs from null. Equal rows are leaves of
their own; rows with equal keys stand in the order of their leaves. An empty table has no root and no proofs. Columns
other than the named ones do not take part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lockgate.llm import common

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 3
LEVELS = 7
#: The tree over the roots of the groups; groups are numbered from 0.
TOP = -1
NODES = "tree bigint, level int, place bigint, digest string, size bigint"
COORDINATES = "tree bigint, level int, place bigint, of_tree bigint, of_block bigint"
SIDES = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


# ---------------------------------------------------------------- leaves and positions


def leaf(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields, each as its length in bytes and its text, or a mark for null."""
    parts = [F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")), F.lit("-")) for f in fields]
    return F.sha2(F.encode(F.concat(*parts), "utf-8"), 256)


def numbered(rows: DataFrame, groups: Sequence[str], order: Sequence[str], label: str) -> DataFrame:
    """``rows`` with their place among the rows of their group (from 0) and the size of the group.

    A salt by the order of reading splits even rows that are equal in every column over several tasks.
    """
    salt, keys = F.monotonically_increasing_id().alias("_salt"), [*groups, *order]
    dealt = rows.select("*", salt).repartitionByRange(*keys, "_salt").sortWithinPartitions(*keys, "_salt")
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    laid = common.stored(dealt.drop("_salt").select("*", F.spark_partition_id().alias("_part"), at.alias("_at")), label)
    held = laid.groupBy(*groups, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_held"))
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = common.stored(
        held.select(
            *[F.col(g).alias(f"_{g}") for g in groups],
            F.col("_part").alias("_p"),
            (F.coalesce(F.sum("_held").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
            F.sum("_held").over(Window.partitionBy(*groups)).alias("size"),
        ),
        f"{label}-shifts",
    )
    same = F.col("_part") == F.col("_p")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    return laid.join(shifts, same).select(*rows.columns, (F.col("_at") + F.col("_shift")).alias("place"), "size")


# ---------------------------------------------------------------- trees


def _digest(parts: Iterable[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def _at_level(size: int, level: int) -> int:
    """Nodes of a level in a tree of ``size`` leaves."""
    return -(-size // FAN**level)


def _subtree(levels: int):
    def step(nodes: pa.Table) -> pa.Table:
        """The inner nodes over the neighbours of one block, up to ``levels`` levels or the root of the tree."""
        nodes = nodes.sort_by("place")
        tree, level, place, size = (nodes.column(c)[0].as_py() for c in ("tree", "level", "place", "size"))
        digests, found = nodes.column("digest").to_pylist(), []
        for _ in range(levels):
            if _at_level(size, level) == 1:
                break
            digests = [_digest(digests[i : i + FAN]) for i in range(0, len(digests), FAN)]
            level, place = level + 1, place // FAN
            found += [(tree, level, place + i, d, size) for i, d in enumerate(digests)]
        kinds = [("tree", pa.int64()), ("level", pa.int32()), ("place", pa.int64()), ("digest", pa.string()), ("size", pa.int64())]
        columns = zip(*found) if found else [[]] * len(kinds)
        return pa.table({name: pa.array(values, kind) for (name, kind), values in zip(kinds, columns)})

    return step


def grow(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """All inner nodes of the trees over ``leaves`` (tree, level 0, place, digest, size), ``levels`` levels a step."""
    steps, level, base = [], 0, leaves
    largest = leaves.agg(F.max("size")).first()[0] or 0
    while _at_level(largest, level) > 1:
        blocks = base.groupBy("tree", F.expr(f"place div {FAN**levels}").alias("block"))
        steps.append(common.stored(blocks.applyInArrow(_subtree(levels), NODES), "nodes"))
        level += levels
        base = steps[-1].filter(F.col("level") == level)
    return reduce(DataFrame.unionByName, steps or [leaves.limit(0)])


def tops(leaves: DataFrame, inner: DataFrame) -> DataFrame:
    """(tree, digest) of the root of each tree; a lone leaf is its own root."""
    one_left = F.col("size") <= F.pow(F.lit(float(FAN)), F.col("level").cast("double"))
    first = F.col("level").isin(0) | (F.col("size") > F.pow(F.lit(float(FAN)), (F.col("level") - 1).cast("double")))
    lone = leaves.filter("size = 1").select("tree", "digest")
    return lone.unionByName(inner.filter(one_left & first & (F.col("size") > 1)).select("tree", "digest"))


# ---------------------------------------------------------------- proofs


def lacking(held: Iterable[int], size: int) -> list[tuple[int, int]]:
    """The smallest set of (level, place) that proves all ``held`` leaves of a tree together: what no held leaf derives."""
    known, level, missing = sorted(set(held)), 0, []
    while size > 1:
        have, above = set(known), sorted({p // FAN for p in known})
        for run in above:
            missing += [(level, p) for p in range(FAN * run, min(FAN * run + FAN, size)) if p not in have]
        known, level, size = above, level + 1, _at_level(size, 1)
    return missing


def _wanted(groups: int, levels: int):
    def step(block: pa.Table) -> pa.Table:
        tree, of_block = block.column("tree")[0].as_py(), block.column("place")[0].as_py() // FAN**levels
        wanted = [(tree, *c) for c in lacking(block.column("place").to_pylist(), block.column("size")[0].as_py())]
        wanted += [(TOP, *c) for c in lacking([tree], groups)]
        # A partition that lacks nothing asks for its own first leaf, so that every partition meets its answer.
        wanted = wanted or [(tree, 0, block.column("place")[0].as_py())]
        trees, heights, places = zip(*wanted)
        n = len(wanted)
        arrays = [pa.array(trees, pa.int64()), pa.array(heights, pa.int32()), pa.array(places, pa.int64())]
        arrays += [pa.array([tree] * n, pa.int64()), pa.array([of_block] * n, pa.int64())]
        return pa.table(arrays, ["tree", "level", "place", "of_tree", "of_block"])

    return step


def _derive(known: dict[tuple[int, int], str], held: Iterable[int], size: int) -> tuple[list[int], str]:
    """Fill in the shared inner nodes level by level; the sizes of the levels and the root."""
    places, level, sizes = sorted(set(held)), 0, [size]
    while size > 1:
        places = sorted({p // FAN for p in places})
        for p in places:
            known[level + 1, p] = _digest(known[level, q] for q in range(FAN * p, min(FAN * p + FAN, size)))
        level, size = level + 1, _at_level(size, 1)
        sizes.append(size)
    return sizes, known[level, 0]


def _path(known: dict[tuple[int, int], str], sizes: list[int], place: int, start: int = 0) -> list[dict[str, str]]:
    """What stands before and after the node of a leaf in its run, level by level from ``start``."""
    path = []
    for level in range(start, len(sizes) - 1):
        first = place // FAN * FAN
        path.append(
            {
                "before": "".join(known[level, p] for p in range(first, place)),
                "after": "".join(known[level, p] for p in range(place + 1, min(first + FAN, sizes[level]))),
            }
        )
        place //= FAN
    return path


def _expanded(groups: int, root: str, carried: pa.Schema):
    def step(leaves: pa.Table, fetched: pa.Table) -> pa.Table:
        tree, size = leaves.column("tree")[0].as_py(), leaves.column("size")[0].as_py()
        own: dict[tuple[int, int], str] = {}
        upper: dict[tuple[int, int], str] = {}
        columns = [fetched.column(c).to_pylist() for c in ("tree", "level", "place", "digest")]
        for of, level, place, digest in zip(*columns):
            (upper if of == TOP else own)[level, place] = digest
        places = leaves.column("place").to_pylist()
        own.update(((0, p), d) for p, d in zip(places, leaves.column("digest").to_pylist()))
        sizes, subroot = _derive(own, places, size)
        upper[0, tree] = subroot
        top_sizes, derived = _derive(upper, [tree], groups)
        if derived != root:
            raise ValueError(f"nodes of tree {tree} do not lead to the root")
        above = _path(upper, top_sizes, tree)
        shared: dict[int, list[dict[str, str]]] = {}
        proofs = []
        for p in places:
            run = p // FAN
            if run not in shared:
                shared[run] = _path(own, sizes, run, 1) + above if size > 1 else above
            proofs.append((_path(own, sizes[:2], p) if size > 1 else []) + shared[run])
        arrays = [leaves.column(c) for c in carried.names]
        n = len(proofs)
        return pa.table(
            [*arrays, leaves.column("digest"), pa.array([subroot] * n), pa.array([root] * n), pa.array(proofs, SIDES)],
            [*carried.names, "leaf", "subroot", "root", "proof"],
        )

    return step


def folded(digest: Column, proof: Column) -> Column:
    """The root that a leaf and the nodes beside its way up lead to."""
    step = lambda acc, p: F.sha2(F.encode(F.concat(p["before"], acc, p["after"]), "utf-8"), 256)
    return F.aggregate(proof, digest, step)


def manifest(
    rows: DataFrame,
    leaf_of: Column,
    group: str = "source",
    order: str = "doc_id",
    carry: Sequence[tuple[str, Column]] = (),
    levels: int = LEVELS,
) -> DataFrame:
    """(order, carried columns, leaf, subroot, root, proof) of every row; proof: array of (before, after) from leaf to root."""
    carried = [(order, F.col(order)), *carry]
    inputs = rows.select(F.col(group).alias("tree_key"), F.col(order).alias("order_key"), leaf_of.alias("digest"), *[c.alias(f"x_{n}") for n, c in carried])
    placed = numbered(inputs, ["tree_key"], ["order_key", "digest"], "leaves")
    sizes = placed.groupBy("tree_key").agg(F.first("size").alias("size"))
    trees = numbered(sizes.withColumn("all", F.lit(0)).withColumnRenamed("size", "leaves"), ["all"], ["tree_key"], "trees")
    trees = common.stored(trees.select(F.col("tree_key").alias("of_key"), F.col("place").alias("tree"), F.col("size").alias("groups")), "trees")
    joined = placed.join(trees, F.col("tree_key").eqNullSafe(F.col("of_key"))).drop("tree_key", "order_key", "of_key", "groups")
    leaves = common.stored(joined.withColumn("level", F.lit(0)), "leaves")
    node = ["tree", "level", "place", "digest", "size"]
    inner = grow(leaves.select(*node), levels)
    groups = (trees.agg(F.max("groups")).first()[0]) or 0
    subroots = tops(leaves, inner).select(F.lit(TOP).cast("bigint").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("place"), "digest", F.lit(groups).cast("bigint").alias("size"))
    subroots = common.stored(subroots, "subroots")
    upper = grow(subroots, levels)
    root = tops(subroots, upper).first()
    root = root["digest"] if root else ""
    names = [f"x_{n}" for n, _ in carried]

    block = F.expr(f"place div {FAN**levels}").alias("of_block")
    asked = common.stored(leaves.select(*node).groupBy("tree", block).applyInArrow(_wanted(groups, levels), COORDINATES), "coordinates")
    known = inner.unionByName(subroots).unionByName(upper).select("tree", "level", "place", "digest")
    if not asked.filter("level = 0 AND tree >= 0").isEmpty():
        known = known.unionByName(leaves.select("tree", "level", "place", "digest"))
    answers = common.stored(asked.join(known, ["tree", "level", "place"]), "answers")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in leaves.select(*names).schema.fields)
    schema = f"{kinds}, leaf string, subroot string, root string, proof array<struct<before: string, after: string>>"
    order_of = pa.schema([(n, pa.null()) for n in names])
    proved = (
        leaves.groupBy("tree", block)
        .cogroup(answers.groupBy("of_tree", "of_block"))
        .applyInArrow(_expanded(groups, root, order_of), schema)
    )
    return proved.select(*[F.col(f"x_{n}").alias(n) for n, _ in carried], "leaf", "subroot", "root", "proof")


# ---------------------------------------------------------------- the query


def check(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The manifest of documents, and for every row whether a version that may have lost its line breaks still proves."""
    fields = {c: F.col(c) for c in COLUMNS}
    odd = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 != 0, F.lit(True))
    cut = F.when(odd | ~F.contains("text", F.lit("\n")) | F.col("text").isNull(), F.lit(None).cast("string")).otherwise(
        leaf([*[fields[c] for c in COLUMNS[:-1]], F.replace("text", F.lit("\n"), F.lit(""))])
    )
    made = manifest(docs, leaf(list(fields.values())), carry=[("tampered", cut)], levels=levels)
    digests = F.array_join(F.transform("proof", lambda p: F.concat(p["before"], p["after"])), "")
    root = folded(F.coalesce("tampered", "leaf"), F.col("proof"))
    return made.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.encode(digests, "utf-8"), 256).alias("proof_sha256"), root.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _crc32_sql(text: str) -> str:
    """crc32 of a text of ASCII characters, bit by bit."""
    bits = "list_reduce([xor(c, b), 1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[], lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))"
    letters = f"list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295]::BIGINT[], {letters}), lambda c, b: {bits}), 4294967295)"


def _oracle(levels: int = 13, top_levels: int = 6) -> str:
    def field(c: str) -> str:
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"

    plain = " || ".join(map(field, COLUMNS))
    fields = " || ".join(field(c) for c in COLUMNS[:-1])
    parts = [
        f"""rows AS MATERIALIZED (SELECT doc_id, source, sha256({plain}) AS leaf,
CASE WHEN {_crc32_sql("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN sha256({fields} || {field("replace(text, chr(10), '')")}) ELSE sha256({plain}) END AS tampered FROM documents)""",
        """ranked AS MATERIALIZED (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY source) AS n FROM rows)""",
        "t0 AS MATERIALIZED (SELECT tree, place, n, leaf AS d FROM ranked)",
        "f0 AS MATERIALIZED (SELECT doc_id, leaf, tree, place, tampered AS up, '' AS proof FROM ranked)",
    ]

    def climb(k: int) -> None:
        run = f"PARTITION BY tree, place // {FAN} ORDER BY place ROWS BETWEEN"
        parts.append(
            f"""p{k} AS MATERIALIZED (SELECT tree, place, n, coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a FROM t{k})"""
        )
        parts.append(
            f"""t{k + 1} AS MATERIALIZED (SELECT tree, place // {FAN} AS place, CAST(ceil(n / {FAN}) AS BIGINT) AS n,
CASE WHEN n > 1 THEN sha256(string_agg(d, '' ORDER BY place)) ELSE min(d) END AS d FROM t{k} GROUP BY tree, place // {FAN}, n)"""
        )
        parts.append(
            f"""f{k + 1} AS MATERIALIZED (SELECT f.* REPLACE (f.place // {FAN} AS place, proof || b || a AS proof,
CASE WHEN n > 1 THEN sha256(b || up || a) ELSE up END AS up) FROM f{k} f JOIN p{k} p ON f.tree = p.tree AND f.place = p.place)"""
        )

    for k in range(levels):
        climb(k)
    after = levels + 1
    parts.append(f"t{after} AS MATERIALIZED (SELECT 0 AS tree, tree AS place, count(*) OVER () AS n, d FROM t{levels})")
    parts.append(f"f{after} AS MATERIALIZED (SELECT f.* REPLACE (0 AS tree, f.tree AS place), d AS subroot FROM f{levels} f JOIN t{levels} t USING (tree))")
    for k in range(after, after + top_levels):
        climb(k)
    last = after + top_levels
    return f"""WITH {", ".join(parts)}
SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, up AS folded_root, up = d AS verified FROM f{last} CROSS JOIN t{last}"""


ORACLE = _oracle()
