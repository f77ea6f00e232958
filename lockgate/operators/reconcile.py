"""Compare a source with its target.

Every comparison stacks the two sides with a side flag and aggregates, instead of joining them: one
shuffle, combined on the map side, so a key or value that holds a third of all rows reaches the reducer
as one partial row per task. Nothing is collected, sampled by row order or cut short.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lockgate import constants as K
from lockgate import schemas
from lockgate.functions import exactsum, hashing
from lockgate.functions.exactsum import tick
from lockgate.sources import scratch
from lockgate.sources.tables import frame, union_all

SIDE = "_is_src"


def _stack(src: DataFrame, tgt: DataFrame) -> DataFrame:
    return src.withColumn(SIDE, F.lit(True)).unionByName(tgt.withColumn(SIDE, F.lit(False)), allowMissingColumns=True)


def _on_src(value: Column) -> Column:
    return F.when(F.col(SIDE), value)


def _on_tgt(value: Column) -> Column:
    return F.when(~F.col(SIDE), value)


def _rows_per_side() -> list[Column]:
    return [F.count_if(F.col(SIDE)).alias("n_src"), F.count_if(~F.col(SIDE)).alias("n_tgt")]


# ---------------------------------------------------------------- schema


def normalized_type(data_type: Column) -> Column:
    plain = F.lower(F.replace(data_type, F.lit(" "), F.lit("")))
    aliases = F.create_map(*[F.lit(x) for pair in K.TYPE_ALIASES.items() for x in pair])
    return F.coalesce(F.try_element_at(aliases, plain), plain)


def schema_diff(src_columns: DataFrame, tgt_columns: DataFrame) -> DataFrame:
    """One row per table out of two column profiles (table_name, column_name, ordinal, data_type).

    The lists hold columns of one table, so their size is bounded by the width of a table.
    """
    per_column = (
        _stack(src_columns, tgt_columns)
        .groupBy("table_name", "column_name")
        .agg(
            F.max(_on_src(F.col("ordinal"))).alias("src_ordinal"),
            F.max(_on_tgt(F.col("ordinal"))).alias("tgt_ordinal"),
            F.max(_on_src(F.col("data_type"))).alias("src_type"),
            F.max(_on_tgt(F.col("data_type"))).alias("tgt_type"),
        )
    )
    differs = normalized_type(F.col("src_type")) != normalized_type(F.col("tgt_type"))
    entry = F.struct("column_name", "src_ordinal", "tgt_ordinal", "src_type", "tgt_type", differs.alias("differs"))

    def kept(condition: str, result: str) -> str:
        return f"array_sort(transform(filter(cols, c -> {condition}), c -> {result}))"

    def ordered(ordinal: str) -> str:
        common = kept("c.src_ordinal IS NOT NULL AND c.tgt_ordinal IS NOT NULL", f"struct(c.{ordinal}, c.column_name)")
        return f"transform({common}, c -> c.column_name)"

    drift = "struct(c.column_name, concat('src=', c.src_type, ' / tgt=', c.tgt_type))"
    per_table = per_column.groupBy("table_name").agg(F.collect_list(entry).alias("cols")).selectExpr(
        "table_name",
        "CAST(size(filter(cols, c -> c.src_ordinal IS NOT NULL)) AS BIGINT) AS num_cols_src",
        "CAST(size(filter(cols, c -> c.tgt_ordinal IS NOT NULL)) AS BIGINT) AS num_cols_tgt",
        f"{kept('c.tgt_ordinal IS NULL', 'c.column_name')} AS missing_cols",
        f"{kept('c.src_ordinal IS NULL', 'c.column_name')} AS extra_cols",
        f"map_from_entries({kept('c.differs', drift)}) AS type_mismatches",
        f"{ordered('src_ordinal')} <> {ordered('tgt_ordinal')} AS order_mismatch",
    )
    issues = (
        (F.size("missing_cols") > 0) | (F.size("extra_cols") > 0) | (F.size("type_mismatches") > 0) | F.col("order_mismatch")
    )
    error = F.when(F.col("num_cols_src") == 0, "source not found").when(F.col("num_cols_tgt") == 0, "target not found")
    return per_table.withColumn("error_message", error).withColumn(
        "status",
        F.when(F.col("error_message").isNotNull(), "ERROR").when(issues, "MISMATCH").otherwise("OK"),
    )


# ---------------------------------------------------------------- counts


@dataclass
class Pair:
    """A source and its target. A side may be a function, which is called when the check is built."""

    name: str
    src: DataFrame | Callable[[], DataFrame]
    tgt: DataFrame | Callable[[], DataFrame]


def with_count_status(df: DataFrame, tolerance_pct: float = 0.0) -> DataFrame:
    """Difference and status for columns n_src and n_tgt (NULL or negative: the side failed).

    An empty source with a filled target is a mismatch.
    """
    s, t = F.col("n_src"), F.col("n_tgt")
    failed = s.isNull() | t.isNull() | (s < 0) | (t < 0)
    share = F.when(s > 0, F.abs(s - t) / s * 100).when(t == 0, 0.0).otherwise(100.0)
    within = F.when(s > 0, share <= tolerance_pct).otherwise(t == 0)
    minus = F.lit(-1).cast("bigint")
    return df.select(
        "*",
        F.when(failed, minus).otherwise(F.abs(s - t)).alias("diff"),
        F.when(failed, -1.0).otherwise(F.round(share, 6)).alias("diff_pct"),
        F.when(failed, "ERROR").when(within, "OK").otherwise("COUNT_MISMATCH").alias("status"),
    )


def counts(
    spark: SparkSession, pairs: Sequence[Pair], tolerance_pct: float = 0.0, isolate: bool = False, max_parallel: int = 4
) -> DataFrame:
    """Row counts of all pairs in one job; each side is scanned once, reading no columns.

    ``isolate`` counts each side by a job of its own, so that a damaged file costs no more than its own pair.
    """
    empty = frame(spark, [], schemas.struct(f"table_name string, {SIDE} boolean, n bigint"))

    def side(pair: Pair, is_src: bool) -> DataFrame:
        df = pair.src if is_src else pair.tgt
        try:
            df = df() if callable(df) else df
            if isolate:
                return frame(spark, [(pair.name, is_src, df.count())], empty.schema)
        except Exception:  # noqa: BLE001 - an unreadable side is reported, the other pairs go on
            return frame(spark, [(pair.name, is_src, -1)], empty.schema)
        return df.agg(F.count("*").alias("n")).select(
            F.lit(pair.name).alias("table_name"), F.lit(is_src).alias(SIDE), "n"
        )

    with ThreadPoolExecutor(max_parallel if isolate else 1) as pool:
        sides = list(pool.map(lambda s: side(*s), [(p, is_src) for p in pairs for is_src in (True, False)]))
    rows = union_all([empty, *sides])
    per_table = rows.groupBy("table_name").agg(
        F.max(_on_src(F.col("n"))).alias("n_src"), F.max(_on_tgt(F.col("n"))).alias("n_tgt")
    )
    return with_count_status(per_table, tolerance_pct)


# ---------------------------------------------------------------- checksums


def numeric_columns(schema: T.StructType, limit: int | None = None) -> list[str]:
    """All numeric columns, by type; arrays or intervals of numbers are not numeric."""
    return [f.name for f in schema.fields if isinstance(f.dataType, T.NumericType)][:limit]


def _metric_aggregates(schema: T.StructType, columns: Sequence[str]) -> list[str]:
    aggregates = []
    for c in columns:
        value = tick(c)
        aggregates += exactsum.sum_parts(value, f"sum:{c}", schema[c].dataType)
        aggregates += [f"min({value}) AS {tick('min:' + c)}", f"max({value}) AS {tick('max:' + c)}"]
    return aggregates


def _agg(grouped: DataFrame | GroupedData, aggregates: Sequence[str]) -> DataFrame:
    return grouped.agg(*[F.expr(a) for a in aggregates])


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _long_metrics(schema: T.StructType, columns: Sequence[str]) -> str:
    """Wide aggregates as rows (column_name, metric, value, evidence); the text of a value is exact."""

    def entry(c: str, metric: str, value: str, evidence: str = "NULL") -> str:
        return f"struct({_literal(c)} AS column_name, '{metric}' AS metric, CAST({value} AS STRING) AS value, CAST({evidence} AS STRING) AS evidence)"

    entries = []
    for c in columns:
        kind = schema[c].dataType
        entries.append(entry(c, "sum", exactsum.total(f"sum:{c}", kind), exactsum.evidence(f"sum:{c}", kind)))
        entries += [entry(c, m, tick(f"{m}:{c}")) for m in ("min", "max")]
    return f"inline(array({', '.join(entries)}))"


def checksums(src: DataFrame, tgt: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """SUM, MIN and MAX of each numeric source column on both sides, one scan per side.

    A column the target lacks, or holds with another type, shows as a mismatch. A sum is OK only if the number of values
    and the sum of their hashes agree too, so values that the sum leaves out or rounds away still count.
    """
    columns = list(columns or numeric_columns(src.schema))
    schema = schemas.struct("column_name string, metric string, value string, evidence string")
    sides = []
    for df in (src, tgt):
        present = [c for c in columns if c in df.columns and isinstance(df.schema[c].dataType, T.NumericType)]
        if not present:
            sides.append(frame(df.sparkSession, [], schema))
            continue
        sides.append(_agg(df, _metric_aggregates(df.schema, present)).selectExpr(_long_metrics(df.schema, present)))
    both = _stack(*sides).groupBy("column_name", "metric").agg(
        *[F.max(side(F.col(c))).alias(f"{name}_{c}") for c in ("value", "evidence") for name, side in (("src", _on_src), ("tgt", _on_tgt))]
    )
    return both.withColumn("status", F.when(_agree(), "OK").otherwise("CHECKSUM_MISMATCH")).drop("src_evidence", "tgt_evidence")


def _agree() -> Column:
    same_value = F.col("src_value").eqNullSafe(F.col("tgt_value"))
    return same_value & F.col("src_evidence").eqNullSafe(F.col("tgt_evidence"))


# ---------------------------------------------------------------- partitions


def partitions(src: DataFrame, tgt: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per partition value on both sides: OK, MISSING, EXTRA or DIFFERENT."""
    both = _stack(src.select(*keys), tgt.select(*keys)).groupBy(*keys).agg(*_rows_per_side())
    s, t = F.col("n_src"), F.col("n_tgt")
    return both.withColumn(
        "status", F.when(s == t, "OK").when(t == 0, "MISSING").when(s == 0, "EXTRA").otherwise("DIFFERENT")
    )


# ---------------------------------------------------------------- hashes


def hashed(df: DataFrame, key: Sequence[str], columns: Sequence[str], hash_kind: str) -> DataFrame:
    """Key columns, row hash and key hash (without a key the row hash serves as both)."""
    row = hashing.row_hash(df.schema, columns, hash_kind).alias("_row")
    place = hashing.row_hash(df.schema, list(key), hash_kind).alias("_place") if key else F.col("_row").alias("_place")
    return df.select(*key, row, place) if key else df.select(row).select("_row", place)


def fingerprint(
    df: DataFrame, buckets: int, key: Sequence[str] = (), columns: Sequence[str] | None = None, hash_kind: str = "fast"
) -> DataFrame:
    """(bucket, n_rows, fingerprint): order-free, the same for any partitioning, sensitive to duplicates."""
    rows = hashed(df, key, columns or df.columns, hash_kind)
    grouped = rows.groupBy(hashing.bucket("_place", buckets).alias("bucket"))
    summed = _agg(grouped, ["count(*) AS n_rows", *exactsum.lane_sums("_row", "hash")])
    return summed.selectExpr("bucket", "n_rows", f"{exactsum.lane_total('hash')} AS fingerprint")


def _aligned(src: DataFrame, tgt: DataFrame) -> DataFrame:
    """The target with the columns of the source; one that it lost is NULL, so rows that had a value there differ."""
    if all(c in tgt.columns for c in src.columns):
        return tgt
    present = {c.lower() for c in tgt.columns}
    return tgt.select(
        *[(F.col(tick(f.name)) if f.name.lower() in present else F.lit(None).cast(f.dataType)).alias(f.name) for f in src.schema.fields]
    )


def fingerprint_diff(
    src: DataFrame, tgt: DataFrame, buckets: int, key: Sequence[str] = (), hash_kind: str = "fast"
) -> DataFrame:
    """Fingerprints of both sides per bucket, with a status."""
    tgt = _aligned(src, tgt)
    both = _stack(
        fingerprint(src, buckets, key, src.columns, hash_kind), fingerprint(tgt, buckets, key, src.columns, hash_kind)
    )
    per_bucket = both.groupBy("bucket").agg(
        F.coalesce(F.max(_on_src(F.col("n_rows"))), F.lit(0)).alias("n_src"),
        F.coalesce(F.max(_on_tgt(F.col("n_rows"))), F.lit(0)).alias("n_tgt"),
        F.max(_on_src(F.col("fingerprint"))).alias("src_fingerprint"),
        F.max(_on_tgt(F.col("fingerprint"))).alias("tgt_fingerprint"),
    )
    same = (F.col("n_src") == F.col("n_tgt")) & F.col("src_fingerprint").eqNullSafe(F.col("tgt_fingerprint"))
    return per_bucket.withColumn("status", F.when(same, "OK").otherwise("DIFFERENT"))


def _only_suspect(rows: DataFrame, suspects: DataFrame, place: str, buckets: int) -> DataFrame:
    """Rows whose bucket differs. The broadcast side has at most ``buckets`` integers."""
    marked = rows.withColumn("bucket", hashing.bucket(place, buckets))
    return marked.join(F.broadcast(suspects), "bucket", "left_semi").drop("bucket")


def _suspects(src: DataFrame, tgt: DataFrame, buckets: int, key: Sequence[str], hash_kind: str) -> DataFrame:
    return fingerprint_diff(src, tgt, buckets, key, hash_kind).filter(F.col("status") != "OK").select("bucket")


def row_diff(
    src: DataFrame, tgt: DataFrame, key: Sequence[str], buckets: int | None = None, hash_kind: str = "fast"
) -> DataFrame:
    """Keys whose rows differ: ONLY_SOURCE, ONLY_TARGET or CHANGED, with the rows per side.

    Rows of one key are summed up before the shuffle, so repeated keys neither multiply nor pile up.
    With ``buckets`` a first pass compares fingerprints, and only keys of differing buckets are
    shuffled: two scans instead of one, but a nearly equal pair of large tables moves almost nothing.
    Columns of the source that the target lost count as NULL there.
    """
    tgt = _aligned(src, tgt)
    columns = src.columns
    rows = _stack(hashed(src, key, columns, hash_kind), hashed(tgt, key, columns, hash_kind))
    if buckets:
        rows = _only_suspect(rows, _suspects(src, tgt, buckets, key, hash_kind), "_place", buckets)
    balances = [
        f"sum(CASE WHEN {SIDE} THEN {lane} ELSE -({lane}) END) AS {tick(name)}"
        for lane, name in zip(exactsum.lanes("_row"), exactsum.lane_names("balance"))
    ]
    per_key = rows.groupBy(*key).agg(*_rows_per_side(), *[F.expr(b) for b in balances])
    s, t = F.col("n_src"), F.col("n_tgt")
    differs = s != t
    for name in exactsum.lane_names("balance"):
        differs = differs | (F.col(f"`{name}`") != 0)
    return (
        per_key.filter(differs)
        .withColumn("finding", F.when(t == 0, "ONLY_SOURCE").when(s == 0, "ONLY_TARGET").otherwise("CHANGED"))
        .select(*key, "n_src", "n_tgt", "finding")
    )


def sampled_hash(
    src: DataFrame, tgt: DataFrame, key: Sequence[str], fraction: float = 0.01, hash_kind: str = "fast"
) -> DataFrame:
    """Row diff over the keys whose hash falls into the sample, the same keys on both sides.

    The keys are chosen before any row is hashed; fraction 1 compares all rows.
    """

    def sampled(df: DataFrame) -> DataFrame:
        return df.filter(hashing.in_sample(hashing.row_hash(df.schema, list(key), hash_kind), fraction))

    return row_diff(sampled(src), sampled(tgt), key, hash_kind=hash_kind)


def smallest_place(df: DataFrame, key: Sequence[str], k: int, hash_kind: str = "fast") -> int | None:
    """The k-th smallest hash of a key of the table, the largest one if it has fewer keys, None if it has none.

    Only hashes below a bound are looked at. The bound starts where a few times k keys are expected and grows until k
    are below it, so nearly all rows stay where they are, and the answer is exact at any size.
    """
    places = df.select(hashing.row_hash(df.schema, list(key), hash_kind).alias("place"))
    low = -(1 << 63) if hash_kind == "fast" else 0
    width = (1 << 64) if hash_kind == "fast" else (1 << 60)
    rows = df.count()
    share = 4 * k / rows if rows else 1.0
    while True:
        bound = F.lit(min(low + round(share * width), (1 << 63) - 1)) if share < 1 else None
        near = places if bound is None else places.filter(F.col("place") <= bound)
        first = near.distinct().orderBy("place").limit(k)
        found = first.agg(F.count("*"), F.max("place")).first()
        if found[0] == k or bound is None:
            return found[1]
        share *= 16


def sample_k(src: DataFrame, tgt: DataFrame, key: Sequence[str], k: int, hash_kind: str = "fast") -> DataFrame:
    """Row diff over the k keys of the source with the smallest hashes: a sample of exact size, the same on every side.

    The target is compared wherever its keys hash into the same range, so keys that only the target has show up too.
    """
    last = smallest_place(src, key, k, hash_kind)
    if last is None:
        last = smallest_place(tgt, key, k, hash_kind)
    if last is None:
        return row_diff(src, tgt, key, hash_kind=hash_kind)

    def sampled(df: DataFrame) -> DataFrame:
        return df.filter(hashing.row_hash(df.schema, list(key), hash_kind) <= F.lit(last))

    return row_diff(sampled(src), sampled(tgt), key, hash_kind=hash_kind)


def multiset_diff(src: DataFrame, tgt: DataFrame, buckets: int | None = None, hash_kind: str = "fast") -> DataFrame:
    """Rows that occur a different number of times, for tables without a key (both EXCEPT ALLs at once)."""
    columns, tgt = src.columns, _aligned(src, tgt)

    def comparable(df: DataFrame) -> DataFrame:
        maps = [f.name for f in df.schema.fields if isinstance(f.dataType, T.MapType)]
        return df.select(*columns).withColumns({m: F.to_json(F.array_sort(F.map_entries(m))) for m in maps})

    src, tgt = comparable(src), comparable(tgt)
    rows = _stack(src, tgt)
    if buckets:
        place = hashing.HASHES[hash_kind](src.schema, columns)
        rows = _only_suspect(rows, _suspects(src, tgt, buckets, (), hash_kind), place, buckets)
    return rows.groupBy(*columns).agg(*_rows_per_side()).filter("n_src <> n_tgt")


# ---------------------------------------------------------------- one pass


def one_pass(
    src: DataFrame,
    tgt: DataFrame,
    partition_by: Sequence[str] = (),
    buckets: int = 16,
    key: Sequence[str] = (),
    hash_kind: str = "fast",
) -> DataFrame:
    """Count, checksums, partition counts and bucket fingerprints with one scan per side.

    The heavy step groups each side by (partition values, bucket) and stores these cells at once. The table, the
    partitions and the buckets are three roll-ups of the stored cells, each reading only the columns it reports, so
    many partitions times many buckets cost one wide pass. Rows: (scope, item, metric, src_value, tgt_value, status).
    Columns that only one side has are rows of scope ``column``; hashes cover the columns of both sides.
    """
    hashed = [c for c in src.columns if c in tgt.columns]
    if not hashed:
        raise ValueError("source and target have no column in common")
    columns = numeric_columns(src.schema)
    shared = [c for c in columns if c in tgt.columns and isinstance(tgt.schema[c].dataType, T.NumericType)]

    def cells(df: DataFrame) -> DataFrame:
        row = hashing.row_hash(df.schema, hashed, hash_kind)
        place = hashing.HASHES[hash_kind](df.schema, key) if key else "_row"
        needed = [F.col(tick(c)) for c in dict.fromkeys([*partition_by, *shared])]
        rows = df.select("*", row.alias("_row")).select(*needed, "_row", hashing.bucket(place, buckets).alias("_bucket"))
        aggregates = ["count(*) AS rows", *exactsum.lane_sums("_row", "hash"), *_metric_aggregates(df.schema, shared)]
        item = f"to_json(struct({', '.join(map(tick, partition_by))}))" if partition_by else "CAST(NULL AS STRING)"
        return _agg(rows.groupBy(*partition_by, "_bucket"), aggregates).withColumn("_item", F.expr(item)).drop(*partition_by)

    stacked = _stack(cells(src), cells(tgt))
    # stored under plain names, as the names of the parts hold characters that not every reader takes
    plain = stacked.toDF(*[f"c{i}" for i in range(len(stacked.columns))])
    kept = scratch.materialize(plain, "cells").toDF(*stacked.columns)

    kinds = {c: (src.schema[c].dataType, tgt.schema[c].dataType) for c in shared}
    metrics = {}
    for c, both in kinds.items():
        metrics |= {n: exactsum.merge_function(n) for kind in both for n in exactsum.part_names(f"sum:{c}", kind)}
        metrics |= {f"min:{c}": "min", f"max:{c}": "max"}

    def merged(parts: dict[str, str]) -> list[str]:
        return [
            f"{function}(CASE WHEN {condition} THEN {tick(name)} END) AS {tick(f'{side}|{name}')}"
            for name, function in parts.items()
            for side, condition in (("src", SIDE), ("tgt", f"NOT {SIDE}"))
        ]

    def entry(metric: str, src_value: str, tgt_value: str, src_evidence: str = "NULL", tgt_evidence: str = "NULL") -> str:
        given = {"src_value": src_value, "tgt_value": tgt_value, "src_evidence": src_evidence, "tgt_evidence": tgt_evidence}
        values = ", ".join(f"CAST({v} AS STRING) AS {n}" for n, v in given.items())
        return f"struct({_literal(metric)} AS metric, {values})"

    def found(scope: str, item: str, totals: DataFrame, entries: list[str]) -> DataFrame:
        return totals.selectExpr(f"'{scope}' AS scope", f"{item} AS item", f"inline(array({', '.join(entries)}))")

    def per(scope: str, item: str, parts: dict[str, str], entries: list[str]) -> DataFrame:
        return found(scope, "item", _agg(kept.groupBy(F.expr(item).alias("item")), merged(parts)), entries)

    # a side without rows has no cells and still counts 0
    entries = [entry("rows", "coalesce(`src|rows`, 0)", "coalesce(`tgt|rows`, 0)")]
    for c, (src_kind, tgt_kind) in kinds.items():
        sides = ((src_kind, "src|"), (tgt_kind, "tgt|"))
        sums = [f(f"sum:{c}", kind, prefix) for f in (exactsum.total, exactsum.evidence) for kind, prefix in sides]
        entries.append(entry(f"sum({c})", *sums))
        entries += [entry(f"{m}({c})", tick(f"src|{m}:{c}"), tick(f"tgt|{m}:{c}")) for m in ("min", "max")]
    report = found("table", "'all'", _agg(kept, merged({"rows": "sum", **metrics})), entries)
    lanes = {n: "sum" for n in exactsum.lane_names("hash")}
    fingerprint = entry("fingerprint", *[exactsum.lane_total("hash", side) for side in ("src|", "tgt|")])
    report = report.unionByName(per("bucket", "CAST(_bucket AS STRING)", lanes, [fingerprint]))
    if partition_by:
        report = report.unionByName(per("partition", "_item", {"rows": "sum"}, [entry("rows", "`src|rows`", "`tgt|rows`")]))
    report = report.withColumn("status", F.when(_agree(), "OK").otherwise("MISMATCH")).drop("src_evidence", "tgt_evidence")
    one_sided = [(c, "present", None) for c in src.columns if c not in tgt.columns]
    one_sided += [(c, None, "present") for c in tgt.columns if c not in src.columns]
    if not one_sided:
        return report
    rows = [("column", c, "present", s, t, "MISMATCH") for c, s, t in one_sided]
    return report.unionByName(frame(src.sparkSession, rows, report.schema))


# ---------------------------------------------------------------- completeness


def unmigrated(inv: DataFrame, log: DataFrame) -> DataFrame:
    """Objects without a successful copy in the log (src_table = database.table)."""
    done = log.filter(F.col("status") == "SUCCESS").select("src_table").distinct()
    named = inv.withColumn("src_table", F.concat_ws(".", "database_name", "table_name"))
    return named.join(done, "src_table", "left_anti").select("src_table", "object_type", "data_provider", "is_delta")
