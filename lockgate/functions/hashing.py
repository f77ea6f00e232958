"""Row hashes that tell NULL from '' and do not depend on partitioning or row order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lockgate.functions.exactsum import tick

NULL_MARK = "N"
SAMPLE_STEPS = 1_000_000


def canonical(field: T.StructField) -> str:
    """SQL for one text per value. Free text carries its length, so that neighbouring columns cannot run together.

    Nested values go through JSON that keeps NULLs; maps at any depth are sorted by key first.
    """
    value, kind = tick(field.name), field.dataType
    if isinstance(kind, T.NumericType):
        text = f"CAST({value} AS STRING)"
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            text = f"CASE WHEN {value} = 0 THEN '0.0' ELSE {text} END"
        return f"coalesce({text}, '{NULL_MARK}')"
    if _nested(kind):
        text = f"to_json({_ordered(value, kind)}, map('ignoreNullFields', 'false'))"
    elif isinstance(kind, T.BinaryType):
        text = f"hex({value})"
    else:
        text = f"CAST({value} AS STRING)"
    return f"coalesce(concat(length({text}), ':', {text}), '{NULL_MARK}')"


def portable_row_hash(schema: T.StructType, columns: Sequence[str]) -> str:
    """First 60 bits of md5 as a bigint: use it when another engine must recompute the hash."""
    text = f"concat_ws('|', {', '.join(canonical(schema[c]) for c in columns)})"
    return f"CAST(conv(substring(md5({text}), 1, 15), 16, 10) AS BIGINT)"


def _nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.ArrayType, T.MapType, T.StructType))


def _ordered(value: str, kind: T.DataType, depth: int = 0) -> str:
    """The nested value with every map in it, at any depth, as entries in the order of their keys."""
    x = f"x{depth}"
    if isinstance(kind, T.ArrayType) and _nested(kind.elementType):
        return f"transform({value}, {x} -> {_ordered(x, kind.elementType, depth + 1)})"
    if isinstance(kind, T.StructType):
        fields = [f"'{_quoted(f.name)}', {_ordered(f'{value}.{tick(f.name)}', f.dataType, depth)}" for f in kind.fields]
        return f"if({value} IS NULL, NULL, named_struct({', '.join(fields)}))"
    if isinstance(kind, T.MapType):
        entry = f"struct({_ordered(f'{x}.key', kind.keyType, depth + 1)} AS key, {_ordered(f'{x}.value', kind.valueType, depth + 1)} AS value)"
        key = f"to_json(struct({_ordered('{0}.key', kind.keyType, depth + 1)} AS k))"
        order = f"(l{depth}, r{depth}) -> CASE WHEN {key.format(f'l{depth}')} < {key.format(f'r{depth}')} THEN -1 WHEN {key.format(f'l{depth}')} > {key.format(f'r{depth}')} THEN 1 ELSE 0 END"
        return f"transform(array_sort(map_entries({value}), {order}), {x} -> {entry})"
    return value


def _quoted(name: str) -> str:
    return name.replace("\\", "\\\\").replace("'", "\\'")


def fast_row_hash(schema: T.StructType, columns: Sequence[str]) -> str:
    """xxhash64, the default inside Spark. NULL flags are hashed too, as xxhash64 skips NULLs; nested values go as text that keeps theirs."""
    parts = []
    for name in columns:
        field = schema[name]
        parts += [canonical(field) if _nested(field.dataType) else tick(name), f"{tick(name)} IS NULL"]
    return f"xxhash64({', '.join(parts)})"


HASHES = {"fast": fast_row_hash, "portable": portable_row_hash}


def row_hash(schema: T.StructType, columns: Sequence[str], kind: str = "fast") -> Column:
    return F.expr(HASHES[kind](schema, columns))


def bucket(hash_value: str, buckets: int) -> Column:
    return F.expr(f"CAST(pmod({hash_value}, {buckets}) AS INT)")


def in_sample(key_hash: Column, fraction: float) -> Column:
    """True for the same keys on every side and every run; about ``fraction`` of them. A fraction below one step is refused."""
    if not 1 / SAMPLE_STEPS <= fraction <= 1:
        raise ValueError(f"the fraction must lie between {1 / SAMPLE_STEPS} and 1")
    return F.pmod(key_hash, F.lit(SAMPLE_STEPS)) < round(fraction * SAMPLE_STEPS)
