"""Sums without rounding, overflow or order effects, as fast as sums of longs.

A 64-bit value is cut into three lanes of 21, 21 and 22 bits that are summed as longs (safe up to 2^42
rows) and put together once per group. A decimal sum of the same values costs several times more.
Everything here is SQL text, as wide tables need many such expressions and text is parsed in one call.
"""

from __future__ import annotations

from pyspark.sql import types as T

LANE_BITS = 21
LANE = 1 << LANE_BITS
DOUBLE_SCALE = 6
DOUBLE_TYPE = f"DECIMAL(38,{DOUBLE_SCALE})"


def tick(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def lanes(value: str) -> list[str]:
    return [
        f"({value}) & {LANE - 1}",
        f"shiftright({value}, {LANE_BITS}) & {LANE - 1}",
        f"shiftright({value}, {2 * LANE_BITS})",
    ]


def lane_names(name: str) -> list[str]:
    return [f"{name}#{i}" for i in range(3)]


def lane_sums(value: str, name: str) -> list[str]:
    return [f"sum({lane}) AS {tick(n)}" for lane, n in zip(lanes(value), lane_names(name))]


def lane_total(name: str, prefix: str = "") -> str:
    """The sum as a decimal, from the columns ``lane_sums`` made."""
    low, middle, high = (f"CAST({tick(prefix + n)} AS DECIMAL(20,0))" for n in lane_names(name))
    step = f"CAST({LANE} AS DECIMAL(8,0))"
    return f"({low} + ({middle} + {high} * {step}) * {step})"


def part_names(name: str, kind: T.DataType) -> list[str]:
    if isinstance(kind, T.IntegralType):
        return [*lane_names(name), f"{name}#seen"]
    sums = [f"{name}#"] if isinstance(kind, T.DecimalType) else [*lane_names(name), f"{name}#wide"]
    return [*sums, f"{name}#seen", *lane_names(f"{name}~")]


def sum_parts(value: str, name: str, kind: T.DataType) -> list[str]:
    """Aggregates that together hold the exact sum of a numeric column, and the evidence that goes with it.

    Floating values are taken at six decimals; those too large for a scaled long go to a decimal sum.
    """
    seen = _evidence_parts(value, name, kind)
    if isinstance(kind, T.DecimalType):
        return [f"try_sum({value}) AS {tick(name + '#')}", *seen]
    if isinstance(kind, T.IntegralType):
        return [*lane_sums(f"CAST({value} AS BIGINT)", name), *seen]
    scaled = f"try_cast(rint(CAST({value} AS DOUBLE) * {10**DOUBLE_SCALE}) AS BIGINT)"
    wide = f"CASE WHEN {scaled} IS NULL THEN try_cast({value} AS {DOUBLE_TYPE}) END"
    return [*lane_sums(scaled, name), f"try_sum({wide}) AS {tick(name + '#wide')}", *seen]


def _evidence_parts(value: str, name: str, kind: T.DataType) -> list[str]:
    seen = f"count({value}) AS {tick(name + '#seen')}"
    if isinstance(kind, T.IntegralType):
        return [seen]
    same = f"CAST({value} AS STRING)" if isinstance(kind, T.DecimalType) else f"CASE WHEN {value} = 0 THEN 0D ELSE CAST({value} AS DOUBLE) END"
    return [seen, *lane_sums(f"CASE WHEN {value} IS NOT NULL THEN xxhash64({same}) END", f"{name}~")]


def evidence(name: str, kind: T.DataType, prefix: str = "") -> str:
    """What must agree besides the sum: how many values there are and, unless they are whole numbers, the sum of their hashes.

    A sum leaves out NaN, infinities and what overflows, and rounds; the evidence covers every value exactly.
    """
    seen = f"CAST({tick(f'{prefix}{name}#seen')} AS STRING)"
    if isinstance(kind, T.IntegralType):
        return seen
    return f"concat_ws('/', {seen}, CAST({lane_total(f'{name}~', prefix)} AS STRING))"


def merge_function(part: str) -> str:
    """How the parts of groups are merged into parts of larger groups."""
    return "try_sum" if part.endswith(("#", "#wide")) else "sum"


def total(name: str, kind: T.DataType, prefix: str = "") -> str:
    if isinstance(kind, T.DecimalType):
        return tick(f"{prefix}{name}#")
    if isinstance(kind, T.IntegralType):
        return lane_total(name, prefix)
    unit = f"CAST({1 / 10**DOUBLE_SCALE:.{DOUBLE_SCALE}f} AS DECIMAL({DOUBLE_SCALE},{DOUBLE_SCALE}))"
    narrow = f"CAST({lane_total(name, prefix)} * {unit} AS {DOUBLE_TYPE})"
    wide = tick(f"{prefix}{name}#wide")
    return f"CASE WHEN {wide} IS NULL THEN {narrow} ELSE {wide} + coalesce({narrow}, 0) END"
