"""Deterministic draws for synthetic data: pure functions of (seed, table, column, row key).

A row's values do not depend on partitioning, order or retries, and any row can be made alone.
Everything is 64-bit integer arithmetic inside generated code. A row's state has two lanes, the key modulo two primes, each
mixed by steps that are one-to-one modulo its prime (a linear step and a fifth power, as 5 divides neither prime less one).
So two keys below ``KEYS`` (about 2^62) never share a state, and rows do not repeat. A draw squares both lanes with the
offset of its column and adds them up.
"""

from __future__ import annotations

import datetime as dt
import re
import zlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The primes 2^31 - 1 and 2^31 - 19 and the multipliers and offsets of the mixing steps.
PRIME = 2_147_483_647
PRIME_2 = 2_147_483_629
MIX_1, ADD_1 = 48_271, 12_345
MIX_2, ADD_2 = 69_621, 54_321
COLUMN_FACTOR, STEP_FACTOR, WIDEN = 16_807, 1_000_003, 32_768
KEYS = PRIME * PRIME_2

STATE, STATE_2 = "_state", "_state_2"
LANES = ((STATE, PRIME), (STATE_2, PRIME_2))


def stream(table: str, column: str) -> int:
    return zlib.crc32(f"{table}.{column}".encode()) % PRIME


def with_state(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Add the row state for a bigint key that is unique per row and lies between 0 and ``KEYS`` less the seed."""

    def mixed(x: Column, prime: int, factor: int, offset: int) -> Column:
        y = (x * factor + offset) % prime
        square = y * y % prime
        return square * square % prime * y % prime

    shifted = F.col(key).cast("bigint") + seed
    df = df.withColumns({name: mixed(shifted % prime, prime, MIX_1, ADD_1) for name, prime in LANES})
    return df.withColumns({name: mixed(F.col(name), prime, MIX_2, ADD_2) for name, prime in LANES})


class Draws:
    """Draws for one table; every method takes the column name that keys its stream.

    The arithmetic is composed as SQL text and parsed once per column.
    """

    def __init__(self, table: str):
        self.table = table

    def raw_sql(self, column: str, step: str | None = None) -> str:
        """0 .. PRIME-1; ``step`` gives several draws per row."""
        offset = stream(self.table, column)
        moved = f" + CAST({step} AS BIGINT) * {STEP_FACTOR}" if step else ""
        y, z = (f"(({name} + {offset}{moved}) % {prime})" for name, prime in LANES)
        return f"(({y} * {y} % {PRIME} * {COLUMN_FACTOR} + {z} * {z} % {PRIME_2}) % {PRIME})"

    def below_sql(self, column: str, n: int, step: str | None = None) -> str:
        """0 .. n-1. Wide ranges take a second draw, as one has 31 bits only."""
        if n <= PRIME // 16:
            return f"({self.raw_sql(column, step)} % {n})"
        low = f"{self.raw_sql(column + '+', step)} % {WIDEN}"
        return f"(({self.raw_sql(column, step)} * {WIDEN} + {low}) % {n})"

    def randint_sql(self, column: str, low: int, high: int, step: str | None = None) -> str:
        return f"({self.below_sql(column, high - low + 1, step)} + ({low}))"

    def raw(self, column: str) -> Column:
        return F.expr(self.raw_sql(column))

    def below(self, column: str, n: int) -> Column:
        return F.expr(self.below_sql(column, n))

    def randint(self, column: str, low: int, high: int) -> Column:
        return F.expr(self.randint_sql(column, low, high))

    def _pick(self, column: str, literals: Sequence[str]) -> Column:
        place = f"CAST({self.below_sql(column, len(literals))} AS INT) + 1"
        return F.expr(f"element_at(array({', '.join(literals)}), {place})")

    def choice(self, column: str, values: Sequence[str | None]) -> Column:
        return self._pick(column, ["NULL" if v is None else f"'{v}'" for v in values])

    def choice_int(self, column: str, values: Sequence[int]) -> Column:
        return self._pick(column, [f"{v}L" for v in values])

    def money(self, column: str, low: float, high: float) -> Column:
        """Uniform with two decimals, drawn in whole cents."""
        return F.expr(f"{self.randint_sql(column, round(low * 100), round(high * 100))} / 100.0D")

    def flag(self, column: str, probability: float) -> Column:
        return F.expr(f"{self.below_sql(column, 100_000)} < {round(probability * 100_000)}")

    def days_back(self, column: str, as_of: dt.date, most: int, least: int = 0) -> Column:
        """A date from ``most`` to ``least`` days before ``as_of``; negative days lie after it."""
        return F.expr(f"date_sub(DATE'{as_of}', CAST({self.randint_sql(column, least, most)} AS INT))")

    def between(self, column: str, start: Column, as_of: dt.date) -> Column:
        """A date from ``start`` to ``as_of``."""
        span = F.greatest(F.datediff(F.lit(as_of), start), F.lit(0)) + 1
        return F.date_add(start, (self.raw(column) % span).cast("int"))

    def maybe(self, column: str, value: Column, null_probability: float) -> Column:
        return F.when(~self.flag(f"{column}?", null_probability), value)

    def pattern(self, column: str, text: str) -> Column:
        """'#' becomes a digit, '?' a capital letter; one draw per run of up to six."""
        parts = []
        for i, run in enumerate(re.findall(r"#{1,6}|\?{1,6}|[^#?]+", text)):
            width = len(run)
            if run[0] == "#":
                parts.append(f"lpad(CAST({self.below_sql(f'{column}/{i}', 10**width)} AS STRING), {width}, '0')")
            elif run[0] == "?":
                drawn = self.below_sql(f"{column}/{i}", 26**width)
                parts += [f"char({drawn} div {26**p} % 26 + 65)" for p in range(width)]
            else:
                parts.append(f"'{run}'")
        return F.expr(f"concat({', '.join(parts)})")


def period(date: Column) -> Column:
    """yyyyMM as a number."""
    return (F.year(date) * 100 + F.month(date)).cast("bigint")
