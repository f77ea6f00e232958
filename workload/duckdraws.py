"""The draws of synthetic columns written as SQL, to recompute generated tables in another engine."""

from __future__ import annotations

import datetime as dt
import re

from lockgate.functions import draws as D
from lockgate.functions.draws import PRIME, STATE, stream


def with_state(inner: str, key: str = "id", seed: int = 42) -> str:
    """Two lanes, each twice a linear step and a fifth power modulo its prime."""
    last = f"SELECT *, (CAST({key} AS BIGINT) + {seed}) % {PRIME} AS x, (CAST({key} AS BIGINT) + {seed}) % {D.PRIME_2} AS z FROM ({inner})"
    for factor, offset in ((D.MIX_1, D.ADD_1), (D.MIX_2, D.ADD_2)):
        for lane, prime in (("x", PRIME), ("z", D.PRIME_2)):
            last = f"SELECT * REPLACE (({lane} * {factor} + {offset}) % {prime} AS {lane}) FROM ({last})"
            fifth = f"({lane} * {lane} % {prime}) * ({lane} * {lane} % {prime}) % {prime} * {lane} % {prime}"
            last = f"SELECT * REPLACE ({fifth} AS {lane}) FROM ({last})"
    return f"SELECT * EXCLUDE (x, z), x AS {STATE}, z AS {D.STATE_2} FROM ({last})"


def text(word: str | None) -> str:
    return "NULL" if word is None else f"'{word}'"


def period(day: str) -> str:
    return f"(year({day}) * 100 + month({day}))"


class DuckDraws:
    def __init__(self, table: str):
        self.table = table

    def raw(self, column: str, step: str | None = None) -> str:
        offset = stream(self.table, column)
        moved = f"{offset}" + (f" + {step} * {D.STEP_FACTOR}" if step else "")
        y, z = f"(({STATE} + {moved}) % {PRIME})", f"(({D.STATE_2} + {moved}) % {D.PRIME_2})"
        return f"({y} * {y} % {PRIME} * {D.COLUMN_FACTOR} + {z} * {z} % {D.PRIME_2}) % {PRIME}"

    def below(self, column: str, n: int, step: str | None = None) -> str:
        if n <= PRIME // 16:
            return f"({self.raw(column, step)}) % {n}"
        return f"(({self.raw(column, step)}) * {D.WIDEN} + ({self.raw(column + '+', step)}) % {D.WIDEN}) % {n}"

    def randint(self, column: str, low: int, high: int, step: str | None = None) -> str:
        return f"({self.below(column, high - low + 1, step)} + ({low}))"

    def choice(self, column: str, words: list) -> str:
        return f"([{', '.join(text(w) for w in words)}])[{self.below(column, len(words))} + 1]"

    def choice_int(self, column: str, numbers: list[int]) -> str:
        return f"CAST(([{', '.join(map(str, numbers))}])[{self.below(column, len(numbers))} + 1] AS BIGINT)"

    def money(self, column: str, low: float, high: float, step: str | None = None) -> str:
        return f"CAST({self.randint(column, round(low * 100), round(high * 100), step)} AS DOUBLE) / CAST(100 AS DOUBLE)"

    def flag(self, column: str, probability: float) -> str:
        return f"({self.below(column, 100_000)} < {round(probability * 100_000)})"

    def days_back(self, column: str, as_of: dt.date, most: int, least: int = 0) -> str:
        return f"(DATE '{as_of}' - CAST({self.randint(column, least, most)} AS INTEGER))"

    def between(self, column: str, start: str, as_of: dt.date) -> str:
        span = f"(greatest(DATE '{as_of}' - {start}, 0) + 1)"
        return f"({start} + CAST({self.raw(column)} % {span} AS INTEGER))"

    def maybe(self, column: str, value: str, null_probability: float) -> str:
        return f"CASE WHEN NOT {self.flag(column + '?', null_probability)} THEN {value} END"

    def pattern(self, column: str, shape: str) -> str:
        parts = []
        for i, run in enumerate(re.findall(r"#{1,6}|\?{1,6}|[^#?]+", shape)):
            width = len(run)
            if run[0] == "#":
                parts.append(f"lpad(CAST({self.below(f'{column}/{i}', 10**width)} AS VARCHAR), {width}, '0')")
            elif run[0] == "?":
                number = self.below(f"{column}/{i}", 26**width)
                parts += [f"chr(CAST(({number}) // {26**p} % 26 + 65 AS INTEGER))" for p in range(width)]
            else:
                parts.append(text(run))
        return " || ".join(parts)


def cpf(base: str) -> str:
    """Person number by the sum of position times digit, 9 base digits."""
    digits = [f"CAST(substr(b, {i + 1}, 1) AS INTEGER)" for i in range(9)]
    d1 = "(" + " + ".join(f"{10 - i} * {x}" for i, x in enumerate(digits)) + ") * 10 % 11 % 10"
    d2 = "(" + " + ".join(f"{11 - i} * {x}" for i, x in enumerate(digits)) + " + 2 * d1) * 10 % 11 % 10"
    shown = "substr(b, 1, 3) || '.' || substr(b, 4, 3) || '.' || substr(b, 7, 3) || '-' || d1 || d2"
    return (
        f"(SELECT {shown} FROM (SELECT b, d1, {d2} AS d2 FROM (SELECT b, {d1} AS d1 "
        f"FROM (SELECT lpad(CAST({base} AS VARCHAR), 9, '0') AS b))))"
    )


def cnpj(base: str) -> str:
    """Company number: weights run 2..9 from the right and start again."""

    def total(n: int) -> str:
        return " + ".join(f"{(n - 1 - i) % 8 + 2} * CAST(substr(b, {i + 1}, 1) AS INTEGER)" for i in range(n))

    d1 = f"CASE WHEN ({total(12)}) % 11 < 2 THEN 0 ELSE 11 - ({total(12)}) % 11 END"
    d2 = f"CASE WHEN ({total(13)}) % 11 < 2 THEN 0 ELSE 11 - ({total(13)}) % 11 END"
    shown = "substr(b, 1, 2) || '.' || substr(b, 3, 3) || '.' || substr(b, 6, 3) || '/' || substr(b, 9, 4) || '-' || substr(b, 13, 1) || d2"
    return (
        f"(SELECT {shown} FROM (SELECT b, {d2} AS d2 FROM (SELECT b || ({d1}) AS b "
        f"FROM (SELECT lpad(CAST({base} AS VARCHAR), 12, '0') AS b))))"
    )
