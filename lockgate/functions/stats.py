"""Row and byte counts out of statistics text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_stats(text: Column, failed: Column | None = None) -> tuple[Column, Column]:
    """(rows, bytes) of texts like '128 bytes, 7 rows': 0 where absent, -1 where the read failed."""

    def number(unit: str) -> Column:
        digits = F.nullif(F.regexp_extract(text, rf"(\d+) {unit}", 1), F.lit(""))
        value = F.coalesce(digits.cast("bigint"), F.lit(0).cast("bigint"))
        return value if failed is None else F.when(failed, F.lit(-1).cast("bigint")).otherwise(value)

    return number("rows"), number("bytes")
