"""View text: body, references and the statement that recreates a view."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lockgate.functions.names import quoted

# What counts as the start of the body, and as a `db`.`table` pair.
BODY = r"(?is)\bAS\b\s*(.*)"
TICKED_PAIR = r"`([^`]+)`\.`([^`]+)`"

# A two-part reference with no dotted neighbour: `db`.`table` or db.table. Three-part names never match,
# which makes the rewrite idempotent.
REFERENCE = (
    r"(?<!\.)`[^`]+`\.`[^`]+`(?!\.)"
    r"|(?<![.`\w])[a-zA-Z_]\w*\.[a-zA-Z_]\w*(?![.`\w])"
)
AFTER_FROM_OR_JOIN = r"(?i)\b(from|join)\s+\z"


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"\A\s+|\s+\z", "")


def view_body(ddl: Column) -> Column:
    """The text after the first word AS, trimmed; the whole text where there is none."""
    return F.when(ddl.rlike(BODY), trimmed(F.regexp_extract(ddl, BODY, 1))).otherwise(ddl)


def pairs(text: Column) -> Column:
    """Every `db`.`table` pair as an array of (db, table)."""
    return F.transform(
        F.regexp_extract_all(text, F.lit(TICKED_PAIR), F.lit(0)),
        lambda hit: F.struct(
            F.regexp_extract(hit, TICKED_PAIR, 1).alias("db"),
            F.regexp_extract(hit, TICKED_PAIR, 2).alias("tbl"),
        ),
    )


def create_view(catalog: Column, schema: Column, view: Column, body: Column) -> Column:
    return F.concat(F.lit("CREATE OR REPLACE VIEW "), quoted(catalog, schema, view), F.lit("\nAS\n"), body)
