"""Name rules as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lockgate import constants as K


def name_check(name: Column) -> Column:
    """OK, INVALID_EMPTY, INVALID_CHARS: <name> or INVALID_TOO_LONG, checked in that order."""
    return (
        F.when(F.coalesce(name, F.lit("")) == "", "INVALID_EMPTY")
        .when(~name.rlike(r"\A[a-zA-Z0-9_]+\z"), F.concat(F.lit("INVALID_CHARS: "), name))
        .when(F.length(name) > K.MAX_NAME, "INVALID_TOO_LONG")
        .otherwise("OK")
    )


def reserved_check(name: Column) -> Column:
    hit = F.coalesce(F.lower(name).isin(K.RESERVED_WORDS), F.lit(False))
    return F.when(hit, F.concat(F.lit("RESERVED_WORD: "), name)).otherwise("OK")


def sanitize(name: Column) -> Column:
    """Letters, digits and underscores only, no leading digit, lower case; '' becomes NULL."""
    clean = F.regexp_replace(name, "[^a-zA-Z0-9_]", "_")
    prefixed = F.when(clean.rlike(r"\A[0-9]"), F.concat(F.lit("_"), clean)).otherwise(clean)
    return F.lower(F.nullif(prefixed, F.lit("")))


def storage_root(path: Column) -> Column:
    """The bucket, container directory or mount a path lies in; any other path is its own root."""
    roots = (F.nullif(F.regexp_extract(path, pattern, 1), F.lit("")) for pattern in K.STORAGE_ROOTS)
    return F.coalesce(*roots, path)


def location_name(path: Column) -> Column:
    squeezed = reduce(
        lambda c, rule: F.regexp_replace(c, *rule),
        [("[^a-zA-Z0-9_]", "_"), ("_+", "_"), (r"\A_|_\z", "")],
        path,
    )
    name = F.lower(squeezed)
    # A cut name ends in a hash of the path, so that two long paths keep two names.
    return F.when(F.length(name) > K.MAX_LOCATION_NAME, hashed_name(name, path)).otherwise(name)


def hashed_name(name: Column, path: Column) -> Column:
    """The name, cut if need be, with a hash of its path at the end."""
    return F.concat(F.substring(name, 1, K.MAX_LOCATION_NAME - 17), F.lit("_"), F.substring(F.sha2(path, 256), 1, 16))


def dotted(*parts: Column) -> Column:
    return F.concat_ws(".", *parts)


def quoted(*parts: Column) -> Column:
    """`a`.`b`.`c`; NULL if a part is NULL."""
    ticked = [F.concat(F.lit("`"), p, F.lit("`")) for p in parts]
    return reduce(lambda a, b: F.concat(a, F.lit("."), b), ticked)
