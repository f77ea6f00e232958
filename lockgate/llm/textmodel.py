"""Words and punctuation runs of a text as features of small classifiers, and bounded samples of labelled rows."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKENS = re.compile(rb"[0-9A-Za-z\x80-\xFF]+|[!-/:-@\[-`{-~]+")
#: Shape features: log of the length, share of distinct words, symbols and capitals, each cut into so many steps.
STEPS = 12


def shape(text: bytes, tokens: list[bytes], distinct: set[bytes]) -> list[bytes]:
    """Features that begin with a blank, which no token does."""
    n = max(1, len(tokens))
    letters = max(1, len(text))
    upper = letters - len(text.translate(None, delete=b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")) if text else 0
    return [
        b" length %d" % min(STEPS, int(math.log2(n))),
        b" distinct %d" % int(STEPS * len(distinct) / n),
        b" longest %d" % min(STEPS, max(map(len, distinct), default=0) // 4),
        b" upper %d" % int(STEPS * upper / letters),
    ]


def features(text: bytes) -> set[bytes]:
    tokens = TOKENS.findall(text)
    distinct = set(tokens)
    return distinct | set(shape(text, tokens, distinct))


def sample(docs: DataFrame, labels: DataFrame, classes: dict[str, Column], rows_each: int) -> list[tuple[str, bytes]]:
    """(class, whole text) of at most ``rows_each`` labelled documents of each class, by the order of a hash of the id.

    Labels that contradict each other for one id are left out, as are ids that are null. The ids are few, so joining
    them moves no documents.
    """
    kind = F.coalesce(*[F.when(condition, F.lit(name)) for name, condition in classes.items()])
    named = labels.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), kind.alias("kind")).filter("kind IS NOT NULL")
    named = named.groupBy("doc_id").agg(F.min("kind").alias("kind"), F.max("kind").alias("other")).filter("kind = other").drop("other")
    taken = None
    for name in classes:
        one = named.filter(F.col("kind") == name).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_each)
        taken = one if taken is None else taken.union(one)
    # at most rows_each * len(classes) rows
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(taken), "doc_id")
    rows = rows.groupBy("doc_id", "kind").agg(F.min("text").alias("text"))
    return [(r.kind, (r.text or "").encode()) for r in sorted(rows.collect(), key=lambda r: r.doc_id)]


def vocabulary(found: list[set[bytes]], kinds: list[str], size: int, least: int = 5) -> dict[bytes, int]:
    """At most ``size`` features that tell the classes apart best, by the chi-square statistic of their presence."""
    totals, by_class = Counter(kinds), {k: Counter() for k in set(kinds)}
    for tokens, kind in zip(found, kinds):
        by_class[kind].update(tokens)
    all_counts = sum(by_class.values(), Counter())
    n = len(found)

    def score(token: bytes) -> float:
        share = all_counts[token] / n
        return sum((by_class[k][token] - share * t) ** 2 / (share * t) for k, t in totals.items()) / max(1e-9, 1 - share) if share < 1 else 0.0

    kept = sorted((t for t, c in all_counts.items() if c >= least), key=lambda t: (-score(t), t))[:size]
    return {t: i for i, t in enumerate(kept)}


def presence(found: list[set[bytes]], words: dict[bytes, int]) -> np.ndarray:
    matrix = np.zeros((len(found), len(words)), np.float32)
    for row, tokens in zip(matrix, found):
        row[[words[t] for t in tokens if t in words]] = 1
    return matrix
