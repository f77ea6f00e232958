"""Periodic runs of words by multi-scale minimizers.

A run is a stretch of consecutive words that repeats with a smallest period q (words q apart are identical), is at least
``max(LEAST, POWER * q)`` words long and cannot be extended by a neighbouring word with the same period.

Words become numbers that are equal exactly where the words are. Ranks of 1, 2, 4 ... consecutive words are made by
doubling, so equal k-grams are known exactly, without a hash. A scale covers the periods in (low, k]:

* Inside a run a k-gram of at least one period occurs at multiples of the period only, and any two windows of k-grams one
  period apart hold the same k-grams. So their minima (the leftmost of the smallest, in a fixed pseudo-random order) lie
  exactly one period apart.
* Window minima with equal k-grams that follow each other at a distance of the scale are therefore the seeds of all runs
  of these periods. Each is extended to both sides while words one period apart agree.
* A seed is itself a repetition with at least two periods, so a text has few of them, however long it is.

Periods up to ``LEAST / POWER`` are too short for that and are found by one direct scan a lag. A text without two equal
``SHORT``-grams has no run and a scale without two equal k-grams no seed, so most texts cost three sorts.

A text is one row of one task; nothing is shuffled. Null and empty texts have no words, no runs and an empty collapsed
text. Repeated rows are judged each for itself, ties of the strongest run go to the smallest start, then period. Columns
other than the key and the text pass or go as the caller asks; their names do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lockgate.llm import common

LEAST = 24
POWER = 3
SHORT = LEAST // POWER
GROWTH = 1.5
SCHEMA = "runs array<struct<start: bigint, length: bigint, period: bigint>>, n_words bigint, collapsed string"
Run = tuple[int, int, int]


def ranked(words: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def _paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One number a pair of ranks, equal exactly where both are; ranks stay below 2^32."""
    return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)


def _dense(names: np.ndarray) -> tuple[np.ndarray, int]:
    known, ranks = np.unique(names, return_inverse=True)
    return ranks, len(known)


def _doubled(ranks: np.ndarray, size: int) -> np.ndarray:
    """Names of the stretches of ``2 * size`` words from those of ``size``."""
    return _paired(ranks[:-size], ranks[size:])


def _scales(words: int) -> list[tuple[int, int]]:
    """(low, k) of each scale: periods above low, up to k."""
    found, low = [], SHORT
    while low < words // POWER:
        k = int(low * GROWTH)
        found.append((low, k))
        low = k
    return found


def _minima(order: np.ndarray, width: int) -> np.ndarray:
    """Places of the leftmost minimum of each window of ``width``, each once."""
    n = len(order) - width + 1
    if n < 1:
        return np.empty(0, np.int64)
    best = np.arange(len(order))
    have = 1
    while have < width:
        step = min(have, width - have)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(order[right] < order[left], right, left)
        have += step
    return np.unique(best[:n])


def _agreeing(ids: np.ndarray, at: int, period: int, forward: bool) -> int:
    """How many places on from ``at`` (or back before it) hold the same word one period later, in growing steps."""
    found, step = 0, 64
    while True:
        if forward:
            low = at + found
            high = min(low + step, len(ids) - period)
        else:
            high = at - found
            low = max(0, high - step)
        if low >= high:
            return found
        differs = np.flatnonzero(ids[low:high] != ids[low + period : high + period])
        if len(differs):
            return found + int(differs[0] if forward else high - low - 1 - differs[-1])
        found += high - low
        step *= 2


def _primitive(ids: np.ndarray, start: int, length: int, period: int) -> bool:
    """Whether no smaller period divides this one; a stretch of two periods or more has no other smaller one."""
    stretch, rest, factor = ids[start : start + length], period, 2
    while rest > 1:
        if factor * factor > rest:
            factor = rest
        if rest % factor:
            factor += 1
            continue
        while rest % factor == 0:
            rest //= factor
        lag = period // factor
        if np.array_equal(stretch[:-lag], stretch[lag:]):
            return False
    return True


def _kept(ids: np.ndarray, start: int, length: int, period: int) -> bool:
    return length >= max(LEAST, POWER * period) and _primitive(ids, start, length, period)


def _by_lag(ids: np.ndarray, period: int) -> list[Run]:
    """Runs of one period, by comparing every word with the one a period later."""
    same = np.zeros(len(ids) - period + 2, np.int8)
    same[1:-1] = ids[:-period] == ids[period:]
    edges = np.flatnonzero(np.diff(same))
    starts, lengths = edges[::2], edges[1::2] - edges[::2] + period
    return [(int(s), int(n), period) for s, n in zip(starts, lengths) if _kept(ids, int(s), int(n), period)]


def _by_minimizers(ids: np.ndarray, names: np.ndarray, low: int, k: int) -> list[Run]:
    """Runs with a period in (low, k]; ``names`` tells k-grams apart."""
    places = _minima(common.mix(names), 2 * (low + 1) - k + 1)
    found: list[Run] = []
    ordered = places[np.lexsort((places, names[places]))]
    gaps = np.diff(ordered)
    near = np.flatnonzero((names[ordered[1:]] == names[ordered[:-1]]) & (gaps > low) & (gaps <= k))
    seeds = sorted((int(gaps[i]), int(ordered[i])) for i in near)
    done, until = 0, -1
    for period, at in seeds:
        if period == done and at < until:
            continue
        start = at - _agreeing(ids, at, period, False)
        length = at - start + _agreeing(ids, at, period, True) + period
        done, until = period, start + length - period
        if _kept(ids, start, length, period):
            found.append((start, length, period))
    return found


def runs(ids: np.ndarray) -> list[Run]:
    """All runs (start, length, period) of a sequence of word numbers, by start, then period."""
    n = len(ids)
    if n < LEAST:
        return []
    # Every run holds two equal SHORT-grams one period apart.
    ranks, size, level = {1: ids}, 1, ids
    while size < SHORT:
        level, known = _dense(_doubled(level, size))
        size *= 2
        ranks[size] = level
    if known == len(level):
        return []
    found = [r for q in range(1, SHORT + 1) for r in _by_lag(ids, q)]
    for low, k in _scales(n):
        while 2 * size <= k and known < len(level):
            level, known = _dense(_doubled(level, size))
            size *= 2
            ranks[size] = level
        if known == len(level):
            break  # no two equal k-grams at this scale or any longer one
        found += _by_minimizers(ids, _paired(level[: n - k + 1], level[k - size : n - size + 1]), low, k)
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept_words(words: list[bytes], found: list[Run]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not found:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return [w for w, over in zip(words, np.cumsum(change[:-1])) if not over]


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, runs, n_words, collapsed) of every row: all runs by start and period, and the text without their repeats."""
    kind = docs.schema[key].dataType.simpleString()

    def step(rows: common.Batches) -> common.Batches:
        for batch in common.slices(rows):
            spans, sizes, collapsed = [], [], []
            for whole in common.texts(batch.column(1)):
                words = whole.split()
                found = runs(ranked(words))
                spans.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                sizes.append(len(words))
                collapsed.append(b" ".join(kept_words(words, found)).decode())
            kinds = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
            arrays = [batch.column(0), pa.array(spans, kinds), pa.array(sizes, pa.int64()), pa.array(collapsed, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, [key, "runs", "n_words", "collapsed"])

    return common.mapped(docs.select(F.col(key), F.col(text)), step, f"{key} {kind}, {SCHEMA}")


# ---------------------------------------------------------------- the query


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where every tenth text, by crc32 of its id, goes on periodically from a word chosen by the id."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"))
    words = chosen.select(
        "doc_id", "text", "h", "g", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("w")
    )
    cut = words.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    sized = cut.withColumn("p", F.expr("1 + floor((n - a) / (3 + g % 8))"))
    moved = F.expr("transform(sequence(0L, n - 1L), i -> element_at(w, int(if(i < a, i, a + (i - a) % p)) + 1))")
    text = F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), F.array_join(moved, " ")).otherwise(F.col("text"))
    return sized.select("doc_id", text.alias("text"))


def _strongest() -> Column:
    """The run with the greatest length by period; among equals the first, as runs are ordered by start and period."""
    better = "(best, r) -> if(best IS NULL OR r.length * best.period > best.length * r.period, r, best)"
    kind = "struct<start: bigint, length: bigint, period: bigint>"
    return F.expr(f"aggregate(runs, CAST(NULL AS {kind}), {better})")


def digest(found: DataFrame) -> DataFrame:
    """The runs of each text in numbers and digests."""
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    best = found.withColumn("best", _strongest())
    return best.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.encode(listed, "utf-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "utf-8"), 256).alias("collapsed_sha256"),
        "n_words",
    )
