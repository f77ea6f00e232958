"""Quality rules: fixed base rules, then robust multivariate outliers by minimum covariance determinant.

Words are runs of bytes other than space and 0x09-0x0D; the statistics cover whole texts. Rows that pass the base rules
get four transformed statistics: log mean word length and the square roots of the shares of symbols, repeated lines and
repeated words. For each language and source a minimum-covariance-determinant estimate is fitted to all its rows: from
medians and quartile ranges, concentration steps keep the three quarters of rows that are nearest and take their mean
and covariance again until the determinant stands still; one reweighting follows. Rows beyond the cut by squared
Mahalanobis distance are rejected.

Every step is a grouped sum or quantile over a stored table of numbers, so a group may hold any share of the rows. Each
covariance gets a small fixed variance added, since a share may be zero in nearly all rows. Groups of fewer than
``MIN_ROWS`` rows are pooled within their language, and pools that are still small over all languages; a pool
smaller than that is judged by the estimate of all rows, unless these are fewer too. A null language or source is a group like any other. Null or empty texts have no
words and fail the base rules. Repeated rows count as often as they occur. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lockgate.llm import common

SYMBOLS = b"#*$%&|<>"
NAMES = ["log_word_length", "symbol_share", "dup_line_share", "repeat_share"]
P = len(NAMES)
#: Standard deviations added to each transformed statistic.
FLOORS = [0.03, 0.05, 0.05, 0.10]
MIN_ROWS = 50
SALTS = 16
#: The pool of what is small in its language too.
LAST = "{}"
KEEP = 0.75
MAX_STEPS = 8
#: Squared distance that one clean row in some 10^6 exceeds if the transformed statistics are normal.
CUT = 33.4

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
COUNTS = [c.split()[0] for c in BASE.split(", ")]


def repeated_words(ids: np.ndarray) -> int:
    """Words inside 3-word windows that the text holds twice or more."""
    found = common.windows(ids, 3)
    if not len(found):
        return 0
    _, where, times = np.unique(found, return_inverse=True, return_counts=True)
    start = np.concatenate([times[where] > 1, [False, False]])
    again = start.copy()
    again[1:] |= start[:-1]
    again[2:] |= start[:-2]
    return int(again.sum())


def text_statistics(text: bytes, ids: common.WordIds) -> tuple[int, int, int, int, int]:
    words = text.split()
    chars = sum(map(len, words))
    if not text.isascii():
        chars -= len(text.translate(None, delete=_STARTS))
    symbols = len(text) - len(text.translate(None, delete=SYMBOLS))
    dup, seen = 0, set()
    if b"\n" in text:
        for line in text.split(b"\n"):
            if line in seen:
                dup += 1
            elif line.split():
                seen.add(line)
    return len(words), chars, symbols, dup, repeated_words(ids.of(words))


#: Bytes that are not the continuation of a code point.
_STARTS = bytes(b for b in range(256) if b & 0xC0 != 0x80)


def _statistics(rows: common.Batches) -> common.Batches:
    ids = common.WordIds()
    for batch in common.slices(rows):
        found = [text_statistics(t, ids) for t in common.texts(batch.column(batch.num_columns - 1))]
        columns = list(zip(*found)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *[pa.array(c, pa.int64()) for c in columns]], [*batch.schema.names[:-1], *COUNTS])


def base_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, rid, lang, source, the five counts and ``base_failed``."""
    rows = docs.select(F.col("doc_id").cast("long"), common.row_key(docs).alias("rid"), F.col("lang").cast("string"), F.col("source").cast("string"), "text")
    rows = common.mapped(rows, _statistics, f"doc_id long, rid long, lang string, source string, {BASE}")
    return rows.withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))


_FEATURES = {
    "f0": "ln(word_chars / n_words)",
    "f1": "sqrt(n_symbols / n_words)",
    "f2": "sqrt(n_dup_lines / n_words)",
    "f3": "sqrt(n_repeat_words / n_words)",
}


def _chi2_even(x: float, dof: int) -> float:
    """Distribution function of chi square with an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(dof // 2))


def _chi2_quantile(q: float, dof: int) -> float:
    low, high = 0.0, 200.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi2_even(middle, dof) < q else (low, middle)
    return high


def consistency(share: float) -> float:
    """What the covariance of the nearest ``share`` of normal rows is multiplied with to be that of all."""
    return share / _chi2_even(_chi2_quantile(share, P), P + 2)


def _grouped(rows: DataFrame) -> DataFrame:
    """With ``pool``: 0 for a group by itself, 1 pooled in the language, 2 over all; ``g`` names the group."""
    per = rows.groupBy("lang", "source").count()
    small = per.filter(F.col("count") < MIN_ROWS)
    lang = small.groupBy("lang").agg(F.sum("count").alias("pooled"))
    level = per.join(lang.withColumnRenamed("lang", "l"), F.col("lang").eqNullSafe(F.col("l")), "left").select(
        F.col("lang").alias("gl"),
        F.col("source").alias("gs"),
        F.expr(f"CASE WHEN count >= {MIN_ROWS} THEN 0 WHEN pooled >= {MIN_ROWS} THEN 1 ELSE 2 END").alias("pool"),
    )
    named = F.expr(f"CASE pool WHEN 0 THEN to_json(struct(0 AS p, gl, gs)) WHEN 1 THEN to_json(struct(1 AS p, gl)) ELSE '{LAST}' END")
    level = common.stored(level.withColumn("g", named), "groups")
    return rows.join(level, F.col("lang").eqNullSafe(F.col("gl")) & F.col("source").eqNullSafe(F.col("gs"))).drop("gl", "gs", "pool")


def _invert(batches: common.Batches) -> common.Batches:
    """Mean, inverse covariance and log determinant from the sums of a group."""
    for batch in batches:
        rows = batch.to_pylist()
        out = []
        for r in rows:
            n, mean = r["n"], np.array(r["s"]) / r["n"]
            cov = np.zeros((P, P))
            cov[np.triu_indices(P)] = np.array(r["ss"]) / n
            cov = cov + np.triu(cov, 1).T - np.outer(mean, mean)
            cov = (cov + cov.T) / 2 * r["factor"] + np.diag(np.square(FLOORS))
            out.append((r["g"], mean.tolist(), np.linalg.inv(cov).reshape(-1).tolist(), float(np.linalg.slogdet(cov)[1]), int(r["all_n"])))
        columns = list(zip(*out)) or [[]] * 5
        kinds = [pa.string(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["g", "mean", "inverse", "log_det", "all_n"])


_MODEL = "g string, mean array<double>, inverse array<double>, log_det double, all_n long"
_D2 = " + ".join(f"(f{i} - mean[{i}]) * (f{j} - mean[{j}]) * inverse[{i * P + j}]" for i in range(P) for j in range(P))


def salted(rows: DataFrame) -> DataFrame:
    """Rows dealt to ``SALTS`` parts of their group, so that the join of a group that holds most rows is no single task."""
    return rows.withColumn("salt", F.monotonically_increasing_id() % SALTS)


def _of_group(rows: DataFrame, values: DataFrame, how: str = "left") -> DataFrame:
    """Salted ``rows`` with the one row that ``values`` has for their group, which is repeated for every part."""
    parts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")))
    spread = values.withColumnRenamed("g", "mg").withColumn("msalt", parts)
    return rows.join(spread, F.expr("g = mg AND salt = msalt"), how).drop("mg", "msalt")


def _with_distance(rows: DataFrame, model: DataFrame) -> DataFrame:
    return _of_group(rows, model).withColumn("d2", F.expr(_D2))


def _model(chosen: DataFrame, factor: float) -> DataFrame:
    """Estimates of each group from the rows with ``inside``; ``all_n`` counts all of the group."""
    value = {f"f{i}": F.when(F.col("inside"), F.col(f"f{i}")) for i in range(P)}
    pairs = [(i, j) for i in range(P) for j in range(i, P)]
    sums = chosen.groupBy("g").agg(
        F.count_if("inside").alias("n"),
        F.count("*").alias("all_n"),
        F.array(*[F.sum(value[f"f{i}"]) for i in range(P)]).alias("s"),
        F.array(*[F.sum(value[f"f{i}"] * F.col(f"f{j}")) for i, j in pairs]).alias("ss"),
    )
    return common.stored(common.mapped(sums.filter("n > 0").withColumn("factor", F.lit(factor)), _invert, _MODEL), "mcd")


def fit(rows: DataFrame) -> DataFrame:
    """Reweighted estimates for each group ``g`` of ``rows`` (g, f0, f1, ...)."""
    rows = salted(rows)
    quartiles = rows.groupBy("g").agg(
        F.count("*").alias("all_n"), *[F.percentile_approx(f"f{i}", [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i in range(P)]
    )
    spread = [f"(pow((q{i}[2] - q{i}[0]) / 1.349, 2) + {FLOORS[i] ** 2})" for i in range(P)]
    start = quartiles.select(
        "g",
        F.array(*[F.col(f"q{i}")[1] for i in range(P)]).alias("mean"),
        F.expr("array(" + ", ".join(f"1 / {spread[i]}" if i == j else "0D" for i in range(P) for j in range(P)) + ")").alias("inverse"),
        F.expr(" + ".join(f"ln({s})" for s in spread)).alias("log_det"),
        "all_n",
    )
    model = common.stored(start, "mcd")
    for _ in range(MAX_STEPS):
        near = _with_distance(rows, model)
        bound = near.groupBy("g").agg(F.percentile_approx("d2", KEEP, 1000).alias("bound"))
        chosen = _of_group(near, bound, "inner").withColumn("inside", F.expr("d2 <= bound"))
        better = _model(chosen, consistency(KEEP))
        moved = better.alias("a").join(model.alias("b"), "g").agg(F.max(F.abs(F.col("a.log_det") - F.col("b.log_det")))).first()[0]
        model = better
        if moved is None or moved < 1e-3:
            break
    inside = _with_distance(rows, model).withColumn("inside", F.expr(f"d2 <= {_chi2_quantile(0.975, P)}"))
    return _model(inside, consistency(0.975))


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: the counts, ``base_failed``, ``distance`` (null if not measured), ``kept`` and the row key ``rid``."""
    rows = common.stored(base_statistics(docs), "statistics")
    passed = rows.filter("NOT base_failed").withColumns({k: F.expr(e) for k, e in _FEATURES.items()})
    passed = _grouped(passed)
    vectors = common.stored(passed.select("g", *_FEATURES), "vectors")
    if 0 < vectors.filter(f"g = '{LAST}'").count() < MIN_ROWS:
        vectors = vectors.union(vectors.filter(f"g != '{LAST}'").withColumn("g", F.lit(LAST)))
    model = fit(vectors)
    judged = _with_distance(salted(passed), model.drop("log_det")).withColumn("kept", F.expr(f"all_n < {MIN_ROWS} OR d2 <= {CUT}"))
    columns = ["doc_id", "rid", *COUNTS, "base_failed"]
    failed = rows.filter("base_failed").select(*columns, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance"))
    return judged.select(*columns, F.coalesce("kept", F.lit(True)).alias("kept"), F.sqrt("d2").alias("distance")).unionByName(failed)
