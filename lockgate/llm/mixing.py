"""Mixing a corpus to target weights with soft domain membership.

A softmax classifier, trained on a bounded sample of labelled documents, gives each document a posterior over the domains.
Its expected tokens of domain k are its words times the posterior. Rates r >= 0 (at most ``max_rate``) are fitted by
projected gradient on the generalised least squares of A r = T, where A holds the expected tokens and T the targets:

    r <- clip(r - p W (A r - T) / N),  W = (M + RIDGE)^-1,  M = sum of n p p^T / N,

which is the gradient in the norm weighted by words. Its Lipschitz constant is below 1, so the step is 1; the ridge keeps a
domain that the corpus hardly has, and whose target is out of reach, from outweighing the others. Only the K errors of each round leave the executors. The rate of a document follows from its own posterior and the list of
gradients, so a round is one scan of a stored table of a few numbers a row, and a lost task recomputes its rows alone.

Texts that are null or empty have no tokens; their posterior is that of no features and they weigh nothing. Null ids and
repeated rows are rows like any other. Without labels of at least two domains the posterior is that of the
first domain. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lockgate.llm import common, textmodel

DOMAINS = {"good": "quality = 1 AND toxic = 0", "poor": "quality = 0 AND toxic = 0", "toxic": "toxic = 1"}
TARGETS = {"good": 0.98, "poor": 0.01, "toxic": 0.01}
ROWS_EACH = 1500
VOCABULARY = 2000
ROUNDS = 40
SMALL = 1e-4
RIDGE = 0.1


@dataclass
class Model:
    names: list[str]
    words: dict[bytes, int]
    weights: np.ndarray  # features x domains
    bias: np.ndarray

    def posteriors(self, texts: list[bytes]) -> np.ndarray:
        logits = np.tile(self.bias, (len(texts), 1))
        get = self.words.get
        for i, text in enumerate(texts):
            found = [k for k in map(get, textmodel.features(text)) if k is not None]
            logits[i] += self.weights[found].sum(0)
        e = np.exp(logits - logits.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)


def train(docs: DataFrame, labels: DataFrame, domains: dict[str, str], rows_each: int = ROWS_EACH) -> Model:
    """Softmax regression with ridge, by accelerated gradient steps, on at most ``rows_each`` labelled rows a domain."""
    names = list(domains)
    conditions = {k: F.expr(v) for k, v in domains.items()}
    rows = textmodel.sample(docs, labels, conditions, rows_each)
    shares = labels.select(*[F.count_if(c).alias(k) for k, c in conditions.items()]).first()
    found, kinds = [textmodel.features(t) for _, t in rows], [k for k, _ in rows]
    if len(set(kinds)) < 2:
        return Model(names, {}, np.zeros((0, len(names))), np.array([0.0] + [-30.0] * (len(names) - 1)))
    words = textmodel.vocabulary(found, kinds, VOCABULARY)
    x = textmodel.presence(found, words)
    y = np.eye(len(names), dtype=np.float32)[[names.index(k) for k in kinds]]
    w, b = np.zeros((x.shape[1], len(names)), np.float32), np.zeros(len(names), np.float32)
    vw, vb, step = w.copy(), b.copy(), 4.0 / max(1.0, float((x**2).sum(1).mean()))
    for turn in range(300):
        logits = x @ vw + vb
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        error = (p - y) / len(x)
        new_w, new_b = vw - step * (x.T @ error + 1e-4 * vw), vb - step * error.sum(0)
        pull = turn / (turn + 3)
        vw, vb, w, b = new_w + pull * (new_w - w), new_b + pull * (new_b - b), new_w, new_b
    drawn, true = y.sum(0) + 0.5, np.array([shares[k] or 0 for k in names]) + 0.5
    return Model(names, words, w.astype(float), b + np.log(true / true.sum()) - np.log(drawn / drawn.sum()))


def _memberships(shared, names: list[str]):
    def step(rows: common.Batches) -> common.Batches:
        model = shared.value
        for batch in common.slices(rows):
            texts = common.texts(batch.column(2))
            p = model.posteriors(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(t.split()) for t in texts], pa.int64()), *[pa.array(p[:, k]) for k in range(p.shape[1])]],
                ["doc_id", "rid", "n_tokens", *names],
            )

    return step


def _rates(p: np.ndarray, gradients: list[np.ndarray], max_rate: float) -> np.ndarray:
    rate = np.ones(len(p))
    for g in gradients:
        rate = np.clip(rate - p @ g, 0, max_rate)
    return rate


def _matrix(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.stack([batch.column(batch.schema.get_field_index(n)).to_numpy() for n in names], 1)


def fit(rows: DataFrame, names: list[str], targets: np.ndarray, max_rate: float, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The gradients of all rounds. ``rows``: n_tokens and one column ``p_<domain>`` for each domain."""
    k, columns = len(names), [f"p_{n}" for n in names]
    sums = rows.agg(
        F.sum("n_tokens").cast("double"),
        *[F.sum(F.col("n_tokens") * F.col(a) * F.col(b)) for a in columns for b in columns],
    ).first()
    total = sums[0] or 0.0
    if not total:
        return []
    inverse = np.linalg.inv(np.array(sums[1:], float).reshape(k, k) / total + RIDGE * np.eye(k))
    gradients: list[np.ndarray] = []

    def step(batches: common.Batches) -> common.Batches:
        for batch in batches:
            p, n = _matrix(batch, columns), batch.column(batch.schema.get_field_index("n_tokens")).to_numpy()
            got = (p * (n * _rates(p, gradients, max_rate))[:, None]).sum(0)
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in got], columns)

    before = None
    for _ in range(rounds):
        got = common.mapped(rows, step, ", ".join(f"{c} double" for c in columns)).agg(*[F.sum(c) for c in columns]).first()
        error = np.array([v or 0.0 for v in got]) / total - targets
        size = float(np.sqrt(error @ inverse @ error))
        if size < SMALL or before is not None and abs(before - size) < 1e-3 * size:
            break
        before = size
        gradients.append(inverse @ error)
    return gradients


def reached(rated: DataFrame, names: list[str], targets: dict[str, float]) -> DataFrame:
    """(domain, target, expected_share, drawn_share): the shares of tokens that the rates and the drawn copies give each domain.

    The rounds of ``fit`` end when the error is small or falls no more; targets that no rates can meet show here.
    """
    parts = [
        F.struct(F.lit(n).alias("domain"), F.lit(float(targets[n])).alias("target"), *[
            F.try_divide(F.sum(F.col("n_tokens") * F.col(by) * F.col(f"p_{n}")), F.sum(F.col("n_tokens") * F.col(by))).alias(f"{word}_share")
            for by, word in (("rate", "expected"), ("n_copies", "drawn"))
        ])
        for n in names
    ]
    return rated.agg(F.array(*parts).alias("all")).select(F.inline("all"))


def mix(
    docs: DataFrame,
    labels: DataFrame,
    domains: dict[str, str] = DOMAINS,
    targets: dict[str, float] = TARGETS,
    max_rate: float = 1.0,
    rows_each: int = ROWS_EACH,
    seed: int = 11,
) -> DataFrame:
    """doc_id, rid, n_tokens, the posteriors ``p_<domain>``, ``rate`` and ``n_copies`` for each row.

    ``targets`` are shares of the mixed corpus. Its size is such that the domain with the largest share keeps all the
    tokens it is expected to have, times ``max_rate``. ``n_copies`` is the rate rounded up or down by a hash of the row.
    """
    spark = docs.sparkSession
    model = train(docs, labels, domains, rows_each)
    names = [f"p_{n}" for n in model.names]
    shared = spark.sparkContext.broadcast(model)
    schema = "doc_id long, rid long, n_tokens long, " + ", ".join(f"{n} double" for n in names)
    texts = docs.select(F.col("doc_id").cast("long"), common.row_key(docs).alias("rid"), "text")
    rows = common.stored(common.mapped(texts, _memberships(shared, names), schema), "memberships")
    has = rows.agg(F.sum("n_tokens"), *[F.sum(F.col("n_tokens") * F.col(n)) for n in names]).first()
    share = np.array([targets[n] for n in model.names], float)
    total = float(has[0] or 0)
    natural = np.array([v or 0.0 for v in has[1:]]) / total if total else share
    largest = int(np.argmax(share))
    wanted = share / share[largest] * natural[largest] * max_rate
    gradients = fit(rows, model.names, wanted, max_rate)

    def step(batches: common.Batches) -> common.Batches:
        for batch in batches:
            rate = _rates(_matrix(batch, names), gradients, max_rate)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rate)], [*batch.schema.names, "rate"])

    draw = F.pmod(F.xxhash64("rid", F.lit(seed)), F.lit(1 << 30)) / (1 << 30)
    rated = common.mapped(rows, step, schema + ", rate double")
    return rated.withColumn("n_copies", (F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("int")).cast("int"))
