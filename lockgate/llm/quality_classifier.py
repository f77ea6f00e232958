"""Quality scores by votes of the nearest labelled documents in a latent semantic space.

Of the labelled rows at most ``ROWS_EACH`` of each label are drawn. The presence of words and punctuation runs in their
texts, weighted by inverse document frequency, is reduced to ``DIMENSIONS`` by a truncated singular value
decomposition. The labelled vectors, whose number and width are parameters, go to every task. Each task takes its
documents in blocks, computes the cosines with all labelled vectors as one matrix product, and the score of a
document is the mean label of its ``NEIGHBOURS`` nearest ones weighted by their similarity.

The whole text of every document is used; ids, language and source are not inputs. A text without any known feature, and every
text if there are no labels, gets the share of label 1 in the sample (one half without labels). Null texts are empty
texts. Labels that are null or contradict each other are not learned. Repeated rows score alike; ties between
neighbours go to the earlier labelled row. A labelled row that was learned is its own nearest neighbour and votes for
itself. Cosines are rounded to nine decimals, so a score depends on its text alone, not on how rows are dealt to tasks.
Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lockgate.llm import common, textmodel

ROWS_EACH = 1500
VOCABULARY = 3000
DIMENSIONS = 64
NEIGHBOURS = 25
BLOCK = 512
FOLDS = 5
THRESHOLD = 0.3


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


@dataclass
class Space:
    words: dict[bytes, int]
    axes: np.ndarray  # features x dimensions, already weighted
    vectors: np.ndarray  # labelled rows x dimensions, of length 1
    labels: np.ndarray
    usual: float

    def project(self, texts: list[bytes]) -> np.ndarray:
        out, get = np.zeros((len(texts), self.axes.shape[1]), np.float32), self.words.get
        for row, text in zip(out, texts):
            found = [k for k in map(get, textmodel.features(text)) if k is not None]
            if found:
                row[:] = self.axes[found].sum(0)
        return _unit(out)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(texts), self.usual)
        found = np.empty(len(texts))
        for at in range(0, len(texts), BLOCK):
            block = self.project(texts[at : at + BLOCK])
            cosines = np.round(block.astype(float) @ self.vectors.T.astype(float), 9)
            near = nearest(cosines, min(NEIGHBOURS, cosines.shape[1]))
            weight = np.maximum(np.take_along_axis(cosines, near, 1), 0)
            total = weight.sum(1)
            votes = (weight * self.labels[near]).sum(1)
            found[at : at + len(block)] = np.where(total > 0, votes / np.where(total > 0, total, 1), self.usual)
        return found


def nearest(cosines: np.ndarray, k: int) -> np.ndarray:
    """The columns of the k largest values of each row, ascending; among equal values the first columns."""
    last = -np.partition(-cosines, k - 1, axis=1)[:, k - 1 : k]
    above, equal = cosines > last, cosines == last
    wanted = k - above.sum(1, keepdims=True)
    taken = above | (equal & (np.cumsum(equal, axis=1) <= wanted))
    return np.nonzero(taken)[1].reshape(-1, k)


def _unit(rows: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(size > 0, size, 1)


def _right_vectors(matrix: np.ndarray, count: int) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration from a fixed start."""
    base = np.random.default_rng(3).standard_normal((matrix.shape[1], min(count + 16, *matrix.shape))).astype(np.float32)
    for _ in range(6):
        base, _ = np.linalg.qr(matrix.T @ (matrix @ base))
    _, _, turn = np.linalg.svd(matrix @ base, full_matrices=False)
    return (base @ turn.T)[:, :count]


def fit(docs: DataFrame, labels: DataFrame, rows_each: int = ROWS_EACH) -> Space:
    learned = labels.filter(~held_out())
    rows = textmodel.sample(docs, learned, {"1": F.col("quality") == 1, "0": F.col("quality") == 0}, rows_each)
    found, kinds = [textmodel.features(t) for _, t in rows], [k for k, _ in rows]
    y = np.array([float(k) for k in kinds])
    words = textmodel.vocabulary(found, kinds, VOCABULARY) if len(set(kinds)) > 1 else {}
    if not words:
        none = np.zeros((0, 1), np.float32)
        return Space({}, none, none, np.zeros(0), float(y.mean()) if len(y) else 0.5)
    x = textmodel.presence(found, words)
    weight = np.log(len(x) / x.sum(0)) + 0.1
    axes = (_right_vectors(_unit(x * weight), DIMENSIONS) * weight[:, None]).astype(np.float32)
    return Space(words, axes, _unit(x @ axes), y, float(y.mean()))


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, rows_each: int = ROWS_EACH) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows_each))

    def step(rows: common.Batches) -> common.Batches:
        for batch in common.slices(rows):
            scores = shared.value.scores(common.texts(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.clip(scores, 0, 1))], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(step, "doc_id long, score double")
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
