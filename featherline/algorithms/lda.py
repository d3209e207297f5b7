"""Topics by spectral moments: a whitened second moment, then tensor power steps on the third.

Words are columns of count vectors, hashed ones if the vocabulary is open. With c the counts of a document of length l >= 3,
``(c c' - diag(c)) / l(l-1)`` estimates the joint distribution of two of its words, and a like term that of three. Four passes over
the rows sum such terms, never a matrix of words by words:

1. the mean word distribution, and the second moment times a random sketch of a few columns;
2. the same times the orthonormal columns found, which sharpens them;
3. once more, for the second moment within these columns, whose eigenvectors whiten it;
4. the third moment in whitened coordinates, k x k x k numbers.

The prior ``alpha0`` corrects both moments for mixed documents. Power steps with deflation find the topics from the small
tensor: of ``max_restarts`` random starts the one with the largest value, up to ``max_iterations`` steps or a change below ``tol``. A
document's mixture is then fitted to the topics by expectation steps. The vectors are written once, so that what made them is
not done again in every pass. The driver holds a few columns per word of
``feature_dim``, as the model does, and no words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, functions as F, types as T

from featherline.algorithms.base import TableEstimator, TableModel
from featherline.algorithms.params import declare, real, whole
from featherline.algorithms.sums import Entries, summed
from featherline.functions import vectors
from featherline.workspace import discard, new_path

#: Columns of the sketch beyond the topics, and steps of fitting a mixture.
SPARE, MIXTURE_STEPS, MIXTURE_CHANGE = 8, 100, 1e-7


def power_steps(tensor: np.ndarray, restarts: int, iterations: int, tol: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Values and unit vectors of a symmetric tensor's components, largest first, by deflation."""
    chance, left = np.random.default_rng(seed), tensor.copy()
    values, found = [], []
    for _ in range(len(tensor)):
        best = None
        for _ in range(restarts):
            v = chance.normal(size=len(tensor))
            v /= np.linalg.norm(v)
            for _ in range(iterations):
                new = np.einsum("abc,b,c->a", left, v, v)
                size = np.linalg.norm(new)
                if size == 0:
                    break
                new /= size
                change, v = np.linalg.norm(new - v), new
                if change < tol:
                    break
            value = float(np.einsum("abc,a,b,c->", left, v, v, v))
            if best is None or value > best[0]:
                best = value, v
        values.append(best[0])
        found.append(best[1])
        left = left - best[0] * np.einsum("a,b,c->abc", *[best[1]] * 3)
    return np.array(values), np.array(found)


class LDATable(TableEstimator):
    """Topics of a table of word counts."""

    required = ("num_topics", "feature_dim", "mini_batch_size")
    assumed = {"alpha0": 0.1, "max_restarts": 10, "max_iterations": 1000, "tol": 1e-8, "seed": 0}

    num_topics = declare("num_topics", "topics to find", whole(1))
    feature_dim = declare("feature_dim", "size of the vocabulary", whole(1))
    mini_batch_size = declare("mini_batch_size", "rows that a task takes up at a time", whole(1))
    alpha0 = declare("alpha0", "sum of the prior over topics", real(0, above=True))
    max_restarts = declare("max_restarts", "random starts of each topic's power steps", whole(1))
    max_iterations = declare("max_iterations", "power steps of a start", whole(1))
    tol = declare("tol", "change that ends the power steps of a start", real(0, above=True))
    seed = declare("seed", "random seed", whole())

    def _train(self, df: DataFrame) -> LDATableModel:
        spark, path = df.sparkSession, new_path(df.sparkSession, "counts")
        rows = df.select(vectors.lean(F.col(self.getOrDefault("featuresCol"))).alias("x")).where("x IS NOT NULL")
        rows.write.parquet(path)
        try:
            return self._found(spark.read.schema(rows.schema).parquet(path))
        finally:
            discard(spark, path)

    def _found(self, rows: DataFrame) -> LDATableModel:
        """The topics of a column ``x`` of lean vectors."""
        k, width, prior = self.getOrDefault("num_topics"), self.getOrDefault("feature_dim"), self.setting("alpha0")
        size = self.getOrDefault("mini_batch_size")
        columns = min(width, k + SPARE)
        sketch = np.random.default_rng(self.setting("seed")).normal(size=(width, columns))

        def usable(counts: Entries) -> np.ndarray:
            """Weight of each row's pairs of words, 0 for rows too short to have three."""
            l = counts.total
            return np.where(l >= 3, 1 / np.maximum(l * (l - 1), 1.0), 0.0)

        def second(matrix: np.ndarray):
            def add(counts: Entries) -> list[np.ndarray]:
                weight = usable(counts)
                per_row = counts.times(matrix) * weight[:, None]
                each = counts.value * weight[counts.row]
                total = np.zeros((width, matrix.shape[1]))
                for c in range(matrix.shape[1]):
                    total[:, c] = np.bincount(counts.place, counts.value * per_row[counts.row, c], width)
                total -= np.bincount(counts.place, each, width)[:, None] * matrix
                share = np.where(weight > 0, 1 / np.maximum(counts.total, 1.0), 0.0)
                return [total, np.bincount(counts.place, counts.value * share[counts.row], width), np.array([float((weight > 0).sum())])]

            total, mean, n = summed(rows, add, [(width, matrix.shape[1]), (width,), (1,)], size)
            n = max(n[0], 1.0)
            mean = mean / n
            return total / n - prior / (prior + 1) * np.outer(mean, mean @ matrix), mean, n

        found, _, n = second(sketch)
        basis = np.linalg.qr(found)[0]
        basis = np.linalg.qr(second(basis)[0])[0]
        found, mean, _ = second(basis)
        inner = basis.T @ found
        values, turns = np.linalg.eigh((inner + inner.T) / 2)
        top = np.argsort(-values)[:k]
        top = top[values[top] > 1e-10 * max(values.max(initial=0.0), 1e-300)]
        values = values[top]
        whiten, back = basis @ turns[:, top] / np.sqrt(values), basis @ turns[:, top] * np.sqrt(values)
        rank = len(top)

        def third(counts: Entries) -> list[np.ndarray]:
            l = counts.total
            weight = np.where(l >= 3, 1 / np.maximum(l * (l - 1) * (l - 2), 1.0), 0.0)
            y = counts.times(whiten)
            w = whiten[counts.place]
            cube = np.einsum("n,na,nb,nc->abc", weight, y, y, y, optimize=True)
            paired = np.einsum("e,ea,eb,ec->abc", counts.value * weight[counts.row], w, w, y[counts.row], optimize=True)
            cube -= paired + paired.transpose(0, 2, 1) + paired.transpose(2, 0, 1)
            return [cube + 2 * np.einsum("e,ea,eb,ec->abc", counts.value * weight[counts.row], w, w, w, optimize=True)]

        cube = summed(rows, third, [(rank,) * 3], size)[0] / n
        m = whiten.T @ mean
        pairs = np.eye(rank) + prior / (prior + 1) * np.outer(m, m)  # the whitened second moment, uncorrected
        mixed = np.einsum("ab,c->abc", pairs, m)
        cube -= prior / (prior + 2) * (mixed + mixed.transpose(0, 2, 1) + mixed.transpose(2, 0, 1))
        cube += 2 * prior ** 2 / ((prior + 1) * (prior + 2)) * np.einsum("a,b,c->abc", m, m, m)
        sizes, vectors_found = power_steps(cube, self.setting("max_restarts"), self.setting("max_iterations"), self.setting("tol"), self.setting("seed"))
        topics = vectors_found.reshape(rank, rank) @ back.T
        topics = np.maximum(topics * np.sign(topics.sum(axis=1, keepdims=True)), 0.0)
        topics /= np.maximum(topics.sum(axis=1, keepdims=True), 1e-300)
        share = 1 / np.maximum(np.abs(sizes), 1e-6) ** 2
        if rank < k:  # fewer words than topics: the others are the mean
            topics, share = np.vstack([topics, np.tile(mean, (k - rank, 1))]), np.append(share, np.full(k - rank, share.min(initial=1.0)))
        model = LDATableModel()
        # A word that no topic has would leave a mixture undefined.
        model.arrays["topics"] = (1 - 1e-6) * topics + 1e-6 / width
        model.arrays["prior"] = (prior * share / share.sum())[:, None]
        model.facts["mixture"] = "topic_mixture"
        return model


class LDATableModel(TableModel):
    """Appends the topic mixture of each row of counts; all zeros for a row without a word."""

    def outputs(self) -> dict[str, T.DataType]:
        return {self.facts["mixture"]: VectorUDT()}

    def predict(self, df: DataFrame):
        topics, prior = self.arrays["topics"], self.arrays["prior"].reshape(-1)

        @F.arrow_udf(VectorUDT())
        def mixtures(column: pa.Array) -> pa.Array:
            found = [fit_mixtures(part, topics, prior) for part in Entries(column).parts()]
            return vectors.dense_column(np.concatenate(found) if found else np.zeros((0, len(topics))))

        return df, {self.facts["mixture"]: mixtures(vectors.lean(F.col(self.getOrDefault("featuresCol"))))}


def fit_mixtures(counts: Entries, topics: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Mixtures of rows of counts by expectation steps, with the prior's pseudo-counts. Rows that have come to rest leave once half of them have."""
    k = len(topics)
    found = np.full((counts.n, k), 1.0 / k)
    at, row, value, likely = np.arange(counts.n), counts.row, counts.value, topics[:, counts.place].T
    theta = found.copy()
    for _ in range(MIXTURE_STEPS):
        held = theta[row] * likely
        held *= (value / np.maximum(held.sum(axis=1), 1e-300))[:, None]
        new = prior + np.stack([np.bincount(row, held[:, t], len(at)) for t in range(k)], axis=1)
        new /= new.sum(axis=1, keepdims=True)
        moves, theta = np.abs(new - theta).max(axis=1) >= MIXTURE_CHANGE, new
        if 2 * moves.sum() > len(at):
            continue
        found[at] = theta
        if not moves.any():
            break
        some, number = moves[row], np.cumsum(moves) - 1
        at, row, value, likely, theta = at[moves], number[row[some]], value[some], likely[some], theta[moves]
    found[at] = theta
    found[counts.total == 0] = 0.0
    return found
