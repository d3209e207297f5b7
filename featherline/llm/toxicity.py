"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

Features are the distinct words, pairs of neighbours and pairs with one word between of the lower-cased
text, hashed into ``2**BITS`` places. The fit goes once through a bounded, documented sample per epoch,
with a learning rate for each coordinate; the L1 term keeps most weights at exactly zero, so the model
that goes to the tasks is small (at most ``2**BITS`` floats). Scoring reads every whole text.

A null text is an empty one and scores what the intercept gives; without any labelled row the score is
0.5 everywhere. Equal texts tie at the same score, rows that repeat get a row each, an empty table none; a very long text is read whole.
Other columns, whatever their names, are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from featherline.llm.labelled import fit_in_task, remainder, sample, scored
from featherline.llm.spans import LOWER, PLAIN_WORDS, Hashes, mix, pieces, text_buffer, words

BITS = 20
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 4.0, 1.0, 4
#: Labelled rows that the fit reads at most.
MAX_ROWS = 30_000


def feature_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Place and row of every n-gram and skip-gram, repeats included."""
    data, offsets = text_buffer(column)
    data = LOWER[data]
    start, end, row = words(data, offsets, PLAIN_WORDS)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = Hashes(data).of(start, end)
    found, at = [word], [row]
    for gap, salt in ((1, 11), (2, 23)):
        pair = mix(word[:-gap] * np.uint64(0x100000001B3) + word[gap:] + np.uint64(salt))
        same = row[:-gap] == row[gap:]
        found.append(pair[same])
        at.append(row[:-gap][same])
    return (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(at)


def distinct(place: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique((row << BITS) | place)
    return both & ((1 << BITS) - 1), both >> BITS


def featurize(batch: pa.RecordBatch) -> Iterator[tuple]:
    for piece in pieces(batch, "text"):
        place, row = distinct(*feature_rows(piece.column("text")))
        bounds = np.searchsorted(row, np.arange(piece.num_rows + 1))
        for k, (order, y) in enumerate(zip(piece.column("_order").to_pylist(), piece.column("y").to_pylist())):
            mine = place[bounds[k]:bounds[k + 1]]
            yield order, y, mine, np.zeros(0)


def train(examples: list) -> dict[str, np.ndarray]:
    """FTRL-proximal; the place after the last is the intercept, which L1 leaves alone."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    l1 = np.full(size, L1)
    l1[-1] = 0.0

    def weights(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        free = np.abs(zi) > l1[i]
        return np.where(free, -(zi - np.sign(zi) * l1[i]) / ((BETA + np.sqrt(n[i])) / ALPHA + L2), 0.0)

    for epoch in range(EPOCHS):
        for k in np.random.default_rng(epoch).permutation(len(examples)):
            _, y, places, _ = examples[k]
            i = np.append(places, size - 1)
            w = weights(i)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            before = n[i]
            after = before + g * g
            z[i] += g - (np.sqrt(after) - np.sqrt(before)) / ALPHA * w
            n[i] = after
    w = weights(np.arange(size))
    kept = np.flatnonzero(w[:-1])
    return {"places": kept.astype(np.float32), "weights": w[kept].astype(np.float32), "intercept": w[-1:].astype(np.float32)}


def scorer(model: dict[str, np.ndarray]):
    """Function from a batch to scores; each distinct feature counts once per text."""
    places, held = model["places"].astype(np.int64), model["weights"]

    def score(batch: pa.RecordBatch) -> np.ndarray:
        table = np.zeros(1 << BITS, np.float32)
        table[places] = held
        found = []
        for piece in pieces(batch, "_in0"):
            place, row = feature_rows(piece.column("_in0"))
            active = table[place] != 0
            place, row = distinct(place[active], row[active])
            logit = np.bincount(row, weights=table[place].astype(np.float64), minlength=piece.num_rows)
            found.append(logit + float(model["intercept"][0]))
        return 1.0 / (1.0 + np.exp(-np.concatenate(found))) if found else np.zeros(0)

    return score


def toxicity(docs: DataFrame, labels: DataFrame, held_out_part: int = 2, parts: int = 4, max_rows: int = MAX_ROWS,
             keep: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` (columns ``keep``) as struct ``row`` with ``score`` from 0 to 1; fitted on rows that aren't held out."""
    learn = remainder(F.col("_key"), parts) != held_out_part
    model = fit_in_task(sample(docs, labels, "toxic", learn, max_rows=max_rows), featurize, train)
    return scored(docs, [F.coalesce(docs["text"], F.lit(""))], scorer(model), keep)
