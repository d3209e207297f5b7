"""Quality: a factorisation machine over hashed words, structure statistics and metadata.

A text becomes a sparse vector: its distinct words, hashed, with length-normalised counts; statistics of
its structure, each in one of a few fixed bins; and bins of the metadata n_chars. The model adds to the
linear part every pairwise interaction through vectors of ``RANK`` factors, computed in linear time as
half of (square of the sum - sum of the squares). It is fitted on a bounded, documented sample and sent
to the tasks as one array of fixed size; scoring reads every whole text.

A null text is an empty one, a null n_chars has a bin of its own. labels, lang, source and doc_id are no
inputs. Without labelled rows every score is 0.5. Rows equal in text and n_chars tie at the same score, rows that repeat get a row each, an empty
table none; a very long text is read whole. Columns of other names are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from featherline.llm.labelled import MAX_ROWS, fit_in_task, remainder, sample, scored
from featherline.llm.spans import LOWER, SPACE_SEPARATED, Hashes, per_row, pieces, text_buffer, words

WORD_BITS, RANK = 16, 8
EPOCHS, RATE, DECAY = 5, 0.08, 1e-5
#: Upper bounds of the bins of every statistic.
BINS = {
    "upper": (0.02, 0.05, 0.1, 0.2, 0.4, 0.7), "digits": (0.005, 0.02, 0.05, 0.1, 0.3),
    "symbols": (0.01, 0.02, 0.04, 0.07, 0.1, 0.15, 0.25), "marks": (0.001, 0.005, 0.02, 0.05),
    "spaces": (0.05, 0.1, 0.14, 0.18, 0.25), "distinct": (0.1, 0.25, 0.4, 0.5, 0.6, 0.7, 0.85),
    "word_length": (2.0, 3.0, 4.0, 5.0, 6.0, 8.0, 12.0), "line_repeats": (0.01, 0.1, 0.25, 0.5, 0.75),
    "words": (0, 5, 10, 20, 50, 100, 200, 500, 2000, 10000), "words_per_line": (2, 5, 10, 20, 50, 200),
    "n_chars": (-1, 0, 100, 500, 1000, 2000, 5000, 20000, 100000),
}
FIRST, _at = {}, 1 << WORD_BITS
for _name, _bounds in BINS.items():
    FIRST[_name] = _at
    _at += len(_bounds) + 1
SIZE = _at

_KINDS = {
    "upper": np.isin(np.arange(256), np.arange(0x41, 0x5B)), "digits": np.isin(np.arange(256), np.arange(0x30, 0x3A)),
    "symbols": np.isin(np.arange(256), [x for x in range(0x21, 0x7F) if not chr(x).isalnum()]),
    "marks": np.isin(np.arange(256), [ord(c) for c in "|#$%&*<>{}[]\\^~=_"]),
    "spaces": ~SPACE_SEPARATED,
}
_NOT_NEWLINE = np.arange(256) != 0x0A


def features(column: pa.Array, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, value and row of every feature, sorted by row. ``n_chars`` is -1 where it is null."""
    data, offsets = text_buffer(column)
    n = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1)
    stats = {}
    for name, kind in _KINDS.items():
        total = np.concatenate([[0], np.cumsum(kind[data], dtype=np.int64)])
        stats[name] = (total[offsets[1:]] - total[offsets[:-1]]) / size
    low = LOWER[data]
    hashes = Hashes(low)
    start, end, row = words(low, offsets, SPACE_SEPARATED)
    count = per_row(row, n)
    place = (hashes.of(start, end) >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    both, times = np.unique((row << WORD_BITS) | place, return_counts=True)
    place, row_of = both & ((1 << WORD_BITS) - 1), both >> WORD_BITS
    tf = np.log1p(times)
    norm = np.sqrt(np.bincount(row_of, weights=tf * tf, minlength=n))
    value = tf / np.maximum(norm[row_of], 1e-9)
    stats["distinct"] = per_row(row_of, n) / np.maximum(count, 1)
    stats["word_length"] = np.bincount(row, weights=end - start, minlength=n) / np.maximum(count, 1)
    stats["words"] = count
    first, last, line_row = words(data, offsets, _NOT_NEWLINE)
    lines = per_row(line_row, n)
    line = hashes.of(first, last)
    order = np.lexsort((line, line_row))
    again = (line[order][1:] == line[order][:-1]) & (line_row[order][1:] == line_row[order][:-1])
    stats["line_repeats"] = per_row(line_row[order][1:][again], n) / np.maximum(lines, 1)
    stats["words_per_line"] = count / np.maximum(lines, 1)
    stats["n_chars"] = n_chars
    each = np.arange(n)
    places, values, rows = [place], [value], [row_of]
    for name, bounds in BINS.items():
        places.append(FIRST[name] + np.searchsorted(bounds, stats[name], "left"))
        values.append(np.ones(n))
        rows.append(each)
    place, value, row = np.concatenate(places), np.concatenate(values), np.concatenate(rows)
    order = np.argsort(row, kind="stable")
    return place[order], value[order], row[order]


def _n_chars(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)


def featurize(batch: pa.RecordBatch) -> Iterator[tuple]:
    for piece in pieces(batch, "text"):
        place, value, row = features(piece.column("text"), _n_chars(piece.column("n_chars")))
        bounds = np.searchsorted(row, np.arange(piece.num_rows + 1))
        for k, (order, y) in enumerate(zip(piece.column("_order").to_pylist(), piece.column("y").to_pylist())):
            yield order, y, place[bounds[k]:bounds[k + 1]], value[bounds[k]:bounds[k + 1]]


def train(examples: list) -> dict[str, np.ndarray]:
    """Adaptive-rate gradient steps on the log loss, one example at a time, in a seeded order."""
    w = np.zeros((SIZE, RANK + 1))
    if examples:
        w[:, 1:] = np.random.default_rng(7).normal(0, 0.05, (SIZE, RANK))
    seen, bias, bias_seen = np.full((SIZE, RANK + 1), 1e-3), 0.0, 1e-3
    for epoch in range(EPOCHS):
        for k in np.random.default_rng(epoch).permutation(len(examples)):
            _, y, i, x = examples[k]
            held, x = w[i], x[:, None]
            scaled = held[:, 1:] * x
            total = scaled.sum(axis=0)
            logit = bias + (held[:, 0] * x[:, 0]).sum() + 0.5 * ((total * total).sum() - (scaled * scaled).sum())
            g = 1.0 / (1.0 + np.exp(-np.clip(logit, -35, 35))) - y
            slope = np.concatenate([x, x * (total - scaled)], axis=1) * g + DECAY * held
            grown = seen[i] + slope * slope
            seen[i] = grown
            w[i] = held - RATE * slope / np.sqrt(grown)
            bias_seen += g * g
            bias -= RATE * g / np.sqrt(bias_seen)
    return {"w": w.astype(np.float32).ravel(), "bias": np.array([bias], np.float32)}


def interaction_logits(w: np.ndarray, bias: float, place: np.ndarray, value: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Linear part and pairwise part of every row, by the sum-of-squares identity; ``row`` is sorted."""
    found = np.full(n, bias, np.float64)
    if not len(row):
        return found
    begin = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    held = w[place].astype(np.float64) * value[:, None]
    total = np.add.reduceat(held, begin, axis=0)
    squares = np.add.reduceat((held[:, 1:] ** 2).sum(axis=1), begin)
    found[row[begin]] += total[:, 0] + 0.5 * ((total[:, 1:] ** 2).sum(axis=1) - squares)
    return found


def scorer(model: dict[str, np.ndarray]):
    w, bias = model["w"].reshape(SIZE, RANK + 1), float(model["bias"][0])

    def score(batch: pa.RecordBatch) -> np.ndarray:
        found = []
        for piece in pieces(batch, "_in0"):
            place, value, row = features(piece.column("_in0"), _n_chars(piece.column("_in1")))
            found.append(interaction_logits(w, bias, place, value, row, piece.num_rows))
        return 1.0 / (1.0 + np.exp(-np.clip(np.concatenate(found), -35, 35))) if found else np.zeros(0)

    return score


def quality(docs: DataFrame, labels: DataFrame, held_out_part: int = 1, parts: int = 3, max_rows: int = MAX_ROWS,
            keep: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` (columns ``keep``) as struct ``row`` with ``score`` from 0 to 1; fitted on rows that aren't held out."""
    learn = remainder(F.col("_key"), parts) != held_out_part
    stated = docs["n_chars"].cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    known = docs.select("doc_id", "text", stated.alias("n_chars"))
    model = fit_in_task(sample(known, labels, "quality", learn, ["n_chars"], max_rows), featurize, train)
    return scored(docs, [F.coalesce(docs["text"], F.lit("")), stated], scorer(model), keep)
