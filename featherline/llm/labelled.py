"""A bounded sample of labelled texts for fitting a classifier, and a classifier's way through Spark.

The sample is at most ``max_rows`` labelled rows, those whose hashed doc_id is smallest, so it does not
depend on partitions and is as random as the hash. Everything after the fit covers every row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from featherline.llm.tasks import tidy

#: Labelled rows that a fit reads at most.
MAX_ROWS = 12_000


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, extra: list[str] = (),
           max_rows: int = MAX_ROWS) -> DataFrame:
    """Columns ``text``, ``extra`` and ``y`` of at most ``max_rows`` labelled documents.

    ``labels`` has doc_id and ``label`` (0 or 1; other values and nulls are left out). A document that is
    labelled several times counts as 1 if one of its labels is 1. ``learn`` says of doc_id which rows may
    be learned from. Documents that repeat an id come with each of their texts.
    """
    chosen = (
        labels.select(F.col("doc_id").alias("_key"), F.col(label).cast("int").alias("_y"))
        .where(F.col("_y").isin(0, 1) & F.col("_key").isNotNull())
        .groupBy("_key").agg(F.max("_y").alias("_y"))
        .where(learn).orderBy(F.xxhash64("_key"), "_key").limit(max_rows))
    # Only what is read comes along, so no other column can clash. The limit bounds what is broadcast.
    known = docs.select("doc_id", "text", *extra)
    return known.join(F.broadcast(chosen), known["doc_id"] == chosen["_key"]).select(
        F.xxhash64("_key").alias("_order"), F.coalesce(known["text"], F.lit("")).alias("text"),
        *[known[c] for c in extra], F.col("_y").alias("y"))


def fit_in_task(rows: DataFrame, featurize: Callable[[pa.RecordBatch], Iterator[tuple]],
                train: Callable[[list], dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """Features in parallel tasks, the sequential fit in one task over the bounded sample.

    ``featurize`` gives (order, y, indices, values) per row; ``train`` gives named float32 arrays.
    """

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(featurize(batch))
            yield pa.RecordBatch.from_arrays([
                pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int32()),
                pa.array([x[2].astype(np.int32).tobytes() for x in found], pa.binary()),
                pa.array([x[3].astype(np.float32).tobytes() for x in found], pa.binary()),
            ], names=["_order", "y", "i", "x"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = []
        for batch in batches:
            order, y, i, x = (batch.column(k).to_pylist() for k in range(4))
            examples += [(o, b, np.frombuffer(c, np.int32), np.frombuffer(d, np.float32)) for o, b, c, d in zip(order, y, i, x)]
        examples.sort(key=lambda e: (e[0], e[1], e[2].tobytes(), e[3].tobytes()))
        made = train(examples)
        yield pa.RecordBatch.from_arrays([
            pa.array(list(made), pa.string()), pa.array([v.tobytes() for v in made.values()], pa.binary()),
        ], names=["name", "held"])

    shaped = rows.mapInArrow(tidy(features), "_order long, y int, i binary, x binary").repartition(1)
    return {name: np.frombuffer(held, np.float32) for name, held in shaped.mapInArrow(tidy(fit), "name string, held binary").collect()}


def scored(docs: DataFrame, columns: list[Column], score: Callable[[pa.RecordBatch], np.ndarray], keep: list[str] | None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) as struct ``row`` beside the double ``score``.

    ``columns`` are what ``score`` reads; the row itself passes through unread.
    """
    names = [f"_in{k}" for k in range(len(columns))]
    read = docs.select(F.struct(*[docs[c] for c in keep or docs.columns]).alias("row"), *[c.alias(n) for n, c in zip(names, columns)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score(batch), pa.float64())], names=["row", "score"])

    schema = read.select("row", F.lit(0.0).cast("double").alias("score")).schema
    return read.mapInArrow(tidy(run), schema)
