"""Training in epochs of mini-batches: a factorization machine, or with rank 0 a linear model.

Rows are dealt into partitions and written once. In an epoch each task goes through its partition in mini-batches, from the
parameters that all start with, by adaptive steps (per coordinate, with rates and decays of their own for bias, linear
weights and factors). Steps of a fixed rate never come to rest, so what a task tells is the mean of its parameters after every step, the ``n``-th
step weighing ``n``; these means are then averaged over the tasks by their rows. So an epoch is one pass, whatever the size of a
mini-batch, its result depends on the rows, their dealing and the seed, and the more steps it has, the less the last rows sway it.

An epoch goes over every row of its table, whatever the table's length and however often rows repeat.

After an epoch its mean loss is taken on the held-out rows, or during the steps where none are held out. Training stops when
``patience`` epochs in a row have not lowered the best loss by ``tolerance`` of it; the best epoch's parameters stay. With a
``state`` folder every epoch is written there as rows of a table, and training goes on after the last one found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from featherline.algorithms import repeated
from featherline.algorithms.sums import PIECES, Entries, merged, pieces
from featherline.functions import vectors
from featherline.workspace import discard, new_path

#: Decay of the steps' running means of gradients and of their squares (fixed values of the published method).
FIRST, SECOND = 0.9, 0.999
TERMS = ("bias", "linear", "factors")
#: Rows up to which :func:`copies` gathers nothing, and copies of a distinct row that it makes on average at least.
ROWS, COPIES = 1_000_000, 4


@dataclass
class Machine:
    """Parameters: a bias, a weight per column and a row of factors per column."""

    bias: np.ndarray
    linear: np.ndarray
    factors: np.ndarray

    def margins(self, rows: Entries, along: np.ndarray | None = None) -> np.ndarray:
        """Bias, linear part and all pairs, by half the square of the sums less the sums of the squares; ``along`` is rows times factors, if known."""
        if not self.factors.shape[1]:
            return self.bias[0] + np.bincount(rows.row, rows.value * self.linear[rows.place], rows.n)
        along = rows.times(self.factors) if along is None else along
        squares = np.bincount(rows.row, rows.value ** 2 * (self.factors ** 2).sum(axis=1)[rows.place], rows.n)
        return self.bias[0] + np.bincount(rows.row, rows.value * self.linear[rows.place], rows.n) + 0.5 * ((along ** 2).sum(axis=1) - squares)

    def parts(self) -> list[np.ndarray]:
        return [self.bias, self.linear, self.factors]


@dataclass
class Plan:
    """How to train."""

    loss: str
    epochs: int
    batch: int
    rates: dict[str, float]
    decays: dict[str, float] = field(default_factory=dict)
    patience: int = 0
    tolerance: float = 0.0
    epsilon: float = 1e-8
    clip: float = 0.0
    rescale: float = 1.0


def loss_and_slope(kind: str, margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Loss of each row and its slope in the margin: ``squared`` or ``logistic`` (labels 0 and 1)."""
    if kind == "squared":
        return (margin - y) ** 2, 2 * (margin - y)
    return np.maximum(margin, 0) + np.log1p(np.exp(-np.abs(margin))) - y * margin, 1 / (1 + np.exp(-np.clip(margin, -500, 500))) - y


class Steps:
    """Adaptive steps of a task: only coordinates that a mini-batch touches move."""

    def __init__(self, machine: Machine, plan: Plan):
        self.machine, self.plan, self.done = Machine(*[p.copy() for p in machine.parts()]), plan, 0
        self.means = [(np.zeros_like(p), np.zeros_like(p)) for p in machine.parts()]
        self.late = [np.zeros_like(p) for p in machine.parts()]

    def move(self, term: int, at, gradient: np.ndarray) -> None:
        plan, name = self.plan, TERMS[term]
        part, (first, second) = self.machine.parts()[term], self.means[term]
        gradient = gradient * plan.rescale
        if plan.clip:
            gradient = np.clip(gradient, -plan.clip, plan.clip)
        gradient = gradient + plan.decays.get(name, 0.0) * part[at]
        first[at] = FIRST * first[at] + (1 - FIRST) * gradient
        second[at] = SECOND * second[at] + (1 - SECOND) * gradient ** 2
        moved = plan.rates[name] * (first[at] / (1 - FIRST ** self.done)) / (np.sqrt(second[at] / (1 - SECOND ** self.done)) + plan.epsilon)
        part[at] -= moved
        # The weights of the steps before this one, in which the move has no part.
        self.late[term][at] -= moved * (self.done * (self.done - 1) / 2)

    def mean(self) -> list[np.ndarray]:
        """The parameters after every step, averaged with the step's number as weight."""
        whole = max(self.done * (self.done + 1) / 2, 1)
        return [p - late / whole for p, late in zip(self.machine.parts(), self.late)]

    def step(self, rows: Entries, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
        """One mini-batch; its summed loss before the step, and its weight."""
        self.done += 1
        machine, rank = self.machine, self.machine.factors.shape[1]
        along = rows.times(machine.factors) if rank else None
        loss, slope = loss_and_slope(self.plan.loss, machine.margins(rows, along), y)
        total = max(float(w.sum()), 1e-300)
        slope = slope * w / total
        if len(machine.linear) <= max(len(rows.place), 1):  # short vectors: places count themselves
            at, size = rows.place, len(machine.linear)
            touched = found = np.flatnonzero(np.bincount(at, minlength=size))
        else:
            touched, at = np.unique(rows.place, return_inverse=True)
            size, found = len(touched), slice(None)
        pull = slope[rows.row] * rows.value
        linear = np.bincount(at, pull, size)[found]
        factors = np.stack([np.bincount(at, pull * (along[rows.row, k] - machine.factors[rows.place, k] * rows.value), size)[found]
                            for k in range(rank)], axis=1) if rank else None
        self.move(0, slice(None), np.array([slope.sum()]))
        self.move(1, touched, linear)
        if rank:
            self.move(2, touched, factors)
        return float((loss * w).sum()), float(w.sum())


def train(df: DataFrame, features: Column, label: Column, start: Machine, plan: Plan, weight: Column | None = None, held_out: Column | None = None,
          state: str | None = None) -> tuple[Machine, list[float], int]:
    """The best epoch's parameters, the loss of every epoch and the number of the best, from 0."""
    spark = df.sparkSession
    rows = df.select(vectors.lean(features).alias("x"), label.cast("double").alias("y"), (F.lit(1.0) if weight is None else weight.cast("double")).alias("w"),
                     (F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))).alias("held")).where("x IS NOT NULL AND y IS NOT NULL")
    path = new_path(spark, "dealt")
    rows.repartition(max(1, spark.sparkContext.defaultParallelism)).write.parquet(path)
    dealt = spark.read.schema(rows.schema).parquet(path)
    shapes = [p.shape for p in start.parts()]
    try:
        told = _found(spark, state) if state else []
        losses = [loss for loss, _ in told]
        machine = _unpacked(told[-1][1], shapes) if told else start
        best, since = _since(losses, plan.tolerance)
        kept = _unpacked(told[best][1], shapes) if told else start
        for epoch in range(len(told), plan.epochs):
            if plan.patience and since >= plan.patience:
                break
            machine, loss = _epoch(dealt.where("NOT held"), machine, plan, shapes)
            if held_out is not None:
                loss = _mean_loss(dealt.where("held"), machine, plan)
            losses.append(loss)
            if state:
                packed = np.concatenate([p.ravel() for p in machine.parts()]).tobytes()
                spark.createDataFrame([(epoch, float(loss), bytearray(packed))], "epoch int, loss double, held binary").write.mode("overwrite").parquet(f"{state}/epoch={epoch:05d}")
            before = best
            best, since = _since(losses, plan.tolerance)
            if best != before:
                kept = machine
    finally:
        discard(spark, path)
    return kept, losses, best


def copies(rows: DataFrame, path: str) -> DataFrame | None:
    """Rows ``x, y, w, held`` as numbered copies of the distinct ones, written at ``path``, that share their weight; nothing where the table is short or too few repeat.

    No fit goes over them: steps would depend on the table's length.
    """
    few = repeated.gathered(rows, ["x", "y", "held"], "n", least=ROWS, w=F.col("w"))
    if few is None:
        return None
    few.write.parquet(path)
    few = rows.sparkSession.read.schema(few.schema).parquet(path)
    n, distinct = few.agg(F.sum("n"), F.count(F.lit(1))).first()
    times = F.when(F.col("held"), 1).otherwise(F.ceil(F.col("n") * (max(ROWS, COPIES * distinct) / n))).cast("int")
    return few.withColumn("copy", F.explode(F.sequence(F.lit(1), times))).withColumn("w", F.col("w") / times)


def _since(losses: list[float], tolerance: float) -> tuple[int, int]:
    """The best epoch, which lowered the loss before it by the tolerance at least, and how many came after it."""
    best = -1
    for k, loss in enumerate(losses):
        if best < 0 or loss < losses[best] - tolerance * abs(losses[best]):
            best = k
    return best, len(losses) - 1 - best


def _unpacked(packed: bytes, shapes: list[tuple[int, ...]]) -> Machine:
    numbers, found, at = np.frombuffer(packed).copy(), [], 0
    for shape in shapes:
        size = int(np.prod(shape))
        found.append(numbers[at:at + size].reshape(shape))
        at += size
    return Machine(*found)


def _found(spark, state: str) -> list[tuple[float, bytes]]:
    """Loss and parameters of the epochs that a folder holds, from the first without a gap."""
    place = spark._jvm.org.apache.hadoop.fs.Path(state)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return []
    rows = {r.epoch: (r.loss, bytes(r.held)) for r in spark.read.schema("loss double, held binary, epoch int").parquet(state).collect()}  # a row an epoch
    found = []
    while len(found) in rows:
        found.append(rows[len(found)])
    return found


def _epoch(rows: DataFrame, machine: Machine, plan: Plan, shapes: list[tuple[int, ...]]) -> tuple[Machine, float]:
    """Averaged parameters after one pass, and the mean loss met on the way."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, loss, total = Steps(machine, plan), 0.0, 0.0
        for batch in batches:
            x, y, w = Entries(batch.column("x")), *(batch.column(name).to_numpy(zero_copy_only=False) for name in ("y", "w"))
            for begin in range(0, x.n, plan.batch):
                some = slice(begin, min(begin + plan.batch, x.n))
                cost, weight = steps.step(x.between(some.start, some.stop), y[some], w[some])
                loss, total = loss + cost, total + weight
        yield pieces([*[p * total for p in steps.mean()], np.array([loss]), np.array([total])])

    *parts, loss, total = merged(rows.mapInArrow(run, PIECES), [*shapes, (1,), (1,)])
    if not total[0]:
        return machine, 0.0
    return Machine(*[p / total[0] for p in parts]), float(loss[0] / total[0])


def _mean_loss(rows: DataFrame, machine: Machine, plan: Plan) -> float:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss = total = 0.0
        for batch in batches:
            y, w = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("y", "w"))
            loss += float((loss_and_slope(plan.loss, machine.margins(Entries(batch.column("x"))), y)[0] * w).sum())
            total += float(w.sum())
        yield pieces([np.array([loss]), np.array([total])])

    loss, total = merged(rows.mapInArrow(run, PIECES), [(1,), (1,)])
    return float(loss[0] / total[0]) if total[0] else 0.0
