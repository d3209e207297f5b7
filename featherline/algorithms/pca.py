"""Principal components, by covariance, by a singular value decomposition, or by a random sketch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.ml.linalg import VectorUDT

from featherline.algorithms import geometry
from featherline.algorithms.base import TableEstimator, TableModel
from featherline.algorithms.params import choice, declare, flag, whole
from featherline.functions import vectors

# Passes that sharpen a random sketch.
POWER_PASSES = 2
# Tasks in which what other tasks summed up meets before the driver gets as many.
MEETINGS = 16


class PCATable(TableEstimator):
    """Projects a feature table on its main directions."""

    required = ("num_components", "feature_dim", "mini_batch_size")
    assumed = {"algorithm_mode": "regular", "subtract_mean": "True", "extra_components": -1, "seed": 0}

    num_components = declare("num_components", "directions to keep", whole(1))
    feature_dim = declare("feature_dim", "size of the vectors", whole(1))
    mini_batch_size = declare("mini_batch_size", "rows per step of a streaming trainer", whole(1))
    algorithm_mode = declare("algorithm_mode", "how directions are found", choice("regular", "stable", "randomized"))
    subtract_mean = declare("subtract_mean", "whether to center, in training and in scoring", flag)
    extra_components = declare("extra_components", "surplus sketch columns; -1 for a rule", whole(-1))
    seed = declare("seed", "random seed", whole())

    def _preset(self) -> None:
        self._setDefault(mini_batch_size=1000)

    def _train(self, df: DataFrame) -> PCATableModel:
        features, k = self.getOrDefault("featuresCol"), self.getOrDefault("num_components")
        width = self.getOrDefault("feature_dim")
        if k > width:
            raise ValueError(f"{k} components need vectors of at least that size, not {width}")
        if self.setting("extra_components") == 0:
            raise ValueError("extra_components must be -1 or above 0")
        slim = df.select(F.col(features).alias("x"))
        centered = self.setting("subtract_mean") == "True"
        mean = slim.agg(Summarizer.mean(F.col("x"))).first()[0].toArray() if centered else None
        mode = self.setting("algorithm_mode")
        if mode == "randomized":
            slim = slim.persist()
            try:
                directions = self._sketched(slim, mean, k, width)
            finally:
                slim.unpersist()
        elif mode == "regular":
            directions = np.linalg.eigh(apply_gram(slim, None, mean, width))[1][:, ::-1][:, :k]
        else:
            # All right singular vectors, so that rows of lower rank still have k directions.
            directions = np.linalg.svd(triangle(slim, width, mean), full_matrices=True)[2].T[:, :k]
        return PCATableModel.of(fixed_signs(directions), mean)

    def _sketched(self, df: DataFrame, mean: np.ndarray | None, k: int, width: int) -> np.ndarray:
        """Directions from a random sketch: only matrices of width by a few columns ever meet."""
        extra = self.setting("extra_components")
        columns = min(width, k + (max(10, k) if extra < 0 else extra))
        basis = np.random.default_rng(self.setting("seed")).normal(size=(width, columns))
        for _ in range(POWER_PASSES):
            basis, _ = np.linalg.qr(apply_gram(df, basis, mean, width))
        image = apply_gram(df, basis, mean, width)
        values, turns = np.linalg.eigh(basis.T @ image)
        return (basis @ turns)[:, ::-1][:, :k]


def triangle(df: DataFrame, width: int, mean: np.ndarray | None) -> np.ndarray:
    """The triangular factor of the (centered) rows: tasks factor their rows, then factors meet in two steps."""

    def factor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, width))
        for batch in batches:
            for block in geometry._blocks(batch.column(0), width):
                held = np.linalg.qr(np.vstack([held, block if mean is None else block - mean]), mode="r")
        yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary())], names=["r"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, width))
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                held = np.linalg.qr(np.vstack([held, np.frombuffer(packed).reshape(-1, width)]), mode="r")
        yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary())], names=["r"])

    parts = df.select(vectors.lean(F.col("x")).alias("x")).mapInArrow(factor, "r binary").repartition(MEETINGS)
    rows = parts.mapInArrow(join, "r binary").collect()
    return np.linalg.qr(np.vstack([np.frombuffer(row["r"]).reshape(-1, width) for row in rows]), mode="r")


def apply_gram(df: DataFrame, basis: np.ndarray | None, mean: np.ndarray | None, width: int) -> np.ndarray:
    """``(X - mean)' (X - mean) basis``, or without a basis the matrix itself, in one pass.

    Each task sums its rows; the sums meet in ``MEETINGS`` tasks before the driver adds up as many.
    """
    columns = width if basis is None else basis.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, columns))
        for batch in batches:
            for block in geometry._blocks(batch.column(0), width):
                block = block if mean is None else block - mean
                total += block.T @ (block if basis is None else block @ basis)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * columns)
        for batch in batches:
            for part in batch.column(0).to_pylist():
                total += np.frombuffer(part)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    parts = df.select(vectors.lean(F.col("x")).alias("x")).mapInArrow(add, "part binary").repartition(MEETINGS)
    rows = parts.mapInArrow(meet, "part binary").collect()
    return sum(np.frombuffer(row["part"]) for row in rows).reshape(width, columns)


def fixed_signs(directions: np.ndarray) -> np.ndarray:
    """Each direction with its largest entry positive."""
    largest = directions[np.abs(directions).argmax(axis=0), np.arange(directions.shape[1])]
    return directions * np.where(largest < 0, -1.0, 1.0)


class PCATableModel(TableModel):
    """Appends the projection."""

    @classmethod
    def of(cls, directions: np.ndarray, mean: np.ndarray | None, projection: str = "projection"):
        model = cls()
        model.arrays["directions"] = directions
        if mean is not None:
            model.arrays["mean"] = mean.reshape(1, -1)
        model.facts["projection"] = projection
        return model

    def outputs(self) -> dict[str, T.DataType]:
        return {self.facts["projection"]: VectorUDT()}

    def predict(self, df: DataFrame):
        mean = self.arrays["mean"][0] if "mean" in self.arrays else None
        column = geometry.project(F.col(self.getOrDefault("featuresCol")), self.arrays["directions"], mean)
        return df, {self.facts["projection"]: column}


