"""k-means: Spark's Lloyd iterations, best of several starts, or mini-batches with surplus centers."""

from __future__ import annotations

from collections.abc import Iterator
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F, types as T

from featherline.algorithms import geometry, repeated
from featherline.algorithms.base import TableEstimator, TableModel, scratch_name
from featherline.algorithms.params import choice, declare, listed, real, whole, words_or
from featherline.functions import vectors
from featherline.operators.evaluation import evaluate
from featherline.workspace import written

# Spark's names of the ways to start (fixed values).
INIT_MODES = {"random": "random", "kmeans++": "k-means||"}


#: Rows per center that the starts of mini-batches are chosen from.
START_ROWS = 20


def start_centers(x: np.ndarray, count: int, spread: bool, seed: int) -> np.ndarray:
    """As many rows of ``x`` as centers, or all: at random, or each with a chance that follows its squared distance from those before."""
    chance = np.random.default_rng(seed)
    if len(x) <= count:
        return x
    if not spread:
        return x[np.sort(chance.permutation(len(x))[:count])]
    chosen = [int(chance.integers(len(x)))]
    far = ((x - x[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < count and far.sum() > 0:
        chosen.append(int(chance.choice(len(x), p=far / far.sum())))
        far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return x[chosen]


class KMeansTable(TableEstimator):
    """Clusters a feature table.

    With ``extra_center_factor`` above 1, rows are passed ``epochs`` times in mini-batches: every task moves its own copy of
    that many times more centers, each a running mean of the rows nearest to it when they came, in which rows weigh half after
    ``half_life_time_size`` later ones (0 for never). The tasks' centers are few weighted rows in place of the table: between passes they are
    clustered into the centers of the next, and after the last down to ``k`` from starts of ``local_lloyd_init_method``; one more pass takes the means of the
    rows nearest to those. Otherwise all rows are clustered by Lloyd's
    iterations. ``init_method`` says where the first clustering of the rows starts; mini-batches start on ``START_ROWS`` rows per center, chosen by hash.
    """

    required = ("k", "feature_dim", "mini_batch_size")
    assumed = {"init_method": "random", "local_lloyd_max_iter": 300, "local_lloyd_tol": 0.0001,
               "local_lloyd_num_trials": "auto", "local_lloyd_init_method": "kmeans++", "half_life_time_size": 0,
               "epochs": 1, "extra_center_factor": "auto", "eval_metrics": ["msd"], "seed": 0}

    k = declare("k", "number of clusters", whole(2))
    feature_dim = declare("feature_dim", "size of the vectors", whole(1))
    mini_batch_size = declare("mini_batch_size", "rows that a task takes up at a time, with surplus centers", whole(1))
    init_method = declare("init_method", "how the first centers are chosen", choice("random", "kmeans++"))
    local_lloyd_max_iter = declare("local_lloyd_max_iter", "most iterations", whole(1))
    local_lloyd_tol = declare("local_lloyd_tol", "movement below which iterations stop", real(0, 1))
    local_lloyd_num_trials = declare("local_lloyd_num_trials", "starts to choose the best of", words_or(whole(1), "auto"))
    local_lloyd_init_method = declare("local_lloyd_init_method", "how each start is chosen", choice("random", "kmeans++"))
    half_life_time_size = declare("half_life_time_size", "rows after which a row counts half; 0 for never", whole(0))
    epochs = declare("epochs", "passes over the data", whole(1))
    extra_center_factor = declare("extra_center_factor", "surplus centers per cluster", words_or(whole(1), "auto"))
    eval_metrics = declare("eval_metrics", "losses to report", listed("msd", "ssd"))
    seed = declare("seed", "random seed", whole())

    def _preset(self) -> None:
        self._setDefault(mini_batch_size=5000)

    def _lloyd(self, df: DataFrame, k: int, init: str, trials: int, weight: str | None = None,
               passes: int | None = None) -> KMeansModel:
        def fit(trial: int) -> KMeansModel:
            stage = KMeans(k=k, featuresCol=self.getOrDefault("featuresCol"), initMode=INIT_MODES[init],
                           maxIter=self.setting("local_lloyd_max_iter") if passes is None else passes, tol=self.setting("local_lloyd_tol"),
                           seed=self.setting("seed") + trial)
            return (stage.setWeightCol(weight) if weight else stage).fit(df)

        # Trials run side by side over one copy of the rows; the first of equals is kept.
        df = df.persist()
        try:
            with ThreadPool(min(trials, 4)) as pool:
                models = pool.map(fit, range(trials))
        finally:
            df.unpersist()
        return min(models, key=lambda model: model.summary.trainingCost)

    def _train(self, df: DataFrame) -> KMeansTableModel:
        features = self.getOrDefault("featuresCol")
        slim = df.select(features)
        count = self.setting("local_lloyd_num_trials")
        trials = 1 if count == "auto" else int(count)
        factor = self.setting("extra_center_factor")
        k, init = self.getOrDefault("k"), self.setting("init_method")
        lloyd = factor == "auto" or int(factor) == 1
        # Equal rows are one with a weight, except where rows weigh less the longer ago they came.
        many = scratch_name("rows")
        once = repeated.gathered(slim, [features], many) if lloyd or not self.setting("half_life_time_size") else None
        slim = slim.withColumn(many, F.lit(1.0)) if once is None else written(once, "gathered")
        if lloyd:
            fitted = self._lloyd(slim, k, init, trials, None if once is None else many)
        else:
            centers = self._surplus(slim, k * int(factor), init, many)
            fitted = self._lloyd(centers.select(vectors.from_array("center").alias(features), "weight"),
                                 k, self.setting("local_lloyd_init_method"), trials, "weight")
        found = np.array(fitted.clusterCenters())
        if not lloyd:
            # A last pass takes the means of the rows themselves.
            for row in lloyd_step(slim, found, features, many).collect():
                found[int(row["cluster"])] = row["center"].toArray()
        return KMeansTableModel.of(found)

    def _surplus(self, df: DataFrame, count: int, init: str, many: str) -> DataFrame:
        """Weighted centers (``center, weight``) that stand for the rows, a few per task, after passes in mini-batches."""
        features, size, half_life = self.getOrDefault("featuresCol"), self.getOrDefault("mini_batch_size"), self.setting("half_life_time_size")
        rows = df.select(vectors.lean(F.col(features)).alias("x"), many)
        sample = df.orderBy(F.xxhash64(F.lit(self.setting("seed")), F.unwrap_udt(features))).limit(count * START_ROWS).select(
            vectors.to_array(features).alias("x")).toArrow().column("x")
        centers = start_centers(vectors.to_matrix(sample.combine_chunks()), count, init == "kmeans++", self.setting("seed"))
        for step in range(self.setting("epochs")):
            def move(batches: Iterator[pa.RecordBatch], centers=centers) -> Iterator[pa.RecordBatch]:
                own, weight = centers.copy(), np.zeros(len(centers))
                for batch in batches:
                    for begin in range(0, batch.num_rows, size):
                        x = vectors.to_matrix(batch.column(0).slice(begin, size), own.shape[1])
                        w = batch.column(1).slice(begin, size).to_numpy(zero_copy_only=False)
                        nearest = ((own ** 2).sum(axis=1) - 2 * (x @ own.T)).argmin(axis=1)
                        held = np.bincount(nearest, w, len(own))
                        sums = np.zeros_like(own)
                        np.add.at(sums, nearest, x * w[:, None])
                        if half_life:
                            weight *= 0.5 ** (len(x) / half_life)
                        some = held > 0
                        own[some] = (own[some] * weight[some, None] + sums[some]) / (weight + held)[some, None]
                        weight += held
                kept = weight > 0
                yield pa.RecordBatch.from_arrays([pa.array(list(own[kept]), pa.list_(pa.float64())), pa.array(weight[kept])], names=["center", "weight"])

            found = written(rows.mapInArrow(move, "center array<double>, weight double"), "surplus-centers")
            if step + 1 < self.setting("epochs"):
                vectors_of = found.select(vectors.from_array("center").alias(features), "weight")
                centers = np.array(self._lloyd(vectors_of, count, self.setting("local_lloyd_init_method"), 1, "weight").clusterCenters())
        return found


    def evaluate(self, model: KMeansTableModel, df: DataFrame) -> dict[str, float]:
        """The losses of ``eval_metrics`` on a table."""
        return evaluate(model.transform(df), self.setting("eval_metrics"), prediction=model.facts["distance"])


class KMeansTableModel(TableModel):
    """Appends the closest center's number and its Euclidean distance."""

    @classmethod
    def of(cls, centers: np.ndarray, distance: str = "distance_to_cluster", cluster: str = "closest_cluster"):
        model = cls()
        model.arrays["centers"] = centers
        model.facts.update(distance=distance, cluster=cluster)
        return model

    def outputs(self) -> dict[str, T.DataType]:
        return {self.facts["distance"]: T.DoubleType(), self.facts["cluster"]: T.DoubleType()}

    def predict(self, df: DataFrame):
        found = "_nearest"
        scored = df.withColumn(found, geometry.nearest(F.col(self.getOrDefault("featuresCol")), self.arrays["centers"]))
        return scored, {self.facts["distance"]: F.col(f"{found}.distance"), self.facts["cluster"]: F.col(f"{found}.cluster")}


def lloyd_step(df: DataFrame, centers: np.ndarray, features: str = "features", weight: str | None = None) -> DataFrame:
    """New centers as the means of the rows closest to the old ones; ``cluster, n, center``. With a ``weight`` a row counts so often."""
    assigned = df.select(F.col(features).alias("x"), geometry.nearest(F.col(features), centers)["cluster"].alias("cluster"),
                         (F.lit(1.0) if weight is None else F.col(weight)).alias("w"))
    return assigned.groupBy("cluster").agg(
        F.sum("w").cast("long").alias("n"), Summarizer.mean(F.col("x"), F.col("w")).alias("center"))


def label_means(df: DataFrame, label: str, features: str = "features") -> DataFrame:
    """The mean vector of each label, as ``cluster, center`` rows."""
    return df.groupBy(F.col(label).alias("cluster")).agg(Summarizer.mean(F.col(features)).alias("center"))
