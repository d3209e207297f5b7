"""k-means over a stream, where old rows count less."""

from __future__ import annotations

from typing import Any

import numpy as np
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from featherline.algorithms import geometry

STATE = (
    T.StructType()
    .add("cluster", T.LongType())
    .add("center", T.ArrayType(T.DoubleType()))
    .add("weight", T.DoubleType())
)


class DecayedKMeans:
    """Centers that move with each batch of a stream.

    A batch's rows go to their closest center; sums per center are taken on executors. The old
    weight of a center is halved for every ``half_life`` rows seen (0 never halves). Centers after batch
    ``n`` are written below ``state_path``, so that a restarted or replayed batch starts from the
    same ones and writes the same result.
    """

    def __init__(self, spark: SparkSession, state_path: str, centers: np.ndarray, half_life: int = 0,
                 features: str = "features") -> None:
        if half_life < 0:
            raise ValueError("half_life must not be negative")
        self.spark, self.state_path, self.half_life, self.features = spark, state_path.rstrip("/"), half_life, features
        self.first = np.asarray(centers, float)

    def _path(self, batch: int) -> str:
        return f"{self.state_path}/batch={batch:010d}"

    def state(self, batch: int) -> tuple[np.ndarray, np.ndarray]:
        """Centers and weights after a batch; before the first, the given centers without weight."""
        if batch < 0:
            return self.first, np.zeros(len(self.first))
        rows = self.spark.read.schema(STATE).parquet(self._path(batch)).orderBy("cluster").collect()
        return np.array([r["center"] for r in rows]), np.array([r["weight"] for r in rows])

    def update(self, batch_df: DataFrame, batch: int) -> None:
        """Take one batch in."""
        centers, weight = self.state(batch - 1)
        column = F.col(self.features)
        assigned = batch_df.select(column.alias("x"), geometry.nearest(column, centers)["cluster"].alias("cluster"))
        means = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), Summarizer.mean(F.col("x")).alias("mean"))
        # At most one row per center comes back.
        found = {int(r["cluster"]): (r["n"], r["mean"].toArray()) for r in means.collect()}
        seen = sum(n for n, _ in found.values())
        weight = weight * (0.5 ** (seen / self.half_life) if self.half_life else 1.0)
        rows = []
        for cluster, center in enumerate(centers):
            count, mean = found.get(cluster, (0, center))
            total = weight[cluster] + count
            moved = (center * weight[cluster] + mean * count) / total if total else center
            rows.append((cluster, moved.tolist(), float(total)))
        self.spark.createDataFrame(rows, STATE).coalesce(1).write.mode("overwrite").parquet(self._path(batch))

    def start(self, stream: DataFrame, checkpoint: str, **trigger: Any) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(self.update).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()
