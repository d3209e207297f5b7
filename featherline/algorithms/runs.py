"""A table of training runs, and models found again through it."""

from __future__ import annotations

import datetime
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from featherline.algorithms.base import attach

# Outcomes of a run (fixed values), and those that leave a model to attach.
COMPLETED, STOPPED, FAILED = "Completed", "Stopped", "Failed"
USABLE = (COMPLETED, STOPPED)
SCHEMA = (
    T.StructType()
    .add("run", T.StringType(), False)
    .add("status", T.StringType(), False)
    .add("params", T.MapType(T.StringType(), T.StringType()))
    .add("model_path", T.StringType())
    .add("metrics", T.MapType(T.StringType(), T.DoubleType()))
    .add("ts", T.TimestampType())
)


class RunTable:
    """Runs as rows appended to a Parquet folder; the last row of a run counts."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def record(self, run: str, status: str, params: dict[str, str], model_path: str | None = None,
               metrics: dict[str, float] | None = None) -> None:
        row = (run, status, params, model_path, metrics or {}, datetime.datetime.now(datetime.timezone.utc))
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def fit(self, estimator: Any, df: DataFrame, model_root: str, run: str | None = None,
            params: dict[str, str] | None = None, validation: DataFrame | None = None) -> tuple[str, Any]:
        """Train, save the model below ``model_root``, and record how it went.

        With a ``validation`` table, the estimator's own metrics on it are recorded too.
        """
        run = run or f"run-{uuid.uuid4().hex[:12]}"
        values = estimator.hyperparameters(params)
        try:
            model = estimator.fit(df)
            path = f"{model_root.rstrip('/')}/{run}"
            model.write().save(path)
            metrics = estimator.evaluate(model, validation) if validation is not None else None
        except Exception:
            self.record(run, FAILED, values)
            raise
        self.record(run, COMPLETED, values, path, metrics)
        return run, model

    def attach(self, run: str) -> Any:
        """The model of a run that completed or was stopped."""
        last = self.rows().filter(F.col("run") == run).orderBy(F.col("ts").desc()).limit(1).collect()
        if not last:
            raise ValueError(f"no run {run}")
        if last[0]["status"] not in USABLE or not last[0]["model_path"]:
            raise ValueError(f"run {run} is {last[0]['status']} and has no model to attach")
        return attach(self.spark, last[0]["model_path"])
