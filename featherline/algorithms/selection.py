"""Training several candidates side by side and keeping the best on held-out rows."""

from __future__ import annotations

from collections.abc import Callable
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Params
from pyspark.ml.tuning import TrainValidationSplit
from pyspark.sql import DataFrame


class CallableEvaluator(Evaluator):
    """Rates a scored table by a function that gives a number."""

    def __init__(self, rate: Callable[[DataFrame], float], larger_better: bool = True) -> None:
        super().__init__()
        self.rate, self.larger_better = rate, larger_better

    def _evaluate(self, dataset: DataFrame) -> float:
        return float(self.rate(dataset))

    def isLargerBetter(self) -> bool:
        return self.larger_better


def select_model(estimator: Any, grid: list[dict[str, Any]], df: DataFrame, rate: Callable[[DataFrame], float],
                 larger_better: bool = True, parallelism: int = 4, train_share: float = 0.8, seed: int = 0):
    """Spark's train-validation split over a grid of params given by name; the model and all ratings."""
    maps = [{estimator.getParam(name): value for name, value in candidate.items()} for candidate in grid]
    split = TrainValidationSplit(
        estimator=estimator, estimatorParamMaps=maps, evaluator=CallableEvaluator(rate, larger_better),
        parallelism=parallelism, trainRatio=train_share, seed=seed)
    fitted = split.fit(df)
    return fitted.bestModel, fitted.validationMetrics


def choose(stage: Params, grid: list[dict[str, Any]], df: DataFrame, rate: Callable[[Any, DataFrame], float], seed: int,
           parallelism: int = 4):
    """The best of a grid on a fifth of the rows, refitted on all; a grid of one is just fitted."""
    if len(grid) == 1:
        return stage.copy({stage.getParam(k): v for k, v in grid[0].items()}).fit(df)
    train, held = df.randomSplit([0.8, 0.2], seed)
    train, held = train.persist(), held.persist()
    try:
        maps = [{stage.getParam(k): v for k, v in candidate.items()} for candidate in grid]
        rated = [None] * len(maps)
        for index, model in _in_parallel(stage, train, maps, parallelism):
            rated[index] = rate(model, held)
    finally:
        train.unpersist()
        held.unpersist()
    best = max(range(len(maps)), key=lambda i: rated[i])
    return stage.copy(maps[best]).fit(df)


def _in_parallel(stage, df, maps, parallelism):
    with ThreadPool(min(parallelism, len(maps))) as pool:
        yield from pool.imap_unordered(lambda item: (item[0], stage.copy(item[1]).fit(df)), enumerate(maps))
