"""Metrics by name, as estimators list them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from featherline.operators import curves, metrics, ranking

# Names of metrics; those with a cut take a number after "@" (fixed values).
REGRESSION = ("rmse", "mae")
CLUSTERING = ("msd", "ssd")


def evaluate(df: DataFrame, names: Sequence[str], label: str = "label", prediction: str = "prediction",
             query: str | None = None, key: str | None = None) -> dict[str, float]:
    """The named metrics of a scored table. Ranking metrics need the query and key of a row."""
    found: dict[str, float] = {}
    thresholds = {n: float(n.partition("@")[2] or 0.5) for n in names if n.split("@")[0] == "error"}
    if thresholds:
        rows = metrics.errors_at(df, list(thresholds.values()), label, prediction).collect()
        by_threshold = {r["threshold"]: r["error"] for r in rows}
        found.update({n: by_threshold[t] for n, t in thresholds.items()})
    if any(n in REGRESSION for n in names):
        found.update(metrics.regression_errors(df, label, prediction).first().asDict())
    if any(n in CLUSTERING for n in names):
        found.update(metrics.clustering_loss(df, prediction).first().asDict())
    for name in names:
        if name == "logloss":
            found[name] = metrics.log_losses(df, label, prediction).first()["logloss"]
        elif name == "mlogloss":
            shares = df.select(label, vector_to_array(F.col(prediction)).alias("_shares"))
            found[name] = metrics.multiclass_log_losses(shares, label, "_shares").first()["mlogloss"]
        elif name == "merror":
            found[name] = metrics.multiclass_metrics(df, label, prediction).first()["merror"]
        elif name == "auc":
            found[name] = curves.auc(df, label, prediction).first()["auc"]
        elif name.startswith(("ndcg", "map")):
            if query is None or key is None:
                raise ValueError(f"{name} needs the query and key of a row")
            found[name] = ranking.ranking_metric(df, name, query, label, prediction, key).first()[name]
    unknown = [n for n in names if n not in found]
    if unknown:
        raise ValueError(f"unknown metrics {unknown}")
    return {name: found[name] for name in names}
