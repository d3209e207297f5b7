"""Boosted trees and their linear stand-ins, by objective."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier, LogisticRegression, OneVsRest, OneVsRestModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from featherline.algorithms import repeated, trees
from featherline.algorithms.base import TableEstimator, TableModel, scratch_name
from featherline.algorithms.params import choice, declare, matching, real, text, whole
from featherline.functions import vectors
from featherline.operators.evaluation import evaluate
from featherline.operators.ranking import training_pairs
from featherline.workspace import written

OBJECTIVES = ("reg:linear", "reg:logistic", "binary:logistic", "binary:logistraw", "count:poisson", "multi:softmax",
              "multi:softprob", "rank:pairwise", "reg:gamma", "reg:tweedie")
# Names of metrics (fixed values). Some take a threshold or a cut after "@", rankings a "-" at the end.
METRICS = ("rmse", "mae", "logloss", "error", "merror", "mlogloss", "auc", "ndcg", "map")
SUFFIXES = {"error": r"(@\d*\.?\d+)?", "ndcg": r"(@\d+)?-?", "map": r"(@\d+)?-?"}
BINARY = ("reg:logistic", "binary:logistic", "binary:logistraw")
MULTI = ("multi:softmax", "multi:softprob")
# Distribution of each count or positive objective (fixed values).
FAMILIES = {"count:poisson": "poisson", "reg:gamma": "gamma", "reg:tweedie": "tweedie"}
#: A round of less gain on the held-out rows, as a share of their loss, is the last.
PATIENCE_SHARE = 0.001


class BoostedTable(TableEstimator):
    """One prediction column under an objective.

    Trees are grown on histograms of the loss's slopes and curvatures (``trees.py``), a tree per class and round on the shared
    softmax for several classes, from one pair a row for ``rank:pairwise``. ``dart`` drops trees while others grow. With
    ``grower`` set to ``ml`` Spark's own boosted trees serve the squared, logistic and class
    objectives, one against the rest. ``gblinear`` uses linear models throughout:
    generalized ones with a log link, and one of differences within queries for ``rank:pairwise``.

    ``base_score`` is a prediction (a mean, a probability, a score), from which margins start. Rows of ``validationCol`` are not trained on: growing
    stops at the first round that does not lower their mean loss by ``PATIENCE_SHARE`` of it, and the rounds up to the best stay.
    """

    labeled = True
    required = ("num_round",)
    assumed = {"booster": "gbtree", "eta": 0.3, "gamma": 0.0, "max_depth": 6, "min_child_weight": 1.0, "subsample": 1.0,
               "colsample_bytree": 1.0, "colsample_bylevel": 1.0, "lambda": 1.0, "scale_pos_weight": 1.0, "max_bin": 256,
               "tweedie_variance_power": 1.5, "objective": "reg:linear", "seed": 0, "alpha": 0.0, "base_score": 0.5, "rate_drop": 0.0, "skip_drop": 0.0,
               "one_drop": 0, "sample_type": "uniform", "normalize_type": "tree", "grower": "histogram"}
    wiring = (*TableEstimator.wiring, "queryCol", "keyCol", "validationCol", "grower")

    num_round = declare("num_round", "trees to grow", whole(1))
    booster = declare("booster", "trees or linear", choice("gbtree", "gblinear", "dart"))
    eta = declare("eta", "shrinkage of each tree", real(0, 1))
    gamma = declare("gamma", "least gain of a split", real(0))
    max_depth = declare("max_depth", "depth of a tree", whole(0))
    min_child_weight = declare("min_child_weight", "least weight of a leaf", real(0))
    subsample = declare("subsample", "share of rows per tree", real(0, 1, above=True))
    colsample_bytree = declare("colsample_bytree", "share of columns per tree", real(0, 1, above=True))
    colsample_bylevel = declare("colsample_bylevel", "share of columns per split", real(0, 1, above=True))
    alpha = declare("alpha", "weight of the absolute penalty, for trees", real(0))
    max_delta_step = declare("max_delta_step", "largest step of a leaf, 0 for any", real(0))
    base_score = declare("base_score", "prediction to start from", real())
    rate_drop = declare("rate_drop", "share of trees that dart drops", real(0, 1))
    skip_drop = declare("skip_drop", "chance that a round of dart drops nothing", real(0, 1))
    one_drop = declare("one_drop", "whether a round of dart drops one tree at least", whole(0, 1))
    sample_type = declare("sample_type", "whether trees of dart drop evenly or by weight", choice("uniform", "weighted"))
    normalize_type = declare("normalize_type", "whether a new tree of dart weighs as a dropped one or as all", choice("tree", "forest"))
    grower = declare("grower", "what grows trees: histogram, or ml for Spark's own", choice("histogram", "ml"))
    scale_pos_weight = declare("scale_pos_weight", "weight of positive rows", real())
    max_bin = declare("max_bin", "bins per column", whole(1))
    tweedie_variance_power = declare("tweedie_variance_power", "power of the variance", real(1, 2, above=True, below=True))
    objective = declare("objective", "what to learn",
                        choice(*OBJECTIVES, either={"binary:logitraw": "binary:logistraw"}))
    num_class = declare("num_class", "number of classes", whole(1))
    eval_metric = declare("eval_metric", "metrics to report", matching("|".join(name + SUFFIXES.get(name, "") for name in METRICS)))
    seed = declare("seed", "random seed", whole())
    feature_dim = declare("feature_dim", "size of the vectors, checked when given", whole(1))
    queryCol = declare("queryCol", "query of a row, for ranking", text)
    keyCol = declare("keyCol", "key of a row, for ranking", text)
    validationCol = declare("validationCol", "boolean column of rows that stop the growing of trees", text)

    def _classes(self) -> int | None:
        objective = self.setting("objective")
        if objective in BINARY:
            return 2
        return self.getOrDefault("num_class") if objective in MULTI and self.isDefined("num_class") else None

    def evaluate(self, model: BoostedModel, df: DataFrame) -> dict[str, float]:
        """The metrics of ``eval_metric`` on a table."""
        names = self.setting("eval_metric") or []
        columns = {name: self.getOrDefault(f"{name}Col") for name in ("query", "key") if self.isDefined(f"{name}Col")}
        return evaluate(model.transform(df), names, self.getOrDefault("labelCol"), model.facts["prediction"], **columns)

    def transformSchema(self, schema: T.StructType) -> T.StructType:
        ml = self.setting("grower") == "ml"
        if ml and self.setting("booster") == "dart":
            raise ValueError("Spark's trees are not dropped")
        if ml and (self.setting("objective") in FAMILIES or self.setting("objective") == "rank:pairwise"):
            raise ValueError("Spark's trees have no such objective")
        if not 0 < self.setting("eta"):
            raise ValueError("eta must be above 0")
        if ml and self.setting("max_depth") > 30:
            raise ValueError("Spark's trees are at most 30 deep")
        if self.setting("objective") == "rank:pairwise" and self.isDefined("validationCol"):
            raise ValueError("a ranking has no rows that stop it")
        if self.setting("max_bin") < 2:
            raise ValueError("max_bin must be at least 2")
        if self.setting("objective") in MULTI and not self.isDefined("num_class"):
            raise ValueError("num_class is needed for several classes")
        if self.setting("objective") == "rank:pairwise" and not (self.isDefined("queryCol") and self.isDefined("keyCol")):
            raise ValueError("queryCol and keyCol are needed for ranking")
        return super().transformSchema(schema)

    def _trees(self, kind: type, df: DataFrame, weight: str | None):
        """Tree params by their Spark names."""
        share = self.setting("colsample_bytree") * self.setting("colsample_bylevel")
        stage = kind(
            featuresCol=self.getOrDefault("featuresCol"), labelCol=self.getOrDefault("labelCol"),
            maxIter=self.getOrDefault("num_round"), maxDepth=self.setting("max_depth"),
            maxBins=self.setting("max_bin"), stepSize=self.setting("eta"),
            minInfoGain=self.setting("gamma"), subsamplingRate=self.setting("subsample"),
            featureSubsetStrategy="all" if share == 1.0 else str(share), seed=self.setting("seed"))
        if self.setting("min_child_weight") > 1:
            total = df.agg(F.sum(weight) if weight else F.count(F.lit(1))).first()[0] or 0
            if 2 * self.setting("min_child_weight") >= total:
                raise ValueError(f"no split leaves a weight of {self.setting('min_child_weight')} on both sides of {total}")
            stage = stage.setMinWeightFractionPerNode(self.setting("min_child_weight") / total)
        if self.isDefined("validationCol"):
            stage = stage.setValidationIndicatorCol(self.getOrDefault("validationCol"))
        return stage.setWeightCol(weight) if weight else stage

    def _linear(self, kind: type, weight: str | None, **extra):
        stage = kind(featuresCol=self.getOrDefault("featuresCol"), labelCol=self.getOrDefault("labelCol"),
                     maxIter=self.getOrDefault("num_round"), **extra)
        return stage.setWeightCol(weight) if weight else stage

    def _train(self, df: DataFrame) -> BoostedModel:
        objective, trees = self.setting("objective"), self.setting("booster") != "gblinear"
        if trees and self.setting("grower") == "histogram":
            return self._forest(df)
        features, label = self.getOrDefault("featuresCol"), self.getOrDefault("labelCol")
        extra = [self.getOrDefault(c) for c in ("queryCol", "keyCol", "validationCol") if self.isDefined(c)]
        slim, weight = df.select(features, label, *extra), None
        if objective in BINARY and self.setting("scale_pos_weight") != 1.0:
            weight = scratch_name("weight")
            slim = slim.withColumn(weight, F.when(F.col(label) == 1, self.setting("scale_pos_weight")).otherwise(1.0))
        # Linear models are penalised only where that is asked for.
        penalty = {"regParam": self.getOrDefault("lambda") if self.isDefined("lambda") else 0.0}
        if objective == "reg:linear":
            stage = self._trees(GBTRegressor, slim, weight) if trees else self._linear(LinearRegression, weight, **penalty)
        elif objective in BINARY:
            stage = self._trees(GBTClassifier, slim, weight) if trees else self._linear(LogisticRegression, weight, **penalty)
        elif objective in MULTI:
            inner = self._trees(GBTClassifier, slim, None) if trees else self._linear(LogisticRegression, None, **penalty)
            stage = OneVsRest(classifier=inner, featuresCol=features, labelCol=label, parallelism=4)
        elif objective in FAMILIES:
            family = FAMILIES[objective]
            # The variance power and the log link (link power 0) of a Tweedie model have their own names.
            link = {"variancePower": self.setting("tweedie_variance_power"), "linkPower": 0.0} if family == "tweedie" else {"link": "log"}
            stage = self._linear(GeneralizedLinearRegression, None, family=family, tol=1e-9, **link, **penalty)
        else:
            return self._ranker(slim, penalty)
        model = BoostedModel()
        model.stages["boosted"] = stage.fit(slim)
        model.facts.update(prediction="prediction", objective=objective)
        if objective in MULTI:
            model.facts["classes"] = self.getOrDefault("num_class")
        return model

    def _start(self) -> float:
        """The margin that gives ``base_score``."""
        base, objective = self.setting("base_score"), self.setting("objective")
        if objective in BINARY:
            if not 0 < base < 1:
                raise ValueError("base_score is a probability for this objective")
            return float(np.log(base / (1 - base)))
        if objective in FAMILIES:
            if base <= 0:
                raise ValueError("base_score is above 0 for this objective")
            return float(np.log(base))
        return base

    def _forest(self, df: DataFrame) -> BoostedModel:
        """Trees on histograms, a round at a time."""
        objective, features, label = self.setting("objective"), self.getOrDefault("featuresCol"), self.getOrDefault("labelCol")
        ranking = objective == "rank:pairwise"
        # The curvature of counts is taken a little ahead, so their steps are bounded unless that is switched off.
        bound = self.getOrDefault("max_delta_step") if self.isDefined("max_delta_step") else 0.7 if objective == "count:poisson" else 0.0
        settings = trees.Settings(
            rounds=self.getOrDefault("num_round"), classes=self.getOrDefault("num_class") if objective in MULTI else 1, eta=self.setting("eta"),
            gamma=self.setting("gamma"), depth=self.setting("max_depth"), least_weight=self.setting("min_child_weight"), ridge=self.setting("lambda"),
            lasso=self.setting("alpha"), largest_step=bound, subsample=self.setting("subsample"), by_tree=self.setting("colsample_bytree"),
            by_level=self.setting("colsample_bylevel"), bins=self.setting("max_bin"), seed=self.setting("seed"), start=self._start(),
            dart={name: self.setting(name) for name in ("rate_drop", "skip_drop", "one_drop", "sample_type", "normalize_type")} if self.setting("booster") == "dart" else {})
        width = self.getOrDefault("feature_dim") if self.isDefined("feature_dim") else (df.select(vectors.vector_size(F.col(features))).first() or [0])[0]
        columns = {"label": F.col(label).cast("double"), "weight": F.lit(1.0),
                   "key": (F.col(self.getOrDefault("keyCol")) if self.isDefined("keyCol") else F.monotonically_increasing_id()).cast("string"),
                   "held_out": F.coalesce(F.col(self.getOrDefault("validationCol")), F.lit(False)) if self.isDefined("validationCol") else F.lit(False)}
        if ranking:
            columns["query"] = F.col(self.getOrDefault("queryCol"))
        slopes = slopes_of(objective, self.setting("scale_pos_weight"), self.setting("tweedie_variance_power"), bound)
        # Rows of equal features are one with their mean label where slopes are linear in it and curvatures without it, else those of equal labels too.
        if not ranking and settings.subsample >= 1 and not self.isDefined("validationCol"):
            name, total = scratch_name("rows"), scratch_name("total")
            linear = objective == "reg:linear"
            once = repeated.gathered(df, [features] if linear else [features, label], name, **({total: F.coalesce(F.col(label).cast("double"), F.lit(float("nan")))} if linear else {}))
            if once is not None:
                df = written(once.select(features, (F.col(total) / F.col(name) if linear else F.col(label)).alias(label), name), "gathered")
                columns.update(label=F.col(label).cast("double"), weight=F.col(name))
        forest = trees.Forest(df, features, columns, width, settings)
        try:
            best, kept, weights = None, settings.rounds, None
            for number in range(settings.rounds):
                forest.round(*((None, pair_slopes(forest.rows)) if ranking else (slopes, None)))
                if self.isDefined("validationCol"):
                    loss = held_out_loss(forest.rows, objective, settings.classes, self.setting("tweedie_variance_power"))
                    if best is not None and not loss < best - PATIENCE_SHARE * abs(best):
                        kept = number  # this round was none too many, but no better
                        break
                    best, weights = loss, list(forest.weights)
        finally:
            forest.close()
        model = BoostedModel()
        model.arrays["nodes"] = trees.table_of(forest.trees[:kept], forest.cuts)
        model.arrays["weights"] = np.array((weights or forest.weights)[:kept], float)[:, None]
        model.facts.update(prediction="prediction", objective=objective, start=settings.start, classes=settings.classes, width=width, rounds=min(kept, len(forest.trees)))
        return model

    def _ranker(self, df: DataFrame, penalty: dict) -> BoostedModel:
        """Logistic regression without intercept on differences of paired rows, both ways round."""
        features, label = self.getOrDefault("featuresCol"), self.getOrDefault("labelCol")
        query, key = self.getOrDefault("queryCol"), self.getOrDefault("keyCol")
        arrays = df.select(query, key, label, vectors.to_array(features).alias("x"))
        pairs = training_pairs(arrays, query, label, key, ["x"])
        better = F.zip_with("x_high", "x_low", lambda a, b: a - b)
        worse = F.zip_with("x_high", "x_low", lambda a, b: b - a)
        both = pairs.select(F.explode(F.array(
            F.struct(better.alias("d"), F.lit(1.0).alias(label)), F.struct(worse.alias("d"), F.lit(0.0).alias(label)),
        )).alias("s")).select(array_to_vector("s.d").alias(features), f"s.{label}")
        stage = LogisticRegression(featuresCol=features, labelCol=label, fitIntercept=False,
                                   maxIter=self.getOrDefault("num_round"), **penalty)
        model = BoostedModel()
        model.stages["boosted"] = stage.fit(both)
        model.facts.update(prediction="prediction", objective="rank:pairwise")
        return model


# "lambda" is a word of the language, so this param is added by name.
setattr(BoostedTable, "lambda", declare("lambda", "weight of the squared penalty", real()))
BoostedTable.setLambda = lambda self, value: self._set(**{"lambda": value})
BoostedTable.getLambda = lambda self: self.getOrDefault("lambda")


def slopes_of(objective: str, positive: float, power: float, bound: float) -> trees.Slopes:
    """Slope and curvature of an objective's loss, per class."""

    def find(margin: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if objective in MULTI:
            p = np.exp(margin - margin.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            return (p - (np.arange(margin.shape[1]) == y[:, None])) * w[:, None], np.maximum(2 * p * (1 - p), 1e-16) * w[:, None]
        f = margin[:, 0]
        if objective == "reg:linear":
            g, h = f - y, np.ones(len(f))
        elif objective in BINARY:
            p = 1 / (1 + np.exp(-f))
            w = np.where(y == 1, positive, 1.0) * w
            g, h = p - y, np.maximum(p * (1 - p), 1e-16)
        elif objective == "count:poisson":
            g, h = np.exp(f) - y, np.exp(f + bound)
        elif objective == "reg:gamma":
            g, h = 1 - y * np.exp(-f), y * np.exp(-f)
        else:
            a, b = y * np.exp((1 - power) * f), np.exp((2 - power) * f)
            g, h = b - a, (2 - power) * b - (1 - power) * a
        return (g * w)[:, None], (h * w)[:, None]

    return find


def pair_slopes(rows: DataFrame) -> DataFrame:
    """Binned rows with ``g`` and ``h`` of the pairwise loss, from a less relevant partner per row; rows in no pair are left out."""
    placed = rows.where("NOT held_out").withColumn("f", F.col("margin")[0])
    pairs = training_pairs(placed, "query", "label", "key", ["f"])
    p = 1 / (1 + F.exp(F.col("f_high") - F.col("f_low")))
    sides = F.array(*[F.struct(F.col(f"key_{side}").alias("_key"), (sign * p).alias("g"), F.greatest(p * (1 - p), F.lit(1e-16)).alias("h"))
                      for side, sign in (("high", -1), ("low", 1))])
    sums = pairs.select(F.col("query").alias("_query"), F.inline(sides)).groupBy("_query", "_key").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    return rows.join(sums, F.col("query").eqNullSafe(F.col("_query")) & (F.col("key") == F.col("_key")))


def held_out_loss(rows: DataFrame, objective: str, classes: int, power: float) -> float:
    """Mean loss of the held-out rows at their margins; 0 without any."""
    y, f = F.col("label"), F.col("margin")[0]
    if objective in MULTI:
        top = F.array_max("margin")
        total = F.aggregate("margin", F.lit(0.0), lambda acc, m: acc + F.exp(m - top))
        loss = top + F.log(total) - F.get("margin", y.cast("int"))
    elif objective == "reg:linear":
        loss = (f - y) * (f - y)
    elif objective in BINARY:
        loss = F.greatest(f, F.lit(0.0)) + F.log1p(F.exp(-F.abs(f))) - y * f
    elif objective == "count:poisson":
        loss = F.exp(f) - y * f
    elif objective == "reg:gamma":
        loss = y * F.exp(-f) + f
    else:
        loss = F.exp((2 - power) * f) / (2 - power) - y * F.exp((1 - power) * f) / (1 - power)
    return rows.where("held_out").agg(F.avg(loss)).first()[0] or 0.0


class BoostedModel(TableModel):
    def nodes(self, spark: SparkSession) -> DataFrame:
        """The trees as rows: leaves with their values, and inner nodes with their cuts."""
        names = ("round", "class", "node", "feature", "threshold", "missing_left", "left", "right", "value", "gain", "cover")
        schema = ", ".join(f"{n} {'double' if n in ('threshold', 'value', 'gain', 'cover') else 'int'}" for n in names)
        rows = [[x if n in ("threshold", "value", "gain", "cover") else int(x) for n, x in zip(names, row)] for row in self.arrays["nodes"].tolist()]
        weights = spark.createDataFrame([(k, float(w)) for k, w in enumerate(self.arrays["weights"][:, 0])], "round int, weight double")
        return spark.createDataFrame(rows, schema).join(weights, "round")

    def _margins(self, features: Column) -> Column:
        nodes, weights = self.arrays["nodes"], self.arrays["weights"].reshape(-1)
        classes, start, width = self.facts["classes"], float(self.facts["start"]), self.facts["width"]

        @F.arrow_udf("array<double>")
        def find(column: pa.Array) -> pa.Array:
            return trees.Forest.listed(trees.margins(vectors.to_matrix(column, width), nodes, weights, classes, start))

        return find(vectors.lean(features))

    def outputs(self) -> dict[str, T.DataType]:
        several = self.facts["objective"] == "multi:softprob"
        return {self.facts["prediction"]: VectorUDT() if several else T.DoubleType()}

    def predict(self, df: DataFrame):
        objective = self.facts["objective"]
        if "nodes" in self.arrays:
            name = scratch_name("margin")
            m = F.col(name)[0]
            if objective in MULTI:
                powers = F.transform(name, lambda x: F.exp(x - F.array_max(name)))
                shares = F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda acc, v: acc + v))
                value = array_to_vector(shares) if objective == "multi:softprob" else (F.array_position(name, F.array_max(name)) - 1).cast("double")
            else:
                value = F.exp(m) if objective in FAMILIES else 1 / (1 + F.exp(-m)) if objective in ("reg:logistic", "binary:logistic") else m
            return df.withColumn(name, self._margins(F.col(self.getOrDefault("featuresCol")))), {self.facts["prediction"]: value}
        names = {n: scratch_name(n) for n in ("prediction", "probability", "raw")}
        stage = self.stages["boosted"].copy()
        if isinstance(stage, OneVsRestModel):
            # It reads its models' raw scores under their own names.
            stage.models = [m.copy().setRawPredictionCol(names["raw"]) for m in stage.models]
        stage.setFeaturesCol(self.getOrDefault("featuresCol")).setPredictionCol(names["prediction"])
        if hasattr(stage, "setProbabilityCol"):
            stage.setProbabilityCol(names["probability"])
        if hasattr(stage, "setRawPredictionCol"):
            stage.setRawPredictionCol(names["raw"])
        return stage.transform(df), {self.facts["prediction"]: self._prediction(objective, names)}

    def _prediction(self, objective: str, names: dict[str, str]) -> Column:
        if objective in ("reg:logistic", "binary:logistic"):
            return vector_to_array(F.col(names["probability"]))[1]
        if objective in ("binary:logistraw", "rank:pairwise"):
            return vector_to_array(F.col(names["raw"]))[1]
        if objective == "multi:softprob":
            # One model per class gives a margin; their probabilities are scaled to sum to 1.
            steep = 2.0 if "GBT" in type(self.stages["boosted"].models[0]).__name__ else 1.0
            own = F.transform(vector_to_array(F.col(names["raw"])), lambda m: 1 / (1 + F.exp(-steep * m)))
            total = F.aggregate(own, F.lit(0.0), lambda acc, p: acc + p)
            # A class that no row has comes after all that were seen.
            absent = F.greatest(F.lit(int(self.facts.get("classes", 0))) - F.size(own), F.lit(0))
            return array_to_vector(F.concat(F.transform(own, lambda p: p / total), F.array_repeat(F.lit(0.0), absent)))
        return F.col(names["prediction"])

