"""Linear models: binary and multiclass classifiers, and regressors with robust losses."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest, OneVsRestModel
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, functions as F, types as T

from featherline.algorithms import epochs, repeated
from featherline.algorithms.base import TableEstimator, TableModel, scratch_name
from featherline.algorithms.factorization import margin
from featherline.algorithms.params import choice, declare, flag, flag_or_auto, real, text, whole, words_or
from featherline.algorithms.selection import choose
from featherline.operators import curves, losses, metrics, weights
from featherline.operators.curves import CRITERIA
from featherline.operators.sampling import hash_sample
from featherline.workspace import written

# Names of losses (fixed values).
LOSSES = ("logistic", "squared_loss", "absolute_loss", "hinge_loss", "eps_insensitive_squared_loss",
          "eps_insensitive_absolute_loss", "quantile_loss", "huber_loss", "softmax_loss", "auto")
# Smoothing of absolute losses: the width's factor per round, its least share of the mean residual, the
# least curvature in it, and the relative change of coefficients that ends the rounds.
SHRINK, NARROWEST, FLATTEST, SETTLED = 0.6, 0.02, 2.5e-4, 1e-7


class LinearParams(TableEstimator):
    labeled = True
    required = ("feature_dim", "predictor_type", "mini_batch_size")
    assumed = {
        "target_recall": 0.8, "target_precision": 0.8, "positive_example_weight_mult": "1.0", "accuracy_top_k": 3,
        "binary_classifier_model_selection_criteria": "accuracy", "balance_multiclass_weights": "False", "epochs": 10,
        "use_bias": "True", "num_models": "auto", "num_calibration_samples": 10000000, "loss": "auto", "wd": 0.0, "l1": 0.0,
        "normalize_data": "True", "normalize_label": "auto", "unbias_data": "auto", "unbias_label": "auto",
        "early_stopping_tolerance": 0.001, "margin": 1.0, "quantile": 0.5,
        "loss_insensitivity": 0.01, "huber_delta": 1.0, "f_beta": 1.0, "seed": 0, "learning_rate": 0.05,
    }

    feature_dim = declare("feature_dim", "size of the vectors", whole(1))
    mini_batch_size = declare("mini_batch_size", "rows per step of a streaming trainer", whole(1))
    predictor_type = declare("predictor_type", "kind of model",
                             choice("binary_classifier", "multiclass_classifier", "regressor"))
    epochs = declare("epochs", "most iterations", whole(1))
    use_bias = declare("use_bias", "whether to fit an intercept", flag)
    num_models = declare("num_models", "candidates trained side by side", words_or(whole(1), "auto"))
    num_calibration_samples = declare("num_calibration_samples", "rows to choose a threshold on", whole(1))
    loss = declare("loss", "loss to minimise", choice(*LOSSES))
    wd = declare("wd", "weight of the squared penalty", real(0))
    l1 = declare("l1", "weight of the absolute penalty", real(0))
    normalize_data = declare("normalize_data", "whether to scale features to unit deviation", flag)
    normalize_label = declare("normalize_label", "whether to scale the label to unit deviation", flag_or_auto)
    unbias_data = declare("unbias_data", "whether to center features", flag_or_auto)
    unbias_label = declare("unbias_label", "whether to center the label", flag_or_auto)
    num_point_for_scaler = declare("num_point_for_scaler", "rows to estimate moments on; all when unset", whole(1))
    early_stopping_tolerance = declare("early_stopping_tolerance", "relative gain below which to stop", real(0, above=True))
    early_stopping_patience = declare("early_stopping_patience", "epochs of mini-batches without gain after which to stop", whole(1))
    learning_rate = declare("learning_rate", "step size of mini-batches", real(0, above=True))
    statePath = declare("statePath", "folder that keeps the epochs of mini-batches", text)
    margin = declare("margin", "margin of the hinge loss", real(0, above=True))
    quantile = declare("quantile", "level of the quantile loss", real(0, 1, above=True, below=True))
    loss_insensitivity = declare("loss_insensitivity", "errors that cost nothing", real(0, above=True))
    huber_delta = declare("huber_delta", "error where the Huber loss turns linear", real(0, above=True))
    f_beta = declare("f_beta", "weight of recall in F-beta", real(0, above=True))
    seed = declare("seed", "random seed", whole())

    wiring = (*TableEstimator.wiring, "statePath")

    def _preset(self) -> None:
        self._setDefault(mini_batch_size=1000)

    def _by_epochs(self, df: DataFrame, loss: str, model: LinearModelBase, weight: str | None = None) -> None:
        """Train in epochs of mini-batches until ``early_stopping_patience`` of them bring no gain on a fifth of the rows, chosen by hash.

        The weights, the loss of every epoch and the number of the chosen one go into the model. Rows that are equal are held out together.
        """
        if self.setting("l1"):
            raise ValueError("mini-batches have no absolute penalty")
        features, label, width = self.getOrDefault("featuresCol"), self.getOrDefault("labelCol"), self.getOrDefault("feature_dim")
        rate = self.setting("learning_rate")
        plan = epochs.Plan(
            loss=loss, epochs=self.setting("epochs"), batch=self.getOrDefault("mini_batch_size"), patience=self.getOrDefault("early_stopping_patience"),
            tolerance=self.setting("early_stopping_tolerance"), rates={"bias": rate if self.setting("use_bias") == "True" else 0.0, "linear": rate, "factors": 0.0},
            decays={"linear": self.setting("wd")})
        held = F.pmod(F.xxhash64(F.lit(self.setting("seed")), F.unwrap_udt(features), label), F.lit(5)) == 0
        start = epochs.Machine(np.zeros(1), np.zeros(width), np.zeros((width, 0)))
        machine, losses, best = epochs.train(df, F.col(features), F.col(label), start, plan, None if weight is None else F.col(weight), held,
                                             self.getOrDefault("statePath") if self.isDefined("statePath") else None)
        model.arrays.update(bias=machine.bias[:, None], linear=machine.linear[:, None])
        model.facts.update(losses=losses, epoch=best, logistic=loss == "logistic")

    def _penalty(self) -> dict:
        l1, l2 = self.setting("l1"), self.setting("wd")
        return {"regParam": l1 + l2, "elasticNetParam": l1 / (l1 + l2) if l1 + l2 else 0.0}

    def _common(self) -> dict:
        return {"featuresCol": self.getOrDefault("featuresCol"), "labelCol": self.getOrDefault("labelCol"),
                "maxIter": self.setting("epochs"), "tol": self.setting("early_stopping_tolerance"),
                "fitIntercept": self.setting("use_bias") == "True"}

    def _scaler_rows(self, df: DataFrame) -> DataFrame:
        """The rows that moments are estimated on: all, or as many as asked for."""
        features, label = self.getOrDefault("featuresCol"), self.getOrDefault("labelCol")
        if not self.isDefined("num_point_for_scaler"):
            return df.select(features, label)
        return hash_sample(df.select(features, label), self.getOrDefault("num_point_for_scaler"),
                           F.xxhash64(F.unwrap_udt(features), label))

    def _scaled(self, df: DataFrame, sample: DataFrame | None = None):
        """Scale and center as asked, by a stage that scoring repeats; none when Spark's trainers do it."""
        by_epochs = self.isDefined("early_stopping_patience")
        if self.setting("unbias_data") != "True" and not (by_epochs and self.setting("normalize_data") == "True"):
            return df, None
        features, name = self.getOrDefault("featuresCol"), scratch_name("scaled")
        stage = StandardScaler(inputCol=features, outputCol=name, withMean=self.setting("unbias_data") == "True",
                               withStd=self.setting("normalize_data") == "True")
        fitted = stage.fit(self._scaler_rows(df) if sample is None else sample)
        return fitted.transform(df).drop(features).withColumnRenamed(name, features), fitted

    def _candidates(self) -> list[dict]:
        """Penalties to try: the given one, then stronger ones by steps of ten."""
        count = self.setting("num_models")
        base = self._penalty()
        steps = [{}] if count == "auto" else [{}] + [
            {"regParam": base["regParam"] + 10.0 ** (i - int(count))} for i in range(1, int(count))]
        return [{**base, **step} for step in steps]


class BinaryClassifierTable(LinearParams):
    """Score and label; the threshold is chosen by a criterion on the training table."""

    binary_classifier_model_selection_criteria = declare(
        "binary_classifier_model_selection_criteria", "how the threshold is chosen", choice(*CRITERIA))
    target_recall = declare("target_recall", "recall to keep", real(0, 1, above=True, below=True))
    target_precision = declare("target_precision", "precision to keep", real(0, 1, above=True, below=True))
    positive_example_weight_mult = declare(
        "positive_example_weight_mult", "weight of positive rows",
        words_or(real(0, above=True), "balanced", "auto"))

    def _preset(self) -> None:
        super()._preset()
        self._setDefault(predictor_type="binary_classifier")

    def _classes(self) -> int:
        return 2

    def _stage(self):
        loss = self.setting("loss")
        if loss in ("auto", "logistic", "softmax_loss"):
            return LogisticRegression(family="binomial", standardization=self.setting("normalize_data") == "True",
                                      **self._common())
        if loss == "hinge_loss":
            return LinearSVC(standardization=self.setting("normalize_data") == "True", **self._common())
        return LinearRegression(standardization=self.setting("normalize_data") == "True", **self._common())

    def _train(self, df: DataFrame) -> BinaryClassifierModel:
        features, label = self.getOrDefault("featuresCol"), self.getOrDefault("labelCol")
        slim, scaler = self._scaled(df.select(features, label))
        stage = self._stage()
        multiplier = self.setting("positive_example_weight_mult")
        if multiplier != "1.0":
            name = scratch_name("weight")
            weight = self._searched_weight(stage, slim) if multiplier == "auto" else weights.positive_weight(
                slim, label, multiplier if multiplier == "balanced" else float(multiplier))
            slim = slim.withColumn(name, weights.positive_weight_column(F.col(label), weight))
            stage = stage.setWeightCol(name)
        if isinstance(stage, LinearSVC) and self.setting("l1"):
            raise ValueError("the hinge loss has no absolute penalty")
        by_epochs = self.isDefined("early_stopping_patience")
        if by_epochs and not isinstance(stage, LogisticRegression):
            raise ValueError("mini-batches minimise the logistic loss only")
        allowed = {p.name for p in stage.params}
        grid = [{k: v for k, v in candidate.items() if k in allowed} for candidate in self._candidates()]
        model = BinaryClassifierModel()
        model._set(featuresCol=features)
        model.stages.update({"scaler": scaler} if scaler else {})
        if by_epochs:
            self._by_epochs(slim, "logistic", model, name if multiplier != "1.0" else None)
        else:
            model.stages["linear"] = choose(stage, grid, slim, self._rating, self.setting("seed"))
        model.facts.update(score="score", label="predicted_label", threshold=0.0 if isinstance(stage, LinearSVC) else 0.5)
        criterion = self.setting("binary_classifier_model_selection_criteria")
        if criterion not in ("cross_entropy_loss", "loss_function"):
            scored = model._scored(df.select(features, label))
            sweep = curves.threshold_sweep(scored, label, "_score", self.setting("f_beta"),
                                           self.setting("num_calibration_samples"),
                                           [F.xxhash64(F.unwrap_udt(features), label)])
            best = curves.best_threshold(sweep, criterion, self.setting("target_recall"),
                                         self.setting("target_precision")).first()
            if best is not None:
                model.facts["threshold"] = float(best["threshold"])
        return model


    def _searched_weight(self, stage, df: DataFrame) -> float:
        """The weight of positive rows whose model rates best on a fifth of the rows: brackets around 1 and the balanced weight, then twice halved."""
        label, name = self.getOrDefault("labelCol"), scratch_name("weight")
        train, held = (part.persist() for part in df.randomSplit([0.8, 0.2], self.setting("seed")))
        rated: dict[float, float] = {}

        def rate(weight: float) -> None:
            if weight not in rated:
                weighted = train.withColumn(name, weights.positive_weight_column(F.col(label), weight))
                rated[weight] = self._rating(stage.copy({stage.weightCol: name}).fit(weighted), held)

        try:
            balanced = weights.positive_weight(train, label, "balanced") or 1.0
            ends = sorted({1.0, balanced})
            for weight in (ends[0] / 4, *ends, ends[-1] * 4):
                rate(weight)
            for _ in range(2):
                order = sorted(rated)
                best = order.index(max(order, key=lambda w: rated[w]))
                for near in (best - 1, best + 1):
                    if 0 <= near < len(order):
                        rate((order[best] * order[near]) ** 0.5)
        finally:
            train.unpersist()
            held.unpersist()
        # Of equal ratings the weight nearest to 1 changes the rows least.
        return min(rated, key=lambda w: (-rated[w], abs(math.log(w))))

    def _rating(self, model, held: DataFrame) -> float:
        """What the criterion gives at its best threshold on held-out rows, or the negative loss."""
        label, criterion = self.getOrDefault("labelCol"), self.setting("binary_classifier_model_selection_criteria")
        if criterion in ("cross_entropy_loss", "loss_function"):
            return -_mean_log_loss(model, held, label)
        score = _score_column(model, "probability", "rawPrediction", "prediction")
        sweep = curves.threshold_sweep(model.transform(held).select(label, score.alias("_score")), label, "_score", self.setting("f_beta"))
        best = curves.best_threshold(sweep, criterion, self.setting("target_recall"), self.setting("target_precision")).first()
        goal = {"precision_at_target_recall": "precision", "recall_at_target_precision": "recall"}.get(criterion, criterion)
        return best[goal] if best is not None else float("-inf")

    def evaluate(self, model: BinaryClassifierModel, df: DataFrame) -> dict[str, float]:
        """Rates of the model's decisions, F-beta included, and the area under the curve."""
        label, scored = self.getOrDefault("labelCol"), model.transform(df)
        rates = metrics.binary_metrics(scored, label, model.facts["score"], model.facts["threshold"], self.setting("f_beta")).first().asDict()
        return {**{k: float(v) for k, v in rates.items()}, "auc": curves.auc(scored, label, model.facts["score"]).first()["auc"]}


def _score_column(stage, probability: str, raw: str, prediction: str) -> Column:
    kind = type(stage).__name__
    if kind == "LogisticRegressionModel":
        return vector_to_array(F.col(probability))[1]
    if kind == "LinearSVCModel":
        return vector_to_array(F.col(raw))[1]
    return F.col(prediction)


def _mean_log_loss(model, data: DataFrame, label: str) -> float:
    scored = model.transform(data)
    if "probability" in scored.columns:
        probability = F.get(vector_to_array("probability"), F.col(label).cast("int"))
        return scored.agg(F.avg(-F.log(losses.clipped(probability)))).first()[0]
    if "rawPrediction" in scored.columns:
        return scored.agg(F.avg(losses.hinge(F.col(label), vector_to_array("rawPrediction")[1]))).first()[0]
    return scored.agg(F.avg(losses.squared(F.col(label), F.col("prediction")))).first()[0]


class LinearModelBase(TableModel):
    def _scored(self, df: DataFrame) -> DataFrame:
        """The table with ``_score`` and, for classifiers, ``_class``."""
        source = features = self.getOrDefault("featuresCol")
        if "scaler" in self.stages:
            source = scratch_name("scaled")
            df = self.stages["scaler"].setInputCol(features).setOutputCol(source).transform(df)
        if "linear" in self.arrays:
            weights_of = self.arrays["linear"].reshape(-1)
            score = margin(F.col(source), epochs.Machine(self.arrays["bias"].reshape(-1), weights_of, np.zeros((len(weights_of), 0))))
            named = df.withColumn("_score", score)
            return named.withColumn("_score", 1 / (1 + F.exp(-F.col("_score")))) if self.facts["logistic"] else named
        stage = self.stages["linear"]
        names = {n: scratch_name(n) for n in ("prediction", "probability", "rawPrediction")}
        stage = stage.copy()
        if isinstance(stage, OneVsRestModel):
            # It reads its models' raw scores under their own names.
            stage.models = [m.copy().setRawPredictionCol(names["rawPrediction"]) for m in stage.models]
        stage.setFeaturesCol(source)
        stage.setPredictionCol(names["prediction"])
        if hasattr(stage, "setProbabilityCol"):
            stage.setProbabilityCol(names["probability"])
        if hasattr(stage, "setRawPredictionCol"):
            stage.setRawPredictionCol(names["rawPrediction"])
        return self._finish(stage.transform(df), stage, names)

    def _finish(self, scored: DataFrame, stage, names: dict[str, str]) -> DataFrame:
        return scored.withColumn("_score", _score_column(stage, names["probability"], names["rawPrediction"], names["prediction"]))


class BinaryClassifierModel(LinearModelBase):
    def outputs(self) -> dict[str, T.DataType]:
        return {self.facts["score"]: T.DoubleType(), self.facts["label"]: T.DoubleType()}

    def predict(self, df: DataFrame):
        above = F.col("_score") >= self.facts["threshold"]
        return self._scored(df), {self.facts["score"]: F.col("_score"), self.facts["label"]: above.cast("double")}


class MulticlassClassifierTable(LinearParams):
    """A score per class, and the class that scores highest."""

    required = (*LinearParams.required, "num_classes")

    num_classes = declare("num_classes", "number of classes", whole(3, 1000000))
    accuracy_top_k = declare("accuracy_top_k", "classes that may hold the true one", whole(1))
    balance_multiclass_weights = declare("balance_multiclass_weights", "whether classes weigh the same", flag)

    def _preset(self) -> None:
        super()._preset()
        self._setDefault(predictor_type="multiclass_classifier")

    def _classes(self) -> int:
        return self.getOrDefault("num_classes")

    def _train(self, df: DataFrame) -> MulticlassClassifierModel:
        features, label = self.getOrDefault("featuresCol"), self.getOrDefault("labelCol")
        slim, scaler = self._scaled(df.select(features, label))
        name = None
        if self.setting("balance_multiclass_weights") == "True":
            name = scratch_name("weight")
            slim = weights.with_class_weights(slim, label, name)
        loss = self.setting("loss")
        standardization = self.setting("normalize_data") == "True"
        if loss in ("auto", "softmax_loss", "logistic"):
            stage = LogisticRegression(family="multinomial", standardization=standardization, **self._common())
            stage = stage.setWeightCol(name) if name else stage
            fitted = choose(stage, self._candidates(), slim,
                            lambda model, data: -_mean_log_loss(model, data, label), self.setting("seed"))
        elif loss == "hinge_loss":
            inner = LinearSVC(standardization=standardization, regParam=self._penalty()["regParam"], **self._common())
            rest = OneVsRest(classifier=inner, featuresCol=features, labelCol=label, parallelism=4)
            fitted = (rest.setWeightCol(name) if name else rest).fit(slim)
        else:
            raise ValueError(f"no multiclass model minimises {loss}")
        model = MulticlassClassifierModel()
        model.stages.update({"scaler": scaler} if scaler else {})
        model.stages["linear"] = fitted
        model.facts.update(score="score", label="predicted_label", classes=self.getOrDefault("num_classes"))
        return model

    def evaluate(self, model: MulticlassClassifierModel, df: DataFrame) -> dict[str, float]:
        """Accuracy, the share of rows whose class is among the ``accuracy_top_k`` best scores, and the error."""
        label, scored = self.getOrDefault("labelCol"), model.transform(df)
        top = metrics.top_k_accuracy(scored.withColumn("_scores", vector_to_array(model.facts["score"])), self.setting("accuracy_top_k"), label, "_scores")
        merror = metrics.multiclass_metrics(scored, label, model.facts["label"]).first()["merror"]
        return {"accuracy": 1.0 - merror, "accuracy_top_k": float(top.first()[0]), "merror": merror}


class MulticlassClassifierModel(LinearModelBase):
    def outputs(self) -> dict[str, T.DataType]:
        return {self.facts["score"]: VectorUDT(), self.facts["label"]: T.DoubleType()}

    def _finish(self, scored: DataFrame, stage, names: dict[str, str]) -> DataFrame:
        score = names["probability"] if hasattr(stage, "setProbabilityCol") else names["rawPrediction"]
        # A class that no row has comes after all that were seen, and scores zero.
        held = vector_to_array(F.col(score))
        absent = F.greatest(F.lit(int(self.facts.get("classes", 0))) - F.size(held), F.lit(0))
        whole = array_to_vector(F.concat(held, F.array_repeat(F.lit(0.0), absent)))
        return scored.withColumns({"_score": whole, "_class": F.col(names["prediction"])})

    def predict(self, df: DataFrame):
        return self._scored(df), {self.facts["score"]: F.col("_score"), self.facts["label"]: F.col("_class")}


class RegressorTable(LinearParams):
    """A linear score under one of several losses."""

    def _preset(self) -> None:
        super()._preset()
        self._setDefault(predictor_type="regressor")

    def _train(self, df: DataFrame) -> RegressorModel:
        features, label = self.getOrDefault("featuresCol"), self.getOrDefault("labelCol")
        slim = df.select(features, label)
        label_moments = "True" in (self.setting("unbias_label"), self.setting("normalize_label"))
        sample = self._scaler_rows(slim).persist() if label_moments or self.setting("unbias_data") == "True" else None
        slim, scaler = self._scaled(slim, sample)
        center, scale = self._label_moments(sample, label) if label_moments else (0.0, 1.0)
        if sample is not None:
            sample.unpersist()
        if (center, scale) != (0.0, 1.0):
            slim = slim.withColumn(label, (F.col(label) - center) / scale)
        loss = self.setting("loss")
        stage = LinearRegression(standardization=self.setting("normalize_data") == "True", **self._common())
        model = RegressorModel()
        model.stages.update({"scaler": scaler} if scaler else {})
        model.facts.update(score="score", center=center, scale=scale)
        if self.isDefined("early_stopping_patience"):
            if loss not in ("auto", "squared_loss"):
                raise ValueError("mini-batches minimise the squared loss only")
            self._by_epochs(slim, "squared", model)
            return model
        if loss in ("auto", "squared_loss"):
            fitted = choose(stage, self._candidates(), slim,
                            lambda model, data: -model.evaluate(data).meanSquaredError, self.setting("seed"))
        elif loss == "huber_loss":
            if self.setting("l1"):
                raise ValueError("the Huber loss has no absolute penalty")
            fitted = self._reweighted(slim, stage.setRegParam(self.setting("wd")), loss, scale)
        elif loss in ("absolute_loss", "quantile_loss", "eps_insensitive_squared_loss", "eps_insensitive_absolute_loss"):
            fitted = self._reweighted(slim, stage.setRegParam(self._penalty()["regParam"]).setElasticNetParam(
                self._penalty()["elasticNetParam"]), loss, scale)
        else:
            raise ValueError(f"no regression minimises {loss}")
        model.stages["linear"] = fitted
        return model

    def evaluate(self, model: RegressorModel, df: DataFrame) -> dict[str, float]:
        """The errors of the scores."""
        return metrics.regression_errors(model.transform(df), self.getOrDefault("labelCol"), model.facts["score"]).first().asDict()

    def _label_moments(self, sample: DataFrame, label: str) -> tuple[float, float]:
        unbias, normalize = self.setting("unbias_label") == "True", self.setting("normalize_label") == "True"
        mean, deviation = sample.agg(F.avg(label), F.stddev_samp(label)).first()
        return (mean if unbias else 0.0), (deviation if normalize and deviation else 1.0)

    def _reweighted(self, df: DataFrame, stage: LinearRegression, loss: str, scale: float):
        """Minimise a robust loss by weighted least squares, each time around the last fit.

        The kinks of the absolute losses are smoothed over a width that shrinks every round, and a
        round is a Newton step. The squared loss with slack pulls labels in to the edge of the
        slack. The Huber loss weighs a row by how far its error exceeds delta. Every round is one training pass over the same table; only coefficients carry over.
        """
        label, features = self.getOrDefault("labelCol"), self.getOrDefault("featuresCol")
        name, weight, target, many = (scratch_name(n) for n in ("fit", "weight", "target", "rows"))
        level = F.lit(self.setting("quantile") if loss == "quantile_loss" else 0.5)
        slack, delta = self.setting("loss_insensitivity") / scale, self.setting("huber_delta") / scale
        smoothed = loss not in ("huber_loss", "eps_insensitive_squared_loss")
        # Equal rows are one with a weight.
        once = repeated.gathered(df, [features, label], many)
        table = (df.withColumn(many, F.lit(1.0)) if once is None else written(once, "gathered")).persist()
        try:
            model = stage.copy().setWeightCol(many).fit(table).setPredictionCol(name)
            error = F.col(label) - F.col(name)
            spread = model.transform(table).agg(F.sum(F.abs(error) * F.col(many)) / F.sum(many)).first()[0]
            width = spread
            for _ in range(self.setting("epochs") if spread else 0):

                def step(distance: Column) -> Column:
                    return 1 / (1 + F.exp(-distance / width))

                if loss == "huber_loss":
                    columns = {target: F.col(label), weight: F.least(F.lit(1.0), delta / F.greatest(F.abs(error), F.lit(1e-300)))}
                elif loss == "eps_insensitive_squared_loss":
                    pulled = F.col(label) - F.signum(error) * slack
                    columns = {target: F.when(F.abs(error) > slack, pulled).otherwise(F.col(name)), weight: F.lit(1.0)}
                else:
                    if loss == "eps_insensitive_absolute_loss":
                        above, below = step(error - slack), step(-error - slack)
                        slope, curve = above - below, above * (1 - above) + below * (1 - below)
                    else:
                        below = step(-error)
                        slope, curve = level - below, below * (1 - below)
                    curve = F.greatest(curve, F.lit(FLATTEST)) / width
                    columns = {target: F.col(name) + slope / curve, weight: curve}
                again = model.transform(table).withColumns(columns).select(features, target, (F.col(weight) * F.col(many)).alias(weight))
                moved = stage.copy().setLabelCol(target).setWeightCol(weight).fit(again).setPredictionCol(name)
                change = moved.coefficients.toArray() - model.coefficients.toArray()
                size = abs(moved.coefficients.toArray()).sum() + abs(moved.intercept)
                still = abs(change).sum() + abs(moved.intercept - model.intercept) <= SETTLED * size
                model, settled = moved, still and (not smoothed or width <= NARROWEST * spread)
                width = max(width * SHRINK, NARROWEST * spread)
                if settled:
                    break
        finally:
            table.unpersist()
        return model


class RegressorModel(LinearModelBase):
    def outputs(self) -> dict[str, T.DataType]:
        return {self.facts["score"]: T.DoubleType()}

    def predict(self, df: DataFrame):
        return self._scored(df), {self.facts["score"]: F.col("_score") * self.facts["scale"] + self.facts["center"]}


