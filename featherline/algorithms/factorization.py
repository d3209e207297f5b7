"""Factorization machines: a linear model plus pairwise interactions of low rank, trained in epochs of mini-batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from featherline.algorithms import epochs
from featherline.algorithms.base import TableEstimator, TableModel, scratch_name
from featherline.algorithms.params import choice, declare, real, text, whole
from featherline.algorithms.sums import Entries
from featherline.functions import vectors

#: Ways to start, and what each needs.
STARTS = ("normal", "uniform", "constant")


class FactorizationParams(TableEstimator):
    """Rates, decays and starts of the three terms: the bias, a weight per column, and the factors.

    Rows of ``validationCol`` are not trained on; with ``patience`` they say when to stop, else the losses of the
    epochs do. ``statePath`` keeps every epoch, so that a fit can go on.
    """

    labeled = True
    required = ("feature_dim", "predictor_type", "num_factors")
    assumed = {"epochs": 1, "mini_batch_size": 1000, "bias_lr": 0.1, "linear_lr": 0.001, "factors_lr": 0.0001, "bias_wd": 0.01, "linear_wd": 0.001, "factors_wd": 0.00001,
               **{f"{term}_init_method": "normal" for term in epochs.TERMS}, **{f"{term}_init_value": 0.0 for term in epochs.TERMS},
               **{f"{term}_init_scale": 0.01 for term in epochs.TERMS}, "bias_init_sigma": 0.01, "linear_init_sigma": 0.01, "factors_init_sigma": 0.001,
               "clip_gradient": 0.0, "rescale_grad": 1.0, "eps": 1e-8, "patience": 0, "tolerance": 0.001, "seed": 0}
    wiring = (*TableEstimator.wiring, "validationCol", "statePath", "patience", "tolerance")

    num_factors = declare("num_factors", "rank of the interactions", whole(1))
    feature_dim = declare("feature_dim", "size of the vectors", whole(1))
    predictor_type = declare("predictor_type", "kind of model", choice("binary_classifier", "regressor"))
    mini_batch_size = declare("mini_batch_size", "rows per step of a task", whole(1))
    epochs = declare("epochs", "most passes over the data", whole(1))
    clip_gradient = declare("clip_gradient", "largest size of a gradient's entry; any when 0", real(0))
    eps = declare("eps", "what keeps a step's divisor from 0", real(0, above=True))
    rescale_grad = declare("rescale_grad", "factor of the gradient", real(0, above=True))
    bias_lr = declare("bias_lr", "step size of the bias", real(0))
    linear_lr = declare("linear_lr", "step size of the weights", real(0))
    factors_lr = declare("factors_lr", "step size of the factors", real(0))
    bias_wd = declare("bias_wd", "decay of the bias", real(0))
    linear_wd = declare("linear_wd", "decay of the weights", real(0))
    factors_wd = declare("factors_wd", "decay of the factors", real(0))
    bias_init_method = declare("bias_init_method", "how the bias starts", choice(*STARTS))
    linear_init_method = declare("linear_init_method", "how the weights start", choice(*STARTS))
    factors_init_method = declare("factors_init_method", "how the factors start", choice(*STARTS))
    bias_init_scale = declare("bias_init_scale", "range of a uniform start of the bias", real(0))
    linear_init_scale = declare("linear_init_scale", "range of a uniform start of the weights", real(0))
    factors_init_scale = declare("factors_init_scale", "range of a uniform start of the factors", real(0))
    bias_init_sigma = declare("bias_init_sigma", "deviation of a normal start of the bias", real(0))
    linear_init_sigma = declare("linear_init_sigma", "deviation of a normal start of the weights", real(0))
    factors_init_sigma = declare("factors_init_sigma", "deviation of a normal start of the factors", real(0))
    bias_init_value = declare("bias_init_value", "constant start of the bias", real())
    linear_init_value = declare("linear_init_value", "constant start of the weights", real())
    factors_init_value = declare("factors_init_value", "constant start of the factors", real())
    patience = declare("patience", "epochs without gain after which to stop; never when 0", whole(0))
    tolerance = declare("tolerance", "share of the best loss that counts as gain", real(0))
    validationCol = declare("validationCol", "boolean column of rows that only rate the epochs", text)
    statePath = declare("statePath", "folder that keeps the epochs", text)
    seed = declare("seed", "random seed", whole())

    def _start(self) -> epochs.Machine:
        chance, width, rank = np.random.default_rng(self.setting("seed")), self.getOrDefault("feature_dim"), self.getOrDefault("num_factors")
        found = []
        for term, shape in zip(epochs.TERMS, ((1,), (width,), (width, rank))):
            how = {name: self.setting(f"{term}_init_{name}") for name in ("method", "scale", "sigma", "value")}
            found.append(chance.normal(0, how["sigma"], shape) if how["method"] == "normal" else
                         chance.uniform(-how["scale"], how["scale"], shape) if how["method"] == "uniform" else np.full(shape, how["value"]))
        if not np.abs(found[2]).max(initial=0) > 0:
            raise ValueError("factors that all start at 0 never move: give factors_init_sigma, _scale or _value above 0")
        return epochs.Machine(*found)

    def _fitted(self, df: DataFrame, loss: str) -> FactorizationModel:
        if not any(self.setting(f"{term}_lr") > 0 for term in epochs.TERMS):
            raise ValueError("one of the step sizes must be above 0")
        plan = epochs.Plan(
            loss=loss, epochs=self.setting("epochs"), batch=self.setting("mini_batch_size"), rates={t: self.setting(f"{t}_lr") for t in epochs.TERMS},
            decays={t: self.setting(f"{t}_wd") for t in epochs.TERMS}, patience=self.setting("patience"), tolerance=self.setting("tolerance"),
            epsilon=self.setting("eps"), clip=self.setting("clip_gradient"), rescale=self.setting("rescale_grad"))
        held = F.col(self.getOrDefault("validationCol")) if self.isDefined("validationCol") else None
        machine, losses, best = epochs.train(df, F.col(self.getOrDefault("featuresCol")), F.col(self.getOrDefault("labelCol")), self._start(), plan, held_out=held,
                                             state=self.getOrDefault("statePath") if self.isDefined("statePath") else None)
        model = FactorizationModel()
        model.arrays.update(bias=machine.bias[:, None], linear=machine.linear[:, None], factors=machine.factors)
        model.facts.update(score="score", losses=losses, epoch=best)
        return model


class FactorizationBinaryTable(FactorizationParams):
    def _preset(self) -> None:
        self._setDefault(predictor_type="binary_classifier")

    def _classes(self) -> int:
        return 2

    def _train(self, df: DataFrame) -> FactorizationModel:
        model = self._fitted(df, "logistic")
        model.facts.update(label="predicted_label", threshold=0.5)
        return model


class FactorizationRegressorTable(FactorizationParams):
    def _preset(self) -> None:
        self._setDefault(predictor_type="regressor")

    def _train(self, df: DataFrame) -> FactorizationModel:
        return self._fitted(df, "squared")


class FactorizationModel(TableModel):
    """``losses`` of the epochs and the number of the chosen one are among its facts."""

    def outputs(self) -> dict[str, T.DataType]:
        names = [self.facts["score"]] + ([self.facts["label"]] if "label" in self.facts else [])
        return {name: T.DoubleType() for name in names}

    def predict(self, df: DataFrame):
        name = scratch_name("margin")
        machine = epochs.Machine(self.arrays["bias"].reshape(-1), self.arrays["linear"].reshape(-1), self.arrays["factors"])
        scored = df.withColumn(name, margin(F.col(self.getOrDefault("featuresCol")), machine))
        if "label" not in self.facts:
            return scored, {self.facts["score"]: F.col(name)}
        score = 1 / (1 + F.exp(-F.col(name)))
        return scored, {self.facts["score"]: score, self.facts["label"]: (score >= self.facts["threshold"]).cast("double")}


def margin(features: Column, machine: epochs.Machine) -> Column:
    """The machine's margin of a vector column."""

    @F.arrow_udf("double")
    def find(column: pa.Array) -> pa.Array:
        found = [machine.margins(part) for part in Entries(column).parts()]
        return pa.array(np.concatenate(found) if found else np.zeros(0))

    return find(vectors.lean(features))
