import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from featherline.algorithms.sums import Entries
from featherline.algorithms import base, boosted, custom, epochs, factorization, kmeans, lda, linear, pca, runs
from featherline.functions import vectors
from featherline.operators import codecs, curves, metrics


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(0)
    centers = np.array([[10.0, 0, 0, 0], [0, 20.0, 0, 0], [0, 0, 35.0, 0]])
    rows = [(i, float(i % 3), Vectors.dense(rng.normal(loc=centers[i % 3]))) for i in range(300)]
    return spark.createDataFrame(rows, ["id", "label", "features"]).persist()


ESTIMATORS = {
    kmeans.KMeansTable: {"k": [2, 5], "feature_dim": [1], "mini_batch_size": [1], "init_method": ["random", "kmeans++"],
                         "local_lloyd_tol": [0, 1], "local_lloyd_num_trials": ["auto", 3, "4"], "eval_metrics": ["msd", "msd,ssd"],
                         "half_life_time_size": [0], "extra_center_factor": ["auto", 2]},
    pca.PCATable: {"num_components": [1], "algorithm_mode": ["regular", "stable", "randomized"], "subtract_mean": [True, "False"],
                   "extra_components": [-1, 3]},
    lda.LDATable: {"num_topics": [1], "alpha0": [0.1], "max_restarts": [1], "max_iterations": [1], "tol": [1e-8]},
    linear.BinaryClassifierTable: {"target_recall": [0.5], "positive_example_weight_mult": ["balanced", "auto", 2.0], "wd": [0],
                                   "num_models": ["auto", 2], "loss": ["logistic", "hinge_loss"], "quantile": [0.1]},
    linear.MulticlassClassifierTable: {"num_classes": [3, 1000000], "accuracy_top_k": [1]},
    factorization.FactorizationBinaryTable: {"num_factors": [1], "factors_wd": [0]},
    boosted.BoostedTable: {"num_round": [1], "eta": [0, 1], "subsample": [1], "objective": ["reg:linear", "binary:logitraw"],
                           "tweedie_variance_power": [1.5], "lambda": [2.0], "alpha": [0, 1.5], "max_delta_step": [0.7], "base_score": [0.5], "rate_drop": [0, 1],
                           "sample_type": ["weighted"], "normalize_type": ["forest"], "one_drop": [1], "skip_drop": [0.5], "eval_metric": ["auc,map-", "ndcg@5-,error@0.3"]},
}
REJECTED = {
    kmeans.KMeansTable: {"k": [1, 2.5, "x"], "feature_dim": [0], "init_method": ["other"], "local_lloyd_tol": [-0.1, 1.1],
                         "local_lloyd_num_trials": [0, "none", 0.5], "eval_metrics": ["mse"], "half_life_time_size": [-1]},
    pca.PCATable: {"num_components": [0], "algorithm_mode": ["fast"], "subtract_mean": ["yes"], "extra_components": [-2]},
    lda.LDATable: {"num_topics": [0], "alpha0": [0], "max_restarts": [0]},
    linear.BinaryClassifierTable: {"target_recall": [0, 1], "positive_example_weight_mult": [0, "some"], "wd": [-1],
                                   "num_models": [0.5], "loss": ["none"], "quantile": [0, 1]},
    linear.MulticlassClassifierTable: {"num_classes": [2, 1000001], "accuracy_top_k": [0]},
    factorization.FactorizationBinaryTable: {"num_factors": [0], "factors_wd": [-1]},
    boosted.BoostedTable: {"num_round": [0], "eta": [-0.1, 1.1], "subsample": [0], "objective": ["rank:ndcg"],
                           "tweedie_variance_power": [1, 2], "eval_metric": ["gini", "map@n", "error@t", "auc@3"]},
}


@pytest.mark.parametrize("kind", ESTIMATORS)
def test_params(spark, kind):
    estimator = kind()
    for name, values in ESTIMATORS[kind].items():
        camel = "".join(p.capitalize() for p in name.split("_"))
        for value in values:
            getattr(estimator, f"set{camel}")(value)
            assert getattr(estimator, f"get{camel}")() is not None
    for name, values in REJECTED[kind].items():
        for value in values:
            with pytest.raises((ValueError, TypeError)):
                estimator._set(**{name: value})


def test_string_map(spark):
    estimator = kmeans.KMeansTable(k=2, feature_dim=3, eval_metrics="msd,ssd", featuresCol="x").setInitMethod("random")
    assert estimator.hyperparameters({"k": "9", "own": "1"}) == {
        "k": "2", "feature_dim": "3", "mini_batch_size": "5000", "eval_metrics": "[msd,ssd]", "init_method": "random", "own": "1"}


@pytest.mark.parametrize("estimator,missing", [
    (kmeans.KMeansTable(k=2), "feature_dim"), (pca.PCATable(feature_dim=2), "num_components"),
    (lda.LDATable(num_topics=2, feature_dim=2), "mini_batch_size"), (boosted.BoostedTable(), "num_round"),
    (linear.MulticlassClassifierTable(feature_dim=4), "num_classes"), (factorization.FactorizationRegressorTable(), "num_factors")])
def test_required_params(blobs, estimator, missing):
    with pytest.raises(ValueError, match=missing):
        estimator.fit(blobs)


def test_wrong_size_and_labels_fail(blobs):
    with pytest.raises(ValueError, match="wrong_size"):
        kmeans.KMeansTable(k=2, feature_dim=5).fit(blobs)
    with pytest.raises(ValueError, match="label_out_of_range"):
        linear.BinaryClassifierTable(feature_dim=4).fit(blobs)


def test_unlabeled_schema_fails(blobs):
    with pytest.raises(ValueError, match="label"):
        linear.RegressorTable(feature_dim=4).fit(blobs.drop("label"))


FITTED = {
    "kmeans": (lambda: kmeans.KMeansTable(k=3, feature_dim=4), ["distance_to_cluster", "closest_cluster"]),
    "pca": (lambda: pca.PCATable(num_components=2, feature_dim=4), ["projection"]),
    "pca_raw": (lambda: pca.PCATable(num_components=2, feature_dim=4, subtract_mean=False), ["projection"]),
    "multiclass": (lambda: linear.MulticlassClassifierTable(feature_dim=4, num_classes=3, balance_multiclass_weights=True, epochs=30),
                   ["score", "predicted_label"]),
    "hinge": (lambda: linear.MulticlassClassifierTable(feature_dim=4, num_classes=3, loss="hinge_loss", unbias_data=True),
              ["score", "predicted_label"]),
    "regressor": (lambda: linear.RegressorTable(feature_dim=4, num_models=3, normalize_label=True), ["score"]),
    "patient": (lambda: linear.RegressorTable(feature_dim=4, epochs=10, early_stopping_patience=2, mini_batch_size=50), ["score"]),
    "surplus": (lambda: kmeans.KMeansTable(k=3, feature_dim=4, extra_center_factor=4, epochs=2, mini_batch_size=50, half_life_time_size=1000, init_method="kmeans++"),
                ["distance_to_cluster", "closest_cluster"]),
    "fm": (lambda: factorization.FactorizationRegressorTable(num_factors=2, feature_dim=4, epochs=3, mini_batch_size=100), ["score"]),
    "trees": (lambda: boosted.BoostedTable(num_round=2, max_depth=2, min_child_weight=3), ["prediction"]),
    "dart": (lambda: boosted.BoostedTable(num_round=3, max_depth=2, booster="dart", rate_drop=0.5, one_drop=1, normalize_type="forest"), ["prediction"]),
    "topics": (lambda: lda.LDATable(num_topics=2, feature_dim=4, mini_batch_size=50), ["topic_mixture"]),
    "softmax": (lambda: boosted.BoostedTable(num_round=2, max_depth=2, objective="multi:softmax", num_class=3), ["prediction"]),
}


@pytest.mark.parametrize("name", FITTED)
def test_fit_score_save_load(spark, blobs, tmp_path, name):
    make, outputs = FITTED[name]
    model = make().fit(blobs)
    scored = model.transform(blobs)
    assert scored.columns == ["id", "label", "features", *outputs] and scored.dtypes == [(f.name, f.dataType.simpleString()) for f in model.transformSchema(blobs.schema)]
    path = str(tmp_path / name)
    model.write().save(path)
    loaded = base.attach(spark, path)
    loaded._set(keepInput=False)
    again = loaded.transform(blobs)
    assert again.columns == outputs
    assert [tuple(r) for r in again.collect()] == [tuple(r) for r in scored.select(*outputs).collect()]
    if "predicted_label" in outputs:
        assert scored.filter(F.col("label") == F.col("predicted_label")).count() > 280


def test_binary_losses(spark, blobs):
    binary = blobs.withColumn("label", (F.col("label") == 2).cast("double"))
    for loss in ("logistic", "hinge_loss", "squared_loss"):
        scored = linear.BinaryClassifierTable(feature_dim=4, loss=loss, epochs=30).fit(binary).transform(binary)
        assert scored.filter(F.col("label") == F.col("predicted_label")).count() > 280, loss


def test_epochs_of_linear_models(spark, blobs):
    binary = blobs.withColumn("label", (F.col("label") == 2).cast("double"))
    params = dict(feature_dim=4, epochs=40, early_stopping_patience=2, mini_batch_size=20, learning_rate=0.2)
    for more in ({}, {"unbias_data": True}, {"positive_example_weight_mult": "balanced"}):
        model = linear.BinaryClassifierTable(**params, **more).fit(binary)
        assert model.transform(binary).filter(F.col("label") == F.col("predicted_label")).count() > 280
        losses, best = model.facts["losses"], model.facts["epoch"]
        assert best == len(losses) - 3 or len(losses) == 40
    for refused in ({"loss": "hinge_loss"}, {"l1": 0.1}):
        with pytest.raises(ValueError, match="mini-batches"):
            linear.BinaryClassifierTable(**params, **refused).fit(binary)


def test_weights_are_searched(spark):
    """By log loss no weight beats 1; by recall at a precision the search need not be balanced either, but never rates worse."""
    df = spark.createDataFrame([(Vectors.dense([float(k % 4)]), float(k % 10 == 0 or k % 40 < 2)) for k in range(400)], ["features", "label"])

    def loss(how):
        scored = linear.BinaryClassifierTable(feature_dim=1, epochs=50, positive_example_weight_mult=how, binary_classifier_model_selection_criteria="cross_entropy_loss").fit(df).transform(df)
        return scored.agg(F.avg(-F.log(F.when(F.col("label") == 1, F.col("score")).otherwise(1 - F.col("score"))))).first()[0]

    assert loss("auto") < loss("balanced")


def test_pca_modes_agree(spark, blobs):
    found = {m: pca.PCATable(num_components=2, feature_dim=4, algorithm_mode=m).fit(blobs).arrays["directions"]
             for m in ("regular", "stable", "randomized")}
    assert np.allclose(found["regular"], found["stable"], atol=1e-6)
    assert np.allclose(found["regular"][:, 0], found["randomized"][:, 0], atol=1e-3)


def test_ties_go_to_the_lower_cluster(spark):
    model = kmeans.KMeansTableModel.of(np.array([[1.0, 0.0], [-1.0, 0.0], [1.0, 0.0]]))
    df = spark.createDataFrame([(Vectors.dense([0.0, 0.0]),), (Vectors.sparse(2, [0], [5.0]),)], ["features"])
    assert [(r["closest_cluster"], r["distance_to_cluster"]) for r in model.transform(df).collect()] == [(0.0, 1.0), (0.0, 4.0)]


def test_train_on_export(spark, blobs, tmp_path):
    for fmt in ("recordio", "libsvm", "parquet"):
        path = tmp_path / fmt
        sibling = tmp_path / f"{fmt}0"
        sibling.mkdir()
        model = boosted.BoostedTable(num_round=1, max_depth=2, feature_dim=4, exportPath=str(path), exportFormat=fmt).fit(blobs)
        assert model.transform(blobs).count() == 300 and not path.exists() and sibling.exists()
    kept = tmp_path / "kept"
    kmeans.KMeansTable(k=2, feature_dim=4, exportPath=str(kept), keepExport=True).fit(blobs)
    assert any(p.name.endswith(".pbr") for p in kept.iterdir())


def test_runs(spark, blobs, tmp_path):
    table = runs.RunTable(spark, str(tmp_path / "runs"))
    run, model = table.fit(kmeans.KMeansTable(k=2, feature_dim=4), blobs, str(tmp_path / "models"))
    assert table.attach(run).transform(blobs).count() == 300
    table.record("other", runs.FAILED, {})
    with pytest.raises(ValueError, match="Failed"):
        table.attach("other")
    with pytest.raises(ValueError, match="no run"):
        table.attach("unknown")


def test_unavailable_booster(blobs):
    with pytest.raises(ValueError, match="dropped"):
        boosted.BoostedTable(num_round=1, booster="dart", grower="ml").fit(blobs)


def test_custom_records(spark, blobs):
    """A scorer that answers in framed records, through the record codecs."""

    def fit(df, params):
        def score(payload):
            from featherline.functions import wire
            data = np.frombuffer(payload, np.uint8)
            starts, lengths, _ = wire.frame_spans(data)
            (features,) = wire.decode_tensors(data, starts, lengths, [("features", "values")])
            totals = features.values.flat().reshape(len(starts), -1).sum(axis=1)
            empty = np.zeros(len(starts), np.int64)
            bodies = wire.encode_records(totals, empty + 1, empty[:0], empty, empty[:0], empty, labels=totals)
            # The label entry is named "values": the decoder is told so.
            return wire.encode_frames(bodies).data.tobytes()
        return score

    from pyspark.sql import types as T
    decoder = codecs.RecordDecoder(T.StructType([T.StructField("total", T.DoubleType())]), ["values"])
    scored = custom.CustomEstimator(fit, codecs.RecordEncoder(), decoder, max_records=7).fit(blobs).transform(blobs)
    for row in scored.collect():
        assert row["total"] == pytest.approx(row["features"].toArray().sum(), abs=1e-4)


def test_slopes_of_a_machine():
    """A step's gradient against differences of the loss; then no decay, one row, one step."""
    chance = np.random.default_rng(0)
    machine = epochs.Machine(chance.normal(size=1), chance.normal(size=4), chance.normal(size=(4, 2)))
    x = np.array([0.5, 0.0, -1.0, 2.0])
    rows = object.__new__(Entries)
    rows.n, rows.row, rows.place, rows.value, rows.total = 1, np.zeros(3, int), np.array([0, 2, 3]), x[[0, 2, 3]], np.array([x.sum()])
    for loss in ("squared", "logistic"):
        steps = epochs.Steps(machine, epochs.Plan(loss, 1, 1, {"bias": 1e-3, "linear": 1e-3, "factors": 1e-3}))
        steps.step(rows, np.array([1.0]), np.array([1.0]))
        for k, (before, after) in enumerate(zip(machine.parts(), steps.machine.parts())):
            for at in np.ndindex(before.shape):
                moved = [epochs.Machine(*[p.copy() for p in machine.parts()]) for _ in range(2)]
                for m, sign in zip(moved, (1, -1)):
                    m.parts()[k][at] += sign * 1e-6
                slope = np.subtract(*[epochs.loss_and_slope(loss, m.margins(rows), np.array([1.0]))[0][0] for m in moved]) / 2e-6
                # The first adaptive step has the rate's size, against the gradient.
                assert after[at] - before[at] == pytest.approx(-1e-3 * np.sign(round(slope, 8)), abs=1e-5)


def test_epochs_go_on_where_they_stopped(spark, tmp_path):
    df = spark.createDataFrame([(Vectors.dense([float(k % 7), float(k % 3)]), float(k % 7) * 2 - 1.0) for k in range(200)], ["features", "label"])
    params = dict(num_factors=1, feature_dim=2, mini_batch_size=20, linear_lr=0.05, statePath=str(tmp_path / "epochs"))
    first = factorization.FactorizationRegressorTable(epochs=3, **params).fit(df).facts["losses"]
    again = factorization.FactorizationRegressorTable(epochs=6, **params).fit(df).facts["losses"]
    assert len(first) == 3 and len(again) == 6 and again[:3] == first and again[-1] < first[0]


def test_interaction_score(spark):
    factors = [[0.1, 0.2], [-0.3, 0.4], [0.5, -0.6]]
    x = [1.5, -2.0, 3.0]
    want = 0.7 + sum(w * v for w, v in zip([1, 2, 3], x)) + sum(
        np.dot(factors[i], factors[j]) * x[i] * x[j] for i in range(3) for j in range(i + 1, 3))
    machine = epochs.Machine(np.array([0.7]), np.array([1.0, 2.0, 3.0]), np.array(factors))
    got = spark.createDataFrame([(Vectors.dense(x),)], ["x"]).select(factorization.margin(F.col("x"), machine)).first()[0]
    assert got == pytest.approx(want)


def test_projection_of_sparse_rows(spark):
    df = spark.createDataFrame([(Vectors.sparse(3, [1], [2.0]),), (Vectors.dense([1.0, 2.0, 3.0]),)], ["features"])
    model = pca.PCATableModel.of(np.eye(3)[:, :2], np.array([1.0, 1.0, 1.0]))
    assert [r["projection"].toArray().tolist() for r in model.transform(df).collect()] == [[-1.0, 1.0], [0.0, 1.0]]


def test_vector_helpers(spark):
    df = spark.createDataFrame([(5, [1, 3], [1.0, 2.0])], "n int, i array<int>, v array<double>")
    assert df.select(vectors.from_struct(F.col("n"), F.col("i"), F.col("v"))).first()[0] == Vectors.sparse(5, [1, 3], [1.0, 2.0])


def test_unfitted_chain_is_saved(spark, blobs, tmp_path):
    from pyspark.ml import Pipeline
    path = str(tmp_path / "chain")
    Pipeline(stages=[pca.PCATable(num_components=2, feature_dim=4), kmeans.KMeansTable(
        k=3, feature_dim=2, featuresCol="projection", eval_metrics="ssd")]).write().save(path)
    loaded = Pipeline.load(path)
    assert loaded.getStages()[1].getOrDefault("eval_metrics") == ["ssd"]
    assert loaded.fit(blobs).transform(blobs).select("closest_cluster").distinct().count() == 3


def test_recorded_metrics(spark, blobs, tmp_path):
    table = runs.RunTable(spark, str(tmp_path / "runs"))
    table.fit(kmeans.KMeansTable(k=3, feature_dim=4, eval_metrics="msd,ssd"), blobs, str(tmp_path / "m"), "a", validation=blobs)
    losses = table.rows().first()["metrics"]
    assert losses["ssd"] == pytest.approx(300 * losses["msd"])
    binary = blobs.withColumn("label", (F.col("label") == 1).cast("double"))
    estimator = boosted.BoostedTable(num_round=2, max_depth=2, objective="binary:logistic", queryCol="id3", keyCol="id",
                                     eval_metric=["auc", "logloss", "error", "error@0.9", "ndcg@5", "map-", "rmse"])
    queried = binary.withColumn("id3", F.col("id") % 4)
    found = estimator.evaluate(estimator.fit(queried), queried)
    assert list(found) == estimator.getEvalMetric() and found["auc"] == 1.0 and found["ndcg@5"] == 1.0 and found["error"] == 0.0
    classes = boosted.BoostedTable(num_round=2, max_depth=2, objective="multi:softprob", num_class=3, eval_metric="mlogloss")
    assert 0 < classes.evaluate(classes.fit(blobs), blobs)["mlogloss"] < 1.0
    with pytest.raises(ValueError, match="query"):
        boosted.evaluate(queried.withColumn("prediction", F.lit(1.0)), ["ndcg"])


def test_settings_that_cannot_be_followed(blobs):
    for params in ({"max_depth": 31, "grower": "ml"}, {"max_bin": 1}, {"eta": 0.0}, {"min_child_weight": 1e9, "grower": "ml"},
                   {"objective": "binary:logistic", "base_score": 1.0}, {"objective": "count:poisson", "base_score": 0.0},
                   {"objective": "count:poisson", "grower": "ml"}):
        with pytest.raises(ValueError):
            boosted.BoostedTable(num_round=1, **params).fit(blobs)
    for params in ({"linear_lr": 0.0, "bias_lr": 0.0, "factors_lr": 0.0}, {"factors_init_sigma": 0.0}, {"factors_init_method": "constant"}):
        with pytest.raises(ValueError):
            factorization.FactorizationRegressorTable(num_factors=2, feature_dim=4, **params).fit(blobs)


def test_starts_differ(spark):
    """Two equal rows far out: starting at random and at spread-out rows are different things."""
    df = spark.createDataFrame([(Vectors.dense([float(k % 50), 0.0]),) for k in range(500)] + [(Vectors.dense([1e6, 1e6]),)] * 2, ["features"])
    found = {m: kmeans.KMeansTable(k=2, feature_dim=2, init_method=m, local_lloyd_max_iter=1, seed=1).fit(df).arrays["centers"]
             for m in ("random", "kmeans++")}
    assert found["kmeans++"].max() == 1e6 and not np.allclose(found["random"], found["kmeans++"])


def test_thresholds_agree(spark):
    df = spark.createDataFrame([(1.0, 0.8), (1.0, 0.5), (0.0, 0.3), (0.0, 0.1)], ["label", "score"])
    best = curves.best_threshold(curves.threshold_sweep(df)).first()
    assert best["accuracy"] == 1.0 == metrics.binary_metrics(df, threshold=best["threshold"]).first()["accuracy"]


def test_low_rank_directions(spark):
    df = spark.createDataFrame([(Vectors.dense([float(k), 2.0 * k, 0.0]),) for k in range(40)], ["features"])
    directions = pca.PCATable(num_components=3, feature_dim=3, algorithm_mode="stable").fit(df).arrays["directions"]
    assert directions.shape == (3, 3) and np.allclose(directions.T @ directions, np.eye(3))
    assert np.allclose(np.abs(directions[:, 0]), np.array([1, 2, 0]) / np.sqrt(5))


def test_custom_model_is_saved(spark, tmp_path):
    df = spark.createDataFrame([(Vectors.dense([float(k)]),) for k in range(20)], ["features"])
    estimator = custom.CustomEstimator(lambda rows, params: (lambda payload: payload.replace(b"\n", b",").rstrip(b",")),
                                       codecs.CSVEncoder(), codecs.CSVDecoder())
    model = estimator.fit(df)
    model.write().save(str(tmp_path / "m"))
    again = base.attach(spark, str(tmp_path / "m"))
    assert [r["prediction"] for r in again.transform(df).collect()] == [r["prediction"] for r in model.transform(df).collect()] == [float(k) for k in range(20)]


def test_steps_of_a_fixed_rate_end_near_least_squares():
    from featherline.algorithms import epochs
    from featherline.algorithms.sums import Entries

    chance = np.random.default_rng(0)
    plan = epochs.Plan(loss="squared", epochs=1, batch=50, rates={"bias": 0.05, "linear": 0.05, "factors": 0.0})
    misses = []
    for _ in range(10):
        x = chance.normal(size=(20_000, 1))
        y = x[:, 0] + chance.normal(size=len(x))
        steps = epochs.Steps(epochs.Machine(np.zeros(1), np.zeros(1), np.zeros((1, 0))), plan)
        for begin in range(0, len(x), plan.batch):
            some = slice(begin, begin + plan.batch)
            steps.step(Entries(vectors.dense_column(x[some])), y[some], np.ones(plan.batch))
        misses.append(steps.mean()[1][0] - 1)
    # The last steps miss by up to 0.07.
    assert np.abs(misses).max() < 0.03
