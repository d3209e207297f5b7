import numpy as np
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from featherline.algorithms import boosted, epochs, kmeans, linear, repeated
from featherline.algorithms.sums import Entries
from featherline.functions import vectors


def often(spark, times):
    rows = [(Vectors.dense([float(k % 7), float(k % 3)]), float(k % 7 + 2 * (k % 3 == 1))) for k in range(42)]
    return spark.createDataFrame(rows * times, ["features", "label"]).repartition(3)


def test_gathered_rows(spark):
    df = often(spark, 10)
    once = repeated.gathered(df, ["features"], "n", total=F.col("label"))
    assert once.count() == 21 and once.agg(F.sum("n"), F.sum("total")).first()[:] == (420.0, df.agg(F.sum("label")).first()[0])
    assert repeated.gathered(df.limit(0), ["features"], "n") is None
    assert repeated.gathered(spark.range(100), ["id"], "n") is None


def test_fits_are_those_of_all_rows(spark, monkeypatch):
    df = often(spark, 10)
    trainers = [
        lambda: boosted.BoostedTable(num_round=3, max_depth=2, feature_dim=2),
        lambda: boosted.BoostedTable(num_round=2, max_depth=2, feature_dim=2, objective="multi:softprob", num_class=9),
        lambda: linear.RegressorTable(feature_dim=2, loss="absolute_loss"),
        lambda: linear.RegressorTable(feature_dim=2, loss="huber_loss")]

    def results():
        return [[np.ravel(r[0].toArray() if hasattr(r[0], "toArray") else r[0]) for r in t().fit(df).transform(df).groupBy("features").agg(
            F.first(c)).orderBy(F.unwrap_udt("features")).select(f"first({c})").collect()] for t, c in zip(trainers, ("prediction", "prediction", "score", "score"))]

    seen = []
    real = repeated.gathered
    monkeypatch.setattr(repeated, "gathered", lambda *a, **k: seen.append(real(*a, **k)) or seen[-1])
    with_weights = results()
    assert len(seen) == 4 and all(s is not None for s in seen)
    monkeypatch.setattr(repeated, "gathered", lambda *a, **k: None)
    for a, b in zip(with_weights, results()):
        assert np.allclose(np.concatenate(a), np.concatenate(b), atol=1e-6)
    found = kmeans.KMeansTable(k=2, feature_dim=2, mini_batch_size=5, extra_center_factor=3, epochs=2).fit(df)
    assert np.isfinite(found.arrays["centers"]).all()


def test_epochs_go_over_copies_that_share_the_weight_of_all_rows(spark, monkeypatch, tmp_path):
    rows = often(spark, 100).select(vectors.lean(F.col("features")).alias("x"), F.col("label").alias("y"), F.lit(0.5).alias("w"), (F.col("label") == 2).alias("held"))
    rows = rows.union(rows.where("y = 4").orderBy("x.values").limit(1).withColumn("y", F.lit(9.0)))
    assert epochs.copies(rows, str(tmp_path / "short")) is None  # gone over row by row
    monkeypatch.setattr(epochs, "ROWS", 200)
    found = epochs.copies(rows, str(tmp_path / "long"))
    weights = {(r.y, r.held): r.w for r in rows.groupBy("y", "held").agg(F.sum("w").alias("w")).collect()}
    for r in found.groupBy("y", "held").agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n"), F.countDistinct("x").alias("d")).collect():
        assert np.isclose(r.w, weights.pop((r.y, r.held))) and (r.n == r.d if r.held or r.y == 9 else r.n > 4 * r.d)
    assert not weights and found.count() < 240
    machine, plan = epochs.Machine(np.array([0.5]), np.array([0.2, 0.1]), np.ones((2, 1))), epochs.Plan("squared", 1, 20, {})
    assert np.isclose(epochs._mean_loss(found.select("x", "y", "w"), machine, plan), epochs._mean_loss(rows.select("x", "y", "w"), machine, plan))


def test_epochs_go_over_every_row_of_a_long_table(spark, monkeypatch):
    rows = often(spark, 10)
    plan, seen, real = epochs.Plan("squared", 2, 20, dict.fromkeys(epochs.TERMS, 0.05)), [], epochs._epoch
    monkeypatch.setattr(epochs, "ROWS", 100)
    monkeypatch.setattr(epochs, "_epoch", lambda rows, *how: seen.append(rows.agg(F.count(F.lit(1)), F.sum("w")).first()[:]) or real(rows, *how))
    epochs.train(rows, F.col("features"), F.col("label"), epochs.Machine(np.zeros(1), np.zeros(2), np.zeros((2, 0))), plan)
    assert seen == [(420, 420.0)] * 2


def test_steps_touch_the_same_places_in_short_and_long_vectors():
    chance = np.random.default_rng(0)
    x, y = chance.normal(size=(60, 3)) * (chance.random((60, 3)) < 0.6), chance.normal(size=60)
    factors, found = chance.normal(size=(3, 2)), []
    for width in (3, 500):  # places count themselves in the first, and are sorted in the second
        machine = epochs.Machine(np.zeros(1), np.zeros(width), np.concatenate([factors, np.zeros((width - 3, 2))]))
        steps = epochs.Steps(machine, epochs.Plan("squared", 1, 20, dict.fromkeys(epochs.TERMS, 0.05), {"linear": 0.01}))
        for begin in range(0, 60, 20):
            steps.step(Entries(vectors.dense_column(x[begin:begin + 20])), y[begin:begin + 20], np.ones(20))
        found.append([p[:3] for p in steps.mean()])
    assert all(np.array_equal(a, b) for a, b in zip(*found))
