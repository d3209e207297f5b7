"""Histogram trees and spectral topics against plain numpy."""

import hashlib

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F

from featherline.algorithms import lda, trees
from featherline.algorithms.boosted import BoostedTable, slopes_of
from featherline.algorithms.sums import Entries
from featherline.functions import vectors


def grown(x, g, h, s, allowed=lambda level: None, level=0):
    """A tree as nested tuples, by trying every value of every column; a leaf is its step times eta."""
    G, H = g.sum(), h.sum()

    def weight(a, b):
        w = -np.sign(a) * max(abs(a) - s["alpha"], 0) / (b + s["ridge"]) if b + s["ridge"] > 0 else 0.0
        return float(np.clip(w, -s["bound"], s["bound"])) if s["bound"] else w

    def score(a, b):
        w = weight(a, b)
        return -(2 * a * w + (b + s["ridge"]) * w * w + 2 * s["alpha"] * abs(w))

    best = None
    if level < s["depth"]:
        for c in range(x.shape[1]):
            if allowed(level) is not None and c not in allowed(level):
                continue
            none = np.isnan(x[:, c])
            for cut in np.unique(x[~none, c]):
                for missing_left in (True, False):
                    left = np.where(none, missing_left, x[:, c] <= cut)
                    a, b = g[left].sum(), h[left].sum()
                    if min(b, H - b) < max(s["least"], 1e-12):
                        continue
                    both = score(a, b) + score(G - a, H - b)
                    gain = both - score(G, H)
                    if gain <= 1e-12 * both or gain < s["gamma"]:
                        continue
                    key = (-np.float32(gain), c, cut, not missing_left)
                    if best is None or key < best[0]:
                        best = key, left, missing_left
    if best is None:
        return 0.0 if H < s["least"] or H + s["ridge"] <= 0 else s["eta"] * weight(G, H)
    (_, c, cut, _), left, missing_left = best
    return c, cut, missing_left, *(grown(x[k], g[k], h[k], s, allowed, level + 1) for k in (left, ~left))


def value(tree, row):
    while isinstance(tree, tuple):
        c, cut, missing_left, left, right = tree
        goes = missing_left if np.isnan(row[c]) else row[c] <= cut
        tree = left if goes else right
    return tree


PLAIN = {"alpha": 0.0, "ridge": 1.0, "bound": 0.0, "depth": 3, "least": 1.0, "gamma": 0.0, "eta": 0.3}


def data(seed=0, n=300):
    chance = np.random.default_rng(seed)
    x = np.column_stack([chance.integers(0, 20, n) / 4, chance.integers(0, 7, n), chance.normal(size=n).round(1)]).astype(float)
    y = x[:, 0] * 2 + (x[:, 1] > 3) * 3 + chance.normal(size=n)
    x[chance.random((n, 3)) < 0.1] = np.nan
    return x, np.nan_to_num(y)


def table(spark, x, y):
    rows = [(k, float(b), Vectors.dense(a.tolist())) for k, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["id", "label", "features"]).repartition(3)


def predictions(model, df):
    return np.array([r[0] for r in model.transform(df).orderBy("id").select("prediction").collect()])


CASES = {
    "squares": ("reg:linear", {}, {}, lambda y: y, lambda m: m, 0.5),
    "strong": ("reg:linear", {"lambda": 30.0, "alpha": 4.0, "gamma": 3.0, "min_child_weight": 25.0}, {"ridge": 30.0, "alpha": 4.0, "gamma": 3.0, "least": 25.0},
               lambda y: y, lambda m: m, 0.5),
    "logistic": ("binary:logistic", {"scale_pos_weight": 2.5, "min_child_weight": 3.0}, {"least": 3.0}, lambda y: (y > 5).astype(float), lambda m: 1 / (1 + np.exp(-m)), 0.0),
    "raw": ("binary:logistraw", {"max_delta_step": 0.4}, {"bound": 0.4}, lambda y: (y > 5).astype(float), lambda m: m, 0.0),
    "counts": ("count:poisson", {}, {"bound": 0.7}, lambda y: np.round(np.maximum(y, 0)), np.exp, np.log(0.5)),
    "amounts": ("reg:gamma", {"lambda": 0.0}, {"ridge": 0.0}, lambda y: np.abs(y) + 0.1, np.exp, np.log(0.5)),
    "tweedie": ("reg:tweedie", {"tweedie_variance_power": 1.3}, {}, lambda y: np.maximum(y, 0), np.exp, np.log(0.5)),
}


@pytest.mark.parametrize("name", CASES)
def test_rounds_as_by_hand(spark, name):
    objective, params, how, label, link, margin = CASES[name]
    x, y = data()
    y = label(y)
    df = table(spark, x, y)
    got = predictions(BoostedTable(num_round=3, max_depth=3, objective=objective, **params).fit(df), df)
    s = {**PLAIN, **how}
    slopes = slopes_of(objective, params.get("scale_pos_weight", 1.0), params.get("tweedie_variance_power", 1.5), s["bound"])
    f = np.full(len(y), margin)
    for _ in range(3):
        g, h = slopes(f[:, None], y, np.ones(len(y)))
        tree = grown(x, g[:, 0], h[:, 0], s)
        f = f + np.array([value(tree, row) for row in x])
    assert np.allclose(got, link(f), rtol=1e-9)


def test_slopes_are_derivatives():
    losses = {"reg:linear": lambda f, y: (f - y) ** 2 / 2, "binary:logistic": lambda f, y: np.log1p(np.exp(f)) - y * f, "count:poisson": lambda f, y: np.exp(f) - y * f,
              "reg:gamma": lambda f, y: y * np.exp(-f) + f, "reg:tweedie": lambda f, y: np.exp(0.5 * f) / 0.5 + y * np.exp(-0.5 * f) / 0.5}
    f, y, e = np.linspace(-2, 2, 9), np.array([0.0, 1.0] * 4 + [1.0]), 1e-4
    for objective, loss in losses.items():
        g, h = slopes_of(objective, 1.0, 1.5, 0.0)(f[:, None], y, np.ones(9))
        assert np.allclose(g[:, 0], (loss(f + e, y) - loss(f - e, y)) / (2 * e), atol=1e-5)
        assert np.allclose(h[:, 0], (loss(f + e, y) + loss(f - e, y) - 2 * loss(f, y)) / e ** 2, atol=1e-3)


def test_softmax_is_joint(spark):
    x, y = data(1)
    y = np.digitize(y, [4, 8]).astype(float)
    df = table(spark, x, y)
    model = BoostedTable(num_round=2, max_depth=2, objective="multi:softprob", num_class=4).fit(df)
    got = np.array([r.prediction.toArray() for r in model.transform(df).orderBy("id").collect()])
    f = np.full((len(y), 4), 0.5)
    for _ in range(2):
        p = np.exp(f) / np.exp(f).sum(axis=1, keepdims=True)
        f = f + np.column_stack([[value(t, row) for row in x] for t in (
            grown(x, p[:, k] - (y == k), 2 * p[:, k] * (1 - p[:, k]), {**PLAIN, "depth": 2}) for k in range(4))])
    assert np.allclose(got, np.exp(f) / np.exp(f).sum(axis=1, keepdims=True), rtol=1e-9)
    top = BoostedTable(num_round=2, max_depth=2, objective="multi:softmax", num_class=4).fit(df)
    assert np.array_equal(predictions(top, df), got.argmax(axis=1))


def digest(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:8], 16)


def test_samples_can_be_repeated(spark):
    x, y = data(2)
    df = table(spark, x, y)
    params = dict(num_round=2, max_depth=2, subsample=0.6, colsample_bytree=0.7, colsample_bylevel=0.5, seed=11, keyCol="id")
    got = predictions(BoostedTable(**params).fit(df), df)
    f = np.full(len(y), 0.5)
    for r in range(2):
        used = np.array([digest(11, r, k) / 2 ** 32 < 0.6 for k in range(len(y))])
        of_tree = sorted(range(3), key=lambda c: digest(11, r, 0, c))[:2]
        tree = grown(x[used], (f - y)[used], np.ones(used.sum()), {**PLAIN, "depth": 2}, lambda level: sorted(of_tree, key=lambda c: digest(11, r, 0, level, c))[:1])
        f = f + np.array([value(tree, row) for row in x])
    assert np.allclose(got, f, rtol=1e-9)
    assert np.allclose(got, predictions(BoostedTable(**params).fit(df.repartition(7)), df), rtol=1e-9)


@pytest.mark.parametrize("how", [{"normalize_type": "tree"}, {"normalize_type": "forest"}, {"one_drop": 1, "rate_drop": 0.0}, {"sample_type": "weighted"}, {"skip_drop": 1.0}])
def test_dropped_trees(spark, how):
    x, y = data(3)
    df = table(spark, x, y)
    params = {"rate_drop": 0.5, "normalize_type": "tree", "one_drop": 0, "sample_type": "uniform", "skip_drop": 0.0, **how}
    got = predictions(BoostedTable(num_round=4, max_depth=2, booster="dart", seed=5, **params).fit(df), df)
    steps, weights = [], []
    for r in range(4):
        told = [digest(5, r, "drop", t) / 2 ** 32 for t in range(r)]
        share = [params["rate_drop"] * (1 if params["sample_type"] == "uniform" else r * w / sum(weights)) for w in weights]
        gone = [t for t in range(r) if told[t] < share[t]] if params["skip_drop"] == 0 else []
        if r and not gone and params["one_drop"]:
            gone = [int(np.argmin(told))]
        f = 0.5 + sum((w * s for t, (w, s) in enumerate(zip(weights, steps)) if t not in gone), np.zeros(len(y)))
        steps.append(np.array([value(grown(x, f - y, np.ones(len(y)), {**PLAIN, "depth": 2}), row) for row in x]))
        k = len(gone)
        old, new = (1.0, 1.0) if not k else (1 / 1.3, 1 / 1.3) if params["normalize_type"] == "forest" else (k / (k + 0.3), 1 / (k + 0.3))
        weights = [w * old if t in gone else w for t, w in enumerate(weights)] + [new]
    assert np.allclose(got, 0.5 + sum(w * s for w, s in zip(weights, steps)), rtol=1e-9)


def test_pairs_order_a_query(spark):
    x, y = data(4)
    grade = np.digitize(y, [3, 6, 9]).astype(float)
    df = table(spark, x, grade).withColumn("query", F.col("id") % 3)
    scored = BoostedTable(num_round=15, max_depth=3, objective="rank:pairwise", queryCol="query", keyCol="id").fit(df).transform(df)
    rows = [(r["query"], r.label, r.prediction) for r in scored.collect()]
    right = [(a[2] > b[2]) for a in rows for b in rows if a[0] == b[0] and a[1] > b[1]]
    assert np.mean(right) > 0.85


def test_rows_that_stop_the_growing(spark):
    x, y = data(5)
    df = table(spark, x, y).withColumn("held", F.col("id") % 4 == 0)
    whole = BoostedTable(num_round=60, max_depth=4, eta=0.9, validationCol="held").fit(df)
    assert 1 <= whole.facts["rounds"] < 60 and whole.facts["rounds"] == len(np.unique(whole.arrays["nodes"][:, 0]))
    first = BoostedTable(num_round=whole.facts["rounds"], max_depth=4, eta=0.9).fit(df.where("NOT held"))
    assert np.allclose(predictions(whole, df), predictions(first, df), rtol=1e-9)


def test_awkward_tables_of_trees(spark):
    rows = spark.createDataFrame([(k, float(k % 2), Vectors.sparse(3, [1], [1.0])) for k in range(10)], ["id", "label", "features"])
    assert np.allclose(predictions(BoostedTable(num_round=1, eta=1.0, **{"lambda": 0.0}).fit(rows), rows), 0.5)
    nan = spark.createDataFrame([(k, 1.0, Vectors.dense([float("nan")])) for k in range(4)], ["id", "label", "features"])
    assert np.allclose(predictions(BoostedTable(num_round=2, eta=1.0, **{"lambda": 0.0}).fit(nan), nan), 1.0)
    empty = BoostedTable(num_round=1, feature_dim=3).fit(rows.limit(0))
    assert np.allclose(predictions(empty, rows), 0.5)


def test_cells_do_not_depend_on_memory(spark, monkeypatch):
    x, y = data(6)
    df = table(spark, x, y)
    before = predictions(BoostedTable(num_round=2, max_depth=0, min_child_weight=5.0).fit(df), df)
    monkeypatch.setattr(trees, "DENSE_CELLS", 0)
    assert np.allclose(before, predictions(BoostedTable(num_round=2, max_depth=0, min_child_weight=5.0).fit(df), df), rtol=1e-9)


def test_few_bins(spark):
    chance = np.random.default_rng(0)
    x = chance.normal(size=(5000, 1))
    df = table(spark, x, (x[:, 0] > 0.3).astype(float))
    cuts = trees.cut_points(df.withColumn("w", F.lit(1.0)), "features", "w", 1, 16)[0]
    assert len(cuts) == 16 and cuts[-1] == x.max()
    shares = np.diff(np.append(0, np.searchsorted(np.sort(x[:, 0]), cuts, "right"))) / 5000
    assert np.all(np.abs(shares - 1 / 16) < 0.02)


def planted(n=1500, words=30, seed=0):
    chance = np.random.default_rng(seed)
    topics = np.array([chance.dirichlet(np.where(np.arange(words) // 10 == t, 1.0, 0.01)) for t in range(3)])
    rows = []
    for _ in range(n):
        mixture = chance.dirichlet([0.1] * 3)
        rows.append(np.bincount(chance.choice(words, 40, p=mixture @ topics), minlength=words).astype(float))
    return topics, np.array(rows)


def test_topics_come_back(spark):
    topics, counts = planted()
    sparse = [(k, Vectors.sparse(30, {int(w): float(c[w]) for w in np.flatnonzero(c)}) if k % 2 else Vectors.dense(c.tolist())) for k, c in enumerate(counts)]
    df = spark.createDataFrame(sparse + [(5000, Vectors.dense([0.0] * 30)), (5001, Vectors.sparse(30, [3], [2.0]))], ["id", "features"]).repartition(4)
    model = lda.LDATable(num_topics=3, feature_dim=30, mini_batch_size=200, alpha0=0.3).fit(df)
    found = model.arrays["topics"]
    order = [int(np.abs(found - t).sum(axis=1).argmin()) for t in topics]
    assert sorted(order) == [0, 1, 2] and np.abs(found[order] - topics).sum(axis=1).max() < 0.15
    rows = {r.id: r.topic_mixture.toArray() for r in model.transform(df).collect()}
    assert np.allclose([v.sum() for k, v in rows.items() if k != 5000], 1.0) and rows[5000].sum() == 0.0
    again = lda.LDATable(num_topics=3, feature_dim=30, mini_batch_size=7, alpha0=0.3).fit(df.repartition(2)).arrays["topics"]
    assert np.allclose(np.sort(again.sum(axis=0)), np.sort(found.sum(axis=0)), atol=1e-3)


def test_topics_of_little(spark):
    few = spark.createDataFrame([(k, Vectors.dense([3.0, 0.0])) for k in range(5)], ["id", "features"])
    model = lda.LDATable(num_topics=3, feature_dim=2, mini_batch_size=10).fit(few)
    assert model.arrays["topics"].shape == (3, 2) and np.isfinite(model.arrays["topics"]).all()
    assert np.allclose([r.topic_mixture.toArray().sum() for r in model.transform(few).collect()], 1.0)
    none = lda.LDATable(num_topics=2, feature_dim=2, mini_batch_size=10).fit(few.limit(0))
    assert np.isfinite(none.arrays["topics"]).all()


def test_trees_on_labels_that_vectors_do_not_tell(spark, tmp_path):
    """At this size no leaf comes to half within five rounds."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from featherline.plans.boosting import trees_binary_features

    n = 100_000
    chance = np.random.default_rng(n)
    x = chance.normal(size=(n, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    columns = {"vec_id": pa.array(range(n), pa.int64()), "embedding": pa.array(list(x.astype(np.float32)), pa.list_(pa.float32())),
               "label": pa.array(chance.integers(0, 10, n).astype(np.int32))}
    pq.write_table(pa.table(columns), tmp_path / "embeddings.parquet", row_group_size=10_000)
    assert tuple(trees_binary_features(spark, str(tmp_path)).first()) == (n, True, True)


def test_topics_take_up_the_rows_once_and_not_in_every_pass(spark):
    made = spark.sparkContext.accumulator(0)

    def seen(k):
        made.add(1)
        return Vectors.dense([float(k % 3 + 1), float(k % 5), 2.0])

    df = spark.range(200).select(F.udf(seen, VectorUDT())("id").alias("features"))
    lda.LDATable(num_topics=2, feature_dim=3, mini_batch_size=50).fit(df)
    assert made.value <= 600  # the check of the rows, and the writing with its filter; four passes over them come after


def test_mixtures_of_rows_that_come_to_rest_early_are_those_of_all_steps():
    chance = np.random.default_rng(3)
    topics, prior = chance.dirichlet(np.ones(12), 4), np.full(4, 0.1)
    counts = chance.poisson(chance.choice([0.0, 0.3, 4.0, 60.0], 90)[:, None] * np.ones(12)).astype(float)
    found = lda.fit_mixtures(Entries(vectors.dense_column(counts)), topics, prior)
    for row, mixture in zip(counts, found):
        theta = np.full(4, 0.25)
        for _ in range(lda.MIXTURE_STEPS):
            new = prior + ((theta[:, None] * topics) / (theta @ topics) * row).sum(axis=1)
            change, theta = np.abs(new / new.sum() - theta).max(), new / new.sum()
            if change < lda.MIXTURE_CHANGE:
                break
        assert np.allclose(mixture, theta if row.any() else 0.0, atol=1e-5)
