import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from featherline.operators import curves, metrics, ranking, sampling, weights
from featherline.operators.ordered import running


def skewed(spark, rows=2000, seed=1):
    """A third of all rows share one query, a third of all rows share one score."""
    rng = random.Random(seed)
    data = []
    for i in range(rows):
        query = "hot" if rng.random() < 0.34 else f"q{rng.randrange(40)}"
        score = 0.5 if rng.random() < 0.34 else round(rng.random(), 2)
        data.append((i, query, score, float(rng.randrange(3)) if rng.random() < 0.3 else 0.0))
    return data, spark.createDataFrame(data, "id int, query string, score double, label double")


@pytest.mark.parametrize("ranges", [9, None])
def test_running_totals(spark, ranges):
    data, df = skewed(spark)
    got = running(df, ["query"], [F.col("score").desc(), F.col("id")], {"rank": F.lit(1), "gain": F.col("label")}, ranges)
    want, seen = {}, defaultdict(lambda: [0, 0.0])
    for i, query, score, label in sorted(data, key=lambda r: (r[1], -r[2], r[0])):
        seen[query][0] += 1
        seen[query][1] += label
        want[i] = tuple(seen[query])
    assert {r["id"]: (r["rank"], r["gain"]) for r in got.collect()} == want


def brute_rank(data, cut, empty):
    groups = defaultdict(list)
    for i, query, score, label in data:
        groups[query].append((i, score, label))
    out = {}
    for query, rows in groups.items():
        limit = cut or len(rows)
        ranked = sorted(rows, key=lambda r: (-r[1], r[0]))
        ideal = sorted(rows, key=lambda r: -r[2])
        gain = lambda order: sum((2 ** r[2] - 1) / math.log2(k + 2) for k, r in enumerate(order[:limit]))
        hits, precision = 0, 0.0
        for k, r in enumerate(ranked):
            if r[2] > 0:
                hits += 1
                if k < limit:
                    precision += hits / (k + 1)
        out[query] = (gain(ranked) / gain(ideal) if gain(ideal) else empty, precision / hits if hits else empty)
    return out


@pytest.mark.parametrize("metric,ranges", [("ndcg", None), ("map@7-", None), ("ndcg@3-", 5), ("map", 5)])
def test_ranking_metrics(spark, metric, ranges):
    data, df = skewed(spark, 800)
    name, cut, zero = ranking.parse_metric(metric)
    want = brute_rank(data, cut, 0.0 if zero else 1.0)
    got = {r["query"]: (r["ndcg"], r["map"]) for r in
           ranking.per_query(df, "query", "label", "score", "id", cut, zero, ranges).collect()}
    assert got.keys() == want.keys()
    for query in want:
        assert got[query] == pytest.approx(want[query], abs=1e-12)
    mean = ranking.ranking_metric(df, metric, "query", "label", "score", "id", ranges).first()[0]
    position = 0 if name == "ndcg" else 1
    assert mean == pytest.approx(sum(v[position] for v in want.values()) / len(want))


@pytest.mark.parametrize("text", ["ndcg@", "map@x", "auc", "ndcg--"])
def test_unknown_ranking_metrics(text):
    with pytest.raises(ValueError):
        ranking.parse_metric(text)


def test_pairs_grow_with_rows(spark):
    data, df = skewed(spark, 3000)
    pairs = ranking.training_pairs(df, "query", "label", "id", ["label", "query"], pool_rows=50).collect()
    assert len(pairs) <= len(data)
    assert all(p["label_high"] > p["label_low"] and p["query_high"] == p["query_low"] == p["query"] for p in pairs)
    assert max(Counter(p["id_high"] for p in pairs).values()) == 1
    # Nearly every row above its query's lowest label has a partner: only a pool without lower rows leaves it out.
    higher = sum(1 for _, q, _, label in data if label > 0)
    assert len(pairs) > 0.9 * higher


@pytest.mark.parametrize("ranges", [7, None])
def test_sweep_and_auc(spark, ranges):
    data, df = skewed(spark, 1500)
    binary = df.withColumn("label", (F.col("label") > 0).cast("double"))
    sweep = {r["threshold"]: r for r in curves.threshold_sweep(binary, beta=0.5, ranges=ranges).collect()}
    assert sweep.keys() == {r[2] for r in data}
    for threshold in list(sweep)[::9]:
        tp = sum(1 for r in data if r[2] >= threshold and r[3] > 0)
        fp = sum(1 for r in data if r[2] >= threshold and r[3] == 0)
        row = sweep[threshold]
        assert (row["tp"], row["fp"]) == (tp, fp) and row["tp"] + row["fp"] + row["fn"] + row["tn"] == len(data)
    area = curves.auc(binary, ranges=ranges).first()["auc"]
    exact = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(binary)
    assert area == pytest.approx(exact, abs=1e-9)


def test_best_threshold(spark):
    rows = [(0.9, 1.0), (0.8, 1.0), (0.7, 0.0), (0.6, 1.0), (0.2, 0.0)]
    sweep = curves.threshold_sweep(spark.createDataFrame(rows, ["score", "label"]))
    best = lambda *a, **k: curves.best_threshold(sweep, *a, **k).first()["threshold"]
    assert best("accuracy") == 0.8 and best("f1") == 0.6
    assert best("precision_at_target_recall", target_recall=0.9) == 0.6
    assert best("recall_at_target_precision", target_precision=0.99) == 0.8
    with pytest.raises(ValueError):
        best("loss_function")


def test_hash_sample(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    first = {r[0] for r in sampling.hash_sample(df, 137, "k").collect()}
    again = {r[0] for r in sampling.hash_sample(df.repartition(7), 137, "k").collect()}
    assert len(first) == 137 and first == again
    assert sampling.hash_sample(df, 5000, "k").count() == 5000
    # Rows that share a key are still cut to the size asked for.
    same = spark.range(300).select(F.lit(1).alias("k"))
    assert sampling.hash_sample(same, 10, "k").count() == 10


def test_top_k(spark):
    df = spark.createDataFrame([(0.0, [0.5, 0.5, 0.1]), (1.0, [0.5, 0.5, 0.1]), (2.0, [0.5, 0.5, 0.1])], ["label", "score"])
    share = lambda k: metrics.top_k_accuracy(df, k).first()[0]
    assert [share(1), share(2), share(3)] == pytest.approx([1 / 3, 2 / 3, 1.0])


def test_binary_metrics(spark):
    df = spark.createDataFrame([(1.0, 0.9), (1.0, 0.4), (0.0, 0.6), (0.0, 0.1), (0.0, 0.2)], ["label", "score"])
    row = metrics.binary_metrics(df, beta=2.0).first()
    assert (row["tp"], row["fp"], row["fn"], row["tn"]) == (1, 1, 1, 2)
    assert row["accuracy"] == 0.6 and row["f1"] == 0.5 and row["f_beta"] == 0.5 and row["error"] == 0.4


def test_weights(spark):
    df = spark.createDataFrame([(1.0,)] * 2 + [(0.0,)] * 6, ["label"])
    table = {r["label"]: (r["n"], r["weight"]) for r in weights.class_weights(df).collect()}
    assert table == {1.0: (2, 2.0), 0.0: (6, 2 / 3)}
    assert weights.positive_weight(df, multiplier="balanced") == 3.0 and weights.positive_weight(df, multiplier=2.5) == 2.5
    total = weights.with_class_weights(df).groupBy("label").agg(F.sum("weight").alias("w")).collect()
    assert [r["w"] for r in total] == pytest.approx([4.0, 4.0])
