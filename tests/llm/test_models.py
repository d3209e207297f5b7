"""Classifiers: accuracy on rows that were held out, awkward rows, and the factorisation machine's identity."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from featherline.llm import quality as q, toxicity as t
from featherline.llm.queries import QUERIES
from tests.llm import cases

TENTH = "/root/testdata/sf0.1"


def accuracy(spark, name, column):
    labels = spark.read.parquet(f"{TENTH}/labels.parquet").where(F.col(column).isNotNull())
    return QUERIES[name](spark, TENTH).join(labels, "doc_id").where("held_out").agg(
        F.avg((F.col("predicted") == F.col(column)).cast("double")), F.avg(F.when(F.col(column) == 1, F.col("predicted")).cast("double")),
        F.avg(F.when(F.col(column) == 0, F.col("predicted")).cast("double"))).first()


def test_quality_of_held_out_rows(spark):
    right, good, bad = accuracy(spark, "op6_quality", "quality")
    assert right > 0.97 and good > 0.97 and bad < 0.05


def test_toxicity_of_held_out_rows(spark):
    right, toxic, clean = accuracy(spark, "op5_toxicity", "toxic")
    assert right > 0.95 and toxic > 0.7 and clean < 0.01


def labelled(spark):
    docs = cases.documents(spark, [(k, ("vile idiot " if k % 2 else "kind friend ") + cases.sentence(k, 20), None, None, None if k % 3 else 100,
                                    *["clash"] * len(cases.EXTRA)) for k in range(300)] + cases.rows())
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(300)] + [(1, None, None), (None, 1, 1), (2, 7, 7), (3, 1, 1), (3, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    return docs, labels


@pytest.mark.parametrize("operator", [q.quality, t.toxicity])
def test_awkward_rows(spark, operator):
    docs, labels = labelled(spark)
    found = operator(docs, labels).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    assert all(r.row["size"] == "clash" and r.row.score == "clash" for r in found)
    by_text = {}
    for r in found:
        assert by_text.setdefault((r.row.text or "", r.row.n_chars), r.score) == pytest.approx(r.score, abs=1e-9)
    assert len({r.score for r in found if not r.row.text}) <= 2
    first = operator(docs, labels, keep=["doc_id"]).collect()
    again = operator(docs.repartition(7), labels.repartition(5), keep=["doc_id"]).collect()
    ordered = [sorted((r.row.doc_id or -1, r.score) for r in x) for x in (first, again)]
    assert [i for i, _ in ordered[0]] == [i for i, _ in ordered[1]]
    assert [s for _, s in ordered[0]] == pytest.approx([s for _, s in ordered[1]])
    assert operator(cases.empty(spark), labels).count() == 0
    unknown = operator(docs, labels.limit(0), keep=["doc_id"]).select("score").distinct().collect()
    assert [r.score for r in unknown] == [0.5]


def test_held_out_labels_change_nothing(spark):
    docs, labels = labelled(spark)
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    other = labels.withColumn("toxic", F.when(part == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [sorted((r.row.doc_id or -1, r.score) for r in t.toxicity(docs, x, keep=["doc_id"]).collect()) for x in (labels, other)]
    assert scores[0] == scores[1] and zlib.crc32(b"5") % 4 == docs.select(F.crc32(F.lit("5").cast("binary")) % 4).first()[0]


def test_interactions_are_all_pairs():
    random = np.random.default_rng(0)
    w = random.normal(size=(50, 4))
    place, value = random.integers(0, 50, 12), random.normal(size=12)
    row = np.array([0] * 5 + [2] * 7)
    got = q.interaction_logits(w, 0.5, place, value, row, 4)
    for k in range(4):
        i = np.flatnonzero(row == k)
        want = 0.5 + sum(w[place[a], 0] * value[a] for a in i) + sum(
            (w[place[a], 1:] @ w[place[b], 1:]) * value[a] * value[b] for a, b in itertools.combinations(i, 2))
        assert got[k] == pytest.approx(want)


def test_training_is_ftrl_proximal(monkeypatch):
    """Weights against the update written out coordinate by coordinate, and the sparsity that L1 gives."""
    monkeypatch.setattr(t, "BITS", 6)
    random = np.random.default_rng(1)
    examples = [(k, int(random.random() < 0.4), np.unique(random.integers(0, 40, 6)), np.zeros(0)) for k in range(120)]
    for _, y, places, _ in examples:
        places[:1] = 63 if y else places[0]
    examples = [(o, y, np.unique(p), x) for o, y, p, x in examples]
    z, n = {}, {}

    def weight(i, l1):
        zi = z.get(i, 0.0)
        return 0.0 if abs(zi) <= l1 else -(zi - np.sign(zi) * l1) / ((t.BETA + n.get(i, 0.0) ** 0.5) / t.ALPHA + t.L2)

    for epoch in range(t.EPOCHS):
        for k in np.random.default_rng(epoch).permutation(len(examples)):
            _, y, places, _ = examples[k]
            w = {i: weight(i, t.L1) for i in places.tolist()}
            w["bias"] = weight("bias", 0.0)
            g = 1 / (1 + np.exp(-sum(w.values()))) - y
            for i in w:
                sigma = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / t.ALPHA
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = n.get(i, 0.0) + g * g
    made = t.train(examples)
    want = {i: weight(i, t.L1) for i in range(64)}
    got = dict(zip(made["places"].astype(int).tolist(), made["weights"].tolist()))
    assert set(got) == {i for i, w in want.items() if w} and 0 < len(got) < len({i for _, _, p, _ in examples for i in p.tolist()})
    assert all(got[i] == pytest.approx(want[i], rel=1e-5) for i in got)
    assert made["intercept"][0] == pytest.approx(weight("bias", 0.0), rel=1e-5)
