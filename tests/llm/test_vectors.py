"""Vector operators against brute force in double precision."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from featherline.llm import connected, hamming, vptree
from featherline.llm.vectors import cosine

SCHEMA = "vec_id long, embedding array<float>, label int, score string, id string, rank string"


def table(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "s", "i", "r") for i, v in vectors], SCHEMA).repartition(3)


def cases(seed=0, n=400, groups=12):
    random = np.random.default_rng(seed)
    x = random.normal(size=(n, 16)).astype(np.float32)
    for g in range(groups):  # copies and near copies
        members = random.integers(0, n, random.integers(2, 40))
        x[members] = x[members[0]] + random.choice([0, 0.1, 0.2]) * random.normal(size=(len(members), 16))
    found = [(k * 3, v.tolist()) for k, v in enumerate(x)]
    found += [(5001, None), (5002, [0.0] * 16), (5003, [float("nan")] * 16), (5004, [None] + [1.0] * 15), (5005, [float("inf")] + [1.0] * 15),
              (5006, []), (5007, x[0].tolist()), (5008, (x[0] * 2).tolist()), (None, x[1].tolist()), (5050, x[3].tolist()), (5100, (x[3] * 1e-30).tolist())]
    return found


def usable(vectors):
    return [(i, np.array(v, dtype=float)) for i, v in vectors
            if i is not None and v and all(x is not None for x in v) and np.isfinite(np.array(v, dtype=float)).all() and np.any(np.array(v, dtype=np.float32) != 0)]


@pytest.mark.parametrize("seed", [0, 1])
def test_near_duplicates(spark, monkeypatch, seed):
    monkeypatch.setattr(hamming, "BLOCK", 16)
    monkeypatch.setattr(hamming, "FEW", 4)
    vectors = cases(seed)
    good = usable(vectors)
    x = np.array([np.array(v, np.float32).astype(float) for _, v in good])
    near = cosine(np.repeat(x, len(x), 0), np.tile(x, (len(x), 1))).reshape(len(x), -1) >= 0.95
    np.fill_diagonal(near, False)
    got = {r.vec_id: r for r in hamming.near_duplicates(table(spark, vectors)).collect()}
    assert len(got) == len(vectors)
    links = sum(got[i].n_links for i, _ in good)
    assert 0.9 * near.sum() <= links <= near.sum()
    assert all(got[i].n_links <= n for (i, _), n in zip(good, near.sum(1)))
    ids = np.array([i for i, _ in good])
    label = ids.copy()
    while True:
        lower = np.array([min(label[k], label[near[k]].min(initial=label[k])) for k in range(len(label))])
        if (lower == label).all():
            break
        label = lower
    assert sum(got[i].component_id == c for i, c in zip(ids.tolist(), label.tolist())) >= 0.95 * len(ids)
    for i in (5001, 5002, 5003, 5004, 5005, 5006):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, True)
    assert all(r.kept == (r.component_id == i) for i, r in got.items() if i is not None)


def around_a_mean(n, squared, seed=0, d=64, cosine_of_pairs=0.953):
    """Unit vectors whose mean has that squared norm, and for each one a vector at that cosine with the same share of the mean."""
    random = np.random.default_rng(seed)
    own, other = (random.normal(size=(n, d - 1)) for _ in range(2))
    own /= np.linalg.norm(own, axis=1, keepdims=True)
    other -= (other * own).sum(1, keepdims=True) * own
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    c = 1 - (1 - cosine_of_pairs) / (1 - squared)
    near = c * own + np.sqrt(1 - c * c) * other
    return [np.column_stack([np.full(n, np.sqrt(squared)), np.sqrt(1 - squared) * x]) for x in (own, near)]


@pytest.mark.parametrize("squared", [0.3, 0.6])
def test_near_duplicates_around_a_mean(spark, squared):
    x, y = around_a_mean(1500, squared)
    got = {r.vec_id: r for r in hamming.near_duplicates(table(spark, enumerate(np.concatenate([x, y]).tolist()))).collect()}
    assert sum(got[k].component_id == got[k + 1500].component_id for k in range(1500)) >= 0.94 * 1500


@pytest.mark.parametrize("squared", [0.0, 0.3, 0.6, 0.8])
@pytest.mark.parametrize("classes", [1 << 20, 3_000_000, 1 << 24])
def test_recall_of_the_plan_at_production_width(squared, classes):
    x, y = around_a_mean(8000, squared)
    mean, turn, width, tables = hamming.plan(x[:6000], classes, 0.95)
    assert 1 <= tables <= hamming.TABLES
    met = (hamming.substrings(x[6000:], mean, turn, width) == hamming.substrings(y[6000:], mean, turn, width)).any(axis=1)
    assert met.mean() >= 0.94


def test_near_duplicates_of_nothing(spark):
    assert hamming.near_duplicates(table(spark, [])).count() == 0
    assert [tuple(r) for r in hamming.near_duplicates(table(spark, [(1, None)])).collect()] == [(1, 0, 1, True)]
    one = [(k, [1.0, 2.0]) for k in range(50)]
    assert {tuple(r)[1:] for r in hamming.near_duplicates(table(spark, one)).collect() if r.vec_id} == {(49, 0, False)}


def brute_nearest(vectors, k=5):
    good = usable(vectors)
    x = np.array([np.array(v, np.float32).astype(float) for _, v in good])
    found = []
    for q, (i, _) in enumerate(good):
        if i % 50 == 0:
            scores = cosine(np.repeat(x[q:q + 1], len(x), 0), x)
            ranked = sorted((-s, j) for s, (j, _) in zip(scores, good) if j != i)[:k]
            found += [(i, r + 1, j, -s) for r, (s, j) in enumerate(ranked)]
    return found


@pytest.mark.parametrize("shard_rows", [8192, 150])
def test_nearest_is_exact_at_factor_one(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(vptree, "LEAF_ROWS", 16)
    vectors = cases(2)
    got = vptree.nearest(table(spark, vectors), F.col("vec_id") % 50 == 0, shard_rows=shard_rows, query_rows=7).collect()
    assert sorted(map(tuple, got)) == sorted(brute_nearest(vectors))


def test_tree_prunes_and_relaxes():
    random = np.random.default_rng(1)
    centers = random.normal(size=(40, 8)) * 4
    raw = np.repeat(centers, 50, 0) + 0.1 * random.normal(size=(2000, 8))
    unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
    order, nodes, radii = vptree.build(unit)
    visited = []
    for factor in (1.0, 3.0):
        search = vptree.Search(order, raw[order], nodes, radii, np.arange(100) + 10**6, raw[:100], 5, factor)
        search.run()
        visited.append(search.visited)
        if factor == 1.0:
            want = np.sort(cosine(np.repeat(raw[:100], 2000, 0), np.tile(raw, (100, 1))).reshape(100, 2000), axis=1)[:, :-6:-1]
            assert np.array_equal(search.best, want)
    assert visited[1] <= visited[0] < 100 * 2000 / 2


def test_nearest_of_few(spark):
    assert vptree.nearest(table(spark, []), F.col("vec_id") % 50 == 0).count() == 0
    assert vptree.nearest(table(spark, [(50, [1.0, 0.0])]), F.col("vec_id") % 50 == 0).count() == 0
    two = vptree.nearest(table(spark, [(50, [1.0, 0.0]), (51, [1.0, 1.0]), (52, [1.0])]), F.col("vec_id") % 50 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in two] == [(50, 1, 51)]
    with pytest.raises(ValueError):
        vptree.nearest(table(spark, []), F.lit(True), factor=0.5)


def test_components(spark):
    random = np.random.default_rng(0)
    edges = [(int(a), int(a) + 1) for a in range(0, 60)] + [(200, 100 + k) for k in range(50)] + [(300, 300), (None, 4), (9, 3), (9, 3)]
    edges += [(int(1000 + a), int(1000 + b)) for a, b in random.integers(0, 200, (120, 2))]
    label = {}

    def find(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            label[max(x, y)] = min(x, y)
    got = {r.id: r.component for r in connected.components(spark.createDataFrame(edges, "a long, b long").repartition(3)).collect()}
    assert got == {x: find(x) for x in label}
    assert connected.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_searches_carry_the_best_of_a_block_from_tree_to_tree():
    random = np.random.default_rng(2)
    raw, asked = random.normal(size=(900, 6)), random.normal(size=(30, 6))
    found = None
    for ids in np.array_split(np.arange(900), 3):
        order, nodes, radii = vptree.build(vptree.unit(raw[ids]))
        search = vptree.Search(ids[order], raw[ids][order], nodes, radii, np.arange(30) + 10**6, asked, 5, 1.0, earlier=found)
        search.run()
        found = search.best, search.best_ids
    scores = cosine(np.repeat(asked, 900, 0), np.tile(raw, (30, 1))).reshape(30, 900)
    want = np.argsort(-scores, axis=1, kind="stable")[:, :5]
    assert np.array_equal(found[1], want) and np.array_equal(found[0], np.take_along_axis(scores, want, 1))


def test_blocks_of_queries_are_neither_broadcast_nor_copied_for_every_tree(spark):
    vectors = cases(3)
    found = vptree.nearest(table(spark, vectors), F.col("vec_id") % 50 == 0, shard_rows=40, query_rows=4)
    assert sorted(map(tuple, found.collect())) == sorted(brute_nearest(vectors))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Broadcast" not in plan and "explode" not in plan


@pytest.mark.parametrize("x", [[[0.5, -2.0]], [[0.1, 3.0]], [[1e300, 0.0]], [[5e-324, 1.0]]])
def test_lean_vectors(x):
    held = vptree.lean(np.array(x))
    assert len(held) == (8 if x[0][0] == 0.5 else 16) and vptree.full(pa.py_buffer(held), 1, 2).tolist() == x
