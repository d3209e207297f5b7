"""Hard negatives and centroid clustering against plain Python integers."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from featherline.llm import negatives, nsimplex
from featherline.llm.negatives import bounds, hard_negatives, keys, unpacked
from featherline.llm.nsimplex import Simplex, candidates, clusters

#: Columns that the operators do not read, under names that they use inside.
SCHEMA = "vec_id long, embedding array<float>, label int, " + ", ".join(f"{name} string" for name in "id row rows v key anchor asks block kind stretch cluster distance n".split())
CLASHES = ["x"] * 13


def table(spark, vectors, cut=3):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], y, *CLASHES) for i, v, y in vectors]
    return spark.createDataFrame(rows, SCHEMA).repartition(cut)


def cases(seed=0, n=420, width=8, large=1.0):
    random = np.random.default_rng(seed)
    x = (random.normal(size=(n, width)) * large).astype(np.float32)
    x[random.integers(0, n, n // 3)] = x[0]  # a third of the rows are copies of one
    found = [(k * 5, v.tolist(), int(random.integers(0, 4))) for k, v in enumerate(x)]
    found += [(None, x[1].tolist(), 1), (None, x[2].tolist(), 2), (100, x[3].tolist(), 1), (100, x[3].tolist(), 1), (200, [0.0] * width, 2), (7, x[5].tolist(), None),
              (9001, None, 1), (9002, [None] + [1.0] * (width - 1), 1), (9003, [float("nan")] * width, 1), (9004, [float("inf")] * width, 2)]
    return found


def usable(vectors, scale, limit=2.0 ** 62):
    return [(i, [int(max(min(math.floor(scale * float(np.float32(x))), limit), -limit)) for x in v], y) for i, v, y in vectors
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]


def brute_negatives(vectors, positives=5, most=10, low=30, high=90):
    rows = [(i, v, (y + 1) % 10 if i is not None and i % 7 == 0 else y) for i, v, y in usable(vectors, 256.0) if y is not None]
    found = []
    for a, (i, v, y) in enumerate(rows):
        if i is None or i % 100:
            continue
        scored = sorted(((-min(max(sum(p * q for p, q in zip(v, w)), -(2 ** 63 - 1)), 2 ** 63 - 1), j is None, j or 0, j, z == y)
                         for b, (j, w, z) in enumerate(rows) if b != a), key=lambda s: s[:3])
        for p in [s for s in scored if s[4]][:positives]:
            inside = [s for s in scored if not s[4] and low * -p[0] <= 100 * -s[0] <= high * -p[0]]
            found += [(i, p[3], r + 1, s[3], -p[0], -s[0]) for r, s in enumerate(inside[:most])]
    return found


def told(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x or 0) for x in r))


def label():
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


@pytest.mark.parametrize("seed,large,block", [(0, 1.0, 4096), (1, 1.0, 50), (2, 1e6, 64), (3, 1e15, 64)])
def test_hard_negatives(spark, monkeypatch, seed, large, block):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(negatives, "ANCHOR_ROWS", max(3, block // 10))
    vectors = cases(seed, 420 if large == 1.0 else 150, large=large)
    got = hard_negatives(table(spark, vectors), label(), F.col("vec_id") % 100 == 0).collect()
    assert told(got) == told(brute_negatives(vectors))


def test_hard_negatives_do_not_depend_on_partitions(spark):
    vectors = cases(4)
    few, many = (hard_negatives(table(spark, vectors, cut), label(), F.col("vec_id") % 100 == 0).collect() for cut in (1, 9))
    assert told(few) == told(many)


def test_hard_negatives_of_few_rows(spark):
    def mined(vectors, **how):
        return hard_negatives(table(spark, vectors, 1), F.col("label"), F.col("vec_id") % 100 == 0, **how).collect()

    assert mined([]) == [] and mined([(1, [1.0], 1)]) == [] and mined([(100, [1.0], 1), (1, [1.0], 1)]) == []
    some = [(100, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 9.0], 2), (3, [0.95], 2), (4, [], 2)]
    assert told(mined(some)) == [(100, 1, 1, 2, 65536, 32768)]
    # A positive with score 0 takes the negatives with score 0; one below 0 takes none.
    assert told(mined([(100, [0.0], 1), (1, [1.0], 1), (2, [5.0], 2)])) == [(100, 1, 1, 2, 0, 0)]
    assert mined([(100, [-1.0], 1), (1, [1.0], 1), (2, [0.5], 2)]) == []
    with pytest.raises(ValueError):
        mined(some, low=50, high=120)


def test_keys_sort_as_their_values_do():
    random = np.random.default_rng(0)
    anchors, scores, ids, rows = (random.choice([-2 ** 62, -5, -1, 0, 1, 7, 2 ** 62], 500) for _ in range(4))
    missing, kinds = random.random(500) < 0.2, random.integers(0, 2, 500)
    packed = [keys(*(x[k:k + 1] for x in (anchors, scores)), int(kinds[k]), *(x[k:k + 1] for x in (ids, missing, rows)))[0].as_py() for k in range(500)]
    values = [(int(a), -int(s), int(k), bool(m), 0 if m else int(i), int(r)) for a, s, k, m, i, r in zip(anchors, scores, kinds, missing, ids, rows)]
    assert [values[k] for k in sorted(range(500), key=lambda k: packed[k])] == sorted(values)
    assert all(unpacked(p) == (v[0], -v[1], v[2], None if v[3] else v[4], v[5]) for p, v in zip(packed, values))


def test_bounds():
    for score in range(-40, 200):
        low, high = bounds(score, 30, 90)
        assert [n for n in range(-60, 220) if 30 * score <= 100 * n <= 90 * score] == list(range(low, high + 1))


def brute_clusters(vectors, k=8, rounds=10, width=64):
    rows = [(i, v) for i, v, _ in usable(vectors, 1024.0) if len(v) == width]
    order = sorted(rows, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centers = [list(v) for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centers))

    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in rows]
        for n in range(len(centers)):
            mine = [v for (_, v), c in zip(rows, of) if c == n]
            if mine:
                centers[n] = [sum(x) // len(mine) for x in zip(*mine)]
    held = [(i, *nearest(v)[::-1]) for i, v in rows]
    most = 2 ** 63 - 1
    inertia = {n: sum(d for _, c, d in held if c == n) for n in range(len(centers))}
    return [(i, c, min(d, most), min(inertia[c], most), min(sum(inertia.values()), most),
             hashlib.sha256(",".join(map(str, centers[c])).encode()).hexdigest()) for i, c, d in held]


@pytest.mark.parametrize("seed,n,large", [(0, 300, 1.0), (1, 120, 3e4), (2, 60, 1e13), (3, 20, 1e25), (4, 6, 1.0)])
def test_clusters(spark, monkeypatch, seed, n, large):
    monkeypatch.setattr(nsimplex, "BLOCK_ROWS", 64)
    vectors = cases(seed, n, 64, large) + [(9010, [1.0] * 63, 1), (9011, [1.0] * 65, 1), (9012, [], 1)]
    assert told(clusters(table(spark, vectors)).collect()) == told(brute_clusters(vectors))


def test_clusters_of_awkward_tables(spark):
    assert clusters(table(spark, [])).collect() == []
    assert clusters(table(spark, [(1, None, 1), (2, [1.0], 1)])).collect() == []
    same = [(k, [0.5] * 64, 1) for k in range(30)]
    assert {tuple(r)[1:5] for r in clusters(table(spark, same)).collect()} == {(0, 0, 0, 0)}
    schema = clusters(table(spark, [])).dtypes
    assert schema == clusters(table(spark, same)).dtypes


@pytest.mark.parametrize("spread", [1e-3, 1.0])
def test_bounds_of_apexes_hold_and_filter(spread):
    random = np.random.default_rng(5)
    centers = random.normal(size=(8, 64)) * 1000
    x = np.floor(centers[random.integers(0, 8, 2000)] + spread * 1000 * random.normal(size=(2000, 64)))
    simplex = Simplex(np.vstack([x[:20], x[:3]]))
    assert 1 < len(simplex.pivots) <= 20
    a, b = simplex.project(x), simplex.project(centers)
    exact = np.sqrt(((x[:, None] - centers[None]) ** 2).sum(axis=2))
    inside = ((a[:, None, :-1] - b[None, :, :-1]) ** 2).sum(axis=2)
    assert (np.sqrt(inside + (a[:, None, -1] - b[None, :, -1]) ** 2) <= exact * (1 + 1e-6) + 1e-3).all()
    assert (np.sqrt(inside + (a[:, None, -1] + b[None, :, -1]) ** 2) >= exact * (1 - 1e-6) - 1e-3).all()
    left = candidates(a, b, simplex.least_height)
    assert left[np.arange(2000), exact.argmin(axis=1)].all()
    if spread < 1:
        assert left.mean() < 0.3


def test_meetings_are_neither_broadcast_nor_shuffled_for_each_pair_of_blocks(spark, monkeypatch):
    seen, real = [], negatives._sorted
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 20)
    monkeypatch.setattr(negatives, "_sorted", lambda pairs: seen.append(pairs) or real(pairs))
    vectors = cases(5)
    got = hard_negatives(table(spark, vectors, 1), label(), F.col("vec_id") % 100 == 0).collect()
    assert told(got) == told(brute_negatives(vectors))
    assert len(seen) == 2
    for pairs, most in zip(seen, (5, 5 + 5 * 10)):
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" in plan and "Broadcast" not in plan and "explode" not in plan
        # One file of blocks is one task: it tells an anchor's first rows once.
        assert 0 < pairs.groupBy("anchor").count().agg(F.max("count")).first()[0] <= most


def test_first_rows_of_several_blocks():
    random = np.random.default_rng(0)
    scores, fits = random.integers(-5, 6, (3, 4000)), random.random((3, 4000)) < 0.7
    fits[2] = False
    missing, ids, rows = random.random(4000) < 0.1, random.integers(0, 300, 4000), random.permutation(4000)
    ids[missing] = 0
    first = negatives.First(np.array([7, 8, 9]), 1, 6)
    for some in np.array_split(np.arange(4000), 9):
        met = type("Met", (), {"missing": missing[some], "ids": ids[some], "rows": rows[some]})
        ranked = np.lexsort((met.rows, met.ids, met.missing))
        met.order = np.argsort(ranked)
        for begin in (0, 2):
            part = slice(begin, begin + 2)
            first.add(met, part, 0, scores[part][:, some], fits[part][:, some] & (scores[part][:, some] >= first.floor[part]))
        first.waiting += 1000
        first.rest()
    want = [(a, -scores[a, b], missing[b], ids[b], rows[b]) for a in range(3) for b in np.flatnonzero(fits[a])]
    want = [sorted(w for w in want if w[0] == a)[:6] for a in range(3)]
    assert first.floor[:, 0].tolist()[:2] == [-w[5][1] for w in want[:2]]
    got = sorted(unpacked(key)[::4] for key in first.told(1).column("key").to_pylist())
    assert got == sorted((int(w[0]) + 7, int(w[4])) for some in want for w in some)
