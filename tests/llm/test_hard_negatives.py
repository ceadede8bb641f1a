import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewloom.llm import hard_negatives as H

SCHEMA = "vec_id bigint, embedding array<float>, label int, rank string, angle string"


def brute(rows, anchor_every, k=5, m=5, low=80, high=100):
    """The contract, pair by pair, in whole numbers."""
    known = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole = [int(np.floor(256 * float(np.float32(x)))) for x in v]
            known[i] = min(known.get(i, (label, whole)), (label, whole))
    out = set()
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    for a, (label, v) in known.items():
        if a % anchor_every:
            continue
        scored = sorted((-score(v, w), i, other) for i, (other, w) in known.items() if i != a)
        for p, i, _ in [x for x in scored if x[2] == label][:k]:
            fits = [x for x in scored if x[2] != label and low * -p <= 100 * -x[0] <= high * -p][:m]
            out |= {(a, i, r + 1, j, -p, -n) for r, (n, j, _) in enumerate(fits)}
    return out


def mine(spark, rows, every, **more):
    data = [(i, v, label, "x", "y") for i, v, label in rows]
    frame = spark.createDataFrame(data, SCHEMA).repartition(3)
    return {tuple(r) for r in H.mine_hard_negatives(frame, F.col("vec_id") % every == 0, **more).collect()}


def vectors(seed, n, dims=8, labels=3, clusters=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(clusters, 1), dims)) * (clusters > 0)
    out = []
    for i in range(n):
        x = centres[rng.integers(len(centres))] * 2 + rng.normal(size=dims)
        out.append((i, [float(np.float32(c)) for c in x / np.linalg.norm(x) * rng.uniform(0.2, 2)], int(rng.integers(labels))))
    return out


@pytest.mark.parametrize("seed, clusters", [(1, 0), (2, 5), (3, 30)])
def test_equals_brute_force(spark, seed, clusters):
    rows = vectors(seed, 700, clusters=clusters)
    want = brute(rows, 10)
    assert want and mine(spark, rows, 10) == want
    assert mine(spark, rows, 10, anchor_rows=20) == want


def test_ties_copies_and_odd_rows(spark):
    rng = random.Random(5)
    rows = vectors(4, 120, dims=4)
    rows += [(1000 + i, [0.5, 0.5, 0.0, 0.0], i % 2) for i in range(300)]  # one vector a great many times
    rows += [(2000, None, 1), (2001, [0.1, None, 0.2, 0.3], 1), (2002, [float("nan")] * 4, 1), (2003, [float("inf"), 0.0, 0.0, 0.0], 0), (None, [1.0] * 4, 1), (2010, [1.0] * 4, None)]
    rows += [(2020, [], 1), (2030, [0.0] * 4, 0), (2040, [1.0, 0.5], 1), (2050, [1.0, 0.5, 0.25, 0.1, 0.9, 0.9], 0), (2060, [-1.0] * 4, 9)]
    rows += [rows[0], rows[10], (20, [9.0] * 4, 99), (-10, [0.5, 0.5, 0.1, 0.0], 1)]
    rng.shuffle(rows)
    want = brute(rows, 10)
    assert any(r[0] == -10 for r in want) and mine(spark, rows, 10) == want


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**22 + 3 * i), float(2**21 - i)], i % 2) for i in range(40)]
    want = brute(rows, 10)
    assert want and mine(spark, rows, 10) == want


def test_empty_table_and_no_anchor(spark):
    assert mine(spark, [], 10) == set()
    assert mine(spark, vectors(1, 30), 1000) == brute(vectors(1, 30), 1000)
    assert mine(spark, vectors(1, 30)[1:], 1000) == set()


@pytest.mark.parametrize("seed", range(4))
def test_bounds_hold_for_rows_and_runs(seed):
    rng = np.random.default_rng(seed)
    a = np.floor(256 * rng.normal(size=(20, 6))).astype(np.int64)
    b = np.floor(256 * rng.normal(size=(64, 6)) * 10.0 ** rng.integers(-3, 2, size=(64, 1))).astype(np.int64)
    b[:20] = a * rng.integers(-2, 3, size=(20, 1))  # parallel, opposite and zero rows
    refs = rng.normal(size=(5, 6))
    refs[0] = a[0]
    refs /= np.linalg.norm(refs, axis=1)[:, None]
    (aa, an), (ba, bn) = H.angles_to(a, refs), H.angles_to(b, refs)
    scores = a @ b.T
    low, high = H.score_bounds(aa, an, ba, ba, bn, bn)
    assert (low <= scores).all() and (scores <= high).all()
    assert (high - low)[0].max() <= 2 + 1e-3 * an[0] * bn.max()  # an anchor along a direction is bounded tightly
    starts = np.arange(0, 64, 16)
    low, high = H.score_bounds(aa, an, np.minimum.reduceat(ba, starts), np.maximum.reduceat(ba, starts), np.minimum.reduceat(bn, starts), np.maximum.reduceat(bn, starts))
    for k in range(4):
        run = scores[:, 16 * k : 16 * k + 16]
        assert (low[:, k, None] <= run).all() and (run <= high[:, k, None]).all()


def test_filter_leaves_rows_out():
    """In clustered vectors most rows are never scored."""
    rows = np.array([[int(256 * x) for x in v] for _, v, _ in sorted(vectors(6, 2000, dims=6, clusters=12), key=lambda r: r[1])])
    refs = rows[::160].astype(float)
    refs /= np.linalg.norm(refs, axis=1)[:, None]
    angles, norms = H.angles_to(rows, refs)
    best = np.sort(rows[:20] @ rows.T, axis=1)[:, -5]
    _, high = H.score_bounds(angles[:20], norms[:20], angles, angles, norms, norms)
    assert (high >= best[:, None]).mean() < 0.7


def test_best_lists_keep_ties_by_id():
    lists = H.BestLists(2, 2)
    lists.add(np.array([0, 0, 1]), np.array([5, 5, 1]), np.array([9, 3, 4]))
    lists.settle()
    assert lists.least[0] == 5
    lists.add(np.array([0, 0]), np.array([5, 7]), np.array([1, 8]))
    slot, score, ids = lists.settle()
    assert list(zip(slot, score, ids)) == [(0, 7, 8), (0, 5, 1), (1, 1, 4)]
