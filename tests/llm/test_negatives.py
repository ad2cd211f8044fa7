"""Hard negatives from cover trees against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from windshear.llm import negatives as ng

SCHEMA = "vec_id long, label int, embedding array<double>, q string"


def brute(rows, every=100, positives=5, negatives=10, low=30, high=90):
    size = max((len(v) for _, _, v in rows), default=0)
    vec = {i: np.array([int(np.floor(256 * x)) for x in v] + [0] * (size - len(v)), object) for i, _, v in rows}
    label = {i: c for i, c, _ in rows}
    out = set()
    for a in (i for i in vec if i % every == 0):
        score = {i: int((vec[a] * vec[i]).sum()) for i in vec if i != a}
        first = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in first if label[i] == label[a]][:positives]:
            fit = [i for i in first if label[i] != label[a] and low * score[p] <= 100 * score[i] <= high * score[p]]
            out |= {(a, p, k + 1, i, score[p], score[i]) for k, i in enumerate(fit[:negatives])}
    return out


def result(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def vectors(n=900, d=6, groups=7, seed=1):
    rnd = np.random.default_rng(seed)
    centre = rnd.normal(size=(groups, d))
    rows = []
    for i in range(n):
        c = int(rnd.integers(groups))
        rows.append((i, int(rnd.integers(3)) if i % 4 else c % 3, (centre[c] + 0.05 * rnd.normal(size=d)).tolist()))
    copy = rows[5][2]
    rows += [(n + i, i % 2, copy) for i in range(150)]  # a large group of one vector
    return rows + [(n + 200 + i, 1, rows[7][2]) for i in range(40)]


@pytest.mark.parametrize("shard, cells, block", [(4096, 1024, 256), (64, 5, 4), (30, 40, 3)])
def test_equals_brute_force(spark, monkeypatch, shard, cells, block):
    for name, value in (("SHARD_ROWS", shard), ("CELLS", cells), ("BLOCK", block), ("ASKS", 8), ("LEAF", 8)):
        monkeypatch.setattr(ng, name, value)
    rows = vectors()
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    assert result(ng.mine(df, F.col("vec_id") % 25 == 0)) == brute(rows, 25)


def test_tree_radii_cover_and_bounds_skip():
    rows = vectors(3000, 3, 20)
    points = np.floor(256 * np.array([v for *_, v in rows]))
    top = float((points ** 2).sum(1).max())
    ids = np.arange(len(points))
    tree = ng.build_tree(points, ids, ids % 3, top)
    x = ng._lift(tree.points, top)
    assert sorted(tree.ids.tolist()) == ids.tolist() and tree.level.max() >= 2
    for leaf in np.flatnonzero(tree.stop > tree.start):
        node = leaf
        while node >= 0:  # each ancestor's radius covers the leaf's points
            far = np.linalg.norm(x[tree.start[leaf]:tree.stop[leaf]] - x[tree.centre[node]], axis=1).max()
            assert far <= tree.radius[node] + 1e-6
            node = tree.parent[node]
    checked = []
    verify, ng._verify = ng._verify, lambda *a: (checked.append(int(a[4].sum()) * int(tree.stop[a[5]] - tree.start[a[5]])), verify(*a))[1]
    try:
        one = ng.Asks(points[:8], ids[:8], ids[:8] % 3, np.ones(8, bool), np.full(8, -np.inf), np.full(8, np.inf), np.full(8, -np.inf))
        ask, got, score = ng.search(tree, one, 5)
    finally:
        ng._verify = verify
    assert sum(checked) < 0.5 * 8 * len(points)
    for i in range(8):
        s = points @ points[i]
        want = sorted((k for k in range(len(points)) if k % 3 == i % 3 and k != i), key=lambda k: (-s[k], k))[:5]
        assert got[ask == i].tolist() == want and score[ask == i].tolist() == s[want].tolist()


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.25]), (2, 2, [0.5, 0.5]), (3, 2, [0.5]), (4, 2, []), (100, 3, [2.0, 1.0]), (5, 2, [0.5, 0.5])]
    bad = [(6, None, [0.6, 0.5]), (7, 2, None), (8, 2, [0.5, None]), (9, 2, [nan, 0.5]), (10, 2, [inf, 0.5]), (None, 2, [0.5, 0.5])]
    df = spark.createDataFrame([(*r, "x") for r in good + good[2:4] + bad], SCHEMA)
    got = result(ng.mine(df, F.col("vec_id") % 100 == 0))
    assert got == brute(good) and {r[0] for r in got} == {0}
    assert ng.mine(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert ng.mine(df, F.col("vec_id") == -1).count() == 0
    # Of different rows of one id the smallest counts.
    more = df.union(spark.createDataFrame([(2, 9, [9.0, 9.0], "y")], SCHEMA))
    assert result(ng.mine(more, F.col("vec_id") % 100 == 0)) == brute(good)
    with pytest.raises(ValueError, match="2\\^52"):
        ng.mine(spark.createDataFrame([(0, 1, [1e300], "x")], SCHEMA), F.col("vec_id") == 0)
