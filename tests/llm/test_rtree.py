"""Hard negatives against brute force, and the trees themselves."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymark.llm import rtree
from waymark.llm.rtree import RTree, Windows


def brute(rows, positives=5, negatives=3, low=50, high=95):
    """rows: (id, label, vector, asks)."""
    fine = [r for r in rows if None not in r[:3] and None not in r[2]]
    width = max((len(r[2]) for r in fine), default=0)
    fine = [(i, c, tuple(v) + (0,) * (width - len(v)), a) for i, c, v, a in fine]
    out = []
    for i, c, v, _ in {r[:3] + (True,) for r in fine if r[3]}:
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), j, d) for j, d, w, _ in fine if j != i))
        own = [(j, -s) for s, j, d in scored if d == c][:positives]
        for j, s in own:
            fit = [(k, -t) for t, k, d in scored if d != c and low * s <= -100 * t <= high * s][:negatives]
            out += [(i, j, n + 1, k, s, t) for n, (k, t) in enumerate(fit)]
    return sorted(out)


def made(seed, n=500, width=6, span=5, labels=4):
    r = random.Random(seed)
    centre = [[r.randint(-span, span) for _ in range(width)] for _ in range(7)]
    rows = []
    for i in range(n):
        c = r.choice(centre)
        rows.append((i, r.randrange(labels), [x + r.randint(-2, 2) for x in c], i % 10 == 0))
    return rows


@pytest.mark.parametrize("seed, tree_rows, page", [(1, 4096, 64), (2, 40, 4), (3, 17, 1)])
def test_negatives_by_brute_force(spark, seed, tree_rows, page):
    rows = made(seed)
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<long>, asks boolean").repartition(3)
    got = sorted(tuple(x) for x in rtree.hard_negatives(df, F.col("asks"), tree_rows=tree_rows, page=page).collect())
    assert got == brute(rows) and got


def test_cases(spark):
    big = 1 << 40
    rows = made(4, 60) + [(1000, None, [1] * 6, True), (1001, 1, None, True), (1002, 1, [1, None, 1, 1, 1, 1], True), (None, 1, [1] * 6, True), (1003, 99, [3] * 6, True), (1004, 1, [2, 1], True), (1005, 1, [], True)]
    rows += [(5, 2, [4] * 6, False), (5, 2, [4] * 6, False), (1006, 3, [9] * 6, True), (1006, 3, [9] * 6, True), (1007, 3, [big] * 6, True), (1008, 3, [big, 1, 2, 3, 4, 5], False), (1009, 2, [big // 2 + 1] * 6, False)]
    df = spark.createDataFrame([(i, c, v, a, 1, b"x") for i, c, v, a in rows], "vec_id long, label int, vector array<long>, asks boolean, q int, tree binary")
    own = df.filter("vec_id is null or vec_id not in (1007, 1008, 1009)")
    left = [r for r in rows if r[0] not in (1007, 1008, 1009)]
    assert sorted(tuple(x) for x in rtree.hard_negatives(own, F.col("asks"), tree_rows=20, page=3).collect()) == brute(left)
    # Beyond a long: 6 * 2**80 and its like are cut to the largest long.
    got = [tuple(x) for x in rtree.hard_negatives(df, F.col("asks")).where("anchor_id = 1007").collect()]
    assert got and all(p == 1008 and s == (1 << 63) - 1 for _, p, _, _, s, _ in got if p == 1008)
    assert rtree.hard_negatives(df.limit(0), F.col("asks")).collect() == []
    assert rtree.hard_negatives(df, F.lit(False)).collect() == []


def test_wide_scores_are_exact(spark):
    """Scores between 2**53 and 2**63, where doubles would round."""
    r = random.Random(8)
    rows = [(i, i % 2, [r.randint(0, 1 << 29) for _ in range(3)], i % 9 == 0) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<long>, asks boolean")
    assert sorted(tuple(x) for x in rtree.hard_negatives(df, F.col("asks"), tree_rows=16, page=2).collect()) == brute(rows)


def test_boxes_hold_what_is_below_them():
    rng = np.random.default_rng(3)
    m, labels, ids = rng.integers(-50, 50, (700, 5)), rng.integers(0, 6, 700), np.arange(700)
    t = RTree.undump(RTree.pack(ids, labels, m, 8).dump())
    assert sorted(t.ids.tolist()) == ids.tolist() and (t.vectors == m[t.ids]).all() and (t.labels == labels[t.ids]).all()

    def check(node):
        a, b = t.first[node], t.last[node]
        if t.leaf[node]:
            rows = np.arange(a, b)
            assert len(rows) <= 8
        else:
            rows = np.concatenate([check(k) for k in range(a, b)])
        assert (t.low[node] == t.vectors[rows].min(axis=0)).all() and (t.high[node] == t.vectors[rows].max(axis=0)).all()
        assert t.label_low[node] == t.labels[rows].min() and t.label_high[node] == t.labels[rows].max()
        return rows

    assert sorted(check(0).tolist()) == list(range(700))


def test_boxes_spare_most_scores_in_few_dimensions():
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(50, 4)) * 300
    m = np.rint(centre[rng.integers(0, 50, 4000)] + rng.normal(size=(4000, 4)) * 5).astype(np.int64)
    labels = rng.integers(0, 10, 4000)
    t = RTree.pack(np.arange(4000), labels, m, 64)
    of = np.arange(100)
    w = Windows(of, labels[:100], m[:100], of, np.full(100, -(1 << 62)), np.full(100, 1 << 62), 5, True)
    w.visit(t)
    assert w.computed < 0.15 * 100 * 4000
    s = np.where((labels[None] == labels[:100, None]) & (np.arange(4000)[None] != of[:, None]), m[:100] @ m.T, -(1 << 62))
    assert (w.score == -np.sort(-s, axis=1)[:, :5]).all()
