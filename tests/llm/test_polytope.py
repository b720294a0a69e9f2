"""Near-duplicate vectors against all pairs."""

import numpy as np
import pytest

from waymark.llm import polytope


def brute(rows, cosine=0.95):
    """(vec_id, n_links, component_id, kept) of rows with vectors that take part."""
    ids = [i for i, _ in rows]
    x = np.array([v for _, v in rows], dtype=np.float64)
    x /= np.sqrt((x**2).sum(axis=1))[:, None]
    near = x @ x.T >= cosine
    np.fill_diagonal(near, False)
    label = list(ids)
    changed = True
    while changed:
        changed = False
        for k in range(len(ids)):
            low = min([label[k], *(label[j] for j in np.flatnonzero(near[k]))])
            changed |= low != label[k]
            label[k] = low
    return sorted((i, int(near[k].sum()), label[k], label[k] == i) for k, i in enumerate(ids))


def cloud(rng, n, width):
    x = rng.normal(size=(n, width))
    return x / np.sqrt((x**2).sum(axis=1))[:, None]


def at_cosine(rng, x, c):
    g = rng.normal(size=x.shape)
    g -= (g * x).sum(axis=-1, keepdims=True) * x
    return c * x + np.sqrt(1 - c * c) * g / np.sqrt((g**2).sum(axis=-1, keepdims=True))


def made(width, seed=1):
    """Singles, pairs and chains about the threshold, one tight group, one loose group, equal vectors."""
    rng = np.random.default_rng(seed)
    x = [cloud(rng, 300, width)]
    for c in (0.93, 0.949, 0.951, 0.96, 0.99):
        a = cloud(rng, 40, width)
        x += [a, at_cosine(rng, a, c)]
    step = cloud(rng, 1, width)
    for _ in range(12):
        x.append(step)
        step = at_cosine(rng, step, 0.955)
    hub = cloud(rng, 1, width)
    x += [at_cosine(rng, np.repeat(hub, 120, axis=0), 0.995), at_cosine(rng, np.repeat(hub, 60, axis=0), 0.965), np.repeat(cloud(rng, 1, width), 90, axis=0)]
    x = np.concatenate(x)
    return [(int(i), v.tolist()) for i, v in zip(rng.permutation(len(x)), x)]


@pytest.mark.parametrize("width, crowd", [(64, 256), (64, 16), (24, 8)])
def test_links_and_groups_by_all_pairs(spark, width, crowd):
    rows = made(width)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = sorted(tuple(x) for x in polytope.near_vectors(df, crowd=crowd, miss=1e-6).collect())
    assert got == brute(rows)


def test_recall_at_the_threshold(spark):
    """Pairs at a cosine of 0.9501: at most a few of a thousand are missed, and what is linked is a link."""
    rng = np.random.default_rng(5)
    a = cloud(rng, 1000, 64)
    b = at_cosine(rng, a, 0.9501)
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([a, b]))]
    got = {x.vec_id: x.n_links for x in polytope.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert sum(got.values()) >= 2 * 990 and max(got.values()) == 1


def test_cases(spark):
    nan, inf = float("nan"), float("inf")
    v = [0.5, -1.0, 2.0]
    rows = [(1, v), (2, None), (3, []), (4, [0.0, 0.0, 0.0]), (5, [1.0, nan, 0.0]), (6, [inf, 0.0, 0.0]), (7, [1.0, None, 2.0]), (None, v), (8, [1e300, -2e300, 4e300]), (8, [0.0, 1.0]), (8, v), (9, [1e-320 * x for x in (1, 1, 1)]), (10, [0.5, -1.0, 2.0, 0.0])]
    df = spark.createDataFrame([(i, x, "n", 0) for i, x in rows], "vec_id long, embedding array<double>, node string, core int")
    got = sorted((tuple(x) for x in polytope.near_vectors(df).collect()), key=str)
    alone = [(i, 0, i, True) for i in (2, 3, 4, 5, 6, 7)]
    group = [(1, 3, 1, True), (8, 3, 1, False), (8, 3, 1, False), (10, 3, 1, False)]
    assert got == sorted([*alone, *group, (8, 0, 8, True), (9, 0, 9, True), (None, 0, None, True)], key=str)
    assert polytope.near_vectors(df.limit(0)).collect() == []
    assert [tuple(x) for x in polytope.near_vectors(df.where("vec_id in (2, 4)")).orderBy("vec_id").collect()] == [(2, 0, 2, True), (4, 0, 4, True)]
    floats = spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 4.0])], "vec_id long, embedding array<float>")
    assert {tuple(x) for x in polytope.near_vectors(floats).collect()} == {(1, 1, 1, True), (2, 1, 1, False)}
