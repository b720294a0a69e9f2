"""The levelling network against dense least squares."""

import random

import numpy as np
import pytest

from waymark.operators import levelling


def dense(nodes, ties):
    """Offsets of smallest norm: the mean of each component is 0."""
    at = {n: k for k, n in enumerate(nodes)}
    m, y = np.zeros((len(ties), len(nodes))), np.zeros(len(ties))
    for k, (a, b, dz, w) in enumerate(ties):
        m[k, at[b]], m[k, at[a]], y[k] = w**0.5, -(w**0.5), -dz * w**0.5
    return dict(zip(nodes, np.linalg.lstsq(m, y, rcond=None)[0]))


def test_offsets_by_dense_least_squares(spark):
    r = random.Random(2)
    true = {f"c{k:02d}": r.uniform(-2, 2) for k in range(25)}
    names = sorted(true)
    ties = [(a, b, true[a] - true[b] + r.gauss(0, 0.02), r.randrange(5, 300)) for part in (names[:17], names[17:]) for i, a in enumerate(part) for b in part[i + 1 : i + 4]]
    bad = [(names[0], names[9], true[names[0]] - true[names[9]] + 40.0, 10), (names[3], names[12], true[names[3]] - true[names[12]] - 25.0, 10)]
    df = spark.createDataFrame(ties + bad + [("c00", "c00", 1.0, 5), ("c01", None, 1.0, 5), ("c01", "c02", None, 5), ("c01", "c05", 9.0, 0)], "a string, b string, dz double, w long").repartition(3)
    offsets, judged = levelling.level(df)
    got = {x.node: (x.group, x.offset) for x in offsets.collect()}
    want = dense(names, ties)
    assert all(abs(got[n][1] - want[n]) < 1e-6 for n in names)
    assert {n: g for n, (g, _) in got.items()} == {n: "c00" if n < "c17" else "c17" for n in names}
    flagged = {(x.a, x.b) for x in judged.where("rejected").collect()}
    assert flagged == {(a, b) for a, b, *_ in bad} and judged.count() == len(ties) + 2
    for x in judged.collect():
        assert x.residual == pytest.approx(x.dz + want[x.b] - want[x.a], abs=1e-6)


def test_no_ties(spark):
    offsets, judged = levelling.level(spark.createDataFrame([], "a string, b string, dz double, w long"))
    assert offsets.collect() == [] and judged.collect() == []


def test_chunks_of_the_small_table_by_dense_least_squares(spark):
    """chunk_levels: offsets of all chunks from their seams, against one dense solution over the ties that were kept."""
    from waymark.operators import seams
    from waymark.plans.queries import _tracks

    ties = seams.seam_ties(_tracks(spark, "/root/testdata/sf0.001"), 6.0, 5)
    offsets, judged = levelling.level(ties)
    rows = judged.collect()
    kept = [(x.a, x.b, x.dz, x.w) for x in rows if not x.rejected]
    nodes = sorted({n for x in rows for n in (x.a, x.b)})
    want = dense(nodes, kept)
    got = {x.node: x.offset for x in offsets.collect()}
    assert got.keys() == set(nodes) and len(nodes) > 3
    assert all(abs(got[n] - want[n]) < 1e-6 for n in nodes)
