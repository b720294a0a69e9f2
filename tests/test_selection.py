"""Exact quantiles by bits against sorted values."""

import random

import pytest

from waymark.operators import selection


def brute(values, share):
    v = sorted(values)
    at = share * (len(v) - 1)
    lo, hi = int(at // 1), int(-(-at // 1))
    return v[lo] if lo == hi else (hi - at) * v[lo] + (at - lo) * v[hi]


@pytest.mark.parametrize("settled", [4096, 1])
def test_quantiles_by_sorting(spark, settled):
    r = random.Random(2)
    rows = [("hot", 1, r.choice([0.0, -0.0, 1.5, 2.0**-1060, -3e300])) for _ in range(400)]
    rows += [("near", 2, 1.0 + r.random() * 1e-12) for _ in range(301)] + [(None, 3, r.gauss(0, 1e3)) for _ in range(200)] + [("one", None, 7.5)]
    rows += [("wide", 5, r.choice([-1, 1]) * 10 ** r.uniform(-300, 300)) for _ in range(200)] + [("inf", 6, v) for v in (float("inf"), float("-inf"), 1.0)]
    gone = [("none", 1, None), ("none", 1, float("nan")), ("hot", 1, None), (None, 3, float("nan"))]
    df = spark.createDataFrame(rows + gone, "k string, j int, v double").repartition(4)
    shares = {"p50": 0.5, "p90": 0.9, "low": 0.0, "top": 1.0}
    got = {(x.k, x.j): (x.n, x.p50, x.p90, x.low, x.top) for x in selection.quantiles(df, ["k", "j"], "v", shares, settled).collect()}
    groups = {}
    for k, j, v in rows:
        groups.setdefault((k, j), []).append(v)
    assert got == {g: (len(v), *(brute(v, s) for s in shares.values())) for g, v in groups.items()}


def test_no_keys_and_no_rows(spark):
    df = spark.createDataFrame([(float(v),) for v in range(10)], "v double")
    assert [tuple(x) for x in selection.quantiles(df, [], "v", {"m": 0.5}).collect()] == [(10, 4.5)]
    assert selection.quantiles(df.where("v < 0"), [], "v", {"m": 0.5}).collect() == []
