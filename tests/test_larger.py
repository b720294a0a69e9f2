"""Queries on tables that are larger, or have larger keys, than the given ones."""

import math
import random
import time

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from waymark.operators import corridor, discs, encounters, levelling, route, seams
from waymark.plans.oracles import ORACLES
from waymark.plans.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["centre_lines", "road_lines"])
def test_lines_of_users_beyond_an_int(spark, tmp_path, name):
    """Users counted on by a multiple of 77 drive the same ways, and the lines' numbers start anew: 77,000 times 100,000 is no int."""
    duckdb.sql(f"copy (select * replace (user_id + 77000 as user_id) from '{SMALL}/events.parquet') to '{tmp_path}/events.parquet' (format parquet)")
    got = sorted(map(tuple, QUERIES[name](spark, str(tmp_path)).collect()))
    assert got == sorted(map(tuple, QUERIES[name](spark, SMALL).collect())) and got


def test_levels_keep_what_sql_keeps_of_equal_contributions(spark):
    """At sf0.1 the cut falls among contributions that are equal but for the last bit of an exp."""
    duck = duckdb.connect()
    duck.execute("create view lineitem as select * from '/root/testdata/sf0.1/lineitem.parquet'")
    want = duck.execute(ORACLES["lod_tiles"]).fetchall()
    got = QUERIES["lod_tiles"](spark, "/root/testdata/sf0.1").select("chunk", "idx", "p", "s", "e", "opacity").collect()
    assert sorted(map(tuple, got)) == sorted(want) and len(got) == 75000


def test_differences_by_all_pairs():
    r = np.random.default_rng(4)
    for n, extent, high in ((3000, 6, 900), (2500, 18, 1500), (4000, 1, 2), (1800, 40, 300_000)):
        a, b = [(np.round(r.normal(0, extent / 4, m), 3), np.round(r.normal(0, extent / 4, m), 3), r.integers(-high, high, m)) for m in (n, n + 500)]
        near = (a[0][:, None] - b[0]) ** 2 + (a[1][:, None] - b[1]) ** 2 <= 36.0
        want = np.unique((b[2] - a[2][:, None])[near], return_counts=True)
        dz, count = discs.differences(a, b, 6.0)
        assert dz.tolist() == want[0].tolist() and count.tolist() == want[1].tolist()


@pytest.mark.parametrize("exact", [False, True])
def test_crowded_buckets_meet_without_a_look_at_each_pair(spark, exact):
    """Two chunks of 60,000 points on one square metre: 3,600 million pairs, with heights of 0 to 4 and 100 to 104 mm."""
    p = spark.range(120_000).select(F.concat(F.lit("c"), F.col("id") % 2).alias("chunk"), (F.col("id") * 7919 % 1000 / 1000).alias("x"), (F.col("id") * 104729 % 1000 / 1000).alias("y"), ((F.floor(F.col("id") / 2) % 5 + F.col("id") % 2 * 100) / 1000).alias("z"))
    began = time.time()
    assert [tuple(x) for x in seams.seam_pairs(p, exact=exact).collect()] == [("c0", "c1", 3_600_000_000, 0.1, 0.103, "agree")]
    assert time.time() - began < 60


def test_a_gathered_network_is_levelled_like_one_that_stays(spark):
    r = random.Random(8)
    true = {f"c{k:02d}": r.uniform(-2, 2) for k in range(14)}
    names = sorted(true)
    ties = [(a, b, true[a] - true[b] + r.gauss(0, 0.02), r.randrange(5, 300)) for part in (names[:9], names[9:]) for i, a in enumerate(part) for b in part[i + 1 : i + 4]]
    df = spark.createDataFrame([*ties, ("c00", "c05", true["c00"] - true["c05"] + 30.0, 9)], "a string, b string, dz double, w long")
    (one, judged), (two, other) = (levelling.level(df, gathered=n) for n in (100_000, 0))
    got, want = ({x.node: (x.group, x.offset) for x in o.collect()} for o in (one, two))
    assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-8 for k in got)
    marks = [sorted((x.a, x.b, x.rejected, round(x.residual, 7)) for x in j.collect()) for j in (judged, other)]
    assert marks[0] == marks[1] and sum(m[2] for m in marks[0]) == 1


def test_levelling_takes_few_jobs(spark):
    """300 chunks in a ring: as many steps as there are nodes, which were a join and two jobs each."""
    df = spark.range(300).select(F.format_string("c%03d", "id").alias("a"), F.format_string("c%03d", (F.col("id") + 1) % 300).alias("b"), F.lit(0.01).alias("dz"), F.lit(1).alias("w"))
    began = time.time()
    assert levelling.level(df)[0].count() == 300 and time.time() - began < 20


@pytest.mark.parametrize("block", [1, 60, 1 << 16])
def test_routes_by_blocks_are_the_greedy_chain(spark, block):
    """Retraces against a plain fold over all pairs of vertices, whatever comes to a block."""
    r = np.random.default_rng(6)
    walks = {k: np.round(r.normal(0, 3, 3) + np.cumsum(r.normal(0, 1.2, (int(r.integers(2, 30)), 3)), axis=0), 3) for k in range(40)}
    rows = [(k, i, *map(float, v)) for k, w in walks.items() for i, v in enumerate(w)]
    length = {k: float(np.sqrt((np.diff(w, axis=0) ** 2).sum(axis=1)).sum()) for k, w in walks.items()}
    kept = []
    for k in sorted((k for k in walks if length[k] >= 4.0), key=lambda k: (-length[k], k)):
        near = sum(any(((v - w) ** 2).sum() <= 2.25 for o in kept for w in walks[o]) for v in walks[k])
        if not kept or near < 0.6 * len(walks[k]):
            kept.append(k)
    got = route.build_route(spark.createDataFrame(rows, "pass long, seq long, x double, y double, z double"), 1e9, 4.0, 0.6, 1.5, block).collect()
    assert {x["pass"] for x in got} == set(kept) and 5 < len(kept) < 35 and [x.ord for x in got] == list(range(len(kept)))


def test_passes_that_all_come_near_each_other_gather_no_sets(spark):
    """600 passes along one line: each vertex is near all longer passes, 599 of them."""
    p = spark.range(60_000).select(F.floor(F.col("id") / 100).alias("pass"), (F.col("id") % 100).alias("seq"), (F.col("id") % 100 * (1 + F.floor(F.col("id") / 100) / 10_000)).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("z"))
    began = time.time()
    assert [(x["pass"], x.ord) for x in route.build_route(p, 60.0, 5.0, 0.9, 20.0).collect()] == [(599, 0)]
    assert time.time() - began < 30


@pytest.mark.parametrize("crowd", [1 << 15, 3000])
def test_a_crowd_of_segments_is_not_met_pair_by_pair(spark, crowd):
    """20,000 points and 5,000 segments on a few metres: 100 million pairs; every hundredth point against all segments, ties by pass and index."""
    r = np.random.default_rng(9)
    a = np.round(r.uniform(0, 3, (5000, 3)), 2)
    b = np.round(a + r.uniform(-1, 1, (5000, 3)), 2)
    a[:50], b[:50] = a[50:100], b[50:100]
    p = np.round(r.uniform(-1, 4, (20_000, 3)), 2)
    p[:100] = a[:100]
    segs = spark.createDataFrame([(k % 70, k, *map(float, (*a[k], *b[k]))) for k in range(5000)], "pass long, idx long, ax double, ay double, az double, bx double, by_ double, bz double")
    points = spark.createDataFrame([(k, *map(float, v)) for k, v in enumerate(p)], "k long, x double, y double, z double")
    began = time.time()
    got = {x.k: (x.d, x.qx, x.qy, x.qz) for x in corridor.nearest_on_corridor(points, "k", segs, 1.0, crowd).collect()}
    assert time.time() - began < 60 and len(got) == 20_000
    for k in [*range(100), *range(100, 20_000, 100)]:
        d = b - a
        t = np.clip(((p[k] - a) * d).sum(axis=1) / (d * d).sum(axis=1), 0, 1)
        far = ((p[k] - a - t[:, None] * d) ** 2).sum(axis=1)
        m = min(np.flatnonzero(far <= far.min() + 1e-12), key=lambda m: (m % 70, m))
        assert got[k] == pytest.approx((far[m] ** 0.5, *(a[m] + t[m] * d[m])), abs=1e-6)


@pytest.mark.parametrize("block", [1, 40, 1 << 15])
@pytest.mark.parametrize("median", [True, False])
def test_encounters_by_all_pairs(spark, block, median):
    """Passes of uneven length, one with a number twice, one with a place missing, on a grid of half metres, so that points lie at the radius exactly."""
    r = np.random.default_rng(2)
    rows = [(k, i, *map(float, np.round(r.normal(0, 3, 3) * 2) / 2)) for k in (3, 5, 6, 9, 12, 40) for i in range(int(r.integers(1, 25)))]
    rows += [(9, 0, 0.5, 0.5, 0.5), (12, 99, None, 1.0, 1.0)]
    got = encounters.encounters(spark.createDataFrame(rows, "pass long, seq long, x double, y double, z double"), "xy" if median else "xyz", 2.0, median, not median, median, block).collect()
    want = {}
    for a, s, *p in rows:
        for b, _, *q in rows:
            if None not in (*p, *q) and (a < b if median else a != b):
                d = math.sqrt(sum((u - v) ** 2 for u, v in zip(p[: 3 - median], q)))
                if d < 2.0 or (d == 2.0 and not median):
                    near = want.setdefault((a, b), {})
                    near[s] = min(d, near.get(s, d))
    assert {(x.a, x.b): (x.n, x.every) for x in got} == {k: (len(v), sum(row[0] == k[0] for row in rows)) for k, v in want.items()} and len(want) > 8
    assert not median or {(x.a, x.b): x.median for x in got} == {k: float(np.median(list(v.values()))) for k, v in want.items()}
