"""Capture operators: known answers, brute force and edge cases; registered queries against their SQL."""

import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from waymark.functions import geo, optics, scalars
from waymark.operators import align, capture, connectivity, corridor, drive, partition, passes, route, seams, shared, world
from waymark.plans.oracles import ORACLES
from waymark.plans.queries import QUERIES
from waymark.sources import files, ply

SMALL = "/root/testdata/sf0.001"


def duck(sql):
    c = duckdb.connect()
    for t in ("embeddings", "events", "lineitem", "orders", "part"):
        c.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    r = c.execute(sql)
    return [d[0] for d in r.description], r.fetchall()


def plain(row):
    return tuple(round(v, 5) + 0.0 if isinstance(v, float) else int(v) if isinstance(v, int) else v for v in row)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, name):
    names, want = duck(ORACLES[name])
    got = [plain(x) for x in QUERIES[name](spark, SMALL).select(*names).collect()]
    assert sorted(got, key=str) == sorted(map(plain, want), key=str) and got


def test_geodesy_of_known_places(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0), (90.0, 0.0, 0.0), (45.0, 45.0, 100.0)], "lat double, lon double, alt double")
    x, y, z = geo.ecef(F.col("lat"), F.col("lon"), F.col("alt"))
    r = df.select(x.alias("x"), y.alias("y"), z.alias("z")).collect()
    assert r[0] == (6378137.0, 0.0, 0.0) and abs(r[1].z - 6356752.3142) < 1e-3
    lat, lon, alt = geo.geodetic(F.lit(0.0), F.lit(0.0), F.lit(-6356752.314245))
    assert df.limit(1).select(lat, lon, F.round(alt, 3)).first() == (-90.0, 0.0, 0.0)


def test_halo_and_least_frames(spark):
    f = spark.createDataFrame([(0, "a", 1.0, 1.0, 0.0), (1, "a", 9.5, 1.0, 0.0), (2, "", 10.5, 1.0, 0.0), (3, None, None, 1.0, 0.0)], "seq long, video string, x double, y double, z double")
    m = partition.chunk_members(f, 10, 1, 2)
    assert {(r.chunk, r.seq, r.is_core) for r in m.collect()} == {("chunk_x0_y0", 0, True), ("chunk_x0_y0", 1, True), ("chunk_x0_y0", 2, False)}
    assert partition.chunk_manifest(m, 10).first().passes == ["a"]


def test_camera_rules(spark):
    cams = spark.createDataFrame([(1, 5.0, 5.0), (2, 14.0, 5.0), (3, 40.0, 5.0)], "image_id long, x double, y double")
    seen = spark.createDataFrame([(2, 5.0, 5.0)] * 3, "image_id long, x double, y double")
    cells = spark.createDataFrame([("c", 0.0, 0.0, 10.0, 10.0)], "chunk string, x0 double, y0 double, x1 double, y1 double")

    def ids(rule, least=3):
        return {r.image_id for r in partition.camera_rule(cams, seen, cells, rule, 1.0, least).collect()}

    assert ids("crop") == {1, 2, 3} and ids("cell") == {1} and ids("inria") == {1, 2} and ids("inria", 4) == {1}


def test_thin_keeps_ends(spark):
    p = spark.createDataFrame([(1, k, float(k), 0.0, 0.0) for k in range(8)] + [(2, 0, 0.0, 0.0, 0.0), (2, 1, 0.1, 0.0, 0.0)], "pass int, seq long, x double, y double, z double")
    got = {(r["pass"], r.seq) for r in passes.thin(p, ["pass"], 3.0).collect()}
    assert got == {(1, 0), (1, 3), (1, 6), (1, 7), (2, 0), (2, 1)}


def test_selection_drops_partial_windows_and_carries_the_mark(spark):
    rows = [(0, 0, 0.0, 1.0), (0, 1, 1.0, 5.0), (0, 2, 2.0, 9.0), (1, 3, 3.0, 1.0), (1, 4, 5.0, 1.0)]
    c = spark.createDataFrame([("v", *r) for r in rows], "video string, seg int, i long, dist double, sharp double")
    assert [r.i for r in passes.select_frames(c, ["video"], 3.0).orderBy("i").collect()] == [0, 3]
    assert passes.select_frames(c, ["video"], 0).count() == 5


def test_times_without_any(spark):
    s = spark.createDataFrame([("v", 0, None), ("v", 1, None)], "video string, i long, t double")
    assert [r.t for r in passes.nudge_times(s, ["video"]).orderBy("i").collect()] == [0.0, 1.0]


def test_near_corridor_against_brute_force(spark):
    import random

    r = random.Random(1)
    pts = [(k, r.uniform(-50, 50), r.uniform(-50, 50), r.uniform(-2, 2)) for k in range(300)]
    line = [(0, k, r.uniform(-50, 50), r.uniform(-50, 50), 0.0) for k in range(12)]
    segs = corridor.segments(spark.createDataFrame(line, "pass int, seq long, x double, y double, z double"), ["pass"])
    got = {x.k for x in corridor.near_corridor(spark.createDataFrame(pts, "k int, x double, y double, z double"), ["k"], segs, 3.0).collect()}

    def far(p, a, b):
        d = [b[i] - a[i] for i in (0, 1)]
        t = max(0, min(1, sum((p[i] - a[i]) * d[i] for i in (0, 1)) / max(d[0] ** 2 + d[1] ** 2, 1e-12)))
        return math.hypot(*[p[i] - a[i] - t * d[i] for i in (0, 1)])

    assert got == {k for k, x, y, _ in pts if min(far((x, y), line[i][2:4], line[i + 1][2:4]) for i in range(11)) <= 3.0} and got


def test_merge_without_corridor_keeps_all_owned(spark):
    g = spark.createDataFrame([("a", 0.0, 0.0, 99.0), ("a", 10.0, 0.0, 0.0)], "chunk string, x double, y double, z double")
    c = spark.createDataFrame([("a", 0.0, 0.0, 10.0, 10.0)], "chunk string, x0 double, y0 double, x1 double, y1 double")
    none = spark.createDataFrame([], "chunk string, pass int, ax double, ay double, bx double, by_ double")
    bands = spark.createDataFrame([], "chunk string, z_lo double, z_hi double")
    m = world.merge_world(g, c, none, 1.0, bands)
    assert m.count() == 1 and world.merge_world(g, c, None, 1.0, None).count() == 1
    assert tuple(world.tile_totals(g, c, m).first()) == ("a", 2, 1, 1)


def test_seams_without_overlap(spark):
    p = spark.createDataFrame([("a", 0.0, 0.0, 0.0), ("b", 90.0, 0.0, 0.0)], "chunk string, x double, y double, z double")
    gate = seams.seam_gate(seams.seam_pairs(p)).first()
    assert gate.skipped and not gate.ok and gate.worst is None


def test_exact_seams_cross_buckets(spark):
    p = spark.createDataFrame([("a", 5.9, 0.0, 0.0), ("b", 6.1, 0.0, 2.0)], "chunk string, x double, y double, z double")
    assert seams.seam_pairs(p, 6.0, 1).count() == 0
    assert seams.seam_pairs(p, 6.0, 1, exact=True).first().verdict == "marginal"


def test_route(spark):
    rows = [(0, k, 10.0 * k, 0.0, 0.0) for k in range(11)] + [(1, k, 10.0 * k, 1.0, 0.0) for k in range(10)] + [(2, k, 200.0 - 10.0 * k, 5.0, 0.0) for k in range(10)] + [(3, k, 1000.0 + 10 * k, 0.0, 0.0) for k in range(9)] + [(4, 0, 0.0, 0.0, 0.0), (4, 1, 1.0, 0.0, 0.0)]
    p = spark.createDataFrame(rows, "pass long, seq long, x double, y double, z double")
    got = [(r["pass"], r.flip) for r in route.build_route(p).orderBy("ord").collect()]
    assert got[0][0] in (0, 3) and ({g[0] for g in got} in ({0, 2}, {3}))
    assert route.build_route(p.where("pass = 4")).count() == 0


def test_groups_and_weak_passes(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    m = spark.createDataFrame([(0, 0, 100), (0, 1, 2), (1, 0, 2), (1, 2, 9), (2, 1, 9), (3, 4, 1), (4, 3, 1), (5, 5, 7)], "a int, b int, pairs long")
    assert {(r["pass"], r.group) for r in connectivity.pass_groups(m).collect()} == {(0, 0), (1, 0), (2, 0), (3, 3), (4, 3), (5, 5)}
    assert {r["pass"] for r in connectivity.weak_passes(m).collect()} == {0, 5}


def test_groups_that_do_not_settle(spark):
    chain = spark.createDataFrame([(a, b, 1) for i in range(12) for a, b in ((i, i + 1), (i + 1, i))], "a int, b int, pairs int")
    assert {x.group for x in connectivity.pass_groups(chain).collect()} == {0}
    with pytest.raises(RuntimeError):
        connectivity.pass_groups(chain, rounds=1)


def test_profiles(spark):
    sfx = [".mp4", ".jpg"]
    rules = [("equirect-360", 5, sfx, 1, None, 0), ("pinhole", 0, sfx, 1, None, 6), ("gopro-360-generic", 1, [".360"], 2, None, 1), ("gopro-max", 10, [".360"], 2, ["4096x1344", "2272x736"], 2)]
    p = spark.createDataFrame(rows := rules, "name string, priority int, suffixes array<string>, tracks int, sizes array<string>, load_order int")
    f = spark.createDataFrame([("a/B.360", 2, 4096, 1344), ("c.360", 2, 1, 1), ("d.JPG", 1, 5, 5), ("e.txt", 1, 5, 5)], "path string, tracks int, width int, height int")
    assert {(r.path, r.profile, r.score) for r in capture.detect_profiles(f, p).collect()} == {("a/B.360", "gopro-max", 110), ("c.360", "gopro-360-generic", 1), ("d.JPG", "equirect-360", 5), ("e.txt", None, None)} and rows


@pytest.mark.parametrize("name, want", [("cam3/000874.jpg", 874), ("cam0/x22.png", 22), ("none.jpg", None), ("a1b2c.jpg", 2)])
def test_frame_numbers(spark, name, want):
    assert spark.range(1).select(scalars.frame_number(F.lit(name))).first()[0] == want


def test_lod_rounds_half_to_even_and_keeps_one(spark):
    t = spark.createDataFrame([("a", k, 0.0, 0.0, 0.0, 0.0, 1.0) for k in range(5)] + [("b", 0, 0.0, 0.0, 0.0, 0.0, 1.0)], "chunk string, idx long, opacity double, scale_0 double, scale_1 double, scale_2 double, f_rest_0 double")
    out = world.level_of_detail(t, 0.5, sh=False)
    assert "f_rest_0" not in out.columns and sorted((r.chunk, r.idx) for r in out.collect()) == [("a", 0), ("a", 1), ("b", 0)]


def test_trim_reversals(spark):
    p = spark.createDataFrame([(0, 0, 5.0, 0.0, 0.0), (0, 1, 0.0, 0.0, 0.0), (0, 2, 20.0, 0.0, 0.0), (0, 3, 60.0, 0.0, 0.0), (0, 4, 40.0, 0.0, 0.0)], "pass int, seq long, x double, y double, z double")
    assert [r.seq for r in drive.trim_reversals(p, ["pass"]).orderBy("seq").collect()] == [1, 2, 3, 4]


def test_empty_residuals_are_zero(spark):
    e = spark.createDataFrame([], "seq long, x double, y double")
    assert tuple(align.residuals(e, e).first()) == (0, 0.0, 0.0, 0.0)


def test_ply_round_trip(spark, tmp_path):
    ply.register(spark)
    rows = [(float(k), -1.5 * k, 2.0, k % 100, k * 7) for k in range(2500)]
    df = spark.createDataFrame(rows, "x float, y double, opacity float, red tinyint, label int")
    df.repartition(3).write.format("ply").mode("append").save(str(tmp_path / "a"))
    assert len([f for f in os.listdir(tmp_path / "a") if f.endswith(".ply")]) == 3
    back = spark.read.format("ply").option("rowsPerTask", 100).load(str(tmp_path / "a"))
    assert sorted(tuple(r) for r in back.select("x", "y", "opacity", "red", "label").collect()) == rows
    assert back.select("idx").distinct().count() >= 833


def test_text_sources(spark, tmp_path):
    (tmp_path / "geo.txt").write_text("cam0/0 1.0 2.0 3.0\ncam0/1 4 5 6\ncam0/0 7 8 9\n\n")
    assert {(r.rel, r.lat) for r in files.geo_index(spark, str(tmp_path / "geo.txt")).collect()} == {("cam0/0", 7.0), ("cam0/1", 4.0)}
    (tmp_path / "enu.txt").write_text("a 1 2 3\nb 1 2\n")
    assert [tuple(r) for r in files.enu_reference(spark, str(tmp_path / "enu.txt")).collect()] == [("a", 1.0, 2.0, 3.0)]
    tags = [("v", f"Doc1-{k}:{t}", v) for k, s in ((2, "02"), (10, "10.500")) for t, v in (("GPSLatitude", "1"), ("GPSLongitude", "2"), ("GPSDateTime", f"2024:01:01 00:00:{s}Z"))] + [("v", "Doc1:Other", "x")]
    got = files.telemetry(spark.createDataFrame(tags, "video string, key string, value string")).orderBy("i").collect()
    assert [(r.i, r.t, r.alt) for r in got] == [(0, 0.0, 0.0), (1, 8.5, 0.0)]
    env = spark.createDataFrame([("f", [("v", [[1.0, 2.0, 3.0], [4.0, 5.0, 6.0]])])], "frame string, passes array<struct<video: string, points: array<array<double>>>>")
    assert files.envelope_points(env).count() == 2


def test_published_layouts(spark):
    df = spark.createDataFrame([(5952, 1920), (4096, 1344)], "w int, h int")
    layout = optics.cube_layout(F.col("w"), F.col("h"))
    a, b = df.select(layout["side"], layout["blend"], F.round(F.lit(90.0) + layout["overlap_deg"], 2)).collect()
    assert tuple(a) == (2016, 96, 94.74) and tuple(b)[1:] == (32, 92.2)


def test_reprojection(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0, 2.0), (2, 0.0, 0.0, -2.0)], "point_id long, x double, y double, z double")
    seen = spark.createDataFrame([(1, 1, 53.0, 54.0), (2, 1, 0.0, 0.0)], "point_id long, image_id long, u double, v double")
    images = spark.createDataFrame([(1, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 100.0, 100.0, 50.0, 50.0)], "image_id long, qw double, qx double, qy double, qz double, tx double, ty double, tz double, fx double, fy double, cx double, cy double")
    assert tuple(align.reprojection_rms(points, seen, images).first()) == (1, 5.0)
    assert math.isnan(align.reprojection_rms(points, seen.limit(0), images).first().rms)


def test_degrees_minutes_seconds(spark):
    d, m, s = optics.degrees_minutes_seconds(F.lit(-12.5125))
    assert tuple(spark.range(1).select(d, m, F.round(s, 3)).first()) == (12, 30, 45.0)


def test_nearest_at_any_distance(spark):
    import random

    r = random.Random(2)
    line = [(p, k, r.uniform(-40, 40), r.uniform(-40, 40), r.uniform(-3, 3)) for p in (0, 1) for k in range(6)]
    pts = [(k, r.uniform(-900, 900), r.uniform(-50, 50), r.uniform(-90, 90)) for k in range(120)] + [(500, None, 1.0, 1.0), (501, 5.0, 5.0, 5.0), (501, 5.0, 5.0, 5.0)]
    segs = corridor.segments(spark.createDataFrame(line, "pass int, seq long, x double, y double, z double"), ["pass"])
    df = spark.createDataFrame(pts, "k int, x double, y double, z double")
    got = corridor.nearest_on_corridor(df, "k", segs, 3.0).collect()

    def far(p, a, b):
        d = [y - x for x, y in zip(a, b)]
        t = max(0, min(1, sum((q - x) * e for q, x, e in zip(p, a, d)) / max(sum(e * e for e in d), 1e-12)))
        return math.dist(p, [x + t * e for x, e in zip(a, d)])

    assert len(got) == len(pts)
    for x in got:
        want = None if x.x is None else min(far((x.x, x.y, x.z), line[i][2:], line[i + 1][2:]) for i in range(11) if i != 5)
        assert (x.d is None) == (want is None) and (want is None or abs(x.d - want) < 1e-9)
        assert want is None or abs(math.dist((x.x, x.y, x.z), (x.qx, x.qy, x.qz)) - want) < 1e-9
    held = corridor.guard(corridor.nearest_on_corridor(df, "k", segs, 3.0).where("d is not null"), 2.0, -1e9, 1e9, 0.5).collect()
    assert all(math.dist((x.gx, x.gy, x.gz), (x.qx, x.qy, x.qz)) <= 1.5 + 1e-9 for x in held)
    none = corridor.nearest_on_corridor(df, "k", segs.limit(0), 3.0)
    assert none.where("d is null").count() == len(pts)


def test_long_tracks_thin_in_linear_time(spark):
    import time

    p = spark.range(400_000).select(F.lit(1).alias("pass"), F.col("id").alias("seq"), F.col("id").cast("double").alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("z"))
    began = time.time()
    assert passes.thin(p, ["pass"], 1.0).count() == 400_000 and time.time() - began < 60
    holes = spark.createDataFrame([(1, 0, None, 0.0, 0.0), (1, 1, 5.0, 0.0, 0.0), (1, 2, 9.0, 0.0, 0.0)], "pass int, seq long, x double, y double, z double")
    assert [r.seq for r in passes.thin(holes, ["pass"], 1.0).orderBy("seq").collect()] == [0, 2]
    assert passes.thin(holes.limit(0), ["pass"], 1.0).count() == 0


def test_salted_seams_are_the_same(spark):
    import random

    r = random.Random(4)
    p = spark.createDataFrame([(r.choice("abc"), r.uniform(0, 9), r.uniform(0, 9), round(r.uniform(0, 4), 3)) for _ in range(400)] + [("a", 1.0, 1.0, 0.0)] * 30, "chunk string, x double, y double, z double").repartition(3)
    for exact in (False, True):
        own = [sorted(map(str, seams.seam_pairs(p, 6.0, 1, exact, crowd).collect())) for crowd in (10, 10_000)]
        assert own[0] == own[1] and len(own[0]) == 3


def test_places_and_names_without_digits(spark):
    df = spark.createDataFrame([("a", f"n{chr(97 + k % 26)}{chr(97 + k // 26)}") for k in range(60)] + [("b", "x"), ("b", "cam0/000008.jpg")], "variant string, name string").repartition(5)
    got = {(r.variant, r.name): r.place for r in shared.with_place(df, "variant", "name").collect()}
    assert got == {v: k for k, v in enumerate(sorted((r.variant, r.name) for r in df.collect()))}
    a = sorted(r.name for r in df.where("variant = 'a'").collect())
    assert {(r.variant, r.name) for r in capture.holdout(df, 4).collect()} == {("a", n) for n in a[::4]} | {("b", "cam0/000008.jpg")}


def test_pairs_to_match(spark):
    i = spark.createDataFrame([(k, f"cam0/{k:06d}.jpg") for k in range(9)], "image_id long, name string")
    assert {(r.a, r.b) for r in connectivity.pair_plan(i, "exhaustive").collect()} == {(a, b) for a in range(9) for b in range(a + 1, 9)}
    assert {(r.a, r.b) for r in connectivity.pair_plan(i, "sequential", 2).collect()} == {(a, b) for a in range(9) for b in range(a + 1, min(9, a + 3))}


@pytest.mark.parametrize("axis, roll", [((0.0, 1.0, 0.0), 0.0), ((0.6, -0.64, 0.48), 25.0), ((1.0, 0.0, 0.0), -70.0), ((0.0, 0.0, 1.0), 10.0), ((0.0, 0.0, -1.0), 0.0)])
@pytest.mark.parametrize("model", list(optics.LENSES))
def test_lens_against_vectors(spark, axis, roll, model):
    import random

    import numpy as np

    r = random.Random(5)
    dirs = [tuple((v / np.linalg.norm(v)).tolist()) for v in (np.array([r.gauss(0, 1) for _ in range(3)]) for _ in range(40))] + [axis]
    x, y, seen = optics.fisheye_pixel((F.col("x"), F.col("y"), F.col("z")), axis, 100.0, 200.0, 50.0, 170.0, model, roll)
    got = spark.createDataFrame(dirs, "x double, y double, z double").select(x, y, seen).collect()
    # Sideways and upright vectors of the picture by cross products, turned by the roll.
    side = np.cross((0, 0, 1) if abs(axis[2]) < 1 else (0, 1, 0), axis)
    side = side / np.linalg.norm(side)
    upright = np.cross(axis, side)
    turn = math.radians(roll)
    side, upright = math.cos(turn) * side + math.sin(turn) * upright, math.cos(turn) * upright - math.sin(turn) * side
    law = {"equidistant": lambda t: t, "equisolid": lambda t: 2 * math.sin(t / 2), "orthographic": math.sin, "stereographic": lambda t: 2 * math.tan(t / 2)}[model]
    for d, (px, py, inside) in zip(dirs, got):
        theta = math.acos(max(-1, min(1, float(np.dot(d, axis)))))
        assert inside == (theta <= math.radians(85))
        if inside:
            radius, to = 50 * law(theta) / law(math.radians(85)), math.atan2(np.dot(d, upright), np.dot(d, side))
            assert abs(px - 100 - radius * math.cos(to)) < 1e-6 and abs(py - 200 - radius * math.sin(to)) < 1e-6


def test_rationals(spark):
    got = spark.createDataFrame([(38.98138,), (-76.69057,), (0.0,), (None,)], "deg double").select(files.dms_rationals("deg").alias("r")).collect()
    for deg, r in zip((38.98138, 76.69057, 0.0), got):
        d, m, s = r.r
        assert abs(d.num / d.den + m.num / m.den / 60 + s.num / s.den / 3600 - deg) < 1e-8 and s.den <= 10_000
    assert got[3].r is None


def test_ply_overwrite_and_what_does_not_fit(spark, tmp_path):
    ply.register(spark)
    path = str(tmp_path / "p")
    df = spark.createDataFrame([(1.0, 5), (2.0, 6)], "x double, label long")
    df.write.format("ply").mode("append").save(path)
    df.limit(1).write.format("ply").mode("overwrite").save(path)
    assert [tuple(r) for r in spark.read.format("ply").load(path).select("x", "label").collect()] == [(1.0, 5)]
    with pytest.raises(Exception, match="doesn't fit"):
        spark.createDataFrame([(1 << 40,)], "label long").write.format("ply").mode("overwrite").save(path)
    assert spark.read.format("ply").load(path).count() == 1


def test_exports(spark, tmp_path):
    p = spark.createDataFrame([(0, k, float(k), 0.0, 0.0) for k in range(3)] + [(1, 0, 9.0, 9.0, 9.0)], "pass int, seq long, x double, y double, z double")
    rows = files.centerline(p, (38.98138, -76.69057, 0.0))
    files.write_centerline(rows, str(tmp_path / "c"))
    back = spark.read.option("header", True).csv(str(tmp_path / "c"))
    assert back.columns == ["pass", "index", "x_enu", "y_enu", "z_enu", "lat", "lon", "alt"] and back.count() == 3
    lines = files.obj_lines(p, 0.0, True)
    files.write_obj(lines.coalesce(1), str(tmp_path / "o"))
    assert [r.line for r in lines.orderBy("part", "ord").collect()][:2] == ["v 0.0000 0.0000 0.0000", "v 1.0000 0.0000 0.0000"] and lines.count() == 6
