"""Registered queries of the capture operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.functions import geo, optics, scalars
from waymark.operators import align, capture, connectivity, corridor, drive, levelling, partition, passes, route, seams, views, world
from waymark.operators.shared import scratch_path
from waymark.plans import round_trips, pictures, streams
from waymark.plans.fixtures import ORIGIN, frames, gaussians
from waymark.sources import files, tables
from waymark.streaming import queue

CELL, HALO, LEAST = 20.0, 4.0, 5


def _r(c: str, n: int = 6) -> Column:
    return (F.round(c, n) + F.lit(0.0)).alias(c)


def frame_sequence(spark: SparkSession, d: str) -> DataFrame:
    return frames(spark, d)


def geo_round_trip(spark: SparkSession, d: str) -> DataFrame:
    f = frames(spark, d).select("seq", "x", "y", "z")
    lat, lon, alt = geo.enu_to_geodetic(F.col("x"), F.col("y"), F.col("z"), ORIGIN)
    g = f.withColumn("lat", lat).withColumn("lon", lon).withColumn("alt", alt)
    e, n, u = geo.enu(F.col("lat"), F.col("lon"), F.col("alt"), ORIGIN)
    return g.select("seq", F.round(e, 3).alias("e") + 0.0, F.round(n, 3).alias("n"), F.round(u, 3).alias("u")).toDF("seq", "e", "n", "u")


def local_plane(spark: SparkSession, d: str) -> DataFrame:
    g = frames(spark, d).select("seq", (F.lit(ORIGIN[0]) + F.col("y") / 111320).alias("lat"), (F.lit(ORIGIN[1]) + F.col("x") / 86000).alias("lon"), "z")
    x, y = geo.local_xy(F.col("lat"), F.col("lon"), *ORIGIN[:2])
    a, b, c = geo.y_up(x, y, F.col("z"))
    return g.select("seq", F.round(a, 3).alias("ax"), F.round(b, 3).alias("ay"), F.round(c, 3).alias("az"))


def members(spark: SparkSession, d: str) -> DataFrame:
    return partition.chunk_members(frames(spark, d), CELL, HALO, LEAST)


def chunk_members(spark: SparkSession, d: str) -> DataFrame:
    return members(spark, d).select("chunk", "cx", "cy", "seq", "is_core")


def chunk_manifest(spark: SparkSession, d: str) -> DataFrame:
    return partition.chunk_manifest(members(spark, d), CELL).select("chunk", "cx", "cy", "frames", "core_frames", F.array_join("passes", ",").alias("passes"), F.round(F.col("centre_x") + 1e-7, 3).alias("centre_x"), F.round(F.col("centre_y") + 1e-7, 3).alias("centre_y"), "x0", "y0", "x1", "y1")


def pass_split(spark: SparkSession, d: str) -> DataFrame:
    return passes.split_passes(frames(spark, d), ["video"], 1.5, 30).groupBy("video", "pass").agg(F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), F.count("*").alias("frames"))


def _corridor(spark: SparkSession, d: str) -> DataFrame:
    return corridor.corridor_points(frames(spark, d), ["video"], 1.0, 1.5, 30)


def corridor_points(spark: SparkSession, d: str) -> DataFrame:
    return _corridor(spark, d)


def corridor_band(spark: SparkSession, d: str) -> DataFrame:
    return corridor.height_band(_corridor(spark, d), ["video"], 8.0).select("video", _r("z_lo"), _r("z_hi"))


def candidates(spark: SparkSession, d: str) -> DataFrame:
    track = passes.track_distance(frames(spark, d).withColumn("x", F.col("x")), ["video"])
    c = frames(spark, d).select("video", "seq", "sharp", "t").join(track.select("seq", "dist"), "seq")
    return c.select("video", F.floor(F.col("t") / 60).cast("int").alias("seg"), F.col("seq").alias("i"), F.floor(F.col("dist") * 4).cast("double").alias("dist"), "sharp")


def frame_selection(spark: SparkSession, d: str) -> DataFrame:
    return passes.select_frames(candidates(spark, d), ["video"], 9.0)


def time_nudge(spark: SparkSession, d: str) -> DataFrame:
    s = frames(spark, d).select("video", F.col("seq").alias("i"), F.when(F.col("seq") % 7 != 0, F.floor(F.col("t") / 3).cast("double")).alias("t"))
    return passes.nudge_times(s, ["video"]).select("video", "i", F.round("t", 6).alias("t"))


def telemetry_interpolation(spark: SparkSession, d: str) -> DataFrame:
    f = frames(spark, d)
    asked = f.select("video", (F.col("t") + 0.2 - (F.col("seq") % 3) * 0.3).alias("t"))
    return passes.interpolate(f.where("seq % 4 = 0").select("video", "t", "x", "y", "z"), asked, "video", ["x", "y", "z"]).select("video", _r("t"), _r("x"), _r("y"), _r("z"))


def _tracks(spark: SparkSession, d: str) -> DataFrame:
    """Each chunk's corridor: its members' passes, thinned to five metres; its datum is off by a step, so that seams show."""
    m = members(spark, d).withColumn("z", F.col("z") + ((F.col("cx") * 7 + F.col("cy") * 13) % 5) * F.lit(0.9))
    return corridor.corridor_points(m, ["chunk"], 5.0, 30.0, 30.0)


def seam_pairs(spark: SparkSession, d: str) -> DataFrame:
    return seams.seam_pairs(_tracks(spark, d)).select("a", "b", "pairs", _r("median_dz"), _r("p90_dz"), "verdict")


def seam_report(spark: SparkSession, d: str) -> DataFrame:
    return seams.seam_report(seams.seam_pairs(_tracks(spark, d))).select("seams", _r("median"), _r("worst"), F.array_join("offenders", ",").alias("offenders"))


def seam_gate(spark: SparkSession, d: str) -> DataFrame:
    return seams.seam_gate(seams.seam_pairs(_tracks(spark, d))).select("seams", _r("upper_median"), _r("worst"), "skipped", "ok")


def chunk_levels(spark: SparkSession, d: str) -> DataFrame:
    """Height offsets of all chunks that make their seams agree; every third chunk's heights are off by some decimetres."""
    off = F.when(F.crc32(F.col("chunk").cast("binary")) % 3 == 0, F.crc32(F.col("chunk").cast("binary")) % 7 / 10).otherwise(0.0)
    ties = seams.seam_ties(_tracks(spark, d).withColumn("z", F.col("z") + off), 6.0, 5)
    return levelling.level(ties)[0].select(F.col("node").alias("chunk"), "group", _r("offset", 4))


def footprint_overlap(spark: SparkSession, d: str) -> DataFrame:
    m = partition.chunk_manifest(members(spark, d), CELL).select("chunk", "x0", "y0", "x1", "y1")
    hull = frames(spark, d).agg(*[f(F.col(c) / 3).alias(n) for f, c, n in ((F.min, "x", "x0"), (F.min, "y", "y0"), (F.max, "x", "x1"), (F.max, "y", "y1"))])
    return seams.footprints(m, hull).select("chunk", _r("share"))


def _merge_inputs(spark: SparkSession, d: str):
    m = partition.chunk_manifest(members(spark, d), CELL).select("chunk", "x0", "y0", "x1", "y1")
    pts = _tracks(spark, d)
    segs = corridor.segments(pts, ["chunk", "pass"])
    return gaussians(spark, d), m, segs, corridor.height_band(pts, ["chunk"], 1.0)


def merge_totals(spark: SparkSession, d: str) -> DataFrame:
    g, m, segs, bands = _merge_inputs(spark, d)
    return world.tile_totals(g, m, world.merge_world(g, m, segs, 1.5, bands))


def lod_tiles(spark: SparkSession, d: str) -> DataFrame:
    return world.level_of_detail(gaussians(spark, d), 0.125, False, ["idx", "p", "s", "e"]).select("chunk", "idx", "p", "s", "e", "opacity")


def corridor_guard(spark: SparkSession, d: str) -> DataFrame:
    """All frames, displaced, against the corridor of all passes."""
    segs = corridor.segments(_corridor(spark, d), ["video", "pass"])
    asked = frames(spark, d).select("seq", (F.col("x") + (F.col("seq") % 9 - 4)).alias("x"), (F.col("y") + (F.col("seq") % 5 - 2) * 1.5).alias("y"), (F.col("z") + (F.col("seq") % 4 - 1)).alias("z"))
    near = corridor.nearest_on_corridor(asked, "seq", segs, 1.0)
    return corridor.guard(near, 2.0, -1.0, 1.0).select("seq", _r("d"), "inside")


def residual_summary(spark: SparkSession, d: str) -> DataFrame:
    f = frames(spark, d)
    solved = f.select("seq", (F.col("x") + (F.col("seq") % 13) / 10).alias("x"), (F.col("y") - (F.col("seq") % 7) / 10).alias("y"))
    return align.residuals(solved, f).select("images", _r("median"), _r("p90"), _r("max"))


def residuals_by_video(spark: SparkSession, d: str) -> DataFrame:
    f = frames(spark, d)
    solved = f.select("video", "seq", (F.col("x") + (F.col("seq") % 13) / 10).alias("x"), (F.col("y") - (F.col("seq") % 7) / 10).alias("y"), (F.col("z") + (F.col("seq") % 3)).alias("z"))
    return align.pass_residuals(solved, f, "seq", "video").select("video", "n", *[_r(c) for c in ("horizontal_median", "horizontal_p90", "vertical_mean", "z_mean", "z_std")])


def warp_windows(spark: SparkSession, d: str) -> DataFrame:
    f = frames(spark, d)
    p = f.select("video", "seq", "x", "y", "z", (F.col("x") * 1.1 - F.col("y") * 0.2 + F.col("seq") % 5).alias("gx"), (F.col("x") * 0.2 + F.col("y") * 1.1 - F.col("seq") % 3).alias("gy"), (F.col("z") + F.col("seq") % 4).alias("gz"))
    return align.windowed_similarity(p, ["video"], 5).select("seq", F.round("yaw", 4).alias("yaw"), F.round("scale", 4).alias("scale"), F.round("dz", 4).alias("dz"), _r("wx", 4), _r("wy", 4), _r("wz", 3))


def path_resample(spark: SparkSession, d: str) -> DataFrame:
    return drive.resample(frames(spark, d).select("video", "seq", "x", "y", "z"), ["video"], 2.5).select("video", "i", _r("s", 4), _r("x", 4), _r("y", 4), _r("z", 4))


def path_smooth(spark: SparkSession, d: str) -> DataFrame:
    p = frames(spark, d).select("video", F.col("seq").alias("i"), F.col("t").alias("s"), "x", "y", "z")
    return drive.smooth(p, ["video"], 9).select("i", _r("x", 3), _r("y", 3), _r("z", 3))


def path_headings(spark: SparkSession, d: str) -> DataFrame:
    p = frames(spark, d).select("video", F.col("seq").alias("i"), "x", "y", "z")
    return drive.headings(p, ["video"], 4).select("i", _r("fx"), _r("fy"), _r("fz"))


def road_ribbon(spark: SparkSession, d: str) -> DataFrame:
    return drive.ribbon(frames(spark, d), ["video"], 6.0, 1.5).select("seq", _r("lx", 4), _r("ly", 4), _r("rx", 4), _r("ry", 4), _r("z", 4))


def pass_pair_matrix(spark: SparkSession, d: str) -> DataFrame:
    f = passes.split_passes(frames(spark, d), ["video"], 1.5, 30)
    ranges = f.groupBy("video").agg(F.min("seq").alias("seq_lo"), F.max("seq").alias("seq_hi")).select(F.expr("cast(substring(video, 2) as int)").alias("pass"), "seq_lo", "seq_hi")
    images = f.select(F.col("seq").alias("image_id"), F.format_string("cam0/%06d.jpg", "seq").alias("name"))
    pairs = f.select("seq", F.explode(F.array(F.lit(1), F.lit(40), F.lit(95))).alias("k")).select((F.col("seq") * F.lit(2147483647) + F.col("seq") + F.col("k")).alias("pair_id"), ((F.col("seq") * 7 + F.col("k")) % 40).alias("rows"))
    return connectivity.pass_matrix(pairs, connectivity.image_passes(images, ranges))


def queue_state(spark: SparkSession, d: str) -> DataFrame:
    return capture.status_counts(_queue(spark, d))


def _queue(spark: SparkSession, d: str) -> DataFrame:
    e = spark.read.parquet(f"{d}/events.parquet")
    kind = F.create_map(*[F.lit(x) for p in (("signup", "claim"), ("view", "heartbeat"), ("purchase", "done"), ("error", "failed")) for x in p])
    q = e.select(F.concat(F.lit("stage"), (F.col("user_id") % 4).cast("string")).alias("stage"), (F.col("user_id") * 100 + F.col("event_id") % 97).cast("string").alias("item"), "ts", kind[F.col("event_type")].alias("kind")).where("kind is not null")
    return capture.queue_status(q, "2024-02-01 00:00:00", 86400.0 * 20)


def holdout_common(spark: SparkSession, d: str) -> DataFrame:
    f = frames(spark, d)
    a = f.select(F.lit("a").alias("variant"), F.format_string("cam3/%06d.jpg", "seq").alias("name"))
    b = f.where("seq % 3 != 1").select(F.lit("b").alias("variant"), F.format_string("cam3/%06d.jpg", "seq").alias("name"))
    return capture.common_holdout(a.union(b), 8)


def sequence_ranking(spark: SparkSession, d: str) -> DataFrame:
    e = spark.read.parquet(f"{d}/events.parquet")
    i = e.select(F.col("user_id").alias("sequence"), F.col("event_id").alias("id"), F.col("ts").alias("captured_at"), F.when(F.col("event_id") % 11 != 0, F.lit("u")).alias("url"), F.when(F.col("event_id") % 13 != 0, F.col("value")).alias("lon"), (F.col("event_type") != "error").alias("is_pano"))
    return capture.rank_sequences(i, 60, 500).select("sequence", "id", "size")


def budget(spark: SparkSession, d: str) -> DataFrame:
    p = spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").cast("string").alias("path"), (F.col("p_retailprice") * 1e6).alias("bytes"), (F.col("p_size") + 1).cast("double").alias("seconds"))
    return capture.capture_budget(p).select("path", "card_gb", _r("mbps"), _r("gb_per_min"), _r("minutes", 4), _r("miles", 4))


def clip_pieces(spark: SparkSession, d: str) -> DataFrame:
    c = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", (F.col("o_orderkey") % 613).cast("double").alias("duration"))
    return passes.clip_segments(c, 60.0).select("o_orderkey", "seg", "start_s", "end_s")


def newest_steps(spark: SparkSession, d: str) -> DataFrame:
    f = spark.read.parquet(f"{d}/lineitem.parquet").select((F.col("l_suppkey")).alias("chunk"), F.concat(F.lit("out/point_"), (F.col("l_partkey") * 7 % 1000).cast("string"), F.lit(".ply")).alias("path"))
    return world.newest(f, "chunk")


def verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Scalar rules over the frames: verdict, PSNR, neighbour count, focal length."""
    f = frames(spark, d)
    return f.select("seq", scalars.verdict(F.abs("z")).alias("verdict"), F.round(scalars.psnr(F.abs(F.col("x")) / 1e4), 6).alias("psnr"), scalars.neighbours(F.lit(6), F.col("seq") % 5, 12).alias("neighbours"), F.round(scalars.focal(F.lit(1920), 60 + F.col("seq") % 40), 6).alias("fx"))


def weak_pass_list(spark: SparkSession, d: str) -> DataFrame:
    return connectivity.weak_passes(pass_pair_matrix(spark, d), 1.0)


def pass_components(spark: SparkSession, d: str) -> DataFrame:
    return connectivity.pass_groups(pass_pair_matrix(spark, d))


def capture_centres(spark: SparkSession, d: str) -> DataFrame:
    """Six views of each position, off by whole millimetres, some without a pose or a number."""
    f = frames(spark, d).select("seq", "x", "y", "z", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("k"))
    name = F.when((F.col("seq") + F.col("k")) % 17 == 0, F.lit("cam0/none.jpg")).otherwise(F.format_string("cam%d/%06d.jpg", "k", "seq"))
    images = f.select(name.alias("name"), F.when((F.col("seq") + F.col("k")) % 5 != 0, F.col("x") + F.col("k")).alias("x"), F.col("y"), F.col("z"))
    return align.capture_centres(images).select("seq", _r("x", 3), _r("y", 3), _r("z", 3))


def camera_deal(spark: SparkSession, d: str) -> DataFrame:
    """Frames as cameras dealt to cells by the rule that also counts what they observe."""
    f = frames(spark, d)
    cells = chunk_manifest(spark, d).select("chunk", "x0", "y0", "x1", "y1")
    seen = f.select(F.col("seq").alias("image_id"), "x", "y", F.explode(F.sequence(F.lit(-3), F.lit(3))).alias("k")).select("image_id", (F.col("x") + F.col("k") * 4).alias("x"), (F.col("y") - F.col("k") * 2).alias("y"))
    return partition.camera_rule(f.select(F.col("seq").alias("image_id"), "x", "y"), seen, cells, "inria", 4.0, 3, CELL)


def cell_states(spark: SparkSession, d: str) -> DataFrame:
    m = members(spark, d)
    dealt = m.select("chunk", F.concat(F.lit("n"), F.col("seq")).alias("name"))
    registered = frames(spark, d).where("seq % 17 != 3").select(F.concat(F.lit("n"), F.col("seq")).alias("name"))
    images = m.where("cx % 2 = 0").select("chunk", F.col("seq").alias("image_id"))
    return align.empty_cells(dealt, registered, images)


def coverage_ratio(spark: SparkSession, d: str) -> DataFrame:
    f = frames(spark, d)
    return align.coverage_gate(f.where("seq % 9 != 0").select("seq"), f.select("seq")).select("registered", "reference", _r("ratio"), "ok")


def mean_psnr(spark: SparkSession, d: str) -> DataFrame:
    f = frames(spark, d).select((F.col("seq") % 4).alias("checkpoint"), scalars.psnr(F.abs(F.col("x")) / 1e4).alias("p"))
    return f.groupBy("checkpoint").agg(F.count("*").alias("views"), F.round(F.avg("p"), 4).alias("psnr"))


def largest_pass(spark: SparkSession, d: str) -> DataFrame:
    p = passes.split_passes(frames(spark, d), ["video"], 1.5, 30)
    return drive.longest_pass(p, ["video"]).groupBy("video", "pass").agg(F.count("*").alias("points"))


def route_chain(spark: SparkSession, d: str) -> DataFrame:
    p = frames(spark, d).select(F.expr("cast(substring(video, 2) as bigint)").alias("pass"), "seq", "x", "y", "z")
    return route.build_route(p, 60.0, 5.0, 0.9, 2.0)


def pass_cover(spark: SparkSession, d: str) -> DataFrame:
    p = frames(spark, d).select(F.expr("cast(substring(video, 2) as bigint)").alias("pass"), "seq", "x", "y", "z")
    return route.coverage(p, 2.0).select("pass", "other", _r("share"))


def exact_seams(spark: SparkSession, d: str) -> DataFrame:
    return seams.seam_pairs(_tracks(spark, d), exact=True).select("a", "b", "pairs", _r("median_dz"), _r("p90_dz"), "verdict")


def newest_profiles(spark: SparkSession, d: str) -> DataFrame:
    p = spark.read.parquet(f"{d}/part.parquet")
    return capture.override(p.select(F.col("p_brand").alias("name"), F.col("p_partkey").alias("dir_order"), F.col("p_size").alias("priority")))


def missing_images(spark: SparkSession, d: str) -> DataFrame:
    f = frames(spark, d)
    return capture.missing(f.where("seq % 2 = 0").select(F.col("seq").alias("name")), f.where("seq % 3 != 0").select(F.col("seq").alias("name")))


def pass_overlap(spark: SparkSession, d: str) -> DataFrame:
    p = frames(spark, d).select(F.expr("cast(substring(video, 2) as bigint)").alias("pass"), "seq", "x", "y")
    return align.pass_overlap(p, 3.0).select("a", "b", "near", _r("share"), _r("median", 4))


def cube_layouts(spark: SparkSession, d: str) -> DataFrame:
    p = spark.read.parquet(f"{d}/part.parquet").select((F.col("p_size") * 64 + 3000).alias("w"), (F.col("p_size") * 16 + 900).alias("h")).distinct()
    layout = optics.cube_layout(F.col("w"), F.col("h"))
    return p.select("w", "h", layout["side"].alias("side"), layout["blend"].alias("blend"), F.round(layout["overlap_deg"], 6).alias("overlap_deg"))


def lens_pixels(spark: SparkSession, d: str) -> DataFrame:
    """Directions of frames from the origin, in an equirectangular image and in a fisheye lens."""
    f = frames(spark, d).where("x != 0 and y != 0").withColumn("n", F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z")))
    v = tuple(F.col(c) / F.col("n") for c in ("x", "y", "z"))
    ex, ey = optics.equirect_pixel(*v, F.lit(5760), F.lit(2880))
    fx, fy, seen = optics.fisheye_pixel(v, (0.0, 1.0, 0.0), 1440.0, 1440.0, 1400.0, 200.0, "equisolid")
    return f.select("seq", F.round(ex, 3).alias("ex"), F.round(ey, 3).alias("ey"), F.round(fx, 3).alias("fx"), F.round(fy, 3).alias("fy"), seen.alias("seen"))


def manifest_totals(spark: SparkSession, d: str) -> DataFrame:
    return partition.manifest_totals(partition.chunk_manifest(members(spark, d), CELL))


def chunk_files(spark: SparkSession, d: str) -> DataFrame:
    """Chunks written to their folders and read back, with the manifest's counts."""
    m, path = members(spark, d).drop("is_core"), scratch_path(spark, "chunks")
    manifest = chunk_manifest(spark, d)
    tables.write_chunks(m, manifest, path)
    found, listed = tables.read_chunks(spark, path, m, manifest)
    n = found.groupBy("chunk").agg(F.count("*").alias("members"), F.min("seq").alias("first_seq"), _s(F.sum("z"), 3, "z"))
    return n.join(listed.select("chunk", "frames", "core_frames", "passes"), "chunk")


def _s(c: Column, n: int, name: str) -> Column:
    return (F.round(c, n) + F.lit(0.0)).alias(name)


def world_files(spark: SparkSession, d: str) -> DataFrame:
    """The merged world's tiles and catalogue written and read back."""
    g, m, segs, bands = _merge_inputs(spark, d)
    merged, path = world.merge_world(g, m, segs, 1.5, bands), scratch_path(spark, "world")
    tables.write_world(merged.select("chunk", "idx", "p", "x", "y", "z"), world.tile_totals(g, m, merged), path)
    tiles = spark.read.parquet(f"{path}/tiles").groupBy("chunk").agg(F.count("*").alias("gaussians"), F.sum("p").cast("bigint").alias("parts"))
    listed = spark.read.schema("chunk string, source bigint, owned bigint, kept bigint").json(f"{path}/world")
    return tiles.join(listed, "chunk").select("chunk", "gaussians", "parts", "source", "owned", "kept")


def level_files(spark: SparkSession, d: str) -> DataFrame:
    """Two levels of detail written, one of them twice, and the catalogue of levels."""
    g, path, cols = gaussians(spark, d), scratch_path(spark, "levels"), ["idx", "p", "s", "e"]
    for name, keep in (("far", 0.5), ("near", 0.5), ("far", 0.125)):
        tables.write_level(world.level_of_detail(g, keep, False, cols).select("chunk", *cols), name, keep, path)
    return tables.read_levels(spark, path).select("name", "chunk", "keep", "gaussians")


def lod_rollup(spark: SparkSession, d: str) -> DataFrame:
    g = gaussians(spark, d)
    return world.lod_totals(g, world.level_of_detail(g, 0.125, False, ["idx", "p", "s", "e"]), 248, 68)[1].select("source", "gaussians", "source_bytes", "bytes", _r("gaussians_share"), _r("bytes_share"))


def envelope_refresh(spark: SparkSession, d: str) -> DataFrame:
    """Envelopes of each chunk's corridor written, written again from solved positions for some, and the versions to keep."""
    pts, path = _tracks(spark, d), scratch_path(spark, "envelopes")
    bands = corridor.height_band(pts, ["chunk"], 8.0)
    tables.write_envelopes(tables.envelope_documents(pts, "chunk", 25.0, bands, "gps"), "chunk", path, 1)
    tables.write_envelopes(tables.envelope_documents(pts.where("chunk like '%_y0'"), "chunk", 25.0, bands, "sfm"), "chunk", path, 2)
    kept = capture.refreshed(tables.read_envelopes(spark, "chunk", path))
    points = F.aggregate("passes", F.lit(0), lambda a, p: a + F.size(p["points"]))
    return kept.select("chunk", "version", "source", "kind", F.size("passes").alias("passes"), points.alias("points"), _s(F.element_at("height_band_m", 1), 3, "z_lo"))


def world_points(spark: SparkSession, d: str) -> DataFrame:
    """All chunks' corridors as one, passes numbered through, a row a pass."""
    pts = _tracks(spark, d)
    own = corridor.union_corridors(pts, corridor.height_band(pts, ["chunk"], 8.0).withColumn("radius_m", F.lit(25.0)))[0]
    return own.groupBy("chunk", "pass").agg(F.count("*").alias("points"), F.min("seq").alias("first_seq"))


def world_header(spark: SparkSession, d: str) -> DataFrame:
    pts = _tracks(spark, d)
    bands = corridor.height_band(pts, ["chunk"], 8.0).withColumn("radius_m", F.length("chunk").cast("double"))
    return corridor.world_corridor(bands).select("radius_m", _r("z_lo"), _r("z_hi"))


def moved_cameras(spark: SparkSession, d: str) -> DataFrame:
    f = frames(spark, d).select(F.col("seq").alias("image_id"), "x", "y", "z")
    after = f.select("image_id", (F.col("x") + (F.col("image_id") % 11) / 20).alias("x"), (F.col("y") - (F.col("image_id") % 7) / 20).alias("y"), "z")
    return align.moved_cameras(f, after)[0].select("images", _r("moved_median"), _r("moved_max"), "reverted")


def database_states(spark: SparkSession, d: str) -> DataFrame:
    m = members(spark, d).select("chunk", "cx", "cy", "seq")
    pairs = m.where("cx % 3 <> 0").select("chunk", (F.col("seq") % 3).alias("rows"))
    return align.database_state(m.where("cy % 2 = 0 or seq % 50 <> 1"), m.where("cx % 5 <> 1 or seq % 20 <> 3"), pairs, m)


def largest_models(spark: SparkSession, d: str) -> DataFrame:
    g = gaussians(spark, d).groupBy("chunk", (F.col("p") % 3 * (F.col("s") % 2)).alias("model")).agg(F.sum(F.col("idx") % 97).alias("size"))
    return align.largest_model(g, ["chunk"]).select("chunk", "model", "models", _r("kept"), "warn")


def black_point_share(spark: SparkSession, d: str) -> DataFrame:
    g = gaussians(spark, d).select("chunk", (F.col("idx") % 3).alias("red"), (F.col("p") % 2 * (F.col("s") % 2)).alias("green"), F.floor(F.col("s") % 5 / 3).alias("blue"))
    return align.black_points(g, ["chunk"], 0.22).select("chunk", "points", _r("share"), "dead")


def _placed(spark: SparkSession, d: str) -> DataFrame:
    lat, lon, _ = geo.enu_to_geodetic(F.col("x"), F.col("y"), F.lit(0.0), ORIGIN)
    return frames(spark, d).select("video", "seq", "t", lat.alias("lat"), lon.alias("lon"))


def _degrees(spark: SparkSession, d: str) -> DataFrame:
    return frames(spark, d).select("video", "seq", "t", (F.col("x") / 1000).alias("lat"), (F.col("y") / 1000).alias("lon"))


def fenced_frames(spark: SparkSession, d: str) -> DataFrame:
    return passes.near_fence(_placed(spark, d), ORIGIN[:2], 11.1005).select("seq")


def reachable_segments(spark: SparkSession, d: str) -> DataFrame:
    f = _placed(spark, d)
    s = f.groupBy("video", F.floor(F.col("t") / 60).alias("seg")).agg(F.count("*").alias("frames")).select("video", "seg", (F.col("seg") * 60.0).alias("start_s"), (F.col("seg") * 60.0 + 60.0).alias("end_s"))
    return passes.reachable_segments(s, f, ORIGIN[:2], 6.0505, 1.0, 2.0).select("video", "seg")


def stream_zip(spark: SparkSession, d: str) -> DataFrame:
    """Candidates of three streams a video, of which the later ones end earlier."""
    f = frames(spark, d).select("video", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("stream"), F.col("seq").alias("n"), "t")
    c = f.join(f.where("stream = 0").groupBy("video").agg(F.min("n").alias("first"), F.max("n").alias("last")), "video").where("n <= last - stream * 3").select("video", "stream", (F.col("n") - F.col("first")).alias("i"), "t", F.format_string("s%d/%06d.jpg", "stream", "n").alias("path"))
    return passes.zip_streams(c, ["video"]).select("video", "i", "t", F.array_join("paths", ",").alias("paths"))


def only_named(spark: SparkSession, d: str) -> DataFrame:
    return capture.only_named(chunk_manifest(spark, d).select(F.col("chunk").alias("name"), "frames"), ["x0_", "_y-1"])


def _images(spark: SparkSession, d: str) -> DataFrame:
    return frames(spark, d).select(F.col("seq").alias("image_id"), F.format_string("cam%d/%06d.jpg", (F.col("seq") % 3).cast("int"), "seq").alias("name"), "x", "y", "z")


def listed_names(spark: SparkSession, d: str) -> DataFrame:
    names = frames(spark, d).where("seq % 4 = 0").select(F.when(F.col("seq") % 8 == 0, F.format_string(" cam%d/%06d.jpg ", (F.col("seq") % 3).cast("int"), "seq")).otherwise(F.lit("  ")).alias("name"))
    return capture.listed_only(_images(spark, d), names).select("image_id", "name")


def geo_lines(spark: SparkSession, d: str) -> DataFrame:
    """Positions written as lines of text, some twice and some broken, read back, and joined to the images that have one."""
    path, i = scratch_path(spark, "geo"), _images(spark, d)
    line = F.concat_ws(" ", "name", *[F.round(c, 3) for c in "xyz"])
    i.where("image_id % 5 <> 0").select(F.when(F.col("image_id") % 7 == 0, F.col("name")).otherwise(line).alias("value")).write.text(path)
    return capture.with_geo(i.select(F.col("name").alias("rel"), "image_id"), files.geo_index(spark, path)).select("image_id", "rel", _r("lat", 3), _r("lon", 3), _r("alt", 3))


def enu_lines(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "enu")
    _images(spark, d).select(F.concat_ws("  ", "name", *[F.format_string("%.4f", c) for c in "xyz"]).alias("value")).write.text(path)
    return files.enu_reference(spark, path).select("name", _r("x", 3), _r("y", 3), _r("z", 3))


def frame_lines(spark: SparkSession, d: str) -> DataFrame:
    """Frame records written as JSON lines and read back, null positions included."""
    path = scratch_path(spark, "frames")
    f = _degrees(spark, d).withColumn("lat", F.when(F.col("seq") % 10 != 0, F.col("lat"))).withColumn("images", F.create_map(F.lit("cam0"), F.format_string("cam0/%06d.jpg", "seq")))
    files.write_frames(f, path)
    return files.frames_jsonl(spark, path).select("seq", "t", _r("lat", 7), _r("lon", 7), "video", F.element_at("images", "cam0").alias("cam0"), F.col("source").isNull().alias("plain"))


def own_frames(spark: SparkSession, d: str) -> DataFrame:
    """Chunks' own frame records, and for those without any the parent's of the images they hold."""
    m = members(spark, d).select("chunk", "seq", "cx")
    own = m.where("cx % 2 = 0").join(frames(spark, d).select("seq", "video"), "seq").select("chunk", "seq", F.concat(F.lit("own-"), "video").alias("video"))
    return capture.own_or_parent(own, frames(spark, d).select("seq", "video"), m.where("seq % 3 <> 0")).select("chunk", "seq", "video")


def _listing(spark: SparkSession, d: str) -> DataFrame:
    names = F.array(*[F.lit(x) for x in ("corridor.json", "envelope.json", "meta.json")])
    p = spark.read.parquet(f"{d}/part.parquet").withColumn("name", F.element_at(names, (F.col("p_partkey") % 7 % 3 + 1).cast("int")))
    return p.where("p_partkey % 10 < p_size % 4 or name = 'meta.json'").select(F.concat(F.lit("chunk_"), "p_size").alias("dir"), "name").distinct()


def envelope_files(spark: SparkSession, d: str) -> DataFrame:
    return capture.envelope_choice(_listing(spark, d))


def rename_plan(spark: SparkSession, d: str) -> DataFrame:
    return capture.rename_plan(_listing(spark, d))


def sequential_pairs(spark: SparkSession, d: str) -> DataFrame:
    return connectivity.pair_plan(_images(spark, d), "sequential", 5)


def group_summary(spark: SparkSession, d: str) -> DataFrame:
    out = connectivity.group_warning(connectivity.pass_groups(pass_pair_matrix(spark, d)))
    return out.select("groups", F.array_join(F.transform("passes", lambda p: F.array_join(p, ",")), ";").alias("passes"), "disconnected")


def telemetry_tags(spark: SparkSession, d: str) -> DataFrame:
    """Events as raw telemetry tags, some documents without a latitude, and the samples they give."""
    f = _degrees(spark, d).withColumn("k", F.row_number().over(Window.partitionBy("video").orderBy("seq")))
    doc = F.concat(F.lit("Doc"), F.col("k").cast("string"), F.when(F.col("k") % 2 == 0, "-1").otherwise(""))
    stamp = F.date_format(F.timestamp_seconds(F.lit(1700000000) + F.col("k")), "yyyy:MM:dd HH:mm:ss")
    tags = F.array(
        F.struct(F.lit("GPSLatitude").alias("tag"), F.when(F.col("k") % 9 != 0, F.round("lat", 7).cast("string")).alias("value")), F.struct(F.lit("GPSLongitude").alias("tag"), F.round("lon", 7).cast("string").alias("value")), F.struct(F.lit("GPSAltitude").alias("tag"), F.when(F.col("k") % 4 != 0, F.lit("12.5")).alias("value")),
        F.struct(F.lit("GPSDateTime").alias("tag"), F.concat(stamp, F.when(F.col("k") % 3 == 0, ".5Z").when(F.col("k") % 3 == 1, ".250").otherwise("")).alias("value")),
    )
    rows = f.select("video", doc.alias("doc"), F.explode(tags).alias("_t")).where("_t.value is not null").select("video", F.concat_ws(":", "doc", "_t.tag").alias("key"), F.col("_t.value").alias("value"))
    return files.telemetry(rows).select("video", "i", _r("t", 3), _r("lat", 7), _r("lon", 7), "alt")


def trimmed_starts(spark: SparkSession, d: str) -> DataFrame:
    return drive.trim_reversals(frames(spark, d).select("video", "seq", "x", "y", "z"), ["video"], 25.0, 120.0).select("video", "seq")


def reprojection(spark: SparkSession, d: str) -> DataFrame:
    """Frames as points before two level cameras, one of them turned, observed a little off."""
    p = frames(spark, d).select(F.col("seq").alias("point_id"), "x", "y", (F.col("z") + 200).alias("z"))
    half = 0.5**0.5
    cams = spark.createDataFrame([(1, 1.0, 0.0, 0.0, 0.0, 1.0, 2.0, 3.0, 800.0, 810.0, 500.0, 400.0), (2, half, 0.0, 0.0, half, 0.0, 0.0, 0.0, 700.0, 700.0, 10.0, 20.0)], "image_id long, qw double, qx double, qy double, qz double, tx double, ty double, tz double, fx double, fy double, cx double, cy double")
    o = p.select("point_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("image_id"), (F.col("point_id") % 1000).cast("double").alias("u"), (F.col("point_id") % 700).cast("double").alias("v"))
    return align.reprojection_rms(p, o.withColumn("image_id", F.col("image_id").cast("long")), cams).select("observations", _s(F.col("rms"), 4, "rms"))


def profile_matches(spark: SparkSession, d: str) -> DataFrame:
    """Parts as recordings, matched with a registry of rules by suffix, tracks and size."""
    p = spark.read.parquet(f"{d}/part.parquet")
    suffix = F.element_at(F.array(*[F.lit(x) for x in (".360", ".MP4", ".insv", ".txt")]), (F.col("p_partkey") % 4 + 1).cast("int"))
    f = p.select(F.concat(F.lit("a/"), F.col("p_partkey").cast("string"), suffix).alias("path"), (F.col("p_size") % 3).cast("int").alias("tracks"), F.when(F.col("p_size") % 2 == 0, 4096).otherwise(5952).alias("width"), F.lit(1344).alias("height"))
    rules = [("max", 10, [".360"], 2, None, 0), ("wide", 5, [".360", ".mp4"], None, ["4096x1344"], 1), ("two", 3, None, 2, None, 2), ("any", 0, None, None, None, 3), ("twin", 5, [".mp4"], None, ["4096x1344"], 4)]
    r = spark.createDataFrame(rules, "name string, priority int, suffixes array<string>, tracks int, sizes array<string>, load_order int")
    return capture.detect_profiles(f, r).select("path", "profile", "score")


def probe_rates(spark: SparkSession, d: str) -> DataFrame:
    """Frame rates of recordings from fractions such as 30000/1001."""
    p = spark.read.parquet(f"{d}/part.parquet").select("p_partkey", F.concat_ws("/", F.col("p_size") * 1000, F.col("p_partkey") % 3 * 1001).alias("rate"))
    return p.select("p_partkey", F.round(scalars.frame_rate(F.col("rate")), 6).alias("fps"))


def metre_degrees(spark: SparkSession, d: str) -> DataFrame:
    lat, lon = scalars.degrees_per_metre(ORIGIN[0])
    return frames(spark, d).select("seq", F.round(F.col("y") * lat, 9).alias("dlat"), F.round(F.col("x") * lon, 9).alias("dlon"))


def ray_directions(spark: SparkSession, d: str) -> DataFrame:
    """Rays of pixels, one a part, of a pinhole and of an equirectangular picture."""
    p = spark.read.parquet(f"{d}/part.parquet").select("p_partkey", (F.col("p_partkey") % 64 + 0.5).alias("i"), (F.col("p_size") % 32 + 0.5).alias("j"))
    a = optics.pinhole_direction(F.col("i"), F.col("j"), *[F.lit(v) for v in (40.0, 45.0, 32.0, 16.0)])
    b = optics.equirect_direction(F.col("i"), F.col("j"), F.lit(64), F.lit(32))
    return p.select("p_partkey", *[_s(c, 6, f"p{n}") for c, n in zip(a, "xyz")], *[_s(c, 6, f"e{n}") for c, n in zip(b, "xyz")])


def cube_faces(spark: SparkSession, d: str) -> DataFrame:
    face, u, v = optics.cube_face(F.col("x"), F.col("y"), F.col("z") * 20)
    return frames(spark, d).where("x <> 0 or y <> 0 or z <> 0").select("seq", face.alias("face"), _s(u, 5, "u"), _s(v, 5, "v"))


def cube_pixels(spark: SparkSession, d: str) -> DataFrame:
    """Frames' directions in the two-track picture, for both lenses."""
    f, out = frames(spark, d).where("x <> 0 or y <> 0 or z <> 0"), None
    for lens in (0, 1):
        track, x, y, covered = optics.cube_pixel((F.col("x"), F.col("y"), F.col("z") * 20), 5952, 1920, lens)
        own = f.select("seq", F.lit(lens).alias("lens"), track.alias("track"), _s(x, 3, "px"), _s(y, 3, "py"), covered.alias("covered"))
        out = own if out is None else out.unionByName(own)
    return out


def flat_frames(spark: SparkSession, d: str) -> DataFrame:
    p = spark.read.parquet(f"{d}/part.parquet").select(F.concat_ws("/", "p_brand", F.format_string("%d.jpg", "p_size")).alias("path"))
    return capture.flat_frames(p).select("seq", "path", "image", F.col("lat").isNull().alias("flat"))


def camera_specs(spark: SparkSession, d: str) -> DataFrame:
    folders = spark.read.parquet(f"{d}/part.parquet").select(F.when(F.col("p_size") % 7 == 0, F.concat(F.lit("rig"), "p_size")).otherwise(F.concat(F.lit("cam"), "p_size")).alias("cam")).distinct()
    return capture.by_camera(folders, spark.range(30).select(F.col("id").cast("int").alias("idx"), (F.col("id") * 15).alias("yaw"))).select("cam", "idx", "yaw")


def failed_items(spark: SparkSession, d: str) -> DataFrame:
    out = capture.first_failed(_queue(spark, d), 6)
    return out.select("stage", "failed", F.array_join("first", ",").alias("first"))


def open_items(spark: SparkSession, d: str) -> DataFrame:
    q = _queue(spark, d)
    return capture.still_to_do(q.select("stage", "item"), q.where("state in ('done', 'running')"), ["stage", "item"])


def route_summary(spark: SparkSession, d: str) -> DataFrame:
    """The route as it is driven: its length, ends and the passes left out."""
    p = frames(spark, d).select(F.expr("cast(substring(video, 2) as bigint)").alias("pass"), "seq", "x", "y", "z")
    return route.route_summary(p, route_chain(spark, d)).select("passes", "dropped_passes", *[_r(c, 3) for c in ("length_m", "start_x", "start_y", "start_z", "finish_x", "finish_y", "finish_z")])


def road_lines(spark: SparkSession, d: str) -> DataFrame:
    """The road's ribbon as the lines of an OBJ file, y up."""
    pts = _corridor(spark, d).select((F.expr("cast(substring(video, 2) as bigint)") * 100000 + F.col("pass")).alias("pass"), "seq", "x", "y", "z")
    return files.obj_road(pts, 6.0, 2.4)


def centre_lines(spark: SparkSession, d: str) -> DataFrame:
    """The corridor's centre lines as the lines of an OBJ file, z up."""
    pts = _corridor(spark, d).select((F.expr("cast(substring(video, 2) as bigint)") * 100000 + F.col("pass")).alias("pass"), "seq", "x", "y", "z")
    return files.obj_lines(pts, 2.4, False)


def frame_records(spark: SparkSession, d: str) -> DataFrame:
    """Frame records as the writer makes them: the names of each camera's image."""
    return files.frame_records(frames(spark, d).select("seq", "t", "video"), 3).select("seq", "t", "video", F.array_join(F.map_values("images"), ",").alias("images"))


def chunk_folders(spark: SparkSession, d: str) -> DataFrame:
    p = spark.read.parquet(f"{d}/part.parquet")
    listing = p.select(F.concat(F.when(F.col("p_size") % 3 == 0, "old_").otherwise("chunk_"), "p_size", F.when(F.col("p_partkey") % 5 == 0, "/images/cam0/").otherwise("/sparse/"), F.format_string("%06d.jpg", "p_partkey")).alias("path"))
    return capture.chunk_folders(listing)


def minute_stream(spark: SparkSession, d: str) -> DataFrame:
    """Events as a stream, run to its end: frames a minute and video, as the watermark closes minutes."""
    path = scratch_path(spark, "minutes")
    e = spark.readStream.schema(spark.read.parquet(f"{d}/events.parquet").schema).option("pathGlobFilter", "events.parquet").parquet(d)
    counts = queue.minute_counts(e.select(F.concat(F.lit("v"), F.col("user_id").cast("string")).alias("video"), F.col("ts").cast("timestamp").alias("ts")))
    counts.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/out").groupBy("video").agg(F.count("*").alias("minutes"), F.sum("frames").cast("bigint").alias("frames"))


def _lenses(spark: SparkSession) -> DataFrame:
    rows = [("front", 0.0, 0.0, 1.0, 0.0, 95.0), ("back", 180.0, 0.0, -1.0, 0.0, 95.0), ("all", 0.0, 0.0, 1.0, 0.0, 180.0), ("narrow", 90.0, 1.0, 0.0, 0.0, 20.0)]
    return spark.createDataFrame(rows, "lens string, yaw_deg double, ax double, ay double, az double, half_fov_deg double")


def _rig(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of parts as level lenses, from narrow ones to one that sees all around."""
    p = spark.read.parquet(f"{d}/part.parquet").select(F.col("p_size").alias("lens")).distinct()
    p = p.withColumn("yaw_deg", F.col("lens") * 297 % 3600 / F.lit(10.0))
    return p.select("lens", "yaw_deg", F.sin(F.radians("yaw_deg")).alias("ax"), F.cos(F.radians("yaw_deg")).alias("ay"), F.lit(0.0).alias("az"), (F.col("lens") * 3.3 + 15).cast("double").alias("half_fov_deg"))


def view_plan(spark: SparkSession, d: str) -> DataFrame:
    return views.plan_views(_rig(spark, d), [-12.0, 5.0], 80.0, 24.0, 0.75, 12.0).select("lens", _r("yaw", 3), "pitch", "fov", "width", "height")


def _views(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of parts as views around the horizon."""
    p = spark.read.parquet(f"{d}/part.parquet").select(F.col("p_size").alias("view")).distinct()
    return p.select("view", (F.col("view") * 7.3).alias("yaw"), ((F.col("view") % 5 - 2) * 9.1).alias("pitch"), (F.col("view") % 4 * 15.0 + 40.3).alias("fov"), F.lit(60).alias("width"), F.lit(45).alias("height"))


def view_split(spark: SparkSession, d: str) -> DataFrame:
    return views.split_views(_views(spark, d), _lenses(spark).where("lens <> 'all'")).select("view", "lens", _r("coverage"))


def seam_bands(spark: SparkSession, d: str) -> DataFrame:
    return views.seam_band_share(_views(spark, d), 6.1).select("view", _r("share"))


def sphere_shares(spark: SparkSession, d: str) -> DataFrame:
    return views.sphere_coverage(view_plan(spark, d).where("pitch < 0 and lens < 30"), _rig(spark, d), 64).select(_r("sphere"), _r("horizon_band"))


QUERIES = {
    f.__name__: f
    for f in (
        chunk_manifest, frame_sequence, geo_round_trip, local_plane, chunk_members, pass_split, corridor_points, corridor_band, frame_selection, time_nudge, telemetry_interpolation, seam_pairs, seam_report, seam_gate, chunk_levels, footprint_overlap, merge_totals, lod_tiles, corridor_guard,
        residual_summary, residuals_by_video, warp_windows, path_resample, path_smooth, path_headings, road_ribbon, pass_pair_matrix, queue_state, holdout_common, sequence_ranking, budget, clip_pieces, newest_steps, verdicts,
        weak_pass_list, pass_components, capture_centres, camera_deal, cell_states, coverage_ratio, mean_psnr, largest_pass, route_chain, pass_cover, exact_seams, newest_profiles, missing_images, pass_overlap, cube_layouts, lens_pixels,
        manifest_totals, chunk_files, world_files, level_files, lod_rollup, envelope_refresh, world_points, world_header, moved_cameras, database_states, largest_models, black_point_share, fenced_frames, reachable_segments, stream_zip, only_named, listed_names, geo_lines, enu_lines, frame_lines,
        own_frames, envelope_files, rename_plan, sequential_pairs, group_summary, telemetry_tags, trimmed_starts, reprojection, profile_matches, probe_rates, metre_degrees, ray_directions, cube_faces,
        route_summary, road_lines, centre_lines, frame_records, chunk_folders, minute_stream, view_plan, view_split, seam_bands, sphere_shares, cube_pixels, flat_frames, camera_specs, failed_items, open_items,
    )
} | pictures.QUERIES | streams.QUERIES | round_trips.QUERIES
