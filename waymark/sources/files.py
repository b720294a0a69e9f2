"""Readers and writers of the capture's text files."""

from __future__ import annotations

import math
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.functions.geo import enu_to_geodetic, y_up
from waymark.operators.drive import ribbon
from waymark.operators.shared import with_place

FRAMES = "seq bigint, t double, lat double, lon double, alt double, images map<string, string>, video string, source string, mapillary_id string, sequence string"
ENVELOPE = "frame string, origin struct<lat: double, lon: double>, radius_m double, height_band_m array<double>, source string, passes array<struct<video: string, seq_range: array<bigint>, points: array<array<double>>>>"


def frames_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Positions, one JSON object a line, with a fixed schema: nothing is inferred."""
    return spark.read.schema(FRAMES).json(path)


def write_frames(frames: DataFrame, path: str) -> None:
    frames.write.json(path)


def geo_index(spark: SparkSession, path: str) -> DataFrame:
    """(rel, lat, lon, alt) of lines `rel lat lon alt`, cut at the first blank; of a repeated name the last line counts."""
    raw = spark.read.text(path).withColumn("_n", F.monotonically_increasing_id())
    rel, rest = F.regexp_extract("value", r"^(\S+)\s", 1), F.split(F.trim(F.regexp_extract("value", r"^\S+\s+(.*)$", 1)), r"\s+")
    rows = raw.where(F.col("value").rlike(r"^\S+\s+\S")).select(rel.alias("rel"), "_n", *[F.get(rest, F.lit(k)).try_cast("double").alias(c) for k, c in enumerate(("lat", "lon", "alt"))])
    return rows.groupBy("rel").agg(F.max_by(F.struct("lat", "lon", "alt"), "_n").alias("_p")).select("rel", "_p.*")


def enu_reference(spark: SparkSession, path: str) -> DataFrame:
    """(name, x, y, z) of lines of four or more tokens; others are skipped."""
    t = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).withColumn("_t", t).where(F.size("_t") >= 4).select(F.get("_t", F.lit(0)).alias("name"), *[F.get("_t", F.lit(k + 1)).try_cast("double").alias(c) for k, c in enumerate("xyz")])


def envelope_points(envelopes: DataFrame) -> DataFrame:
    """(pass, video, idx, x, y, z) of envelope documents."""
    p = envelopes.select("*", F.posexplode("passes").alias("pass", "_p"))
    q = p.select(*[c for c in envelopes.columns if c != "passes"], "pass", F.col("_p.video").alias("video"), F.posexplode("_p.points").alias("idx", "_q"))
    return q.select(*[c for c in q.columns if c != "_q"], *[F.get("_q", F.lit(k)).alias(c) for k, c in enumerate("xyz")])


def telemetry(tags: DataFrame) -> DataFrame:
    """(video, i, t, lat, lon, alt) of raw tags (video, key like Doc1-7:GPSLatitude, value).

    Documents are ordered by the numbers of their name; one without a latitude or longitude is left out, a
    missing altitude is 0. Times, with a fraction of any length or none, count from the first.
    """
    doc, tag = F.split_part("key", F.lit(":"), F.lit(1)), F.split_part("key", F.lit(":"), F.lit(2))
    order = F.transform(F.split(F.regexp_replace(doc, "^Doc", ""), "-"), lambda x: x.try_cast("int"))
    rows = tags.where(doc.rlike(r"^Doc\d+(-\d+)*$")).select("video", order.alias("_o"), tag.alias("_tag"), "value")

    def one(name: str):
        return F.max(F.when(F.col("_tag") == name, F.col("value")))

    wide = rows.groupBy("video", "_o").agg(one("GPSLatitude").try_cast("double").alias("lat"), one("GPSLongitude").try_cast("double").alias("lon"), F.coalesce(one("GPSAltitude").try_cast("double"), F.lit(0.0)).alias("alt"), F.regexp_replace(one("GPSDateTime"), "Z$", "").alias("_ts"))
    at = F.try_to_timestamp("_ts", F.lit("yyyy:MM:dd HH:mm:ss[.SSSSSSSSS]"))

    w = Window.partitionBy("video").orderBy("_o")
    kept = wide.where("lat is not null and lon is not null").withColumn("_at", at.cast("timestamp").cast("double"))
    first = F.first("_at", True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return kept.select("video", (F.row_number().over(w) - 1).alias("i"), (F.col("_at") - first).alias("t"), "lat", "lon", "alt")


def candidates(probes: DataFrame, fps: float) -> DataFrame:
    """(video, seg, i, t) of segments (video, seg, start_s, end_s) decoded at fps: the middle of each instant."""
    n = F.floor((F.col("end_s") - F.col("start_s")) * fps).cast("int")
    return probes.where(n > 0).select("video", "seg", F.explode(F.sequence(F.lit(0), n - 1)).alias("i"), "start_s").select("video", "seg", "i", (F.col("start_s") + (F.col("i") + 0.5) / fps).alias("t"))


def frame_records(frames: DataFrame, cameras: int) -> DataFrame:
    """frames with `images`, each camera's image of the position: camK to camK/NNNNNN.jpg."""
    pairs = [x for k in range(cameras) for x in (F.lit(f"cam{k}"), F.format_string(f"cam{k}/%06d.jpg", "seq"))]
    return frames.withColumn("images", F.create_map(*pairs))


_RATIONALS = T.ArrayType(T.StructType([T.StructField("num", T.LongType()), T.StructField("den", T.LongType())]))


@F.pandas_udf(_RATIONALS)
def dms_rationals(deg: pd.Series) -> pd.Series:
    """Degrees, minutes and seconds of an angle as EXIF's rationals; seconds by the nearest fraction with a denominator of at most 10000."""

    def one(v):
        if v is None or math.isnan(v):
            return None
        d, part = int(abs(v)), abs(v) % 1
        m = int(part * 60)
        parts = [Fraction(d), Fraction(m), Fraction(part * 3600 - m * 60).limit_denominator(10000)]
        return [{"num": f.numerator, "den": f.denominator} for f in parts]

    return deg.map(one)


def centerline(points: DataFrame, origin: tuple[float, float, float], drop_m: float = 2.4) -> DataFrame:
    """(pass, index, x_enu, y_enu, z_enu, lat, lon, alt) of (pass, seq, x, y, z), lowered from the lens to the road; passes of one point have no line."""
    w = Window.partitionBy("pass")
    low = points.withColumn("index", F.row_number().over(w.orderBy("seq")) - 1).withColumn("_n", F.count("*").over(w)).where("_n > 1").withColumn("z", F.col("z") - drop_m)
    lat, lon, alt = enu_to_geodetic(F.col("x"), F.col("y"), F.col("z"), origin)
    return low.select("pass", "index", *[F.round(c, 3).alias(f"{c}_enu") for c in "xyz"], F.round(lat, 8).alias("lat"), F.round(lon, 8).alias("lon"), F.round(alt, 2).alias("alt"))


def write_centerline(rows: DataFrame, path: str) -> None:
    rows.repartitionByRange("pass", "index").sortWithinPartitions("pass", "index").write.option("header", True).csv(path)


def _vertex(x: Column, y: Column, z: Column, up: bool) -> Column:
    return F.format_string("v %.4f %.4f %.4f", *[c + F.lit(0.0) for c in (y_up(x, y, z) if up else (x, y, z))])


def obj_lines(points: DataFrame, drop_m: float = 2.4, up: bool = True) -> DataFrame:
    """(part, ord, line) of an OBJ file of passes' centre lines: vertices (part 1), then lines between neighbours (part 2), numbered through from 1."""
    p = with_place(points, "pass", "seq")
    n = F.col("place")
    on = p.withColumn("_next", F.lead("place").over(Window.partitionBy("pass").orderBy("place"))).where("_next is not null")
    return p.select(F.lit(1).alias("part"), n.alias("ord"), _vertex(F.col("x"), F.col("y"), F.col("z") - drop_m, up).alias("line")).unionByName(on.select(F.lit(2).alias("part"), n.alias("ord"), F.format_string("l %d %d", n + 1, n + 2).alias("line")))


def obj_road(points: DataFrame, width_m: float = 6.0, drop_m: float = 2.4, up: bool = True) -> DataFrame:
    """(part, ord, line) of an OBJ file of the road: two vertices a point, left and right (part 1), and two triangles between neighbours (part 2)."""
    p = with_place(ribbon(points, ["pass"], width_m, drop_m), "pass", "seq")
    n, a = F.col("place"), F.col("place") * 2 + 1
    corners = F.array(F.struct(F.lit(0).alias("k"), _vertex(F.col("lx"), F.col("ly"), F.col("z"), up).alias("line")), F.struct(F.lit(1).alias("k"), _vertex(F.col("rx"), F.col("ry"), F.col("z"), up).alias("line")))
    faces = F.array(F.struct(F.lit(0).alias("k"), F.format_string("f %d %d %d", a, a + 2, a + 3).alias("line")), F.struct(F.lit(1).alias("k"), F.format_string("f %d %d %d", a, a + 3, a + 1).alias("line")))
    on = p.withColumn("_next", F.lead("place").over(Window.partitionBy("pass").orderBy("place"))).where("_next is not null")
    parts = [df.select(F.lit(k).alias("part"), n.alias("_n"), F.explode(c).alias("_c")).select("part", (F.col("_n") * 2 + F.col("_c.k")).alias("ord"), "_c.line") for df, k, c in ((p, 1, corners), (on, 2, faces))]
    return parts[0].unionByName(parts[1])


def write_obj(lines: DataFrame, path: str) -> None:
    """A file a range of lines; put together in order of their names they are the OBJ file."""
    lines.repartitionByRange("part", "ord").sortWithinPartitions("part", "ord").select("line").write.text(path)


def geojson_lines(points: DataFrame) -> DataFrame:
    """(pass, feature): a GeoJSON line string for each pass of (pass, idx, lat, lon, alt)."""
    line = F.array_sort(F.collect_list(F.struct("idx", "lon", "lat", "alt")))
    geometry = F.struct(F.lit("LineString").alias("type"), F.transform(line, lambda r: F.array(F.round(r["lon"], 8), F.round(r["lat"], 8), F.round(r["alt"], 2))).alias("coordinates"))
    return points.groupBy("pass").agg(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.col("pass")).alias("properties"), geometry.alias("geometry"))).alias("feature"))
