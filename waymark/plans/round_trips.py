"""Registered queries that write files and read them back, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.operators.shared import scratch_path
from waymark.plans.fixtures import FRAMES_SQL, GAUSSIANS_SQL, frames, gaussians
from waymark.sources import ply, solved


def _r(c: str | Column, name: str, n: int = 6) -> Column:
    return (F.round(c, n) + F.lit(0.0)).alias(name)


def gaussian_window(spark: SparkSession, d: str) -> DataFrame:
    """All gaussians as PLY files by x, read back within a window: three columns of a file's thirteen, no file beyond the window, no row either."""
    ply.register(spark)
    path = scratch_path(spark, "gaussians").removeprefix("file://")
    g = gaussians(spark, d).drop("chunk", "idx")
    g.repartitionByRange(16, "x").write.format("ply").mode("append").save(path)
    back = spark.read.format("ply").schema("x double, y double, z double").option("rowsPerTask", 20_000).load(path)
    return back.where("x >= -20.0 and x < 12.5 and y > -30.0 and y <= 25.0").groupBy("x", "y", "z").agg(F.count("*").alias("n"))


def solved_centres(spark: SparkSession, d: str) -> DataFrame:
    """All frames as solved images, each turned about the vertical and with up to four observations, read back: camera centres and what they see."""
    solved.register(spark)
    path = scratch_path(spark, "solved").removeprefix("file://")
    turn, seen = F.col("seq") * 0.1, F.sequence(F.lit(1), (F.col("seq") % 5).cast("int"))
    none = F.array().cast("array<double>")
    rows = frames(spark, d).select(
        F.col("seq").alias("image_id"), F.cos(turn / 2).alias("qw"), F.lit(0.0).alias("qx"), F.lit(0.0).alias("qy"), F.sin(turn / 2).alias("qz"), F.col("x").alias("tx"), F.col("y").alias("ty"), F.col("z").alias("tz"), (F.col("seq") % 3).alias("camera_id"),
        F.format_string("cam%d/%06d.jpg", F.col("seq") % 3, F.col("seq")).alias("name"), *[F.when(F.col("seq") % 5 == 0, none).otherwise(F.transform(seen, lambda k: k * f + F.col("seq"))).alias(c) for c, f in (("xs", 0.5), ("ys", 0.25))],
        F.when(F.col("seq") % 5 == 0, F.array().cast("array<bigint>")).otherwise(F.transform(seen, lambda k: k + F.col("seq") * 7)).alias("points"),
    )
    rows.repartition(2, "seq").write.format("solved").mode("append").save(path)
    back = spark.read.format("solved").option("recordsPerTask", 700).load(path)
    return back.select("image_id", "name", "camera_id", "observations", *[_r(c, n) for c, n in zip(solved.centre(), ("x", "y", "z"))], _r(F.aggregate("xs", F.lit(0.0), lambda a, v: a + v), "xs"), F.aggregate("points", F.lit(0).cast("bigint"), lambda a, v: a + v).alias("points"))


ORACLES = {
    "gaussian_window": f"with {GAUSSIANS_SQL} select x, y, z, count(*) as n from fx_gaussians where x >= -20.0e0 and x < 12.5e0 and y > -30.0e0 and y <= 25.0e0 group by 1, 2, 3",
    "solved_centres": f"""with {FRAMES_SQL}, s as (select *, seq * 0.1e0 as a, seq % 5 as m from fx_frames)
select seq as image_id, printf('cam%d/%06d.jpg', seq % 3, seq) as name, seq % 3 as camera_id, m as observations, round(-(cos(a) * x + sin(a) * y), 6) as x, round(-(cos(a) * y - sin(a) * x), 6) as y, round(-z, 6) as z,
  round(m * (m + 1) / 4.0e0 + m * seq, 6) as xs, m * (m + 1) // 2 + m * seq * 7 as points from s""",
}
QUERIES = {f.__name__: f for f in (gaussian_window, solved_centres)}
