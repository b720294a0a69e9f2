"""Chunks, worlds and envelopes as folders of Spark tables: written by tasks, each chunk in a folder of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.sources.files import ENVELOPE


def write_chunks(members: DataFrame, manifest: DataFrame, path: str) -> None:
    """Member frames by chunk (path/frames/chunk=...), their geo index (path/geo, positions to four decimals) and the manifest (path/chunks, JSON lines)."""
    members.write.partitionBy("chunk").parquet(f"{path}/frames")
    members.select("chunk", "seq", *[F.format_string("%.4f", c).alias(c) for c in "xyz"]).write.partitionBy("chunk").json(f"{path}/geo")
    manifest.write.json(f"{path}/chunks")


def read_chunks(spark: SparkSession, path: str, members: DataFrame, manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members and manifest with the schemas of two tables like those written; a filter on chunk reads just its folders."""
    return spark.read.schema(members.schema).parquet(f"{path}/frames"), spark.read.schema(manifest.schema).json(f"{path}/chunks")


def write_world(merged: DataFrame, totals: DataFrame, path: str) -> None:
    """Tiles by chunk (path/tiles/chunk=...) and the world's catalogue of tiles (path/world, JSON lines)."""
    merged.write.partitionBy("chunk").parquet(f"{path}/tiles")
    totals.write.json(f"{path}/world")


def write_level(level: DataFrame, name: str, keep: float, path: str) -> None:
    """Tiles of a level of detail (path/lods/name=...), in the place of those of the same name, and its row of the catalogue."""
    level.write.mode("overwrite").partitionBy("chunk").parquet(f"{path}/lods/name={name}")
    rows = level.groupBy("chunk").agg(F.count("*").alias("gaussians")).select("chunk", F.lit(keep).alias("keep"), "gaussians")
    rows.write.mode("overwrite").json(f"{path}/levels/name={name}")


def read_levels(spark: SparkSession, path: str) -> DataFrame:
    """(chunk, keep, gaussians, name) of all levels written."""
    return spark.read.schema("chunk string, keep double, gaussians bigint, name string").json(f"{path}/levels")


def envelope_documents(points: DataFrame, by: str, radius_m: float, bands: DataFrame, source: str) -> DataFrame:
    """An envelope a row of `by`: passes with their points, sequence ranges and videos, from (by, video, pass, seq, x, y, z) and (by, z_lo, z_hi)."""
    line = F.array_sort(F.collect_list(F.struct("seq", F.array("x", "y", "z").alias("p"))))
    passes = points.groupBy(by, "pass").agg(F.max("video").alias("video"), F.array(F.min("seq"), F.max("seq")).alias("seq_range"), line.alias("_l"))
    whole = passes.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("pass", F.struct("video", "seq_range", F.transform("_l", lambda r: r["p"]).alias("points")).alias("d")))).alias("_p"))
    origin = F.lit(None).cast("struct<lat: double, lon: double>")
    return whole.join(bands, by).select(by, F.lit("enu").alias("frame"), origin.alias("origin"), F.lit(radius_m).alias("radius_m"), F.array("z_lo", "z_hi").alias("height_band_m"), F.lit(source).alias("source"), F.transform("_p", lambda r: r["d"]).alias("passes"))


def write_envelopes(documents: DataFrame, by: str, path: str, version: int) -> None:
    """A version of envelopes, JSON lines; what an earlier version says stays on disk (see capture.refreshed())."""
    documents.withColumn("version", F.lit(version)).write.mode("append").partitionBy("version", by).json(path)


def read_envelopes(spark: SparkSession, by: str, path: str) -> DataFrame:
    return spark.read.schema(f"{ENVELOPE}, version int, {by} string").json(path)
