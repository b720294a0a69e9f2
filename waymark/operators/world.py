"""Merging partitions into one world, and its levels of detail."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.scalars import contribution
from waymark.operators.corridor import near_corridor


def newest(files: DataFrame, by: str, path: str = "path") -> DataFrame:
    """(by, path, step): the file of the highest step, the digits of its stem (-1 without any)."""
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"\.[^.]*$", "")
    step = F.coalesce(F.nullif(F.regexp_replace(stem, "[^0-9]", ""), F.lit("")).cast("bigint"), F.lit(-1))
    return files.withColumn("_s", step).groupBy(by).agg(F.min_by(path, F.struct((-F.col("_s")).alias("s"), F.col(path).alias("p"))).alias(path), F.max("_s").alias("step"))


def mark_owned(gaussians: DataFrame, chunks: DataFrame) -> DataFrame:
    """Gaussians of listed chunks, with owned: within the chunk's half-open box. All properties ride along."""
    box = chunks.select("chunk", "x0", "y0", "x1", "y1")
    owned = (F.col("x") >= F.col("x0")) & (F.col("x") < F.col("x1")) & (F.col("y") >= F.col("y0")) & (F.col("y") < F.col("y1"))
    return gaussians.join(box, "chunk").withColumn("owned", owned).drop("x0", "y0", "x1", "y1")


def merge_world(gaussians: DataFrame, chunks: DataFrame, segs: DataFrame | None, radius: float, bands: DataFrame | None) -> DataFrame:
    """Owned gaussians within their chunk's corridor: its height band (z_lo, z_hi), then its radius in the plane.

    Every chunk shares one frame, so the world is a filter and a union. A chunk without segments keeps all
    that it owns, whatever the height; so does a call without segs.
    """
    own = mark_owned(gaussians, chunks).where("owned").drop("owned")
    if segs is None:
        return own
    with_path = segs.select("chunk").distinct()
    banded = own.join(bands.select("chunk", "z_lo", "z_hi"), "chunk").where(F.col("z").between(F.col("z_lo"), F.col("z_hi"))).drop("z_lo", "z_hi")
    kept = near_corridor(banded.join(with_path, "chunk", "left_semi"), ["chunk"], segs, radius, ["chunk"])
    return kept.select(own.columns).unionByName(own.join(with_path, "chunk", "left_anti").select(own.columns))


def tile_totals(gaussians: DataFrame, chunks: DataFrame, merged: DataFrame) -> DataFrame:
    """(chunk, source, owned, kept)."""
    counts = mark_owned(gaussians, chunks).groupBy("chunk").agg(F.count("*").alias("source"), F.count_if("owned").alias("owned"))
    return counts.join(merged.groupBy("chunk").agg(F.count("*").alias("kept")), "chunk", "left").na.fill(0, ["kept"])


def level_of_detail(tiles: DataFrame, keep: float, sh: bool = True, tie: list[str] = ["idx"]) -> DataFrame:
    """The share `keep` of each tile with the largest contributions, one row at least; without sh, f_rest_ columns go.

    Ties fall to the tie columns. The count is rounded half to even. The rank is by tile, which is a chunk's rows.
    """
    cols = [c for c in tiles.columns if sh or not c.startswith("f_rest_")]
    if keep >= 1:
        return tiles.select(cols)
    c = contribution(F.col("opacity"), [F.col(f"scale_{k}") for k in range(3)])
    w = Window.partitionBy("chunk")
    ranked = tiles.withColumn("_c", c).withColumn("_r", F.row_number().over(w.orderBy(F.col("_c").desc(), *tie))).withColumn("_n", F.count("*").over(w))
    return ranked.where(F.col("_r") <= F.greatest(F.lit(1), F.bround(F.col("_n") * F.lit(keep)))).select(cols)


def lod_totals(tiles: DataFrame, kept: DataFrame, source_bytes: int, kept_bytes: int) -> tuple[DataFrame, DataFrame]:
    """What a level of detail keeps: (chunk, source, gaussians) and one row of totals.

    Bytes are rows times the bytes a row takes, before and after: (source, gaussians, gaussians_share, source_bytes, bytes, bytes_share).
    """
    each = tiles.groupBy("chunk").agg(F.count("*").alias("source")).join(kept.groupBy("chunk").agg(F.count("*").alias("gaussians")), "chunk", "left").na.fill(0, ["gaussians"])
    zero = F.lit(0).cast("bigint")
    total = each.agg(F.coalesce(F.sum("source"), zero).alias("source"), F.coalesce(F.sum("gaussians"), zero).alias("gaussians"))
    total = total.withColumn("source_bytes", F.col("source") * source_bytes).withColumn("bytes", F.col("gaussians") * kept_bytes)
    share = {n: F.col(a) / F.greatest(F.col(b), F.lit(1)) for n, a, b in (("gaussians_share", "gaussians", "source"), ("bytes_share", "bytes", "source_bytes"))}
    return each, total.withColumns(share)


def with_level(catalogue: DataFrame, level: DataFrame, key: str = "name") -> DataFrame:
    """A world's catalogue of levels with one level's rows put in the place of the rows of its name."""
    return catalogue.join(level.select(key).distinct(), key, "left_anti").unionByName(level)
