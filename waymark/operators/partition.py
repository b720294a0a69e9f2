"""Spatial grid partition with a halo."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.scalars import cell, cell_name


def _cells(v: Column, size: float, overlap: float) -> Column:
    """The distinct cells of v - overlap, v and v + overlap."""
    return F.array_distinct(F.array(*[cell(v + d, size) for d in (-overlap, 0.0, overlap)]))


def chunk_members(frames: DataFrame, cell_m: float = 200.0, overlap_m: float = 40.0, min_frames: int = 20) -> DataFrame:
    """frames with (cx, cy, chunk, is_core): a row for each cell whose halo holds the frame.

    Membership is an expansion of keys, not a join. Cells with fewer than min_frames frames of their own are
    dropped; their counts come from one grouped pass and join by cell. Frames without a position belong to
    no cell.
    """
    placed = frames.where("x is not null and y is not null").withColumn("own_x", cell(F.col("x"), cell_m)).withColumn("own_y", cell(F.col("y"), cell_m))
    earned = placed.groupBy(F.col("own_x").alias("cx"), F.col("own_y").alias("cy")).agg(F.count("*").alias("core_frames")).where(F.col("core_frames") >= min_frames)
    out = placed.withColumn("cx", F.explode(_cells(F.col("x"), cell_m, overlap_m))).withColumn("cy", F.explode(_cells(F.col("y"), cell_m, overlap_m)))
    out = out.join(earned.drop("core_frames"), ["cx", "cy"], "left_semi").withColumn("chunk", cell_name(F.col("cx"), F.col("cy")))
    return out.withColumn("is_core", (F.col("cx") == F.col("own_x")) & (F.col("cy") == F.col("own_y"))).drop("own_x", "own_y")


def chunk_manifest(members: DataFrame, cell_m: float) -> DataFrame:
    """A row for each chunk: counts, distinct videos, mean position, bounds."""
    out = members.groupBy("chunk", "cx", "cy").agg(
        F.count("*").alias("frames"), F.count_if("is_core").alias("core_frames"), F.array_sort(F.collect_set(F.nullif("video", F.lit("")))).alias("passes"), F.avg("x").alias("centre_x"), F.avg("y").alias("centre_y")
    )
    for name, axis, d in (("x0", "cx", 0), ("y0", "cy", 0), ("x1", "cx", 1), ("y1", "cy", 1)):
        out = out.withColumn(name, (F.col(axis) + d) * F.lit(float(cell_m)))
    return out


def _boxed(points: DataFrame, cells: DataFrame, grow: Column, grid_m: float) -> DataFrame:
    """points with the chunk of every cell whose box, grown, holds them, edges included: boxes are expanded to grid squares, so this is an equi-join."""
    box = cells.select("chunk", *[(F.col(c) + d * grow).alias(f"_{c}") for c, d in (("x0", -1), ("y0", -1), ("x1", 1), ("y1", 1))])
    for axis in "xy":
        box = box.withColumn(f"_g{axis}", F.explode(F.sequence(cell(F.col(f"_{axis}0"), grid_m), cell(F.col(f"_{axis}1"), grid_m))))
    placed = points.withColumns({f"_g{axis}": cell(F.col(axis), grid_m) for axis in "xy"})
    inside = F.col("x").between(F.col("_x0"), F.col("_x1")) & F.col("y").between(F.col("_y0"), F.col("_y1"))
    return placed.join(box, ["_gx", "_gy"]).where(inside).select("chunk", *points.columns)


def camera_rule(cameras: DataFrame, seen: DataFrame, cells: DataFrame, rule: str = "inria", halo: float = 40.0, least: int = 50, grid_m: float = 200.0) -> DataFrame:
    """Cameras dealt to cells: (chunk, image_id).

    crop: every camera to every cell, which is what the rule says; cell: those inside the cell and its halo, edges included;
    inria: those, and cameras in a box twice the cell's size that observe at least `least` points inside the bare
    cell. cameras (image_id, x, y); seen (image_id, x, y of an observed point); cells (chunk, x0, y0, x1, y1).
    Points and boxes meet in grid squares of grid_m, best the cells' own size.
    """
    if rule == "crop":
        return cameras.crossJoin(cells).select("chunk", "image_id")
    inner = _boxed(cameras, cells, F.lit(halo), grid_m).select("chunk", "image_id")
    if rule == "cell":
        return inner
    outer = _boxed(cameras, cells, (F.col("x1") - F.col("x0")) / 2, grid_m).select("chunk", "image_id")
    enough = _boxed(seen, cells, F.lit(0.0), grid_m).groupBy("chunk", "image_id").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return inner.union(outer.join(enough, ["chunk", "image_id"], "left_semi")).distinct()


def manifest_totals(manifest: DataFrame) -> DataFrame:
    """One row: chunks, and memberships and own frames over all of them."""
    zero = F.lit(0).cast("bigint")
    return manifest.agg(F.count("*").alias("chunks"), F.coalesce(F.sum("frames"), zero).alias("memberships"), F.coalesce(F.sum("core_frames"), zero).alias("core_frames"))
