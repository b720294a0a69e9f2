"""Corridors: polylines of passes with a radius and a height band, and distances to them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.operators.discs import grouped
from waymark.operators.passes import split_passes, thin
from waymark.operators.shared import written, with_place


def corridor_points(frames: DataFrame, by: list[str], spacing: float = 5.0, gap_m: float = 30.0, gap_s: float = 30.0) -> DataFrame:
    """(by, video, pass, seq, x, y, z): passes thinned and rounded to millimetres; passes of one point are dropped."""
    keys = list(dict.fromkeys([*by, "video", "pass"]))
    kept = thin(split_passes(frames, by, gap_m, gap_s), keys, spacing)
    w = Window.partitionBy(*keys)
    return kept.withColumn("_n", F.count("*").over(w)).where("_n >= 2").select(*keys, "seq", *[F.round(c, 3).alias(c) for c in ("x", "y", "z")])


def height_band(points: DataFrame, by: list[str], margin: float = 8.0) -> DataFrame:
    """(by, z_lo, z_hi) of corridor points, widened by a margin."""
    out = points.groupBy(*by) if by else points
    return out.agg((F.coalesce(F.min("z"), F.lit(0.0)) - margin).alias("z_lo"), (F.coalesce(F.max("z"), F.lit(0.0)) + margin).alias("z_hi"))


def pass_ranges(points: DataFrame, by: list[str]) -> DataFrame:
    return points.groupBy(*by, "pass").agg(F.min("seq").alias("seq_lo"), F.max("seq").alias("seq_hi"), F.count("*").alias("points"))


def segments(points: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, idx, ax, ay, az, bx, by_, bz): a row between neighbours of a pass."""
    w = Window.partitionBy(*keys).orderBy("seq")
    out = points.withColumn("idx", F.row_number().over(w) - 1)
    for c, n in (("x", "bx"), ("y", "by_"), ("z", "bz")):
        out = out.withColumn(n, F.lead(c).over(w))
    return out.where("bx is not null").select(*keys, "idx", F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("z").alias("az"), "bx", "by_", "bz")


def world_corridor(headers: DataFrame) -> DataFrame:
    """One row of chunk headers (radius_m, z_lo, z_hi): the widest radius (25 if 0), the band over all (a missing one is 0)."""
    radius = F.coalesce(F.max("radius_m"), F.lit(0.0))
    return headers.agg(F.when(radius == 0, 25.0).otherwise(radius).alias("radius_m"), F.coalesce(F.min(F.coalesce("z_lo", F.lit(0.0))), F.lit(0.0)).alias("z_lo"), F.coalesce(F.max(F.coalesce("z_hi", F.lit(0.0))), F.lit(0.0)).alias("z_hi"))


def _share(p: list[Column], a: list[Column], b: list[Column]) -> Column:
    """Where on a segment a point's nearest place is, 0 to 1."""
    d = [y - x for x, y in zip(a, b)]
    dot = sum(((q - x) * e for q, x, e in zip(p, a, d)), F.lit(0.0))
    norm = sum((e * e for e in d), F.lit(0.0))
    return F.when(norm < 1e-12, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot / F.greatest(norm, F.lit(1e-12)))))


def _square(p: list[Column], a: list[Column], b: list[Column]) -> Column:
    t = _share(p, a, b)
    return sum((F.pow(q - x - t * (y - x), 2) for q, x, y in zip(p, a, b)), F.lit(0.0))


def near_corridor(points: DataFrame, key: list[str], segs: DataFrame, radius: float, by: list[str] | None = None) -> DataFrame:
    """Those rows of points within radius of a segment in the plane (of the same `by`, if given).

    A segment goes to the grid cells of size radius that its box, widened by radius, covers; a point to its own.
    Cells turn the distance condition into an equi-join that shuffles; the rest is a filter, and a
    semi-join keeps each point once. No broadcast, no nested loop.
    """
    by = by or []
    size = F.lit(float(radius))
    grid = segs.withColumn("_gx", F.explode(F.sequence(F.floor((F.least("ax", "bx") - radius) / size), F.floor((F.greatest("ax", "bx") + radius) / size))))
    grid = grid.withColumn("_gy", F.explode(F.sequence(F.floor((F.least("ay", "by_") - radius) / size), F.floor((F.greatest("ay", "by_") + radius) / size))))
    grid = grid.select(*[F.col(c).alias(f"_{c}") for c in by], "_gx", "_gy", "ax", "ay", "bx", "by_")
    placed = points.withColumn("_px", F.floor(F.col("x") / size)).withColumn("_py", F.floor(F.col("y") / size))
    cond = (F.col("_px") == F.col("_gx")) & (F.col("_py") == F.col("_gy"))
    for c in by:
        cond &= F.col(c) == F.col(f"_{c}")
    cond &= _square([F.col("x"), F.col("y")], [F.col("ax"), F.col("ay")], [F.col("bx"), F.col("by_")]) <= radius * radius
    return placed.join(grid, cond, "left_semi").drop("_px", "_py")


def _places_on(p: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of points (rows) to segments (columns), and where on these they are nearest; the arithmetic of _square()."""
    d = b - a
    norm = d[:, 0] * d[:, 0] + d[:, 1] * d[:, 1] + d[:, 2] * d[:, 2]
    dot = sum((p[:, k, None] - a[:, k]) * d[:, k] for k in range(3))
    t = np.where(norm < 1e-12, 0.0, np.maximum(0.0, np.minimum(1.0, dot / np.maximum(norm, 1e-12))))
    return sum((p[:, k, None] - a[:, k] - t * d[:, k]) ** 2 for k in range(3)), t


def _nearest(p: np.ndarray, a: np.ndarray, b: np.ndarray, rank: np.ndarray, few: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(squared distance, segment, nearest place) for each point; ties by rank, then by place.

    Points are halved until few are left. A box of points only keeps the segments that may be nearest to one of them: those not farther from its
    middle than the nearest one by more than the box's diagonal. So a crowd of segments is compared with few points only.
    """
    d2, seg, at = np.empty(len(p)), np.empty(len(p), dtype=np.int64), np.empty((len(p), 3))
    wait = [(np.arange(len(p)), np.arange(len(a)))]
    while wait:
        own, segs = wait.pop()
        low, high = p[own].min(axis=0), p[own].max(axis=0)
        if len(segs) > 1:
            far = np.sqrt(_places_on((low + high)[None] / 2, a[segs], b[segs])[0][0])
            segs = segs[far <= (far.min() + np.linalg.norm(high - low)) * (1 + 1e-9) + 1e-9]
        if len(own) > few and len(own) * len(segs) > 4096 and (high > low).any():
            axis = int((high - low).argmax())
            right = p[own, axis] > (low[axis] + high[axis]) / 2
            wait += [(own[right], segs), (own[~right], segs)]
            continue
        step = max(1, (1 << 20) // len(segs))
        for k in range(0, len(own), step):
            some = own[k : k + step]
            square, t = _places_on(p[some], a[segs], b[segs])
            least = square.min(axis=1)
            row, col = np.nonzero(square == least[:, None])
            place = a[segs[col]] + t[row, col, None] * (b[segs[col]] - a[segs[col]])
            order = np.lexsort((place[:, 2], place[:, 1], place[:, 0], rank[segs[col]], row))
            first = order[np.concatenate([[True], row[order][1:] != row[order][:-1]])]
            d2[some], seg[some], at[some] = least, segs[col[first]], place[first]
    return d2, seg, at


def _hits(batches: Iterator[pa.RecordBatch], reach: float) -> Iterator[pa.RecordBatch]:
    """Rows (cell, part, side, _place or pass, idx, x, y, z, ...), sorted by cell and part: each place's nearest within reach."""
    names = ["_place", "d2", "pass", "idx", "qx", "qy", "qz"]

    def closed(t: pa.Table) -> Iterator[pa.RecordBatch]:
        side = t["side"].to_numpy() == 0
        if side.all() or not side.any():
            return
        own, segs = t.filter(pa.array(side)), t.filter(pa.array(~side))
        ids, idx = segs["id"].to_numpy(), segs["idx"].to_numpy()
        order = np.lexsort((idx, ids))
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], (np.diff(ids[order]) != 0) | (np.diff(idx[order]) != 0)]))
        p, a = (np.stack([x[c].to_numpy() for c in "xyz"], axis=1) for x in (own, segs))
        d2, seg, at = _nearest(p, a, np.stack([segs[c].to_numpy() for c in ("bx", "by_", "bz")], axis=1), rank)
        near = d2 <= reach * reach
        if near.any():
            yield pa.RecordBatch.from_arrays([pa.array(v[near]) for v in (own["id"].to_numpy(), d2, ids[seg], idx[seg], at[:, 0], at[:, 1], at[:, 2])], names=names)

    return grouped(batches, 4, closed)


def nearest_on_corridor(points: DataFrame, key: str, segs: DataFrame, reach: float, crowd: int = 1 << 15) -> DataFrame:
    """points with (d, qx, qy, qz): the nearest place of the corridor in space, at any distance; null without segments.

    A segment goes to the grid cells of four times `reach` that its box, widened by reach, covers, and a point to its own, so a place
    within reach is proven nearest. Within a cell halved boxes of points rule out segments; no row a pair is made, and of a cell's points and segments
    at most `crowd` each meet at a time. Points that find none go on with four times the reach, until all have one: few
    rounds, each an equi-join of the places still open, which are written between rounds. Ties go to the first pass
    and segment. Each place is asked for once, however many points lie there, and points find theirs by place: `key` may repeat.
    """
    places = points.select(*[(F.col(c).cast("double") + 0.0).alias(c) for c in "xyz"]).where("x is not null and y is not null and z is not null").distinct()
    places = written(places.withColumn("_place", F.monotonically_increasing_id()))
    wait = places
    found, segs = None, written(segs.select("pass", "idx", "ax", "ay", "az", "bx", "by_", "bz").dropna(subset=["ax", "ay", "az", "bx", "by_", "bz"]))
    if not segs.take(1):
        none = F.lit(None).cast("double")
        return points.withColumns({c: none for c in ("d", "qx", "qy", "qz")})
    while True:
        size = F.lit(4.0 * reach)
        grid = segs.withColumn("gx", F.explode(F.sequence(F.floor((F.least("ax", "bx") - reach) / size), F.floor((F.greatest("ax", "bx") + reach) / size))))
        grid = grid.withColumn("gy", F.explode(F.sequence(F.floor((F.least("ay", "by_") - reach) / size), F.floor((F.greatest("ay", "by_") + reach) / size))))
        grid = grid.select("gx", "gy", F.col("pass").cast("bigint").alias("id"), F.col("idx").cast("bigint").alias("idx"), F.col("ax").alias("x"), F.col("ay").alias("y"), F.col("az").alias("z"), "bx", "by_", "bz")
        asked = wait.select(F.floor(F.col("x") / size).alias("gx"), F.floor(F.col("y") / size).alias("gy"), F.col("_place").alias("id"), "x", "y", "z")
        parts = [df.groupBy("gx", "gy").agg(F.ceil(F.count("*") / crowd).cast("bigint").alias(n)).where(F.col(n) > 1) for df, n in ((asked, "_i"), (grid, "_j"))]
        sides = []
        for df, own, met, n in ((asked, "i", "j", 0), (grid, "j", "i", 1)):
            out = df.join(parts[0], ["gx", "gy"], "left").join(parts[1], ["gx", "gy"], "left").na.fill(1, ["_i", "_j"])
            out = out.withColumn(own, F.pmod(F.xxhash64("id", "x", "y", "z"), F.col(f"_{own}"))).withColumn(met, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(f"_{met}") - 1)))
            sides.append(out.withColumn("side", F.lit(n)).drop("_i", "_j"))
        keys = ["gx", "gy", "i", "j"]
        both = sides[1].unionByName(sides[0], allowMissingColumns=True).select(*keys, "side", "id", "idx", "x", "y", "z", "bx", "by_", "bz")
        hits = both.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lambda batches, reach=reach: _hits(batches, reach), "_place bigint, d2 double, pass bigint, idx bigint, qx double, qy double, qz double")
        best = written(hits.groupBy("_place").agg(F.min(F.struct("d2", "pass", "idx", "qx", "qy", "qz")).alias("_q")))
        found = best if found is None else found.union(best)
        wait = written(wait.join(best.select("_place"), "_place", "left_anti"))
        if not wait.take(1):
            break
        reach *= 4
    at = places.join(found, "_place").select(*[F.col(c).alias(f"_{c}") for c in "xyz"], "_q")
    same = F.lit(True)
    for c in "xyz":
        same &= F.col(c) == F.col(f"_{c}")
    return points.join(at, same, "left").drop("_x", "_y", "_z").withColumn("d", F.sqrt("_q.d2")).withColumn("qx", F.col("_q.qx")).withColumn("qy", F.col("_q.qy")).withColumn("qz", F.col("_q.qz")).drop("_q")


def guard(nearest: DataFrame, radius: float, z_lo: float, z_hi: float, margin: float = 0.0) -> DataFrame:
    """nearest_on_corridor() rows with inside, and the position (gx, gy, gz) held within the corridor."""
    limit = max(radius - margin, 0.0)
    out = nearest.withColumn("inside", F.coalesce((F.col("d") <= radius) & F.col("z").between(z_lo, z_hi), F.lit(False)))
    pull = F.when((F.col("d") > limit) & (F.col("d") > 0), limit / F.col("d")).otherwise(1.0)
    for c in ("x", "y", "z"):
        out = out.withColumn(f"g{c}", F.col(f"q{c}") + (F.col(c) - F.col(f"q{c}")) * pull)
    return out.withColumn("gz", F.greatest(F.lit(z_lo), F.least(F.lit(z_hi), F.col("gz"))))


def union_corridors(points: DataFrame, headers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chunks' corridors as one of the world: points (chunk, pass, seq, x, y, z) with passes numbered through, and the header.

    Passes count on from chunk to chunk, in order of (chunk, pass); the table of passes, a row each, is numbered.
    """
    passes = with_place(points.select("chunk", "pass").distinct(), "chunk", "pass", name="_all")
    return points.join(passes, ["chunk", "pass"]).withColumn("pass", F.col("_all")).drop("_all"), world_corridor(headers)
