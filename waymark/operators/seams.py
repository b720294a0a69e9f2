"""Agreement of neighbouring partitions where their corridors meet."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions.scalars import verdict
from waymark.operators import discs
from waymark.operators.selection import quantiles
from waymark.operators.shared import written


def _met(batches: Iterator[pa.RecordBatch], bucket_m: float) -> Iterator[pa.RecordBatch]:
    """Rows (gx, gy, i, j, side, chunk, x, y, z), sorted, as (a, b, dz, n) of each part of a bucket."""

    def closed(t: pa.Table) -> Iterator[pa.RecordBatch]:
        chunk = t["chunk"].combine_chunks().dictionary_encode()
        names = chunk.dictionary.to_pylist()
        code, side = chunk.indices.to_numpy(), t["side"].to_numpy()
        columns = [t[c].to_numpy() for c in "xyz"]
        own = [{k: tuple(v[(side == s) & (code == k)] for v in columns) for k in np.unique(code[side == s]).tolist()} for s in (0, 1)]
        for k, a in own[0].items():
            for m, b in own[1].items():
                if names[k] < names[m]:
                    dz, n = discs.differences(*[tuple(v[~np.isnan(p[2])] if c < 2 else v[~np.isnan(p[2])].astype(np.int64) for c, v in enumerate(p)) for p in (a, b)], bucket_m)
                    none = discs.unknown(a, b, bucket_m)
                    dz, n = pa.array([*dz, None], pa.int64()) if none else pa.array(dz), np.append(n, none) if none else n
                    yield pa.RecordBatch.from_arrays([pa.array([v] * len(n), pa.string()) for v in (names[k], names[m])] + [dz, pa.array(n)], names=["a", "b", "dz", "n"])

    return discs.grouped(batches, 4, closed)


def _differences(points: DataFrame, bucket_m: float, exact: bool, crowd: int) -> DataFrame:
    """(a, b, dz, n): how often dz is the millimetres that points of b are higher than points of a, an earlier chunk, in one bucket.

    A bucket with more than `crowd` points is dealt into parts on both sides, which all meet: a task holds two parts at a time. Parts count
    their pairs, so what comes out is a row a difference, not a row a pair.
    """
    size = F.lit(float(bucket_m))
    some = [F.col(c).isNotNull() & (F.abs(c) < float("inf")) for c in "xy"]
    p = points.where("chunk is not null").where(some[0] & some[1]).select("chunk", "x", "y", F.round(F.col("z") * 1000).cast("bigint").alias("z"), F.floor(F.col("x") / size).alias("gx"), F.floor(F.col("y") / size).alias("gy"))
    p = written(p.withColumn("_n", F.monotonically_increasing_id()), "seam-points")
    other = p
    if exact:
        around = F.array(F.lit(-1), F.lit(0), F.lit(1))
        other = p.withColumn("_i", F.explode(around)).withColumn("_j", F.explode(around)).withColumn("gx", F.col("gx") + F.col("_i")).withColumn("gy", F.col("gy") + F.col("_j")).drop("_i", "_j")
    parts = other.groupBy("gx", "gy").agg(F.least(F.lit(4096), F.ceil(F.count("*") / crowd)).cast("int").alias("_parts")).where("_parts > 1")

    def dealt(df: DataFrame, side: int, own: str, met: str) -> DataFrame:
        out = df.join(parts, ["gx", "gy"], "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))
        out = out.withColumn(own, F.pmod(F.xxhash64("_n"), F.col("_parts")).cast("bigint")).withColumn(met, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts").cast("bigint") - 1)))
        return out.select("gx", "gy", "i", "j", F.lit(side).alias("side"), "chunk", "x", "y", F.col("z").cast("double").alias("z"))

    both = dealt(p, 0, "i", "j").unionByName(dealt(other, 1, "j", "i"))
    keys = ["gx", "gy", "i", "j"]
    return both.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lambda batches: _met(batches, bucket_m), "a string, b string, dz bigint, n bigint").groupBy("a", "b", "dz").agg(F.sum("n").alias("n"))


def seam_ties(points: DataFrame, bucket_m: float = 6.0, min_pairs: int = 20, crowd: int = 1 << 15) -> DataFrame:
    """(a, b, dz, w): the mean height difference of b to a in metres where two chunks meet, and how many pairs of points tell, for a levelling network."""
    out = _differences(points, bucket_m, False, crowd).groupBy("a", "b").agg((F.sum(F.col("dz") * F.col("n")) / F.sum("n") / 1000).alias("dz"), F.sum("n").alias("w"))
    return out.where(F.col("w") >= min_pairs)


def seam_pairs(points: DataFrame, bucket_m: float = 6.0, min_pairs: int = 20, exact: bool = False, crowd: int = 1 << 15) -> DataFrame:
    """(a, b, pairs, median_dz, p90_dz, verdict) of (chunk, x, y, z): thinned corridor points, a handful a bucket.

    Points of different chunks that share a bucket and lie within bucket_m in the plane; with exact, those in
    neighbouring buckets too. Points meet by bucket, one of more than `crowd` points in parts; within a part, small squares that are near as a whole meet by
    counts of heights, so that pairs aren't looked at one by one. Heights count in millimetres, as corridors are
    stored; percentiles come from the counts of each difference, not from a row a pair. The points are written once.
    """
    each = _differences(points, bucket_m, exact, crowd).groupBy("a", "b", F.abs("dz").alias("dz")).agg(F.sum("n").alias("n"))
    out = each.groupBy("a", "b").agg(F.sum("n").alias("pairs"), (F.percentile("dz", 0.5, F.col("n")) / 1000).alias("median_dz"), (F.percentile("dz", 0.9, F.col("n")) / 1000).alias("p90_dz"))
    return out.where(F.col("pairs") >= min_pairs).withColumn("verdict", verdict(F.col("median_dz")))


def seam_report(pairs: DataFrame, fail_over: float = 3.0) -> DataFrame:
    """One row: seams, the median of medians, the worst, and the chunks in any pair of at least fail_over."""
    pairs = written(pairs, "seams")
    bad = pairs.where(F.col("median_dz") >= fail_over).select(F.explode(F.array("a", "b")).alias("_c")).distinct().agg(F.array_sort(F.collect_list("_c")).alias("offenders"))
    middle = quantiles(pairs, [], "median_dz", {"median": 0.5}).drop("n")
    totals = pairs.agg(F.count("*").alias("seams"), F.max("median_dz").alias("worst"))
    return totals.join(F.broadcast(middle), F.lit(True), "left").join(F.broadcast(bad), F.lit(True), "left").select("seams", "median", "worst", "offenders")


def seam_gate(pairs: DataFrame, fail_over: float = 3.0) -> DataFrame:
    """One row: the gate's upper median, the worst, and ok: true, false, or false with `skipped` if nothing overlaps."""
    pairs = written(pairs, "seams")
    middle = quantiles(pairs, [], "median_dz", {"upper_median": 0.5}, upper=True).drop("n")
    totals = pairs.agg(F.count("*").alias("seams"), F.max("median_dz").alias("worst")).join(F.broadcast(middle), F.lit(True), "left")
    return totals.select("seams", "upper_median", "worst", (F.col("seams") == 0).alias("skipped"), F.coalesce(F.col("worst") <= fail_over, F.lit(False)).alias("ok"))


def footprints(chunks: DataFrame, hull: DataFrame, least: float = 0.30) -> DataFrame:
    """Chunks (chunk, x0, y0, x1, y1) whose footprint lies in the hull, one row of the same bounds, by more than a share."""
    h = F.broadcast(hull.select(*[F.col(c).alias(f"h{c}") for c in ("x0", "y0", "x1", "y1")]).limit(1))
    both = chunks.join(h)
    w = F.greatest(F.lit(0.0), F.least("x1", "hx1") - F.greatest("x0", "hx0"))
    d = F.greatest(F.lit(0.0), F.least("y1", "hy1") - F.greatest("y0", "hy0"))
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    return both.withColumn("share", F.when(area > 0, w * d / area).otherwise(0.0)).where(F.col("share") > least).select(*chunks.columns, "share")
