"""A levelling network: height offsets of chunks from the ties between them, by least squares."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.operators.connectivity import pass_groups
from waymark.operators.selection import quantiles
from waymark.operators.shared import written


def _both_ways(ties: DataFrame) -> DataFrame:
    return ties.select("a", "b", "dz", "w").union(ties.select("b", "a", -F.col("dz"), "w")).toDF("a", "b", "dz", "w")


def _solved(ties: DataFrame, tolerance: float, steps: int) -> DataFrame:
    """(node, h) that minimise the sum of w * (dz + h_b - h_a) ** 2 over ties (a, b, dz, w): conjugate gradients, scaled by the diagonal.

    A step is a join of the ties with the nodes' directions, a grouped sum, and one row of totals; the nodes' table is written once a step, so that its
    lineage doesn't grow. Starting from 0, every component stays free of a common shift by itself.
    """
    both = written(_both_ways(ties), "ties")
    d, r = F.sum("w").alias("d"), F.sum(F.col("w") * F.col("dz")).alias("r")
    state = both.groupBy(F.col("a").alias("node")).agg(d, r).withColumns({"h": F.lit(0.0), "p": F.col("r") / F.col("d")}).select("node", "d", "h", "r", "p")
    first = None
    for _ in range(steps):
        near = both.join(state.select(F.col("node").alias("b"), F.col("p").alias("_p")), "b").groupBy(F.col("a").alias("node")).agg(F.sum(F.col("w") * F.col("_p")).alias("_s"))
        state = written(state.join(near, "node").withColumn("q", F.col("d") * F.col("p") - F.col("_s")).drop("_s"), "nodes")
        pq, rz, rq, qq = state.agg(F.sum(F.col("p") * F.col("q")), *[F.sum(F.col(a) * F.col(b) / F.col("d")) for a, b in ("rr", "rq", "qq")]).first()
        first = rz if first is None else first
        if not rz or not pq or rz <= tolerance * tolerance * first:
            return state.select("node", "h")
        alpha = rz / pq
        beta = max(0.0, rz - 2 * alpha * rq + alpha * alpha * qq) / rz
        left = F.col("r") - F.lit(alpha) * F.col("q")
        state = state.select("node", "d", (F.col("h") + F.lit(alpha) * F.col("p")).alias("h"), left.alias("r"), (left / F.col("d") + F.lit(beta) * F.col("p")).alias("p"))
    raise RuntimeError(f"the network did not settle in {steps} steps")


def _solved_here(a: np.ndarray, b: np.ndarray, dz: np.ndarray, w: np.ndarray, n: int, tolerance: float, steps: int) -> np.ndarray:
    """_solved() for nodes 0 to n - 1 in memory; 0 for those without a tie."""
    ends = np.concatenate([a, b])
    d = np.bincount(ends, np.concatenate([w, w]), n)
    r = np.bincount(ends, np.concatenate([w * dz, -w * dz]), n)
    d = np.where(d > 0, d, 1.0)
    h, p, first = np.zeros(n), r / d, None
    for _ in range(steps):
        q = np.bincount(ends, np.concatenate([w * (p[a] - p[b]), w * (p[b] - p[a])]), n)
        pq, rz = p @ q, r @ (r / d)
        first = rz if first is None else first
        if not rz or not pq or rz <= tolerance * tolerance * first:
            return h
        h, r = h + rz / pq * p, r - rz / pq * q
        p = r / d + (r @ (r / d)) / rz * p
    raise RuntimeError(f"the network did not settle in {steps} steps")


def _level_here(own: DataFrame, least_m: float, spread: float, rounds: int, tolerance: float, steps: int) -> tuple[DataFrame, DataFrame]:
    """level() of ties that are gathered."""
    spark, schema = own.sparkSession, own.schema
    rows = own.collect()
    names = sorted({r[c] for r in rows for c in ("a", "b")})
    at = {v: k for k, v in enumerate(names)}
    a, b = (np.array([at[r[c]] for r in rows], dtype=np.int64) for c in ("a", "b"))
    dz, w = (np.array([r[c] for r in rows], dtype=np.float64) for c in ("dz", "w"))
    rejected = np.zeros(len(rows), dtype=bool)
    for k in range(rounds):
        kept = ~rejected
        h = _solved_here(a[kept], b[kept], dz[kept], w[kept], len(names), tolerance, steps)
        residual = dz + h[b] - h[a]
        size = np.abs(residual)
        limit = max(least_m, spread * 1.4826 * float(np.quantile(size, 0.5)))
        worst = np.full(len(names), -1.0)
        for end in (a, b):
            np.maximum.at(worst, end[kept], size[kept])
        before, rejected = rejected, (size > limit) & (rejected | ((size >= worst[a]) & (size >= worst[b])))
        if (rejected == before).all():
            break
    group = np.arange(len(names))
    while True:
        low = group.copy()
        for x, y in ((a, b), (b, a)):
            np.minimum.at(low, x[kept], group[y[kept]])
        low = low[low]
        if (low == group).all():
            break
        group = low
    mean = np.bincount(group, h, len(names)) / np.maximum(np.bincount(group, minlength=len(names)), 1)
    node = schema["a"].dataType.simpleString()
    offsets = spark.createDataFrame([(v, names[g], float(x)) for v, g, x in zip(names, group, h - mean[group])], f"node {node}, group {node}, offset double")
    judged = [(r["a"], r["b"], r["dz"], r["w"], float(x), bool(y)) for r, x, y in zip(rows, residual, rejected)]
    return offsets, spark.createDataFrame(judged, f"a {node}, b {node}, dz double, w double, residual double, rejected boolean")


def level(ties: DataFrame, least_m: float = 0.5, spread: float = 4.0, rounds: int = 12, tolerance: float = 1e-10, steps: int = 2000, gathered: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """Offsets (node, group, offset) that make heights agree, and the ties with their `residual` and whether they were `rejected`.

    ties: (a, b, dz, w), how much higher b is than a where they meet, and how much that counts; a row a pair. Heights plus offsets agree as well as
    ties allow, in the sense of least squares. A tie whose residual is beyond `spread` robust standard deviations (by the median of all
    absolute residuals), and beyond least_m, is suspect. As one bad tie bends its neighbours, only a suspect that is the worst accepted tie of both its ends is left out, and the rest solved
    again; one left out that fits later is taken back. That goes on until nothing changes or `rounds` are over. In each group of nodes
    that accepted ties join, named by its smallest node, offsets have a mean of 0: a common shift can't be known. A node without an accepted tie is a group of its own.

    A network of up to `gathered` ties is solved on the driver; a larger one stays where it is, a few jobs a step.

    Cases: ties with a null, of a node with itself, or of no weight say nothing; no ties: no rows.
    """
    own = ties.select("a", "b", F.col("dz").cast("double").alias("dz"), F.col("w").cast("double").alias("w")).where("a is not null and b is not null and dz is not null and a != b and w > 0")
    own = written(own.withColumn("_t", F.monotonically_increasing_id()), "network")
    if 0 < own.count() <= gathered:
        return _level_here(own, least_m, spread, rounds, tolerance, steps)
    nodes = own.select(F.col("a").alias("node")).union(own.select("b")).distinct()
    judged, before = own.withColumn("rejected", F.lit(False)), None
    for _ in range(rounds):
        kept = written(judged.where("not rejected").select("a", "b", "dz", "w"), "kept")
        h = nodes.join(_solved(kept, tolerance, steps), "node", "left").select("node", F.coalesce("h", F.lit(0.0)).alias("h"))
        h = written(h, "heights")
        judged = judged.drop("residual").join(h.toDF("a", "_ha"), "a").join(h.toDF("b", "_hb"), "b").withColumn("residual", F.col("dz") + F.col("_hb") - F.col("_ha")).drop("_ha", "_hb")
        judged = written(judged, "residuals")
        middle = quantiles(judged.withColumn("_r", F.abs("residual")), [], "_r", {"m": 0.5}).first()
        limit = max(least_m, spread * 1.4826 * (middle["m"] if middle else 0.0))
        size = F.abs("residual")
        worst = judged.where("not rejected").select(F.explode(F.array("a", "b")).alias("node"), size.alias("r")).groupBy("node").agg(F.max("r").alias("r"))
        judged = judged.join(worst.toDF("a", "_ra"), "a", "left").join(worst.toDF("b", "_rb"), "b", "left")
        judged = judged.withColumn("rejected", (size > limit) & (F.col("rejected") | ((size >= F.col("_ra")) & (size >= F.col("_rb"))))).drop("_ra", "_rb")
        judged = written(judged, "judged")
        out = judged.where("rejected").agg(F.count("*"), F.sum(F.xxhash64("_t").cast("decimal(38,0)"))).first()
        if tuple(out) == before or (before is None and not out[0]):
            break
        before = tuple(out)
    edges = kept.select("a", "b").union(kept.select("b", "a")).union(nodes.select("node", "node")).distinct()
    groups = pass_groups(edges.toDF("a", "b")).withColumnRenamed("pass", "node")
    placed = h.join(groups, "node")
    mean = placed.groupBy("group").agg(F.avg("h").alias("_m"))
    return placed.join(mean, "group").select("node", "group", (F.col("h") - F.col("_m")).alias("offset")), judged.select("a", "b", "dz", "w", "residual", "rejected")
