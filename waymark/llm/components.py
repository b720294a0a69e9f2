"""Connected components of a table of links, without gathering it anywhere."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import removed, stored


def _forest(batches):
    """Union-find over one partition's links: every node once, with the smallest node it reaches there."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p]
        return x

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = np.fromiter(parent, dtype=np.int64, count=len(parent))
    roots = np.fromiter((root(x) for x in parent), dtype=np.int64, count=len(parent))
    far = nodes != roots
    for i in range(0, int(far.sum()), 50_000):
        yield pa.RecordBatch.from_arrays([pa.array(nodes[far][i : i + 50_000]), pa.array(roots[far][i : i + 50_000])], names=["u", "v"])


def components(links: DataFrame, u: str = "u", v: str = "v", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the links; component is the smallest node reachable.

    Each partition first thins its links to a forest by union-find; rounds of large-star and
    small-star then join the forests until nothing changes. A hub's neighbours are never
    gathered: every step is a grouped minimum and an equi-join that adaptive execution can split.
    Links that are null at an end or lead to themselves say nothing. No links: no rows.
    """
    edges = links.where(F.col(u).isNotNull() & F.col(v).isNotNull() & (F.col(u) != F.col(v))).select(F.col(u).cast("long").alias("u"), F.col(v).cast("long").alias("v"))
    edges = stored(edges.mapInArrow(_forest, "u long, v long"), "forest")
    seen = None
    for _ in range(max_rounds):
        both = edges.union(edges.select("v", "u")).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.where("u != v")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        old, edges = edges, stored(small, "stars")
        removed(edges.sparkSession, old)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.count_distinct("u")).first()
        if state == seen or (state[0] == state[2] and not _has_path(edges)):
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _has_path(edges: DataFrame) -> bool:
    """Whether some node is both a child and a parent."""
    return bool(edges.select("u").join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi").take(1))
