"""Connectivity of passes from verified image pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions.scalars import frame_number, pair_images
from waymark.operators.shared import written, with_place


def image_passes(images: DataFrame, ranges: DataFrame) -> DataFrame:
    """(image_id, pass): the first pass whose sequence range holds the image's number, -1 if none does.

    A range is expanded to the runs of 1024 numbers it touches, so that the two meet by an equi-join.
    """
    n = images.select("image_id", frame_number(F.col("name")).alias("seq"))
    runs = ranges.where("seq_lo <= seq_hi").select("pass", "seq_lo", "seq_hi", F.explode(F.sequence(F.shiftright("seq_lo", 10), F.shiftright("seq_hi", 10))).alias("_run"))
    hit = n.withColumn("_run", F.shiftright("seq", 10)).join(runs, "_run").where(F.col("seq").between(F.col("seq_lo"), F.col("seq_hi"))).groupBy("image_id").agg(F.min("pass").alias("pass"))
    return n.join(hit, "image_id", "left").select("image_id", F.coalesce("pass", F.lit(-1)).alias("pass"))


def pass_matrix(pairs: DataFrame, passes: DataFrame, least_rows: int = 15) -> DataFrame:
    """(a, b, pairs) in both directions, the diagonal once, of pairs (pair_id, rows) with more than least_rows matches."""
    one, two = pair_images(F.col("pair_id"))
    ids = pairs.where(F.col("rows") > least_rows).select(one.alias("i1"), two.alias("i2"))
    both = ids.join(passes.select(F.col("image_id").alias("i1"), F.col("pass").alias("p1")), "i1").join(passes.select(F.col("image_id").alias("i2"), F.col("pass").alias("p2")), "i2").where("p1 >= 0 and p2 >= 0")
    half = both.groupBy(F.least("p1", "p2").alias("a"), F.greatest("p1", "p2").alias("b")).agg(F.count("*").alias("pairs"))
    return half.unionByName(half.where("a != b").select(F.col("b").alias("a"), F.col("a").alias("b"), "pairs"))


def weak_passes(matrix: DataFrame, share: float = 0.05) -> DataFrame:
    """(pass, intra, cross): passes with matches of their own, but few with others."""
    own = matrix.groupBy(F.col("a").alias("pass")).agg(F.coalesce(F.sum(F.when(F.col("a") == F.col("b"), F.col("pairs"))), F.lit(0)).alias("intra"), F.coalesce(F.sum(F.when(F.col("a") != F.col("b"), F.col("pairs"))), F.lit(0)).alias("cross"))
    return own.where((F.col("intra") > 0) & (F.col("cross") < share * F.col("intra")))


def pass_groups(matrix: DataFrame, rounds: int = 50) -> DataFrame:
    """(pass, group): the smallest pass reachable over off-diagonal matches, by rounds of minimum labels.

    The matrix has a row a pair of passes of a capture, which Spark counts in thousands; each round is a join and a
    grouped minimum on it, materialised by checkpoint so that no plan grows, until no label changes.
    """
    matrix = written(matrix.select("a", "b"))
    edges = matrix.where("a != b")
    label = matrix.select(F.col("a").alias("pass")).distinct().withColumn("group", F.col("pass"))
    before = None
    for _ in range(rounds):
        near = edges.join(label.withColumnRenamed("pass", "b"), "b").groupBy(F.col("a").alias("pass")).agg(F.min("group").alias("_g"))
        label = label.join(near, "pass", "left").select("pass", F.least("group", "_g").alias("group"))
        # A label is a pass; follow it once more.
        label = label.join(label.select(F.col("pass").alias("group"), F.col("group").alias("_up")), "group", "left").select("pass", F.least("group", "_up").alias("group"))
        label = written(label)
        state = label.agg(F.sum(F.xxhash64("group").cast("decimal(38,0)"))).first()[0]
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"pass groups did not settle in {rounds} rounds")
    return label


def group_warning(groups: DataFrame) -> DataFrame:
    """One row: groups, their passes (lists of passes, the smallest first) and disconnected: whether there is more than one."""
    each = groups.groupBy("group").agg(F.array_sort(F.collect_set("pass")).alias("passes"))
    return each.agg(F.count("*").alias("groups"), F.array_sort(F.collect_list("passes")).alias("passes")).withColumn("disconnected", F.col("groups") > 1)


def pair_plan(images: DataFrame, kind: str = "sequential", overlap: int = 15) -> DataFrame:
    """(a, b): pairs of images (image_id, name) to match, the earlier name first.

    sequential: within `overlap` places of each other in order of names. exhaustive: all pairs, which is what was asked for
    and quadratic, for small chunks: blocks of places meet blocks by an equi-join, so that no task holds more than two.
    """
    placed = with_place(images.select("image_id", "name"), "name", "image_id")
    if kind == "sequential":
        ahead = placed.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(overlap)))).select(F.col("image_id").alias("a"), (F.col("place") + F.col("k")).alias("place"))
        return ahead.join(placed.select("place", F.col("image_id").alias("b")), "place").select("a", "b")
    if kind != "exhaustive":
        raise ValueError(f"no plan of kind {kind}")
    blocks = placed.withColumn("block", F.shiftright("place", 10))
    last = blocks.agg(F.max("block").alias("last"))
    one = blocks.join(F.broadcast(last)).withColumn("other", F.explode(F.sequence("block", "last"))).select(F.col("image_id").alias("a"), F.col("place").alias("pa"), F.col("block").alias("ba"), F.col("other").alias("bb"))
    two = blocks.select(F.col("image_id").alias("b"), F.col("place").alias("pb"), F.col("block").alias("bb"))
    return one.join(two, "bb").where("pa < pb").select("a", "b")
