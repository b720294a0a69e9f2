"""Pictures as rows of pixels: stencils over tiles with a halo, connected regions, the rig's silhouette, sharpness."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.operators.connectivity import pass_groups
from waymark.operators.selection import quantiles
from waymark.operators.shared import written


def framed(pixels: DataFrame) -> DataFrame:
    """(picture, x, y, value, w, h): pixels with a place, one value each (the largest, if rows repeat one), and the size of their picture, whose last pixel is that of largest x and y."""
    own = pixels.where("picture is not null and x >= 0 and y >= 0").groupBy(F.col("picture").cast("long").alias("picture"), F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y")).agg(F.coalesce(F.max(F.col("value").cast("double")), F.lit(0.0)).alias("value"))
    size = own.groupBy("picture").agg((F.max("x") + 1).alias("w"), (F.max("y") + 1).alias("h"))
    return own.join(size, "picture")


def _each_tile(pixels: DataFrame, tile: int, halo: int, f: Callable[..., Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """f(picture, w, h, x0, y0, inner, values) for every square tile of framed() pixels.

    A pixel goes to its own tile and to those whose edge is at most `halo` away, so that a stencil needs no other tile. values has
    the tile with its halo, clipped to the picture, from x0, y0 on; inner: where the tile itself lies in it. Missing pixels are 0.
    """
    def cells(v: str, size: str):
        return F.explode(F.sequence(F.greatest(F.lit(0), F.floor((F.col(v) - halo) / tile)), F.least(F.floor((F.col(size) - 1) / tile), F.floor((F.col(v) + halo) / tile))))

    dealt = pixels.withColumn("bx", cells("x", "w")).withColumn("by", cells("y", "h"))
    dealt = dealt.select("picture", "bx", "by", "w", "h", "x", "y", "value").repartition("picture", "bx", "by").sortWithinPartitions("picture", "bx", "by")

    def run(batches):
        held: list[pa.RecordBatch] = []

        def closed():
            picture, bx, by, w, h = (held[0].column(c)[0].as_py() for c in range(5))
            x, y, v = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in (5, 6, 7))
            x0, y0 = max(0, bx * tile - halo), max(0, by * tile - halo)
            x1, y1 = min(w, (bx + 1) * tile + halo), min(h, (by + 1) * tile + halo)
            values = np.zeros((y1 - y0, x1 - x0))
            values[y - y0, x - x0] = v
            inner = (slice(by * tile - y0, min(h, (by + 1) * tile) - y0), slice(bx * tile - x0, min(w, (bx + 1) * tile) - x0))
            yield from f(picture, w, h, x0, y0, inner, values)

        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in range(3)], axis=1)
            cuts = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, [len(key)]])
            for a, b in zip(cuts[:-1], cuts[1:]):
                if held and [held[0].column(c)[0].as_py() for c in range(3)] != key[a].tolist():
                    yield from closed()
                    held.clear()
                if b > a:
                    held.append(batch.slice(a, b - a))
        if held:
            yield from closed()

    return dealt.mapInArrow(run, schema)


def stencil(pixels: DataFrame, reach: int, f: Callable[[np.ndarray, int, int, int, int], np.ndarray], tile: int = 256) -> DataFrame:
    """framed() pixels with value replaced by f, which maps a tile's values with what is around them (reach pixels, fewer at the picture's edges),
    its place x0, y0 and the picture's w, h to values of the same shape. Missing pixels are 0 and come back with a value."""

    def one(picture, w, h, x0, y0, inner, values):
        got = f(values, x0, y0, w, h)[inner]
        n = got.size
        y, x = np.divmod(np.arange(n), got.shape[1])
        columns = (np.full(n, picture), x + x0 + inner[1].start, y + y0 + inner[0].start, got.reshape(-1).astype(np.float64), np.full(n, w), np.full(n, h))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["picture", "x", "y", "value", "w", "h"])

    return _each_tile(pixels, tile, reach, one, "picture long, x long, y long, value double, w long, h long")


def _laplacian(values: np.ndarray, x0: int, y0: int, w: int, h: int) -> np.ndarray:
    """Differences to the four neighbours, summed up. Beyond a picture's edge lies the mirror image without the edge itself."""
    out = -4.0 * values
    for axis, (start, size) in enumerate(((y0, h), (x0, w))):
        n = values.shape[axis]
        back, ahead = np.arange(n) - 1, np.arange(n) + 1
        # At the picture's edges the mirrored place; at a tile's cut any place, as what comes of it is not kept.
        back[0] = min(1, n - 1) if start == 0 else 0
        ahead[-1] = max(0, n - 2) if start + n == size else n - 1
        out += np.take(values, back, axis=axis) + np.take(values, ahead, axis=axis)
    return out


def sharpness(pixels: DataFrame, tile: int = 256) -> DataFrame:
    """(picture, pixels, sharpness): the variance of a picture's Laplacian, from (picture, x, y, value).

    Tiles of tile * tile pixels and a halo of one work by themselves; each gives its count, mean and sum of squares about it, which are put together.
    Cases: null values and missing pixels are 0; a picture of one row or column is mirrored in itself; rows without picture or place take no part.
    """

    def one(picture, w, h, x0, y0, inner, values):
        got = _laplacian(values, x0, y0, w, h)[inner]
        mean = float(got.mean())
        yield pa.RecordBatch.from_arrays([pa.array([picture]), pa.array([got.size]), pa.array([mean]), pa.array([float(((got - mean) ** 2).sum())])], names=["picture", "n", "mean", "spread"])

    parts = _each_tile(framed(pixels), tile, 1, one, "picture long, n long, mean double, spread double")
    whole = Window.partitionBy("picture")
    centred = parts.withColumn("all", F.sum(F.col("n") * F.col("mean")).over(whole) / F.sum("n").over(whole))
    return centred.groupBy("picture").agg(F.sum("n").alias("pixels"), (F.sum(F.col("spread") + F.col("n") * F.pow(F.col("mean") - F.col("all"), 2)) / F.sum("n")).alias("sharpness"))


def _slide(values: np.ndarray, reach: int, f) -> np.ndarray:
    """f (minimum or maximum) over squares of 2 * reach + 1 pixels, as far as there are pixels."""
    for axis in (0, 1):
        out = values.copy()
        for d in range(1, min(reach, values.shape[axis] - 1) + 1):
            near, far = [slice(None)] * 2, [slice(None)] * 2
            near[axis], far[axis] = slice(0, -d), slice(d, None)
            near, far = tuple(near), tuple(far)
            out[near] = f(out[near], values[far])
            out[far] = f(out[far], values[near])
        values = out
    return values


def closed(pixels: DataFrame, size: int, tile: int = 256) -> DataFrame:
    """framed() pixels after a closing by squares of an odd size: the largest value about each pixel, then the smallest of these. Pixels beyond the edge don't count."""
    reach = size // 2
    return stencil(pixels, 2 * reach, lambda v, *_: _slide(_slide(v, reach, np.maximum), reach, np.minimum), tile)


def _labels(on: np.ndarray) -> np.ndarray:
    """For each pixel that is on the number of the first pixel of its region (neighbours sideways, up, down and across), else -1."""
    h, w = on.shape
    edge = np.diff(np.pad(on.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, start = np.nonzero(edge == 1)
    _, stop = np.nonzero(edge == -1)
    # Runs of the row above that touch a run: the first one that doesn't end before it, to the last one that begins before its end.
    key = row * (w + 2)
    first = np.searchsorted(key + stop, key - (w + 2) + start, side="left")
    last = np.searchsorted(key + start, key - (w + 2) + stop, side="right")
    many = np.maximum(0, last - first)
    a = np.repeat(np.arange(len(row)), many)
    b = np.arange(len(a)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
    label = np.arange(len(row))
    while len(a):
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        if np.array_equal(label, before):
            break
    out = np.full(on.shape, -1, dtype=np.int64)
    name = (row * w + start)[label]
    out[on] = np.repeat(name, stop - start)
    return out


def regions(pixels: DataFrame, tile: int = 256) -> DataFrame:
    """(picture, x, y, region): the connected region of every framed() pixel with a value above 0; neighbours touch sideways, up, down or across.

    A region is named by a number that all its pixels and no others of its picture have. Each tile finds its own regions from runs of
    pixels and by union-find; regions of different tiles that touch across a border meet by an equi-join of border pixels, and
    rounds on these links, a row each, put them together. No picture is ever held as a whole.
    """
    stride = tile * tile

    def one(picture, w, h, x0, y0, inner, values):
        label = _labels(values[inner] > 0)
        n = label.shape[1]
        y, x = np.nonzero(label >= 0)
        if not len(x):
            return
        across = -(-w // tile)
        number = ((y0 // tile) * across + x0 // tile) * stride
        columns = (np.full(len(x), picture), x + x0, y + y0, number + (label[y, x] // n) * tile + label[y, x] % n)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["picture", "x", "y", "part"])

    parts = _each_tile(pixels, tile, 0, one, "picture long, x long, y long, part long")
    parts = written(parts, "parts")
    node = F.struct("picture", "part")
    border = parts.where(f"x % {tile} in (0, {tile - 1}) or y % {tile} in (0, {tile - 1})").withColumn("node", node)
    steps = F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy")) for i, j in ((1, 0), (1, 1), (0, 1), (-1, 1))])
    over = border.withColumn("d", F.explode(steps)).select("picture", (F.col("x") + F.col("d.dx")).alias("x"), (F.col("y") + F.col("d.dy")).alias("y"), F.col("node").alias("a"))
    links = over.join(border.select("picture", "x", "y", F.col("node").alias("b")), ["picture", "x", "y"]).where("a != b").select("a", "b").distinct()
    links = written(links, "touching")
    named = parts.withColumn("node", node)
    if not links.take(1):
        return parts.withColumnRenamed("part", "region")
    both = links.union(links.select("b", "a"))
    groups = pass_groups(both.union(both.select("a", F.col("a"))).distinct())
    return named.join(groups.withColumnRenamed("pass", "node"), "node", "left").select("picture", "x", "y", F.coalesce("group", "node")["part"].alias("region"))


def silhouette(pixels: DataFrame, search_from: float = 0.35, dark_percent: float = 45.0, close: int = 11, smooth: int = 41, pad: int = 8, tile: int = 256) -> DataFrame:
    """(picture, x, w, h, top): where the capture vehicle begins in each column of a (median) picture: pixels from row `top` down are masked.

    Only rows from search_from of the height down are looked at. Dark are values below the dark_percent-th percentile of theirs; the dark picture is closed by squares, and of
    its regions those that touch the last row are the vehicle. A column's boundary is its topmost vehicle pixel (the height, if none); boundaries are averaged over
    `smooth` columns, mirrored at the edges, and raised by `pad`, but to no less than half the search's first row.

    Percentiles come from counts (selection), closing and regions from tiles: what one task orders is a picture's columns, never its pixels.
    """
    own = written(framed(pixels), "framed")
    lo = F.floor(F.col("h") * F.lit(float(search_from)))
    limit = quantiles(own.where(F.col("y") >= lo), ["picture"], "value", {"limit": dark_percent / 100}).select("picture", "limit")
    dark = own.join(limit, "picture", "left").withColumn("value", F.when((F.col("y") >= lo) & (F.col("value") < F.col("limit")), 1.0).otherwise(0.0)).select("picture", "x", "y", "value", "w", "h")
    found = written(regions(written(closed(dark, close, tile), "closed"), tile), "regions")
    size = own.select("picture", "w", "h").distinct()
    rig = found.join(size, "picture").where("y = h - 1").select("picture", "region").distinct()
    top = found.join(rig, ["picture", "region"], "left_semi").groupBy("picture", "x").agg(F.min("y").alias("first"))
    columns = size.withColumn("x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("w") - 1))).join(top, ["picture", "x"], "left").withColumn("first", F.coalesce("first", "h"))
    reach = max(smooth | 1, 3) // 2
    # Mirrored beyond both edges, without the edge itself, and again where the picture is narrower than that.
    around = columns.withColumn("p", F.explode(F.sequence(F.lit(-reach), F.lit(reach)))).withColumn("m", 2 * F.greatest(F.col("w") - 1, F.lit(1)))
    around = around.withColumn("at", F.pmod(F.col("x") + F.col("p"), F.col("m"))).withColumn("at", F.when(F.col("w") == 1, 0).otherwise(F.least(F.col("at"), F.col("m") - F.col("at"))))
    mean = around.select("picture", "x", "w", "h", "at").join(columns.select("picture", F.col("x").alias("at"), F.col("first").alias("other")), ["picture", "at"]).groupBy("picture", "x", "w", "h").agg(F.avg("other").alias("mean"))
    return mean.select("picture", "x", "w", "h", F.floor(F.greatest(F.col("mean") - pad, lo * F.lit(0.5))).cast("long").alias("top"))


def masked_share(outline: DataFrame) -> DataFrame:
    """(picture, share): how much of each picture silhouette() masks."""
    return outline.groupBy("picture", "w", "h").agg(F.sum(F.greatest(F.lit(0), F.col("h") - F.col("top"))).alias("_n")).select("picture", (F.col("_n") / (F.col("w") * F.col("h"))).alias("share"))


def median_picture(pixels: DataFrame, group: str) -> DataFrame:
    """(picture, x, y, value): for each pixel of all pictures of a group (its number is the new picture) the exact median over time, from (group, picture, x, y, value)."""
    return quantiles(pixels, [group, "x", "y"], "value", {"value": 0.5}).select(F.col(group).alias("picture"), "x", "y", "value")


def mask_rows(outline: DataFrame) -> DataFrame:
    """(picture, x, y, value): silhouette() as a picture of its own, 0 where the vehicle is and 255 elsewhere."""
    return outline.withColumn("y", F.explode(F.sequence(F.lit(0).cast("long"), F.col("h") - 1))).select("picture", "x", "y", F.when(F.col("y") >= F.col("top"), 0).otherwise(255).alias("value"))
