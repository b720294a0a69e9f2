"""Scalar rules of a capture as column expressions."""

from __future__ import annotations

import math

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PAIR = 2147483647


def cell(v: Column, size: float) -> Column:
    """Index of the grid cell, towards minus infinity."""
    return F.floor(v / F.lit(float(size))).cast("int")


def cell_name(cx: Column, cy: Column) -> Column:
    return F.concat(F.lit("chunk_x"), cx.cast("string"), F.lit("_y"), cy.cast("string"))


def frame_number(name: Column) -> Column:
    """The last run of digits of the file's stem, null if there is none."""
    stem = F.regexp_replace(F.regexp_extract(name, r"([^/]*)$", 1), r"\.[^.]*$", "")
    return F.nullif(F.regexp_extract(stem, r"(\d+)\D*$", 1), F.lit("")).cast("bigint")


def held_out(name: Column, index: Column, every: int) -> Column:
    """Whether an image is kept for evaluation: its number, else its index, is a multiple of `every`."""
    return F.lit(False) if every <= 0 else F.coalesce(frame_number(name), index) % every == 0


def verdict(median: Column) -> Column:
    return F.when(median < 1, "agree").when(median < 3, "marginal").otherwise("DISAGREE")


def pair_images(pair: Column) -> tuple[Column, Column]:
    """The two image ids packed in a pair id."""
    second = pair % _PAIR
    return F.floor((pair - second) / _PAIR).cast("bigint"), second.cast("bigint")


@F.arrow_udf(T.DoubleType())
def exp(v: pa.Array) -> pa.Array:
    """The C library's exp. The JVM's differs in the last bit of some values, which reorders products that are equal but for rounding."""
    return pc.exp(v)


def contribution(opacity: Column, scales: list[Column]) -> Column:
    """sigmoid(opacity) times the product of the two largest clipped axes."""
    axes = F.array_sort(F.array(*[exp(F.greatest(F.lit(-30.0), F.least(F.lit(20.0), s.cast("double")))) for s in scales]))
    return (1 / (1 + exp(-opacity.cast("double")))) * F.element_at(axes, -1) * F.element_at(axes, -2)


def psnr(mse: Column) -> Column:
    return 10 * F.log10(1 / F.greatest(mse, F.lit(1e-12)))


def neighbours(cameras: Column, passes: Column, radius: int) -> Column:
    return F.greatest(F.lit(32), cameras * F.greatest(F.lit(1), passes) * radius * 2)


def focal(width: Column, fov: Column) -> Column:
    """Pinhole focal length in pixels from a field of view in degrees."""
    return F.lit(0.5) * width / F.tan(F.radians(fov) / 2)


def degrees_per_metre(lat0: float) -> tuple[float, float]:
    """(lat, lon) degrees of one metre, the footprint's approximation."""
    return 1 / 111320.0, 1 / (111320.0 * max(1e-6, math.cos(math.radians(lat0))))


def frame_rate(fraction: Column) -> Column:
    """Frames a second of `num/den` or a plain number; null where the denominator is 0."""
    parts = F.split(fraction, "/")
    return F.try_divide(F.get(parts, F.lit(0)).try_cast("double"), F.coalesce(F.get(parts, F.lit(1)).try_cast("double"), F.lit(1.0)))
