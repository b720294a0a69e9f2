"""Camera paths along a corridor, and road ribbons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.operators.passes import track_distance


def longest_pass(points: DataFrame, by: list[str], wanted: str = "pass") -> DataFrame:
    """Points of the pass with most points in each group; the first of equals."""
    n = points.groupBy(*by, wanted).agg(F.count("*").alias("_n"))
    best = n.groupBy(*by).agg(F.min(F.struct((-F.col("_n")).alias("n"), wanted)).alias("_b")).select(*by, F.col(f"_b.{wanted}").alias(wanted)) if by else n.agg(F.min(F.struct((-F.col("_n")).alias("n"), wanted)).alias("_b")).select(F.col(f"_b.{wanted}").alias(wanted))
    return points.join(best, [*by, wanted], "left_semi")


def trim_reversals(points: DataFrame, by: list[str], head_m: float = 25.0, turn_deg: float = 120.0) -> DataFrame:
    """points from the last turn of more than turn_deg within the first head_m metres on."""
    w = Window.partitionBy(*by).orderBy("seq")
    d = track_distance(points, by)
    ax, ay = F.col("x") - F.lag("x").over(w), F.col("y") - F.lag("y").over(w)
    bx, by_ = F.lead("x").over(w) - F.col("x"), F.lead("y").over(w) - F.col("y")
    norm = F.sqrt(ax * ax + ay * ay) * F.sqrt(bx * bx + by_ * by_)
    angle = F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(ax * bx + ay * by_, norm)))))
    turn = F.coalesce((angle > turn_deg) & (F.col("dist") <= head_m), F.lit(False))
    flagged = d.withColumn("_turn", turn)
    last = F.coalesce(F.max(F.when(F.col("_turn"), F.col("seq"))).over(Window.partitionBy(*by)), F.min("seq").over(Window.partitionBy(*by)))
    return flagged.withColumn("_from", last).where(F.col("seq") >= F.col("_from")).drop("_turn", "_from", "dist")


def resample(points: DataFrame, by: list[str], spacing: float) -> DataFrame:
    """(by, i, s, x, y, z): positions every `spacing` metres of the track, below its length.

    Each segment makes the marks that fall on it, so there is no join: marks are a sequence a row.
    """
    w = Window.partitionBy(*by).orderBy("seq")
    d = track_distance(points, by)
    for c in ("x", "y", "z", "dist"):
        d = d.withColumn(f"_{c}", F.lead(c).over(w))
    d = d.where(F.col("_dist") > F.col("dist"))
    lo, hi = F.ceil(F.col("dist") / spacing), F.ceil(F.col("_dist") / spacing) - 1
    marks = d.where(hi >= lo).withColumn("i", F.explode(F.sequence(lo, hi))).withColumn("s", F.col("i") * F.lit(float(spacing)))
    share = (F.col("s") - F.col("dist")) / (F.col("_dist") - F.col("dist"))
    return marks.select(*by, "i", "s", *[(F.col(c) + (F.col(f"_{c}") - F.col(c)) * share).alias(c) for c in ("x", "y", "z")])


def smooth(path: DataFrame, by: list[str], width: int, order: str = "i") -> DataFrame:
    """Moving average of x, y, z over width rows; the ends are filled with copies of the first and last row."""
    half = width // 2
    w = Window.partitionBy(*by).orderBy(order)
    frame, whole = w.rowsBetween(-half, half), Window.partitionBy(*by)
    out = path.withColumn("_k", F.row_number().over(w) - 1).withColumn("_n", F.count("*").over(whole))
    before, after = F.greatest(F.lit(0), half - F.col("_k")), F.greatest(F.lit(0), half - (F.col("_n") - 1 - F.col("_k")))
    for c in ("x", "y", "z"):
        out = out.withColumn(f"_{c}", (F.sum(c).over(frame) + before * F.first(c).over(w) + after * F.last(c).over(whole.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))) / (2 * half + 1))
    return out.select(*by, order, "s", *[F.col(f"_{c}").alias(c) for c in ("x", "y", "z")])


def headings(path: DataFrame, by: list[str], ahead: int, order: str = "i") -> DataFrame:
    """path with a forward unit vector (fx, fy, fz) to the row `ahead` on (the last, near the end), else from the row before."""
    w = Window.partitionBy(*by).orderBy(order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    on = {c: F.coalesce(F.lead(c, ahead).over(w), F.last(c).over(whole)) - F.col(c) for c in ("x", "y", "z")}
    back = {c: F.col(c) - F.coalesce(F.lag(c, ahead).over(w), F.first(c).over(whole)) for c in ("x", "y", "z")}

    def size(v: dict[str, Column]) -> Column:
        return F.sqrt(sum((d * d for d in v.values()), F.lit(0.0)))

    out = path.withColumn("_n", size(on)).withColumn("_m", size(back))
    for c in ("x", "y", "z"):
        out = out.withColumn(f"f{c}", F.when(F.col("_n") > 1e-9, on[c] / F.col("_n")).when(F.col("_m") > 1e-9, back[c] / F.col("_m")).otherwise(0.0))
    return out.drop("_n", "_m")


def ribbon(points: DataFrame, by: list[str], width: float, drop: float = 0.0) -> DataFrame:
    """points with both edges of a road of a width: (lx, ly, rx, ry, z less drop).

    The normal is that of the mean of the directions before and after; the ends have one.
    """
    w = Window.partitionBy(*by).orderBy("seq")
    dx, dy = F.lead("x").over(w) - F.col("x"), F.lead("y").over(w) - F.col("y")
    n = F.sqrt(dx * dx + dy * dy)
    out = points.withColumn("_ux", F.when(n > 0, dx / n)).withColumn("_uy", F.when(n > 0, dy / n))
    for c in ("x", "y"):
        out = out.withColumn(f"_t{c}", F.coalesce(F.lag(f"_u{c}").over(w), F.col(f"_u{c}"), F.lit(0.0)) + F.coalesce(F.col(f"_u{c}"), F.lag(f"_u{c}").over(w), F.lit(0.0)))
    t = F.sqrt(F.col("_tx") * F.col("_tx") + F.col("_ty") * F.col("_ty"))
    nx, ny = F.when(t > 0, -F.col("_ty") / t).otherwise(0.0), F.when(t > 0, F.col("_tx") / t).otherwise(0.0)
    half = width / 2
    return out.select(*by, "seq", (F.col("x") + nx * half).alias("lx"), (F.col("y") + ny * half).alias("ly"), (F.col("x") - nx * half).alias("rx"), (F.col("y") - ny * half).alias("ry"), (F.col("z") - drop).alias("z"))
