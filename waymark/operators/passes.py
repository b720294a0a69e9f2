"""Time series of a drive: passes, selection, thinning, interpolation."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.geo import enu


def number_rows(df: DataFrame, key: str, *order: str, name: str = "seq") -> DataFrame:
    """Gapless numbers from 0 over (key, order), without sorting all rows in one place.

    A key's rows are numbered among themselves; the keys' counts, a row a key, give where each starts.
    """
    own = Window.partitionBy(key).orderBy(*order)
    starts = df.groupBy(key).agg(F.count("*").alias("_n")).withColumn("_start", F.coalesce(F.sum("_n").over(Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return df.withColumn("_own", F.row_number().over(own) - 1).join(starts.drop("_n"), key).withColumn(name, F.col("_start") + F.col("_own")).drop("_own", "_start")


def split_passes(frames: DataFrame, by: list[str], gap_m: float = 30.0, gap_s: float = 30.0) -> DataFrame:
    """frames with `pass`, from 0 within `by`, in order of seq.

    A pass ends where the next frame is more than gap_m away in the plane, of another video, or more than
    gap_s apart in time, if both times are known.
    """
    w = Window.partitionBy(*by).orderBy("seq")
    before = {c: F.lag(c).over(w) for c in ("x", "y", "t", "video", "seq")}
    far = F.sqrt(F.pow(F.col("x") - before["x"], 2) + F.pow(F.col("y") - before["y"], 2)) > gap_m
    late = F.abs(F.col("t") - before["t"]) > gap_s
    cut = before["seq"].isNotNull() & (F.coalesce(far, F.lit(False)) | ~F.col("video").eqNullSafe(before["video"]) | F.coalesce(late, F.lit(False)))
    return frames.withColumn("_cut", cut.cast("int")).withColumn("pass", F.sum("_cut").over(w).cast("int")).drop("_cut")


def _fold(df: DataFrame, by: list[str], order: list[str], columns: list[str], out: str, start: Callable[[], list], step: Callable[[list, tuple], Iterator[tuple]], end: Callable[[list], Iterator[tuple]]) -> DataFrame:
    """(by, out): rows of each group, in order, through a state of fixed size.

    A group's rows meet by one shuffle and stream sorted through one task, batch by batch, so a group of any length needs
    the memory of its state alone. start() makes the state, step() takes a row's columns and gives rows, end() gives the last.
    """
    rows = df.select(*by, *columns)
    keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*by).schema)
    schema = f"{keys}, {out}"
    types = None

    def run(batches):
        nonlocal types
        own, state, held = None, None, []
        n = len(by)

        def batch():
            names = [*by, *[c.split()[0] for c in out.split(", ")]]
            arrays = [pa.array(c, t) for c, t in zip(zip(*held), types)]
            held.clear()
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for rows in batches:
            if types is None:
                kinds = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}
                types = [*[rows.schema.field(k).type for k in range(n)], *[kinds[c.split()[1]] for c in out.split(", ")]]
            for row in zip(*[c.to_pylist() for c in rows.columns]):
                key = row[:n]
                if state is None or key != own:
                    if state is not None:
                        held += [(*own, *r) for r in end(state)]
                    own, state = key, start()
                held += [(*own, *r) for r in step(state, row[n:])]
            if held:
                yield batch()
        if state is not None:
            held += [(*own, *r) for r in end(state)]
            if held:
                yield batch()

    return rows.repartition(*by).sortWithinPartitions(*by, *order).mapInArrow(run, schema)


def thin(points: DataFrame, by: list[str], spacing: float) -> DataFrame:
    """Greedy thinning of (seq, x, y, z): a point stays if it is at least `spacing` from the last that stayed.

    The first and last points stay; fewer than three points, or no spacing, change nothing. A point without a
    position stays only as first or last.
    """
    if spacing <= 0:
        return points

    def step(state, r):
        far = not state
        if state and None not in (r[1], r[2], state[0][1], state[0][2]):
            dx, dy = r[1] - state[0][1], r[2] - state[0][2]
            far = math.sqrt(dx * dx + dy * dy) >= spacing
        if far:
            state[:] = [r, None]
            yield r
        else:
            state[1] = r

    def end(state):
        if state[1]:
            yield state[1]

    plain = points.select(*by, F.col("seq").cast("bigint").alias("seq"), *[F.col(c).cast("double").alias(c) for c in "xyz"])
    return _fold(plain, by, ["seq", "x", "y", "z"], ["seq", "x", "y", "z"], "seq bigint, x double, y double, z double", list, step, end)


def select_frames(candidates: DataFrame, by: list[str], spacing: float) -> DataFrame:
    """The sharpest candidate of each stretch of the track: columns by, seg, i, dist, sharp.

    Candidates join a window in order of (seg, i); where the distance reaches the next mark, the sharpest
    (the first of equals) is taken and the mark moves to that distance plus spacing. The mark
    carries over to the next segment, the window doesn't. No spacing: all stay.
    """
    if spacing <= 0:
        return candidates.select(*by, "seg", "i", "dist", "sharp")

    def step(state, r):
        mark, best = state
        if best is None or best[0] != r[0] or (r[3] is not None and best[3] is not None and r[3] > best[3]):
            best = r
        if r[2] is not None and r[2] >= mark:
            yield best
            mark, best = r[2] + spacing, None
        state[:] = mark, best

    columns = {"seg": "int", "i": "bigint", "dist": "double", "sharp": "double"}
    plain = candidates.select(*by, *[F.col(c).cast(t).alias(c) for c, t in columns.items()])
    return _fold(plain, by, list(columns), list(columns), ", ".join(f"{c} {t}" for c, t in columns.items()), lambda: [0.0, None], step, lambda state: iter(()))


def nudge_times(samples: DataFrame, by: list[str]) -> DataFrame:
    """Times made strictly ascending: one that isn't above the last becomes the last plus a millisecond.

    A row without a time takes the last; if none of a group has one, the time is the row's number i.
    """

    def step(state, r):
        i, t, some = r
        if not some:
            yield i, None if i is None else float(i)
            return
        t = state[0] if t is None else t
        state[0] = state[0] + 1e-3 if t <= state[0] else t
        yield i, state[0]

    plain = samples.select(*by, F.col("i").cast("bigint").alias("i"), F.col("t").cast("double").alias("t"))
    plain = plain.withColumn("_some", F.count("t").over(Window.partitionBy(*by)) > 0)
    return _fold(plain, by, ["i", "t"], ["i", "t", "_some"], "i bigint, t double", lambda: [-1.0], step, lambda state: iter(()))


def interpolate(samples: DataFrame, wanted: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """wanted (by, t) with columns interpolated linearly from samples (by, t, columns), held at the ends.

    Both sides meet in one sort of their union by (by, t): the neighbours come from the last and first
    non-null values of running frames, not from a join on inequality.
    """
    point = F.struct("t", *columns)
    one = samples.select(by, "t", point.alias("_p"), F.lit(0).alias("_ask"))
    two = wanted.select(by, "t", F.lit(None).cast(one.schema["_p"].dataType).alias("_p"), F.lit(1).alias("_ask"))
    w = Window.partitionBy(by).orderBy("t", "_ask")
    both = one.unionByName(two).withColumn("_a", F.last("_p", True).over(w)).withColumn("_b", F.first("_p", True).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))).where("_ask = 1")
    share = F.when(F.col("_b.t") > F.col("_a.t"), (F.col("t") - F.col("_a.t")) / (F.col("_b.t") - F.col("_a.t"))).otherwise(0.0)
    out = [F.when(F.col("_a").isNull(), F.col(f"_b.{c}")).when(F.col("_b").isNull(), F.col(f"_a.{c}")).otherwise(F.col(f"_a.{c}") + (F.col(f"_b.{c}") - F.col(f"_a.{c}")) * share).alias(c) for c in columns]
    return both.select(by, "t", *out)


def track_distance(points: DataFrame, by: list[str], order: str = "seq") -> DataFrame:
    """points with `dist`, the length of the track up to each in the plane."""
    w = Window.partitionBy(*by).orderBy(order)
    step = F.sqrt(F.pow(F.col("x") - F.lag("x").over(w), 2) + F.pow(F.col("y") - F.lag("y").over(w), 2))
    return points.withColumn("_step", F.coalesce(step, F.lit(0.0))).withColumn("dist", F.sum("_step").over(w)).drop("_step")


def near_fence(frames: DataFrame, near: tuple[float, float], radius_m: float) -> DataFrame:
    """Frames (lat, lon) within radius_m of a place in its plane; those without a position aren't. Applied after selection."""
    e, n, _ = enu(F.col("lat"), F.col("lon"), F.lit(0.0), (*near, 0.0))
    return frames.where(e * e + n * n <= radius_m * radius_m)


def reachable_segments(segments: DataFrame, samples: DataFrame, near: tuple[float, float], radius_m: float, slack_s: float = 1.0, slack_m: float = 25.0) -> DataFrame:
    """Segments (video, seg, start_s, end_s) that some sample (video, t, lat, lon) of theirs brings within radius_m + slack_m.

    A sample counts for a segment within slack_s of it. Segments and samples meet by the second: a segment is expanded to
    the seconds it spans, so the time condition is an equi-join; videos without samples keep all their segments.
    """
    e, n, _ = enu(F.col("lat"), F.col("lon"), F.lit(0.0), (*near, 0.0))
    reach = (radius_m + slack_m) ** 2
    close = samples.where(e * e + n * n <= reach).select("video", "t", F.floor("t").alias("_s"))
    spans = segments.select("video", "seg", "start_s", "end_s", F.explode(F.sequence(F.floor(F.col("start_s") - slack_s), F.floor(F.col("end_s") + slack_s))).alias("_s"))
    hit = spans.join(close, ["video", "_s"]).where(F.col("t").between(F.col("start_s") - slack_s, F.col("end_s") + slack_s)).select("video", "seg").distinct()
    known = samples.select("video").distinct()
    return segments.join(hit, ["video", "seg"], "left_semi").unionByName(segments.join(known, "video", "left_anti"))


def zip_streams(streams: DataFrame, by: list[str]) -> DataFrame:
    """(by, i, t, paths): candidates (by, stream, i, t, path) of all streams, cut to the shortest stream; paths by stream, t of the first."""
    n = streams.select(*by, "stream").distinct().groupBy(*by).agg(F.count("*").alias("_n"))
    rows = streams.groupBy(*by, "i").agg(F.min(F.struct("stream", "t")).alias("_t"), F.array_sort(F.collect_list(F.struct("stream", "path"))).alias("_p"))
    return rows.join(n, by).where(F.size("_p") == F.col("_n")).select(*by, "i", F.col("_t.t").alias("t"), F.col("_p.path").alias("paths"))


def clip_segments(clips: DataFrame, seconds: float) -> DataFrame:
    """Pieces (seg, start_s, end_s) of each clip's duration; the last is shorter."""
    pieces = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("duration") / seconds).cast("int") - 1))
    return clips.where("duration > 0").withColumn("seg", F.explode(pieces)).withColumn("start_s", F.col("seg") * F.lit(float(seconds))).withColumn("end_s", F.least(F.col("duration"), (F.col("seg") + 1) * F.lit(float(seconds))))
