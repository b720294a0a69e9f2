"""Pictures in tiles against whole pictures in numpy."""

import numpy as np
import pytest

from waymark.operators import raster


def rows_of(pictures):
    return [(p, x, y, float(v)) for p, m in pictures.items() for (y, x), v in np.ndenumerate(m)]


def frame(spark, pictures):
    return spark.createDataFrame(rows_of(pictures), "picture long, x int, y int, value double").repartition(4)


def laplacian(m):
    a = np.pad(m, 1, mode="reflect") if min(m.shape) > 1 else np.pad(m, [(1, 1) if n > 1 else (0, 0) for n in m.shape], mode="reflect")
    if m.shape[0] == 1:
        a = np.concatenate([a] * 3)
    if m.shape[1] == 1:
        a = np.concatenate([a] * 3, axis=1)
    return a[:-2, 1:-1] + a[2:, 1:-1] + a[1:-1, :-2] + a[1:-1, 2:] - 4 * m


def flood(on):
    """Labels of regions, by flood fill."""
    label = np.full(on.shape, -1)
    for seed in zip(*np.nonzero(on)):
        wait = [seed] if label[seed] < 0 else []
        while wait:
            y, x = wait.pop()
            if 0 <= y < on.shape[0] and 0 <= x < on.shape[1] and on[y, x] and label[y, x] < 0:
                label[y, x] = seed[0] * on.shape[1] + seed[1]
                wait += [(y + i, x + j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    return label


def slid(m, r, f):
    return np.array([[f(m[max(0, y - r) : y + r + 1, max(0, x - r) : x + r + 1]) for x in range(m.shape[1])] for y in range(m.shape[0])])


def made(seed=1):
    rng = np.random.default_rng(seed)
    spiral = np.zeros((21, 21))
    x, y, dx, dy = 0, 0, 1, 0
    for _ in range(220):
        spiral[y, x] = 1
        ahead = (y + 2 * dy, x + 2 * dx)
        if not (0 <= y + dy < 21 and 0 <= x + dx < 21) or (0 <= ahead[0] < 21 and 0 <= ahead[1] < 21 and spiral[ahead]):
            dx, dy = -dy, dx
        x, y = x + dx, y + dy
    return {0: rng.integers(0, 255, (23, 31)), 1: (rng.random((30, 19)) < 0.45) * 1, 2: spiral, 3: np.array([[5.0]]), 4: rng.integers(0, 9, (1, 12)), 5: rng.integers(0, 9, (13, 1)), 6: np.zeros((9, 9))}


@pytest.mark.parametrize("tile", [4, 7, 256])
def test_sharpness(spark, tile):
    pictures = made()
    got = {r.picture: (r.pixels, r.sharpness) for r in raster.sharpness(frame(spark, pictures), tile).collect()}
    assert got.keys() == pictures.keys()
    for p, m in pictures.items():
        assert got[p][0] == m.size and got[p][1] == pytest.approx(laplacian(m.astype(float)).var(), rel=1e-9, abs=1e-12), p


@pytest.mark.parametrize("tile", [5, 64])
def test_regions_by_flood_fill(spark, tile):
    pictures = {p: m for p, m in made().items() if p in (1, 2, 3, 6)}
    got = {(r.picture, r.x, r.y): r.region for r in raster.regions(raster.framed(frame(spark, pictures)), tile).collect()}
    seen = {}
    for p, m in pictures.items():
        label = flood(m > 0)
        for (y, x), v in np.ndenumerate(label):
            assert (v >= 0) == ((p, x, y) in got)
            if v >= 0:
                assert seen.setdefault((p, int(v)), got[p, x, y]) == got[p, x, y]
    assert len({(p, v) for (p, _), v in seen.items()}) == len(seen)


@pytest.mark.parametrize("tile", [6, 64])
def test_closing(spark, tile):
    pictures = {p: m for p, m in made().items() if p in (1, 4)}
    got = {(r.picture, r.x, r.y): r.value for r in raster.closed(raster.framed(frame(spark, pictures)), 5, tile).collect()}
    want = {(p, x, y): float(v) for p, m in pictures.items() for (y, x), v in np.ndenumerate(slid(slid(m, 2, np.max), 2, np.min))}
    assert got == want


@pytest.mark.parametrize("tile", [8, 256])
def test_silhouette(spark, tile):
    rng = np.random.default_rng(6)
    pictures = {}
    for p in range(3):
        m = rng.integers(100, 256, (40, 33))
        m[30 - 4 * p :, 5 + p : 25] = rng.integers(0, 60, m[30 - 4 * p :, 5 + p : 25].shape)
        m[20:23, 28:31] = 3  # dark, but not attached to the bottom
        pictures[p] = m
    got = {(r.picture, r.x): r.top for r in raster.silhouette(frame(spark, pictures), close=3, smooth=5, pad=2, tile=tile).collect()}
    shares = {}
    for p, m in pictures.items():
        h, w = m.shape
        lo = int(h * 0.35)
        dark = np.zeros(m.shape)
        dark[lo:] = m[lo:] < np.percentile(m[lo:], 45)
        label = flood(slid(slid(dark, 1, np.max), 1, np.min) > 0)
        keep = np.isin(label, [v for v in set(label[-1]) if v >= 0])
        first = np.where(keep.any(axis=0), keep.argmax(axis=0), h)
        around = np.pad(first, 2, mode="reflect")
        top = [int(max(around[x : x + 5].mean() - 2, lo * 0.5)) for x in range(w)]
        assert [got[p, x] for x in range(w)] == top
        shares[p] = sum(max(0, h - t) for t in top) / m.size
    out = raster.silhouette(frame(spark, pictures), close=3, smooth=5, pad=2, tile=tile)
    assert {r.picture: r.share for r in raster.masked_share(out).collect()} == pytest.approx(shares)
    assert {r.picture: r.n / pictures[r.picture].size for r in raster.mask_rows(out).where("value = 0").groupBy("picture").agg({"*": "count"}).toDF("picture", "n").collect()} == pytest.approx(shares)


def test_cases(spark):
    rows = [(1, 0, 0, 1.0), (1, 2, 1, None), (1, 0, 0, 3.0), (None, 0, 0, 1.0), (1, None, 0, 1.0), (1, -1, 0, 1.0)]
    df = spark.createDataFrame(rows, "picture long, x int, y int, value double")
    assert sorted((r.x, r.y, r.value, r.w, r.h) for r in raster.framed(df).collect()) == [(0, 0, 3.0, 3, 2), (2, 1, 0.0, 3, 2)]
    m = np.array([[3.0, 0, 0], [0, 0, 0]])
    assert raster.sharpness(df).first().sharpness == pytest.approx(laplacian(m).var())
    none = df.limit(0)
    assert raster.sharpness(none).collect() == [] and raster.regions(raster.framed(none)).collect() == [] and raster.silhouette(none).collect() == []
