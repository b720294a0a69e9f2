"""Views of lenses against rays, and the sphere against its cells."""

import math

import numpy as np
import pytest

from waymark.operators import views


def ray(u, v, yaw, pitch):
    y, p = math.radians(yaw), math.radians(pitch)
    ahead, up = math.cos(p) - v * math.sin(p), math.sin(p) + v * math.cos(p)
    d = np.array([u * math.cos(y) + ahead * math.sin(y), ahead * math.cos(y) - u * math.sin(y), up])
    return d / np.linalg.norm(d)


def lens(name, yaw, tilt, half):
    y, t = math.radians(yaw), math.radians(tilt)
    return name, yaw, math.cos(t) * math.sin(y), math.cos(t) * math.cos(y), math.sin(t), half


SCHEMA = "lens string, yaw_deg double, ax double, ay double, az double, half_fov_deg double"
LENSES = [lens("a", 0.0, 0.0, 95.0), lens("b", 180.0, 10.0, 80.0), lens("c", 33.0, -20.0, 60.0), lens("narrow", 90.0, 0.0, 20.0), lens("all", 5.0, 0.0, 180.0)]


@pytest.mark.parametrize("pitch", [-30.0, 0.0, 12.0])
def test_views_reach_the_cone_and_stay_inside(spark, pitch):
    """Corners of the outermost views touch their cone: a hundredth of a degree further they are out."""
    got = views.plan_views(spark.createDataFrame(LENSES, SCHEMA), [pitch], 60.0, 20.0, 0.75, 10.0).collect()
    t = math.tan(math.radians(30))
    for name, yaw, *axis, half in LENSES:
        own = sorted(r.yaw for r in got if r.lens == name)
        inside = lambda y: all(np.dot(ray(sx * t, sy * t * 0.75, y, pitch), axis) >= math.cos(math.radians(half)) for sx in (-1, 1) for sy in (-1, 1))
        if half >= 179:
            assert np.allclose(np.diff(own), 360 / 8) and len(own) == 8
        elif len(own) == 1:
            assert own == [yaw] and not (inside(yaw - 0.01) and inside(yaw + 0.01))
        else:
            assert all(inside(y + 0.002 * (1 if y < yaw else -1)) for y in own) and not inside(own[0] - 0.01) and not inside(own[-1] + 0.01)
            assert max(np.diff(own)) <= 50.01 and (len(own) == 2 or (own[-1] - own[0]) / (len(own) - 2) > 50)
    assert {(r.width, r.height) for r in got} == {(1200, 900)}


def test_sphere_by_cells(spark):
    df = spark.createDataFrame(LENSES, SCHEMA)
    plan = views.plan_views(df, [-10.0], 60.0)
    got = views.sphere_coverage(plan, df, 32).first()
    hit, band = 0, []
    t, of = math.tan(math.radians(30)), {x[0]: x for x in LENSES}
    for k in range(32 * 64):
        z, lon = 1 - (k // 64 + 0.5) / 16, (k % 64 + 0.5) / 64 * math.tau - math.pi
        d = np.array([math.sqrt(1 - z * z) * math.sin(lon), math.sqrt(1 - z * z) * math.cos(lon), z])
        seen = False
        for r in plan.collect() if k == 0 else rows:
            if k == 0:
                rows = plan.collect()
            side, mid, top = (ray(u, v, r.yaw, r.pitch) for u, v in ((1e9, 0), (0, 0), (0, 1e9)))
            depth = d @ mid
            seen |= bool(depth > 0 and abs(d @ side) <= depth * t and abs(d @ top) <= depth * t * r.height / r.width and d @ np.array(of[r.lens][2:5]) >= math.cos(math.radians(of[r.lens][5])))
        hit += seen
        if abs(z) <= math.sin(math.radians(10)):
            band.append(seen)
    assert got.sphere == pytest.approx(hit / (32 * 64)) and got.horizon_band == pytest.approx(sum(band) / len(band))
    assert tuple(views.sphere_coverage(plan.limit(0), df, 32).first()) == (0.0, 0.0)


def test_any_number_of_lenses_split_a_view(spark):
    many = [lens(f"l{k:03d}", float(k), 0.0, 40.0) for k in range(150)]
    view = spark.createDataFrame([("v", 0.0, 0.0, 20.0, 60, 45)], "view string, yaw double, pitch double, fov double, width int, height int")
    got = {r.lens: r.coverage for r in views.split_views(view, spark.createDataFrame(many, SCHEMA)).collect()}
    assert got["l000"] == 1.0 and len(got) == sum(1 for c in got.values() if c >= 0.1) and 40 < len(got) < 60
