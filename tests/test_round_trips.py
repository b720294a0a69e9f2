"""Binary sources: records of varying length, and points of which only what is asked for is read."""

import math
import os
import random
import struct

import pytest
from pyspark.sql import functions as F

from waymark.sources import ply, solved


def made(n):
    r = random.Random(1)
    out = []
    for k in range(n):
        m = r.randrange(5)
        out.append((k, *[r.uniform(-1, 1) for _ in range(4)], *[r.uniform(-9, 9) for _ in range(3)], k % 3, f"cam{k % 3}/{'é' * (k % 4)}{k:06d}.jpg" + "x" * (300 * (k % 7 == 0)), [r.random() for _ in range(m)], [r.random() for _ in range(m)], [r.choice([-1, 5, 1 << 40]) for _ in range(m)]))
    return out


WRITTEN = "image_id long, qw double, qx double, qy double, qz double, tx double, ty double, tz double, camera_id long, name string, xs array<double>, ys array<double>, points array<long>"


def test_solved_images_come_back_from_several_tasks(spark, tmp_path):
    solved.register(spark)
    rows = made(230)
    spark.createDataFrame(rows, WRITTEN).repartition(3).write.format("solved").mode("append").save(str(tmp_path))
    back = spark.read.format("solved").option("recordsPerTask", 10).load(str(tmp_path))
    assert back.rdd.getNumPartitions() >= 23
    got = {tuple(map(str, (*r[:10], *r[11:14]))) for r in back.collect()}
    assert got == {tuple(map(str, r)) for r in rows} and {r.observations == len(r.xs) for r in back.collect()} == {True}
    names = spark.read.format("solved").schema("name string, observations bigint").load(str(tmp_path))
    assert sorted((r.name, r.observations) for r in names.collect()) == sorted((r[9], len(r[10])) for r in rows)


def test_layout_of_a_record(spark, tmp_path):
    """By hand, as the format has it; an index of offsets by stretches."""
    body = struct.pack("<Q", 2)
    for k, name, seen in ((7, b"a.jpg", [(1.5, 2.5, 9)]), (8, b"", [])):
        body += struct.pack("<I7dI", k, 1, 0, 0, 0, 4, 5, 6, 3) + name + b"\0" + struct.pack("<Q", len(seen)) + b"".join(struct.pack("<ddq", *s) for s in seen)
    (tmp_path / "images.bin").write_bytes(body)
    solved.register(spark)
    got = spark.read.format("solved").load(str(tmp_path / "images.bin")).select("image_id", "tx", "camera_id", "name", "xs", "points").orderBy("image_id").collect()
    assert [tuple(r) for r in got] == [(7, 4.0, 3, "a.jpg", [1.5], [9]), (8, 4.0, 3, "", [], [])]
    assert [n for _, n in solved.offsets(str(tmp_path / "images.bin"), 1)] == [1, 1]
    (tmp_path / "images.bin").write_bytes(body[:-20])
    with pytest.raises(Exception):
        solved.offsets(str(tmp_path / "images.bin"), 1)


def test_centre_is_where_the_world_comes_to_nought(spark):
    """R c + t = 0, for quaternions of any length; none for a quaternion of length 0."""
    rows = [r[1:8] for r in made(40)] + [(0.0,) * 4 + (1.0, 2.0, 3.0)]
    df = spark.createDataFrame(rows, "qw double, qx double, qy double, qz double, tx double, ty double, tz double")
    for r in df.withColumns(dict(zip("abc", solved.centre()))).collect():
        w, x, y, z, *t, a, b, c = r
        n = w * w + x * x + y * y + z * z
        if not n:
            assert a is None
            continue
        m = [[1 - 2 * (y * y + z * z) / n, 2 * (x * y - w * z) / n, 2 * (x * z + w * y) / n], [2 * (x * y + w * z) / n, 1 - 2 * (x * x + z * z) / n, 2 * (y * z - w * x) / n], [2 * (x * z - w * y) / n, 2 * (y * z + w * x) / n, 1 - 2 * (x * x + y * y) / n]]
        assert all(math.isclose(sum(k * v for k, v in zip(row, (a, b, c))) + u, 0, abs_tol=1e-9) for row, u in zip(m, t))


def test_ply_reads_what_is_asked_for(spark, tmp_path):
    """Files beyond the bounds make no task, rows beyond them no row, columns nobody names none."""
    ply.register(spark)
    rows = [(float(k), float(k % 7), k % 5) for k in range(400)]
    for k in range(4):
        spark.createDataFrame(rows[100 * k : 100 * k + 100], "x double, y double, label int").coalesce(1).write.format("ply").mode("append").save(str(tmp_path))
    reader = ply.PlyReader({"path": str(tmp_path)}, ply.PlySource({"path": str(tmp_path)}).schema())
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, IsNotNull, LessThan, StringContains

    left = list(reader.pushFilters([GreaterThanOrEqual(("x",), 150.0), LessThan(("x",), 180.0), EqualTo(("label",), 2), IsNotNull(("x",)), StringContains(("file",), "a")]))
    assert [type(f).__name__ for f in left] == ["IsNotNull", "StringContains"]
    parts = reader.partitions()
    assert len(parts) == 1 and sum(b.num_rows for b in reader.read(parts[0])) == 6
    some = spark.read.format("ply").schema("x double").load(str(tmp_path)).where("x >= 150 and x < 180")
    assert some.rdd.getNumPartitions() == 1 and sorted(r.x for r in some.collect()) == [float(k) for k in range(150, 180)]
    assert spark.read.format("ply").load(str(tmp_path)).where("label = 2 and y > 3").count() == sum(1 for x, y, c in rows if c == 2 and y > 3)
    assert os.path.getsize(reader.partitions()[0].path) > 100 * 20
    assert spark.read.format("ply").load(str(tmp_path)).agg(F.sum("x")).first()[0] == sum(x for x, *_ in rows)


def test_ply_bounds_with_what_is_not_a_number(spark, tmp_path):
    ply.register(spark)
    spark.createDataFrame([(1.0,), (float("nan"),)], "x double").coalesce(1).write.format("ply").mode("append").save(str(tmp_path))
    df = spark.read.format("ply").load(str(tmp_path))
    assert df.where("x > 5").count() == 1 and df.where("x < 5").count() == 1
