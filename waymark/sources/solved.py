"""Solved images as a Spark data source: format("solved"), binary records of varying length.

A file has a count and then a record for each image: number, rotation (qw, qx, qy, qz) and translation (tx, ty, tz) from the world to the
camera, the camera's number, the name and its observations (x, y and the point's number, -1 for none). Records can't be
found by number, so one pass over a file, which jumps from record to record, makes an index of offsets, and row ranges are cut by
it: a large file is read by many tasks, each from its own offset on. Files lie on a mounted path.
"""

from __future__ import annotations

import glob
import os
import struct
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from waymark.sources.ply import _Written

SCHEMA = "image_id bigint, qw double, qx double, qy double, qz double, tx double, ty double, tz double, camera_id bigint, name string, observations bigint, xs array<double>, ys array<double>, points array<bigint>, file string"
#: The layout of a record before its name, of the number of observations after it, and of an observation.
_HEAD, _MANY, _SEEN = "<I7dI", "<Q", np.dtype([("x", "<f8"), ("y", "<f8"), ("point", "<i8")])
_PLAIN = ("image_id", "qw", "qx", "qy", "qz", "tx", "ty", "tz", "camera_id")
_TYPES = {"long": pa.int64(), "double": pa.float64(), "string": pa.string()}


def centre(q: tuple[str, ...] = ("qw", "qx", "qy", "qz"), t: tuple[str, ...] = ("tx", "ty", "tz")) -> tuple[Column, Column, Column]:
    """Where a camera is in the world: its translation turned back, with the sign changed. The quaternion is made a unit one; of length 0 it has no centre."""
    w, *v = (F.col(c) for c in q)
    n = F.nullif(w * w + v[0] * v[0] + v[1] * v[1] + v[2] * v[2], F.lit(0.0))
    u = [F.col(c) for c in t]

    def cross(a, b):
        return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]

    # u turned by the conjugate: u - 2 w (v x u) + 2 v x (v x u), over the square of the quaternion's length.
    once = cross(v, u)
    twice = cross(v, once)
    return tuple(-(a + 2 * (c - w * b) / n) for a, b, c in zip(u, once, twice))


def _name(f) -> bytes:
    """Up to the zero byte."""
    out, at = b"", f.tell()
    while b"\0" not in out:
        more = f.read(256)
        if not more:
            raise ValueError(f"{f.name} ends early")
        out += more
    name = out[: out.index(b"\0")]
    f.seek(at + len(name) + 1)
    return name


def offsets(path: str, every: int) -> list[tuple[int, int]]:
    """(offset, records) of stretches of `every` records: one pass that reads heads and names and jumps over observations."""
    out, size = [], os.path.getsize(path)
    with open(path, "rb") as f:
        (count,) = struct.unpack(_MANY, f.read(8))
        for k in range(count):
            if k % every == 0:
                out.append((f.tell(), min(every, count - k)))
            f.seek(struct.calcsize(_HEAD), os.SEEK_CUR)
            _name(f)
            (seen,) = struct.unpack(_MANY, f.read(8))
            f.seek(seen * _SEEN.itemsize, os.SEEK_CUR)
        if f.tell() > size:
            raise ValueError(f"{path} ends early")
    return out


@dataclass
class _Stretch(InputPartition):
    path: str
    offset: int
    records: int


class SolvedReader(DataSourceReader):
    def __init__(self, options, schema):
        self.path, self.every, self.wanted = options["path"].removeprefix("file://"), int(options.get("recordsPerTask", 50_000)), schema

    def partitions(self):
        files = sorted(glob.glob(f"{self.path}/**/*.bin", recursive=True)) if os.path.isdir(self.path) else sorted(glob.glob(self.path))
        return [_Stretch(p, at, n) for p in files for at, n in offsets(p, self.every)] or [_Stretch("", 0, 0)]

    def read(self, part):
        names = self.wanted.names
        seen_wanted = [c for c in ("xs", "ys", "points") if c in names]
        if not part.records:
            return
        with open(part.path, "rb") as f:
            f.seek(part.offset)
            left = part.records
            while left:
                n, rows, seen = min(left, 4096), [], []
                for _ in range(n):
                    head = struct.unpack(_HEAD, f.read(struct.calcsize(_HEAD)))
                    name = _name(f).decode()
                    (many,) = struct.unpack(_MANY, f.read(8))
                    # Observations nobody asks for are jumped over.
                    if seen_wanted:
                        seen.append(np.frombuffer(f.read(many * _SEEN.itemsize), dtype=_SEEN))
                    else:
                        f.seek(many * _SEEN.itemsize, os.SEEK_CUR)
                    rows.append((*head, name, many))
                left -= n
                columns = dict(zip((*_PLAIN, "name", "observations"), zip(*rows))) | {"file": [part.path] * n}
                arrays = {c: pa.array(columns[c], _TYPES[self.wanted[c].dataType.typeName()]) for c in names if c in columns}
                if seen_wanted:
                    flat, at = np.concatenate(seen), pa.array(np.cumsum([0] + [len(s) for s in seen]).astype(np.int32))
                    arrays |= {c: pa.ListArray.from_arrays(at, pa.array(np.ascontiguousarray(flat[k]))) for c, k in (("xs", "x"), ("ys", "y"), ("points", "point")) if c in names}
                yield pa.RecordBatch.from_arrays([arrays[c] for c in names], names=names)


class SolvedWriter(DataSourceArrowWriter):
    """One file a task; the count at its start is put in at the end."""

    def __init__(self, options, overwrite):
        self.path, self.overwrite = options["path"].removeprefix("file://"), overwrite

    def write(self, iterator):
        os.makedirs(self.path, exist_ok=True)
        path, count = f"{self.path}/part-{uuid.uuid4().hex}.bin.tmp", 0
        with open(path, "wb") as f:
            f.write(struct.pack(_MANY, 0))
            for batch in iterator:
                columns = {c: batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (*_PLAIN, "name")}
                seen = [batch.column(k).to_pylist() if (k := batch.schema.get_field_index(c)) >= 0 else [None] * batch.num_rows for c in ("xs", "ys", "points")]
                for head, name, *own in zip(zip(*[columns[c] for c in _PLAIN]), columns["name"], *seen):
                    if None in head or name is None or "\0" in name:
                        raise ValueError("a solved image needs all its numbers and a name without a zero byte")
                    x, y, point = (o or [] for o in own)
                    rows = np.zeros(len(x), dtype=_SEEN)
                    rows["x"], rows["y"], rows["point"] = x, y, point
                    f.write(struct.pack(_HEAD, *head) + name.encode() + b"\0" + struct.pack(_MANY, len(rows)) + rows.tobytes())
                    count += 1
            f.seek(0)
            f.write(struct.pack(_MANY, count))
        return _Written(path)

    def commit(self, messages):
        for path in glob.glob(f"{self.path}/*.bin") if self.overwrite else []:
            os.remove(path)
        for m in messages:
            if m:
                os.rename(m.path, m.path.removesuffix(".tmp"))

    def abort(self, messages: list[WriterCommitMessage | None]):
        for m in messages:
            if m and os.path.exists(m.path):
                os.remove(m.path)


class SolvedSource(DataSource):
    @classmethod
    def name(cls):
        return "solved"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return SolvedReader(self.options, schema)

    def writer(self, schema, overwrite):
        return SolvedWriter(self.options, overwrite)


def register(spark) -> None:
    spark.dataSource.register(SolvedSource)
