"""PLY point sets as a Spark data source: format("ply"), binary little-endian.

Reading takes the schema from the header of the first file; every property is a column, in order, before `file`
and `idx`. A schema given to the reader names the columns wanted: only these are decoded. Unsigned types widen, as Spark has none. A file
is cut into row ranges, so a large one is read by many tasks. Writing makes one file a task, with the bounds of each property as comments.

Comparisons of properties with numbers are taken over (register() sets spark.sql.python.filterPushdown.enabled for that): files whose bounds rule all their
rows out aren't opened again, and rows are dropped before a column is made of them. Files lie on a mounted path.
"""

from __future__ import annotations

import glob
import os
import shutil
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

#: The format's scalar types, their numpy codes and the Spark types that hold them.
TYPES = {
    "char": ("<i1", T.ByteType()), "int8": ("<i1", T.ByteType()), "uchar": ("<u1", T.ShortType()), "uint8": ("<u1", T.ShortType()), "short": ("<i2", T.ShortType()), "int16": ("<i2", T.ShortType()), "ushort": ("<u2", T.IntegerType()), "uint16": ("<u2", T.IntegerType()),
    "int": ("<i4", T.IntegerType()), "int32": ("<i4", T.IntegerType()), "uint": ("<u4", T.LongType()), "uint32": ("<u4", T.LongType()), "float": ("<f4", T.FloatType()), "float32": ("<f4", T.FloatType()), "double": ("<f8", T.DoubleType()), "float64": ("<f8", T.DoubleType()),
}
_WRITTEN = {"tinyint": "char", "smallint": "short", "int": "int", "bigint": "int", "float": "float", "double": "double"}


@dataclass
class Header:
    count: int
    properties: list[tuple[str, str]]
    size: int
    bounds: dict[str, tuple[float, float]]

    def dtype(self) -> np.dtype:
        return np.dtype([(n, TYPES[t][0]) for n, t in self.properties])

    def schema(self) -> T.StructType:
        return T.StructType([*[T.StructField(n, TYPES[t][1]) for n, t in self.properties], T.StructField("file", T.StringType()), T.StructField("idx", T.LongType())])


def read_header(path: str) -> Header:
    count, properties, element, bounds = 0, [], "", {}
    with open(path, "rb") as f:
        if f.readline().strip() != b"ply":
            raise ValueError(f"{path} is not a PLY file")
        while (line := f.readline().decode("ascii").split()) != ["end_header"]:
            if not line:
                raise ValueError(f"{path}: the header doesn't end")
            if line[0] == "format" and line[1] != "binary_little_endian":
                raise ValueError(f"{path}: {line[1]} isn't supported")
            if line[:2] == ["comment", "bounds"] and len(line) == 5:
                bounds[line[2]] = float(line[3]), float(line[4])
            if line[0] == "element":
                element = line[1]
                if element == "vertex":
                    count = int(line[2])
            if line[0] == "property" and element == "vertex":
                if line[1] == "list":
                    raise ValueError(f"{path}: vertices have a list property")
                properties.append((line[2], line[1]))
        return Header(count, properties, f.tell(), bounds)


def _files(path: str) -> list[str]:
    path = path.removeprefix("file://")
    return sorted(glob.glob(f"{path}/**/*.ply", recursive=True)) if os.path.isdir(path) else sorted(glob.glob(path))


#: For each comparison that is taken over: whether a row's value fits, and whether any value between bounds can.
_COMPARED = {
    GreaterThan: (np.greater, lambda lo, hi, v: hi > v),
    GreaterThanOrEqual: (np.greater_equal, lambda lo, hi, v: hi >= v),
    LessThan: (np.less, lambda lo, hi, v: lo < v),
    LessThanOrEqual: (np.less_equal, lambda lo, hi, v: lo <= v),
    EqualTo: (np.equal, lambda lo, hi, v: lo <= v <= hi),
}


@dataclass
class _Rows(InputPartition):
    path: str
    first: int
    count: int


class PlyReader(DataSourceReader):
    def __init__(self, options, schema):
        self.path, self.rows, self.wanted = options["path"], int(options.get("rowsPerTask", 1_000_000)), schema
        self.filters: list[tuple[str, type, float]] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            one = isinstance(getattr(f, "value", None), (int, float)) and f.value == f.value and len(f.attribute) == 1 and f.attribute[0] not in ("file", "idx")
            if type(f) in _COMPARED and one:
                self.filters.append((f.attribute[0], type(f), f.value))
            else:
                yield f

    def partitions(self):
        out = []
        for path in _files(self.path):
            head = read_header(path)
            if not all(_COMPARED[kind][1](*head.bounds[name], value) for name, kind, value in self.filters if name in head.bounds):
                continue
            n = head.count
            out += [_Rows(path, a, min(self.rows, n - a)) for a in range(0, n, self.rows)]
        return out or [_Rows("", 0, 0)]

    def read(self, part):
        if not part.count:
            return
        head = read_header(part.path)
        dtype = head.dtype()
        for a in range(part.first, part.first + part.count, 65536):
            n = min(65536, part.first + part.count - a)
            with open(part.path, "rb") as f:
                f.seek(head.size + a * dtype.itemsize)
                rows = np.frombuffer(f.read(n * dtype.itemsize), dtype=dtype)
            if len(rows) != n:
                raise ValueError(f"{part.path} ends early")
            keep = np.ones(n, dtype=bool)
            for name, kind, value in self.filters:
                # Not a number is larger than any, as Spark has it.
                own = rows[name]
                keep &= _COMPARED[kind][0](own, value) | (np.isnan(own) if own.dtype.kind == "f" and kind in (GreaterThan, GreaterThanOrEqual) else False)
            at = np.flatnonzero(keep)
            if not len(at):
                continue
            columns = {name: np.ascontiguousarray(rows[name][at]) for name in dtype.names if name in self.wanted.names} | {"file": pa.array([part.path] * len(at)), "idx": at + a}
            arrow = {"byte": pa.int8(), "short": pa.int16(), "integer": pa.int32(), "long": pa.int64(), "float": pa.float32(), "double": pa.float64(), "string": pa.string()}
            yield pa.RecordBatch.from_arrays([pa.array(columns[c.name]).cast(arrow[c.dataType.typeName()]) for c in self.wanted.fields], names=self.wanted.names)


@dataclass
class _Written(WriterCommitMessage):
    path: str | None


class PlyWriter(DataSourceArrowWriter):
    """Batches go to a body file as they come; the header, which has the count, is put before it at the end of the task."""

    def __init__(self, options, schema, overwrite):
        self.path, self.overwrite = options["path"].removeprefix("file://"), overwrite
        self.fields = [(f.name, _WRITTEN[f.dataType.simpleString()]) for f in schema.fields if f.dataType.simpleString() in _WRITTEN and f.name != "idx"]

    def write(self, iterator):
        dtype = np.dtype([(n, TYPES[t][0]) for n, t in self.fields])
        os.makedirs(self.path, exist_ok=True)
        path, count = f"{self.path}/part-{uuid.uuid4().hex}.ply.tmp", 0
        bounds: dict[str, list[float]] = {n: [np.inf, -np.inf] for n, _ in self.fields}
        with open(f"{path}.body", "wb") as f:
            for batch in iterator:
                rows = np.zeros(batch.num_rows, dtype=dtype)
                for n, t in self.fields:
                    values = batch.column(batch.schema.get_field_index(n))
                    if values.null_count:
                        raise ValueError(f"{n} has nulls, which PLY can't hold")
                    values = values.to_numpy(zero_copy_only=False)
                    if values.dtype.kind == "i" and len(values) and not (np.iinfo(dtype[n]).min <= values.min() and values.max() <= np.iinfo(dtype[n]).max):
                        raise ValueError(f"{n} doesn't fit the format's {t}; cast it to double")
                    rows[n] = values
                    if len(rows):
                        # Bounds of what is written, after its rounding; with not a number in it, none.
                        bounds[n] = [float(f(b, e)) for f, b, e in zip((np.minimum, np.maximum), bounds[n], (rows[n].min(), rows[n].max()))]
                f.write(rows.tobytes())
                count += len(rows)
        if not count:
            os.remove(f"{path}.body")
            return _Written(None)
        lines = ["ply", "format binary_little_endian 1.0", f"element vertex {count}", *[f"comment bounds {n} {lo!r} {hi!r}" for n, (lo, hi) in bounds.items() if lo <= hi], *[f"property {t} {n}" for n, t in self.fields], "end_header", ""]
        with open(path, "wb") as f, open(f"{path}.body", "rb") as body:
            f.write("\n".join(lines).encode("ascii"))
            shutil.copyfileobj(body, f, 1 << 20)
        os.remove(f"{path}.body")
        return _Written(path)

    def commit(self, messages):
        # What is overwritten goes only once the job has succeeded.
        for path in _files(self.path) if self.overwrite else []:
            os.remove(path)
        for m in messages:
            if m and m.path:
                os.rename(m.path, m.path.removesuffix(".tmp"))

    def abort(self, messages):
        for m in messages:
            if m and m.path and os.path.exists(m.path):
                os.remove(m.path)


class PlySource(DataSource):
    @classmethod
    def name(cls):
        return "ply"

    def schema(self):
        files = _files(self.options["path"])
        if not files:
            raise FileNotFoundError(self.options["path"])
        return read_header(files[0]).schema()

    def reader(self, schema):
        return PlyReader(self.options, schema)

    def writer(self, schema, overwrite):
        return PlyWriter(self.options, schema, overwrite)


def register(spark) -> None:
    """The source takes filters over, which the session has to allow."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PlySource)
