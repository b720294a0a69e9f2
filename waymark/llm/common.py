"""Shared helpers: session folders, written intermediate tables, Arrow plumbing."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """Folder of spark.checkpoint.dir, which driver and executors share.

    Only a local session that names none, as in tests, gets a temporary one; on a cluster that is an error.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not named:
        named = spark.conf.get("spark.waymark.sharedDir", None)
    if not named:
        named = f"file://{tempfile.mkdtemp(prefix='waymark-')}"
        spark.conf.set("spark.waymark.sharedDir", named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/waymark-{uuid.uuid4().hex}-{name}"
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a stored() table that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        p = jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def column_at(df: DataFrame, name: str) -> int:
    """Where a column is, as Spark finds it: by exact name, else whatever the case."""
    if name in df.columns:
        return df.columns.index(name)
    return [c.lower() for c in df.columns].index(name.lower())


def arrow_map(df: DataFrame, schema: str | T.StructType, f: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]) -> DataFrame:
    """mapInArrow of a function of one batch."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from f(batch)

    return df.mapInArrow(run, schema)
