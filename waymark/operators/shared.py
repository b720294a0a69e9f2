"""Written intermediate tables, and order without a sort in one task."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """df as Parquet in the shared folder, read back: computed once, its lineage cut, whole again after a lost executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_place(df: DataFrame, *order: str, name: str = "place") -> DataFrame:
    """Gapless numbers from 0 over a total order.

    Rows are dealt by range and sorted within partitions; only partitions' counts, a row a partition, are summed up in one
    place. The dealt rows are written first, so that numbers don't change if a task runs again.
    """
    dealt = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    counts = dealt.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    return dealt.withColumn("_part", part).join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at", "_part", "_start")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder of spark.checkpoint.dir (a temporary one in a local session without it), removed when the driver's JVM ends."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = f"file://{tempfile.mkdtemp(prefix='waymark-')}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{named.rstrip('/')}/waymark-{uuid.uuid4().hex}-{name}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return path.toString()
