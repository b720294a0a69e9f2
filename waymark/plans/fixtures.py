"""Capture-like views derived from the driver's tables, as DataFrames and as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.operators.passes import number_rows

ORIGIN = (38.98138, -76.69057, 0.0)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video, seq, t, x, y, z, sharp): events as positions of a capture; integer millimetres make sums exact."""
    e = _table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    e = number_rows(e, "user_id", "ts", "event_id")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    k = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    errors = F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0)).over(w)

    def metres(step: Column) -> Column:
        return F.sum(step).over(w).cast("double") / F.lit(1e3)

    i, u = F.col("event_id"), F.col("user_id")
    return e.select(
        F.concat(F.lit("v"), u.cast("string")).alias("video"), "seq", (k.cast("double") * 0.5 + F.lit(60.0) * errors.cast("double")).alias("t"),
        metres((i * 7919 % 2001) - 1000 + ((u * 37 % 11) - 5) * 200).alias("x"), metres((i * 104729 % 2001) - 1000 + ((u * 53 % 7) - 3) * 200).alias("y"), metres((i * 31 % 201) - 100).alias("z"), F.col("value").alias("sharp"),
    )


FRAMES_SQL = """fx_frames as (
select 'v' || cast(user_id as varchar(10)) as video,
 row_number() over (order by user_id, ts, event_id) - 1 as seq,
 cast(row_number() over (partition by user_id order by ts, event_id) as double) * 0.5
  + 60.0e0 * cast(sum(case when event_type='error' then 1 else 0 end)
      over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as double) as t,
 cast(sum((event_id*7919 % 2001) - 1000 + ((user_id*37 % 11) - 5)*200)
      over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as double)/1e3 as x,
 cast(sum((event_id*104729 % 2001) - 1000 + ((user_id*53 % 7) - 3)*200)
      over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as double)/1e3 as y,
 cast(sum((event_id*31 % 201) - 100)
      over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as double)/1e3 as z,
 value as sharp
from events)"""


def gaussians(spark: SparkSession, sf_dir: str, cell: float = 20.0) -> DataFrame:
    """(chunk, idx, x, y, z, opacity, scale_0..2, f_rest_0): line items as points of a model, a chunk each."""
    li = _table(spark, sf_dir, "lineitem")
    x = ((F.col("l_orderkey") * 131 + F.col("l_linenumber") * 17) % 1600 - 800).cast("double") / 10
    y = ((F.col("l_partkey") * 71 + F.col("l_suppkey") * 29) % 1200 - 600).cast("double") / 10
    cx, cy = F.floor((x + (F.col("l_suppkey") % 3 - 1) * 4) / cell), F.floor((y + (F.col("l_partkey") % 3 - 1) * 4) / cell)
    return li.select(
        F.concat(F.lit("chunk_x"), cx.cast("string"), F.lit("_y"), cy.cast("string")).alias("chunk"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("idx"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"), F.col("l_extendedprice").alias("e"),
        x.alias("x"), y.alias("y"), ((F.col("l_linenumber") - 4) * F.lit(0.5)).alias("z"), (F.col("l_discount") * 40 - 2).alias("opacity"),
        (F.col("l_tax") * 10 - 3).alias("scale_0"), (F.col("l_quantity") / 25 - 2).alias("scale_1"), (F.col("l_linenumber") / F.lit(4.0) - 2).alias("scale_2"), F.col("l_quantity").alias("f_rest_0"),
    )


GAUSSIANS_SQL = """fx_raw as (
select *, cast((l_orderkey * 131 + l_linenumber * 17) % 1600 - 800 as double) / 10 as x, cast((l_partkey * 71 + l_suppkey * 29) % 1200 - 600 as double) / 10 as y from lineitem
), fx_gaussians as (
select 'chunk_x' || cast(cast(floor((x + (l_suppkey % 3 - 1) * 4) / 20.0e0) as int) as varchar) || '_y' || cast(cast(floor((y + (l_partkey % 3 - 1) * 4) / 20.0e0) as int) as varchar) as chunk,
 l_orderkey * 8 + l_linenumber as idx, l_partkey as p, l_suppkey as s, l_extendedprice as e, x, y, (l_linenumber - 4) * 0.5e0 as z, l_discount * 40 - 2 as opacity,
 l_tax * 10 - 3 as scale_0, l_quantity / 25 - 2 as scale_1, l_linenumber / 4.0e0 - 2 as scale_2, l_quantity as f_rest_0
from fx_raw)"""
