"""Registered queries that run streams to their end, with DuckDB SQL of what must have come out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.operators.shared import scratch_path
from waymark.streaming import queue, selection

_LEASE_DAYS = 2


def _drained(stream: DataFrame, path: str) -> DataFrame:
    """All rows that a stream appends until its input ends."""
    stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/out")


def claim_stream(spark: SparkSession, d: str) -> DataFrame:
    """Events as those of a queue, in one stream: every item's last state, stale locks included."""
    e = spark.readStream.schema(spark.read.parquet(f"{d}/events.parquet").schema).option("pathGlobFilter", "events.parquet").parquet(d)
    kind = F.create_map(*[F.lit(x) for p in (("signup", "claim"), ("view", "heartbeat"), ("purchase", "done"), ("error", "failed")) for x in p])
    q = e.select(F.concat(F.lit("stage"), (F.col("user_id") % 4).cast("string")).alias("stage"), (F.col("user_id") * 100 + F.col("event_id") % 97).cast("string").alias("item"), "ts", kind[F.col("event_type")].alias("kind"))
    return queue.latest(_drained(queue.queue_stream(q, _LEASE_DAYS * 86400.0, 2), scratch_path(spark, "claims")))


def selection_stream(spark: SparkSession, d: str) -> DataFrame:
    """frame_selection, its candidates delivered in four parts one after the other: marks outlive the parts."""
    from waymark.plans.queries import candidates

    path = scratch_path(spark, "candidates")
    c = candidates(spark, d).withColumn("_part", F.ntile(4).over(Window.partitionBy("video").orderBy("seg", "i")))
    c.write.parquet(f"{path}/all")
    for k in range(1, 5):
        spark.read.parquet(f"{path}/all").where(F.col("_part") == k).drop("_part").coalesce(1).write.mode("append").parquet(f"{path}/in")
    stream = spark.readStream.schema(c.drop("_part").schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    return _drained(selection.select_stream(stream, 9.0), path)


ORACLES = {
    "claim_stream": f"""with q as (select 'stage' || (user_id % 4) as stage, cast(user_id * 100 + event_id % 97 as varchar) as item, ts, event_type as k from events where event_type in ('signup', 'view', 'purchase', 'error')),
w as (select epoch_us(max(ts)) // 1000 - 600000 as mark from q),
a as (select stage, item, count(*) filter (k = 'purchase') as done, count(*) filter (k = 'error') as attempts, epoch_us(max(ts) filter (k in ('signup', 'view'))) as held, epoch_us(max(ts) filter (k in ('purchase', 'error'))) as freed from q group by 1, 2),
s as (select *, case when done > 0 then 'done' when held is not null and (freed is null or held > freed) then 'running' when attempts >= 2 then 'failed' else 'pending' end as state from a)
select stage, item, attempts, state, state = 'running' and held // 1000 + {_LEASE_DAYS * 86_400_000} <= mark as stale from s, w""",
}
QUERIES = {f.__name__: f for f in (claim_stream, selection_stream)}
