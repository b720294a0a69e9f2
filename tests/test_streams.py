"""Streams run to their end, batch by batch, against the batch rules."""

import random

from pyspark.sql import functions as F

from waymark.operators import capture, passes
from waymark.streaming import queue, selection


def deliver(df, parts, path):
    for k in range(parts):
        df.where(F.col("part") == k).drop("part").coalesce(1).write.mode("append").json(path)
    return df.sparkSession.readStream.schema(df.drop("part").schema).option("maxFilesPerTrigger", 1).json(path)


def drained(stream, path):
    stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/cp").outputMode("append").trigger(availableNow=True).start().awaitTermination(240)
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/out")


def test_queue_stream_ends_as_the_batch_rule_says(spark, tmp_path):
    """Locks that outlive their lease included: d's is stale at the end, e's has been renewed, f's failures count after its lock is freed."""
    rows = [
        (0, "a", "00:00:00", "claim"), (0, "b", "00:00:00", "claim"), (0, "b", "00:01:00", "failed"), (0, "d", "00:02:00", "claim"), (0, "e", "00:02:00", "claim"), (0, "f", "00:03:00", "failed"), (0, "x", "00:03:00", None),
        (1, "a", "00:05:00", "done"), (1, "b", "00:06:00", "claim"), (1, "b", "00:07:00", "failed"), (1, "f", "00:08:00", "claim"), (1, "f", "00:09:00", "failed"),
        (2, "e", "01:50:00", "heartbeat"), (2, "c", "01:55:00", "claim"), (2, "g", "02:00:00", "failed"),
    ]
    df = spark.createDataFrame([(p, "s", i, f"2024-01-01 {t}", k) for p, i, t, k in rows], "part int, stage string, item string, ts string, kind string")
    df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    found = queue.latest(drained(queue.queue_stream(deliver(df, 3, str(tmp_path / "in"))), str(tmp_path)))
    # The last event less ten minutes is what the watermark comes to.
    want = capture.queue_status(df.where("kind is not null"), "2024-01-01 01:50:00")
    names = ["stage", "item", "attempts", "state", "stale"]
    got = {tuple(r) for r in found.select(names).collect()}
    assert got == {tuple(r) for r in want.select(names).collect()}
    assert ("s", "d", 0, "running", True) in got and ("s", "e", 0, "running", False) in got and ("s", "f", 2, "failed", False) in got


def test_done_items_are_forgotten_after_their_keep(spark, tmp_path):
    rows = [(0, "a", "00:00:00", "done"), (1, "z", "05:00:00", "claim"), (2, "y", "05:30:00", "claim"), (3, "a", "06:00:00", "claim")]
    df = spark.createDataFrame([(p, "s", i, f"2024-01-01 {t}", k) for p, i, t, k in rows], "part int, stage string, item string, ts string, kind string").withColumn("ts", F.col("ts").cast("timestamp"))
    got = drained(queue.queue_stream(deliver(df, 4, str(tmp_path / "in")), keep_s=3600.0), str(tmp_path))
    assert {(r.item, r.state) for r in got.where("item = 'a'").collect()} == {("a", "done"), ("a", "running")}


def test_selection_stream_is_the_batch_selection(spark, tmp_path):
    r = random.Random(5)
    rows = []
    for v in ("v1", "v2"):
        d = 0.0
        for i in range(300):
            d += r.random() * 2
            rows.append((i // 90, v, i // 40, i, d if i % 17 else None, r.random() if i % 13 else None))
    df = spark.createDataFrame(rows, "part int, video string, seg int, i long, dist double, sharp double")
    late = spark.createDataFrame([(3, "v1", 0, 5, 1e9, 9.0), (3, None, 1, 1, 1.0, 1.0), (2, "v1", 5, 210, 1e9, 9.0)], df.schema).where("part = 3")
    got = drained(selection.select_stream(deliver(df.union(late), 4, str(tmp_path / "in")), 5.0), str(tmp_path))
    want = passes.select_frames(df, ["video"], 5.0)
    names = ["video", "seg", "i", "dist", "sharp"]
    assert sorted(map(tuple, got.select(names).collect()), key=str) == sorted(map(tuple, want.select(names).collect()), key=str) and got.count() > 20


def test_items_of_a_bucket_keep_their_own_deadlines(spark, tmp_path):
    """200 items in one bucket, in three, or nearly each in its own: the same rows, whichever part ends a lease while others of its bucket get events."""
    r = random.Random(3)
    rows = [(p, f"s{k % 2}", f"i{k}", p * 3600 + r.randrange(3600), r.choice(["claim", "heartbeat", "heartbeat", "failed", "done", None])) for p in range(4) for k in range(200) if r.random() < 0.4]
    df = spark.createDataFrame(rows, "part int, stage string, item string, at long, kind string").select("part", "stage", "item", F.timestamp_seconds("at").alias("ts"), "kind")
    got = []
    for buckets in (1, 3, 1024):
        path = str(tmp_path / str(buckets))
        got.append(drained(queue.queue_stream(deliver(df, 4, f"{path}/in"), 1500.0, 2, buckets=buckets), path))
    want = sorted(map(tuple, got[2].collect()))
    assert [sorted(map(tuple, g.collect())) for g in got[:2]] == [want, want]
    assert len(set(want)) == len(want) and sum(x[4] for x in want) > 20
