"""A work queue's state over a stream of its events."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATUS = "stage string, item string, attempts bigint, state string, stale boolean, at bigint"


def keyed_state(spark: SparkSession) -> None:
    """State with timers needs the RocksDB store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


_ITEMS = pa.schema([("stage", pa.string()), ("item", pa.string()), ("done", pa.bool_()), *[(c, pa.int64()) for c in ("attempts", "held", "freed", "last")]])


class ClaimQueue(StatefulProcessor):
    """Five numbers an item, kept together for all items of a bucket, so that a call, a state and a timer serve many items.

    An item has one deadline: the end of its lease while it runs, the end of its keep once it is done. A bucket's timer is the first of them that is later
    than `fired`, up to where deadlines have had their word.
    """

    def __init__(self, lease_ms: int, retries: int, keep_ms: int):
        self.lease_ms, self.retries, self.keep_ms = lease_ms, retries, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.items = handle.getValueState("items", "items binary, fired bigint")

    def _known(self) -> tuple[pd.DataFrame, int]:
        if not self.items.exists():
            return _ITEMS.empty_table().to_pandas(), -1
        items, fired = self.items.get()
        return pa.ipc.open_stream(bytes(items)).read_pandas(), fired

    def _deadline(self, s: pd.DataFrame) -> np.ndarray:
        """Milliseconds; the largest long for items that wait for nothing."""
        never = np.iinfo(np.int64).max
        ends = np.where(s["held"] > s["freed"], s["held"] // 1000 + self.lease_ms, never)
        return np.where(s["done"], s["last"] // 1000 + self.keep_ms, ends)

    def _keep(self, s: pd.DataFrame, fired: int) -> None:
        """Writes the bucket's items, and sets its timer."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if not len(s):
            self.items.clear()
            return
        table = pa.Table.from_pandas(s, schema=_ITEMS, preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _ITEMS) as out:
            out.write_table(table)
        self.items.update((sink.getvalue().to_pybytes(), int(fired)))
        ends = self._deadline(s)
        ends = ends[(ends > fired) & (ends < np.iinfo(np.int64).max)]
        if len(ends):
            self.handle.registerTimer(int(ends.min()))

    def _rows(self, s: pd.DataFrame, stale: bool, at: np.ndarray) -> pd.DataFrame:
        running = ~s["done"] & (s["held"] > s["freed"])
        name = np.where(s["done"], "done", np.where(running, "running", np.where(s["attempts"] >= self.retries, "failed", "pending")))
        return pd.DataFrame({"stage": s["stage"], "item": s["item"], "attempts": s["attempts"], "state": name, "stale": running & stale, "at": at})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        (known, fired), touched = self._known(), []
        for part in rows:
            # Sums and latest times: the order within a batch doesn't matter.
            kind, us = part["kind"], part["us"]
            own = pd.DataFrame({"stage": part["stage"], "item": part["item"], "done": kind == "done", "attempts": (kind == "failed").astype("int64"), "held": us.where(kind.isin(["claim", "heartbeat"]), -1).astype("int64"), "freed": us.where(kind.isin(["done", "failed"]), -1).astype("int64"), "last": us.astype("int64")})
            touched.append(self._summed(own))
        new = pd.concat(touched)
        asked = pd.MultiIndex.from_frame(new[["stage", "item"]])
        every = self._summed(pd.concat([known, new]))
        hit = every[pd.MultiIndex.from_frame(every[["stage", "item"]]).isin(asked)]
        self._keep(every, fired)
        yield self._rows(hit, False, hit["last"].to_numpy() // 1000)

    @staticmethod
    def _summed(s: pd.DataFrame) -> pd.DataFrame:
        out = s.groupby(["stage", "item"], sort=False, dropna=False, as_index=False).agg({"done": "max", "attempts": "sum", "held": "max", "freed": "max", "last": "max"})
        return out.astype({"done": bool, **{c: "int64" for c in ("attempts", "held", "freed", "last")}})

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        (s, fired), now = self._known(), max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)
        ends = self._deadline(s)
        over = (ends > fired) & (ends <= now)
        late = s[over & ~s["done"]]
        self._keep(s[~(over & s["done"])].reset_index(drop=True), now)
        if len(late):
            yield self._rows(late, True, ends[over & ~s["done"]])

    def close(self) -> None:
        pass


def queue_stream(events: DataFrame, lease_s: float = 3600.0, retries: int = 2, late: str = "10 minutes", keep_s: float = 7 * 86400.0, buckets: int = 1024) -> DataFrame:
    """(stage, item, attempts, state, stale, at) whenever a batch of (stage, item, ts, kind) touched an item or an item outlived its lease.

    The rule is queue_status(): done outranks a held lock (running), then failures, then pending; a lock whose lease the watermark has passed
    stays running and is stale. A done item is forgotten keep_s after its last event, so what is held is bounded by what is open and what was lately done: an event
    that comes for it later begins anew. Events older than the watermark are left out, as the watermark says. at: milliseconds of the event or timer; an item's row
    of largest `at` is its state. In append mode. Items are dealt to `buckets`, whose numbers are kept and written together; a stream's number of them can't change.
    """
    keyed_state(events.sparkSession)
    rows = events.where("kind is not null").withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).withColumn("us", F.unix_micros("ts"))
    return rows.withColumn("_bucket", F.pmod(F.xxhash64("stage", "item"), F.lit(buckets))).groupBy("_bucket").transformWithStateInPandas(ClaimQueue(int(lease_s * 1000), retries, int(keep_s * 1000)), STATUS, "Append", "EventTime")


def latest(rows: DataFrame) -> DataFrame:
    """(stage, item, attempts, state, stale): the last word of queue_stream() rows on each item; at one time the timer's outranks the event's."""
    return rows.groupBy("stage", "item").agg(F.max(F.struct("at", "stale", "attempts", "state")).alias("l")).select("stage", "item", "l.attempts", "l.state", "l.stale")


def minute_counts(frames: DataFrame, late: str = "1 minute") -> DataFrame:
    """Frames a minute and video of a stream (video, ts), in append mode as the watermark passes."""
    return frames.withWatermark("ts", late).groupBy(F.window("ts", "1 minute"), "video").agg(F.count("*").alias("frames")).select(F.col("window.start").alias("minute"), "video", "frames")
