"""The selection of the sharpest frames over a stream of candidates."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from waymark.streaming.queue import keyed_state

CHOSEN = "video string, seg int, i bigint, dist double, sharp double"


class FrameSelector(StatefulProcessor):
    """A video's mark, the window's sharpest candidate so far, and the place (seg, i) that the fold has come to."""

    def __init__(self, spacing: float):
        self.spacing = spacing

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.track = handle.getValueState("track", "mark double, open boolean, seg int, i bigint, dist double, sharp double, at_seg int, at_i bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        mark, open_, *best, at_seg, at_i = self.track.get() if self.track.exists() else (0.0, False, 0, 0, 0.0, 0.0, -(1 << 31), -1)
        part = pd.concat(list(rows)).sort_values(["seg", "i"], kind="stable")
        chosen = []
        for r in zip(part["seg"].tolist(), part["i"].tolist(), part["dist"].tolist(), part["sharp"].tolist()):
            if r[:2] <= (at_seg, at_i):
                continue
            at_seg, at_i = r[:2]
            # NaN, as pandas has nulls, is never sharper and never reaches the mark.
            if not open_ or best[0] != r[0] or r[3] > best[3]:
                open_, best = True, list(r)
            if r[2] >= mark:
                chosen.append((key[0], *best))
                mark, open_ = r[2] + self.spacing, False
        self.track.update((float(mark), bool(open_), int(best[0]), int(best[1]), float(best[2]), float(best[3]), int(at_seg), int(at_i)))
        yield pd.DataFrame(chosen, columns=["video", "seg", "i", "dist", "sharp"])

    def close(self) -> None:
        pass


def select_stream(candidates: DataFrame, spacing: float) -> DataFrame:
    """(video, seg, i, dist, sharp): select_frames() over a stream of candidates of those columns, in append mode.

    Eight numbers a video outlive batches and segments; a batch holds a video's new candidates, some minutes of it, and nothing else. The fold
    goes forward only: a candidate at or before the place (seg, i) that its video has come to is late and left out, as is the
    repetition of one. Candidates without seg or i take no part; one without a distance reaches no mark, one without a sharpness is never sharper.
    """
    keyed_state(candidates.sparkSession)
    own = candidates.where("video is not null and seg is not null and i is not null").select("video", F.col("seg").cast("int").alias("seg"), F.col("i").cast("bigint").alias("i"), F.col("dist").cast("double").alias("dist"), F.col("sharp").cast("double").alias("sharp"))
    return own.groupBy("video").transformWithStateInPandas(FrameSelector(spacing), CHOSEN, "Append", "None")
