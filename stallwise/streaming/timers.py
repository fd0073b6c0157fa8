"""Timer figures per window and metric on a stream, by a mergeable buffer of the last values in keyed state.

State of a (window, name) is the last KEPT samples along (ts, seq), whatever their number: buffers merge by keeping the
last KEPT of both. An event-time timer at the window's end plus the delay gives the figures out and drops the buffer.
Map tasks reduce their rows to such buffers before the shuffle, so a metric that nearly all samples belong to sends at
most KEPT rows per Arrow batch.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from stallwise.operators.metrics import TIMER_VALUES

FIGURES = "window_at long, name string, count long, avg double, min double, max double, p95 double"


def figures(values: list[float]) -> dict[str, float]:
    """Count, average, least, greatest and the 95th percentile (the greatest, for 20 values or fewer)."""
    ordered = sorted(values)
    n = len(ordered)
    return {
        "count": n, "avg": math.fsum(ordered) / n, "min": ordered[0], "max": ordered[-1],
        "p95": ordered[int(n * 0.95)] if n > 20 else ordered[-1],
    }


class LastValues(StatefulProcessor):
    def __init__(self, width: int, kept: int) -> None:
        self.width, self.kept = width, kept

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buffer = handle.getListState("buffer", "at long, seq long, value double")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = [tuple(r) for r in self.buffer.get()]
        if not held:
            # Rows of a window are late, and dropped, once the watermark has passed it.
            self.handle.registerTimer((key[0] + self.width) // 1000)
        held += [(r["at"], r["seq"], r["value"]) for r in rows]
        self.buffer.put(sorted(held)[-self.kept :])
        return iter([])

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        values = [r[2] for r in self.buffer.get()]
        self.buffer.clear()
        if values:
            yield Row(window_at=key[0], name=key[1], **figures(values))


def last_of_batch(timers: DataFrame, width: int, kept: int) -> DataFrame:
    """(window_at, name, at, seq, value, ends): of each Arrow batch, the last `kept` rows per window and name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, seq = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("at", "seq"))
            window = at - at % width
            name, _ = pd.factorize(batch.column("name").to_pandas(), use_na_sentinel=False)
            order = np.lexsort((seq, at, name, window))
            group = np.cumsum(np.append(0, (np.diff(window[order]) != 0) | (np.diff(name[order]) != 0))) if len(at) else at
            after = np.searchsorted(group, group, "right") - np.arange(len(group))
            picked = order[after <= kept]
            columns = [pa.array(window[picked]), *(batch.column(c).take(pa.array(picked)) for c in ("name", "at", "seq", "value"))]
            yield pa.RecordBatch.from_arrays(columns, ["window_at", "name", "at", "seq", "value"])

    return timers.mapInArrow(run, "window_at long, name string, at long, seq long, value double")


def timer_windows(stream: DataFrame, delay: str = "1 hour", seconds: int = 3600, kept: int = TIMER_VALUES) -> DataFrame:
    """(window_start, window_end, name, count, avg, min, max, p95) over each window's last `kept` timer samples.

    A window is given out once the watermark, `delay` behind the latest sample, has passed its end. Samples without time
    or value are left out. To be started within `silence.keyed_state`.
    """
    width = seconds * 1_000_000
    timers = stream.where("type = 'timer' and ts is not null and value is not null").select(
        "name", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), F.col("seq").cast("long").alias("seq"), F.col("value").cast("double").alias("value")
    )
    slim = last_of_batch(timers, width, kept).withColumn("time", F.timestamp_micros("at")).withWatermark("time", delay)
    found = slim.groupBy("window_at", "name").transformWithState(LastValues(width, kept), FIGURES, "append", "EventTime")
    start, end = F.timestamp_micros("window_at"), F.timestamp_micros(F.col("window_at") + width)
    return found.select(start.alias("window_start"), end.alias("window_end"), "name", "count", "avg", "min", "max", "p95")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
