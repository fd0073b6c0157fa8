"""Alerts for keys that fall silent, by keyed state and event-time timers.

Each key's state is a short list of spells: stretches of activity without a gap above the limit. Rows that come out of
order extend, open or join spells. One timer per key stands at the end of its first spell's grace; when the watermark
passes it, the spell raises its alert and leaves the state. So a silence alerts once, while it lasts, and the key is
armed again by its next row. State holds the spells that can still change: about delay / limit + 2 per key.

Map tasks merge their rows to spells before the shuffle, so a key that a third of all rows share sends a few rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructType

from stallwise import schemas

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HOUR = 3_600_000_000

Spell = tuple[int, int, int]


def joined(spells: list[Spell], longest: int) -> list[Spell]:
    """Spells (first, last, rows) in order, those with gaps of up to `longest` made one."""
    out: list[Spell] = []
    for first, last, n in sorted(spells):
        if out and first - out[-1][1] <= longest:
            out[-1] = (out[-1][0], max(out[-1][1], last), out[-1][2] + n)
        else:
            out.append((first, last, n))
    return out


class SilenceWatch(StatefulProcessor):
    def __init__(self, key: str, longest: int) -> None:
        self.key, self.longest = key, longest

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spells = handle.getListState("spells", "first long, last long, n long")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = [(r["first"], r["last"], r["n"]) for r in rows] + [tuple(s) for s in self.spells.get()]
        return self.settled(key, joined(held, self.longest), timerValues)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return self.settled(key, [tuple(s) for s in self.spells.get()], timerValues)

    def settled(self, key: tuple, spells: list[Spell], timerValues) -> Iterator[Row]:
        """Raise the alerts that are due, keep the other spells and move the timer to the first of them."""
        # A row at the very end of the grace still keeps the spell alive.
        due = [self.longest + last < timerValues.getCurrentWatermarkInMs() * 1000 for _, last, _ in spells]
        kept = [s for s, over in zip(spells, due) if not over]
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if kept:
            self.spells.put(kept)
            self.handle.registerTimer((kept[0][1] + self.longest) // 1000 + 1)
        else:
            self.spells.clear()
        for (first, last, n), over in zip(spells, due):
            if over:
                yield Row(**{self.key: key[0], "first": first, "last": last, "n": n})


def merged(stream: DataFrame, key: str, longest: int) -> DataFrame:
    """(key, first, last, n): each task's rows (key, ts) as spells, times as microseconds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(1).to_numpy(zero_copy_only=False)
            code, _ = pd.factorize(batch.column(0).to_pandas(), use_na_sentinel=False)
            order = np.lexsort((at, code))
            at, code = at[order], code[order]
            opens = np.ones(len(at), bool)
            opens[1:] = (np.diff(code) != 0) | (np.diff(at) > longest)
            starts = np.flatnonzero(opens)
            ends = np.append(starts[1:], len(at)) - 1
            columns = [batch.column(0).take(pa.array(order[starts])), *(pa.array(x, pa.int64()) for x in (at[starts], at[ends], ends - starts + 1))]
            yield pa.RecordBatch.from_arrays(columns, [key, "first", "last", "n"])

    timed = stream.where("ts is not null").select(F.col(key), F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    schema = StructType([timed.schema[key]])
    for name in ("first", "last", "n"):
        schema = schema.add(name, LongType())
    return timed.mapInArrow(run, schema)


def silence_alerts(stream: DataFrame, key: str, delay: str = "1 hour", hours: int = schemas.STALE_HOURS) -> DataFrame:
    """(key, first_seen, last_seen, rows, alert_at): one row for each silence of more than `hours`, when it is that old.

    `stream` has `key` and `ts`. Rows up to `delay` behind the latest one count wherever they belong; rows without a
    time are left out; rows without a key are a key of their own. To be started within `keyed_state`.
    """
    longest = hours * HOUR
    spells = merged(stream, key, longest).withColumn("at", F.timestamp_micros("last")).withWatermark("at", delay)
    schema = StructType([stream.schema[key]])
    for name in ("first", "last", "n"):
        schema = schema.add(name, LongType())
    alerts = spells.groupBy(key).transformWithState(SilenceWatch(key, longest), schema, "append", "EventTime")
    return alerts.select(
        key, F.timestamp_micros("first").alias("first_seen"), F.timestamp_micros("last").alias("last_seen"), F.col("n").alias("rows"),
        F.timestamp_micros(F.col("last") + longest).alias("alert_at"),
    )


@contextmanager
def keyed_state(spark: SparkSession, more: dict[str, str] | None = None):
    """Within it, streams start with the state store that keyed state and timers need; the session is left as it was."""
    wanted = {PROVIDER: ROCKS} | (more or {})
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
