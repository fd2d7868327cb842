"""Recent rows of a stream as keyed state: one list a symbol and pane of five minutes, kept for a while, and given out whole when it changes."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import LongType, StructField, StructType

from sluice.functions.timeutil import next_boundary

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class PaneRows(StatefulProcessor):
    """The rows of one pane, of equal keys the latest to come. A timer at the pane's end clears it, once the watermark is there."""

    def __init__(self, schema: StructType, keys: list[str]) -> None:
        self.schema, self.keys = schema, keys

    def init(self, handle) -> None:
        self.handle, self.rows = handle, handle.getListState("rows", self.schema)

    def _held(self, parts: list[pd.DataFrame], pane: int) -> pd.DataFrame:
        names = self.schema.names
        old = pd.DataFrame(list(self.rows.get()), columns=names).astype(object)
        new = pd.concat([old, *[p[names].astype(object) for p in parts]]).drop_duplicates(self.keys, keep="last")
        new = new.where(new.notna(), None)
        self.rows.put([tuple(r) for r in new.itertuples(index=False)])
        self.handle.registerTimer(pane)
        return new

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self._held([initialState], int(key[1]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self._held(list(rows), int(key[1]))
        yield held.assign(pane=int(key[1]))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.rows.clear()
        return iter([])

    def close(self) -> None:
        pass


def in_panes(rows: DataFrame, time: str) -> DataFrame:
    """With the end of each row's pane."""
    return rows.withColumn("pane", next_boundary(F.col(time)))


def changed_panes(stream: DataFrame, keys: list[str], time: str, keep_ms: int, initial: DataFrame | None = None) -> DataFrame:
    """All rows of the panes in which a trigger changes something: the stream's columns and ``pane``.

    ``stream`` has symbol and ``time`` (ms). Rows that lie more than ``keep_ms`` behind the newest one seen before are dropped, and so is
    the state of their panes. ``initial`` are rows that are known from before (of a table, say): they are in the state from the start, but given
    out only when their pane changes. State is spread by symbol and pane, so a busy symbol is in many tasks.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    timed = in_panes(stream, time).withColumn("_time", F.timestamp_millis(time)).withWatermark("_time", f"{keep_ms} milliseconds")
    schema = stream.schema
    known = None if initial is None else in_panes(initial.select(*schema.names), time).groupBy("symbol", "pane")
    out = StructType([*schema.fields, StructField("pane", LongType())])
    return timed.groupBy("symbol", "pane").transformWithStateInPandas(PaneRows(schema, keys), out, "append", "EventTime", known)
