"""Order books rebuilt from snapshot and update messages."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

MINUTE, DAY = 60_000, 86_400_000
#: Levels a side that a snapshot keeps.
TOP = 50


def top_levels(levels, side: str, k: int = TOP):
    """The best k levels of a side from an array of (price, size): bids from the highest price, asks from the lowest; sizes above 0 only."""
    positive = F.filter(levels, lambda x: x["size"] > 0)
    return F.slice(F.sort_array(positive, asc=side == "ask"), 1, k)


#: Height of the tree over a day's minutes: nodes of 1 to 1,024 minutes.
HEIGHT = 11


def _books_of_nodes(held: DataFrame, top: int) -> DataFrame:
    """(symbol, dt, ts, asks, bids) of levels (symbol, dt, side, price, size) that are valid at the minutes from lo to hi (ms)."""
    minute = lambda c: ((F.col(c) - F.col("dt")) / MINUTE).cast("bigint")
    nodes = []
    for h in range(HEIGHT):
        size = 1 << h
        left, right = F.floor((minute("lo") + size - 1) / size), F.floor((minute("hi") + 1) / size)
        node = lambda n: F.struct(F.lit(h).alias("h"), n.alias("n"))  # noqa: B023, E731
        nodes += [F.when((left < right) & (left % 2 == 1), node(left)), F.when((left < right) & (right % 2 == 1), node(right - 1))]
    spread = held.select("symbol", "dt", "side", "price", "size", F.explode(F.array_compact(F.array(*nodes))).alias("node"))
    best = Window.partitionBy("symbol", "dt", "side", "node").orderBy(F.when(F.col("side") == "ask", F.col("price")).otherwise(-F.col("price")))
    kept = spread.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    lists = kept.groupBy("symbol", "dt", "side", "node").agg(F.collect_list(F.struct("price", "size")).alias("levels"))
    size = F.expr("shiftleft(1L, node.h)")
    minutes = F.sequence(F.col("node.n") * size, F.least((F.col("node.n") + 1) * size - 1, F.lit(DAY // MINUTE - 1)))
    at = lists.select("symbol", "dt", "side", "levels", F.explode(minutes).alias("m"))
    return at.groupBy("symbol", "dt", (F.col("dt") + F.col("m") * MINUTE).alias("ts")).agg(*[top_levels(F.flatten(F.collect_list(F.when(F.col("side") == s, F.col("levels")))), s, top).alias(f"{s}s") for s in ("ask", "bid")])


def minute_books(messages: DataFrame, top: int = TOP) -> DataFrame:
    """(symbol, dt, ts, asks, bids): 1,440 books a day, each made of the messages before its minute.

    ``messages`` has symbol, ts (ms), seq (orders messages of one instant), action, bids and asks (arrays of
    (price, size)). A snapshot replaces the book, an update sets levels or deletes those of size 0. Minutes
    before the first book hold the first one; a day without a snapshot in time has none.

    A level is valid from its message to the next one for its price or the next snapshot. The minutes it covers are at most 20 nodes of a binary
    tree over the day's minutes; a node keeps its ``top`` best levels a side, and a minute's book comes from the eleven nodes above it. So
    a level that stands all day costs a few rows and not 1,440, a book is never gathered whole, and nothing runs through the messages in order.
    """
    day = F.floor(F.col("ts") / DAY) * DAY
    rows = messages.withColumn("dt", day)
    # the next snapshot, as a running least value from the day's end: a frame that grows row by row
    after = Window.partitionBy("symbol", "dt").orderBy(F.desc("ts"), F.desc("seq")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("reset", F.min(F.when(F.col("action") == "snapshot", F.struct("ts", "seq"))).over(after))
    sides = [rows.select("symbol", "dt", "ts", "seq", "reset", "action", F.lit(s).alias("side"), F.explode(c).alias("l")) for s, c in (("bid", "bids"), ("ask", "asks"))]
    levels = sides[0].unionByName(sides[1]).select("symbol", "dt", "ts", "seq", "reset", "action", "side", F.col("l.price").alias("price"), F.col("l.size").alias("size")).where("price is not null and size is not null")
    # of levels that a message names twice, the last counts; the source order inside a message is its array order
    same_price = Window.partitionBy("symbol", "dt", "side", "price").orderBy("ts", "seq")
    end = F.least(F.lead(F.struct("ts", "seq")).over(same_price), F.col("reset"))
    valid = levels.withColumn("end", F.coalesce(end["ts"], F.col("dt") + DAY)).where("size > 0")
    first = F.floor(F.col("ts") / MINUTE) * MINUTE + MINUTE
    last = F.least(F.floor(F.col("end") / MINUTE) * MINUTE, F.col("dt") + DAY - MINUTE)
    begins = rows.where(F.col("action") == "snapshot").groupBy("symbol", "dt").agg((F.floor(F.min("ts") / MINUTE) * MINUTE + MINUTE).alias("begin")).where(F.col("begin") < F.col("dt") + DAY)
    held = valid.join(begins, ["symbol", "dt"]).withColumn("lo", F.greatest(first, F.col("begin"))).withColumn("hi", last).where("lo <= hi")
    books = _books_of_nodes(held, top)
    grid = begins.select("symbol", "dt", "begin", F.explode(F.sequence("dt", F.col("dt") + DAY - MINUTE, F.lit(MINUTE))).alias("minute")).withColumn("ts", F.greatest("minute", "begin"))
    none = F.array().cast("array<struct<price:double,size:double>>")
    return grid.join(books, ["symbol", "dt", "ts"], "left").select("symbol", "dt", F.col("minute").alias("ts"), F.coalesce("asks", none).alias("asks"), F.coalesce("bids", none).alias("bids"))


def minute_books_by_day(messages: DataFrame, top: int = TOP) -> DataFrame:
    """The same by running through each day's messages in order: a check on minute_books for days that fit a task."""
    level = "array<struct<price:double,size:double>>"

    def run(day: pd.DataFrame) -> pd.DataFrame:
        day = day.sort_values(["ts", "seq"], kind="stable")
        start = int(day["ts"].iloc[0]) // DAY * DAY
        book: dict[str, dict[float, float]] = {"bids": {}, "asks": {}}
        known, out, mark = False, [], start

        def shot() -> tuple[list, list]:
            return tuple([{"price": p, "size": book[s][p]} for p in sorted(book[s], reverse=s == "bids")[:top]] for s in ("asks", "bids"))

        for row in day.itertuples():
            while mark < start + DAY and mark <= row.ts:
                if known:
                    out.append((mark, *shot()))
                mark += MINUTE
            if row.action == "snapshot":
                book, known = {"bids": {}, "asks": {}}, True
            for side in ("bids", "asks"):
                for x in getattr(row, side):
                    if x["size"] > 0:
                        book[side][x["price"]] = x["size"]
                    else:
                        book[side].pop(x["price"], None)
        while known and mark < start + DAY:
            out.append((mark, *shot()))
            mark += MINUTE
        if out:
            out = [(m, *out[0][1:]) for m in range(start, out[0][0], MINUTE)] + out
        return pd.DataFrame({"symbol": day["symbol"].iloc[0], "dt": start, "ts": [x[0] for x in out], "asks": [x[1] for x in out], "bids": [x[2] for x in out]})

    rows = messages.withColumn("dt", F.floor(F.col("ts") / DAY))
    return rows.groupBy("symbol", "dt").applyInPandas(run, f"symbol string, dt bigint, ts bigint, asks {level}, bids {level}")


class LiveBook(StatefulProcessor):
    """One symbol's book as state, a row a price; a message touches its own levels alone."""

    def __init__(self, top: int, silent: bool) -> None:
        self.top, self.silent = top, silent

    def init(self, handle) -> None:
        self.handle = handle
        self.levels = handle.getMapState("levels", "side string, price double", "size double")
        self.minute = handle.getValueState("minute", "minute bigint")

    def _shot(self) -> tuple[list, list]:
        book: dict[str, list] = {"asks": [], "bids": []}
        for (side, price), (size,) in self.levels.iterator():
            book[side].append({"price": price, "size": size})
        return tuple(sorted(book[s], key=lambda x: x["price"], reverse=s == "bids")[: self.top] for s in ("asks", "bids"))

    def _frame(self, symbol: str, out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame({"symbol": [symbol] * len(out), "ts": [x[0] for x in out], "asks": [x[1] for x in out], "bids": [x[2] for x in out]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        minute, out = self.minute.get()[0] if self.minute.exists() else None, []
        for row in pd.concat(list(rows)).sort_values(["ts", "seq"], kind="stable").itertuples():
            now = int(row.ts) // MINUTE * MINUTE
            if minute is not None and now > minute:
                shot = self._shot()
                out += [(m, *shot) for m in range(minute, now if self.silent else minute + 1, MINUTE)]
            minute = now if minute is None else max(minute, now)
            for side in ("bids", "asks"):
                for x in getattr(row, side):
                    if x["size"] > 0:
                        self.levels.updateValue((side, float(x["price"])), (float(x["size"]),))
                    else:
                        self.levels.removeKey((side, float(x["price"])))
        self.minute.update((minute,))
        if self.silent:
            self.handle.registerTimer(minute + MINUTE)
        if out:
            yield self._frame(key[0], out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        minute, end = self.minute.get()[0], timerValues.getCurrentWatermarkInMs() // MINUTE * MINUTE
        if minute + MINUTE <= end:  # else messages have come since the timer was set
            shot = self._shot()
            yield self._frame(key[0], [(m, *shot) for m in range(minute, end, MINUTE)])
            self.minute.update((end,))
            self.handle.registerTimer(end + MINUTE)

    def close(self) -> None:
        pass


def live_books(messages: DataFrame, top: int = TOP, silent: bool = False, delay: str = "0 seconds") -> DataFrame:
    """(symbol, ts, asks, bids) of a stream of messages: a book at each minute that had messages.

    As a live feed does it: a minute's book holds the deltas through its end, is emitted when a message of a later
    minute comes, is labelled with the finished minute; a snapshot doesn't reset the book. With ``silent`` minutes without
    messages have a book too, and a minute is emitted as soon as event time, ``delay`` behind the newest message of any symbol, has passed it; messages
    later than that are dropped. State is a row for each price of a book. Messages come in order of ts, seq within a trigger.
    """
    messages.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    level = "array<struct<price:double,size:double>>"
    if silent:
        messages = messages.withColumn("_time", F.timestamp_millis("ts")).withWatermark("_time", delay)
    return messages.groupBy("symbol").transformWithStateInPandas(LiveBook(top, silent), f"symbol string, ts bigint, asks {level}, bids {level}", "append", "EventTime" if silent else "None")


def snapshot_rows(books: DataFrame) -> DataFrame:
    """Bronze rows (instId, action, ts, asks, bids) with sides as JSON arrays of [price, size]."""
    pairs = lambda c: F.to_json(F.transform(c, lambda x: F.array(x["price"], x["size"])))
    return books.select(F.col("symbol").alias("instId"), F.lit("snapshot").alias("action"), "ts", pairs("asks").alias("asks"), pairs("bids").alias("bids"))


def truncate_snapshots(raw: DataFrame, top: int = TOP) -> DataFrame:
    """Deep snapshots cut to the best levels: only snapshots with both sides are kept; sides are arrays of arrays."""
    kept = raw.where((F.col("action") == "snapshot") & (F.size("asks") > 0) & (F.size("bids") > 0))
    return kept.withColumn("asks", F.slice("asks", 1, top)).withColumn("bids", F.slice("bids", 1, top))
