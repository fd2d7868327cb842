"""Bar features over hop windows, from five-minute panes and hour blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions import stats as S
from sluice.functions.timeutil import BLOCK, STEP_MS, cover_windows, expand_windows, interval_ms, next_boundary, wall_clock


def kline_panes(klines: DataFrame, time: str = "close_time") -> DataFrame:
    """One row for each symbol and pane with bars: first, last, high, low, n, m, m2 (closes: number, mean, sum of squares around it).

    ``klines`` has symbol, open_time (ms), open, high, low, close. A bar counts at its close, a minute after open_time; ``time="open_time"``
    counts it at its open.
    """
    bars = klines.withColumn("close_time", F.col("open_time") + 60_000)
    order = F.struct(time, "open_time", "close", "open")
    panes = bars.withColumn("pane", next_boundary(F.col(time))).groupBy("symbol", "pane").agg(
        F.min(F.struct(order.alias("o"), F.col("open").alias("v"))).alias("first"), F.max(F.struct(order.alias("o"), F.col("close").alias("v"))).alias("last"),
        F.max("high").alias("high"), F.min("low").alias("low"), F.count("close").alias("n"), F.avg("close").alias("m"), (F.var_pop("close") * F.count("close")).alias("m2"),
    )
    return panes.withColumn("first", F.col("first.v")).withColumn("last", F.col("last.v"))


def _joined(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Panes or blocks put together; ``centre`` is near all closes, so that squares don't cancel. A unit's end orders its first and last bar, so buffers have fixed width."""
    n, d = F.col("n"), F.col("m") - F.col("centre")
    sums = rows.groupBy(*keys).agg(
        F.min_by("first", "unit_end").alias("first"), F.max_by("last", "unit_end").alias("last"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.sum("n").alias("n"), F.sum(n * d).alias("s1"), F.sum(F.col("m2") + n * d * d).alias("s2"), F.first("centre").alias("centre"),
    )
    spread = F.greatest(F.lit(0.0), F.col("s2") - F.try_divide(F.col("s1") * F.col("s1"), F.col("n")))
    return sums.withColumn("m", F.when(F.col("n") > 0, F.col("centre") + F.try_divide("s1", "n"))).withColumn("m2", F.coalesce(spread, F.lit(0.0))).drop("s1", "s2")


def windows_of_panes(panes: DataFrame, interval: str, first_end: int | None = None, last_end: int | None = None) -> DataFrame:
    """One row for each symbol and window over panes with bars; beyond an hour windows are made of hour blocks and the panes at their edges."""
    centre = panes.groupBy("symbol").agg(F.avg("m").alias("centre"))
    units = panes.join(centre, "symbol").withColumn("unit_end", F.col("pane")).withColumn("unit", F.lit(STEP_MS).cast("bigint"))
    block = BLOCK * STEP_MS
    if interval_ms(interval) > block:
        whole = _joined(units.withColumn("block", F.col("pane") + F.pmod(-F.col("pane"), F.lit(block))), ["symbol", "block"])
        units = units.drop("pane").unionByName(whole.withColumnRenamed("block", "unit_end").withColumn("unit", F.lit(block).cast("bigint")))
    merged = _joined(cover_windows(units, interval, STEP_MS, first_end, last_end), ["symbol", "ts_ms"])
    return merged.where(F.col("first").isNotNull()).select(
        "symbol", wall_clock(F.col("ts_ms")).alias("timestamp_dt"), "ts_ms", F.col("first").alias("open"), "high", "low", F.col("last").alias("close"),
        F.col("m").alias("mean"), F.when(F.col("n") > 1, F.sqrt(F.try_divide(F.col("m2"), F.col("n") - 1))).alias("std"),
    )


def kline_windows(klines: DataFrame, interval: str, time: str = "close_time", first_end: int | None = None, last_end: int | None = None) -> DataFrame:
    """One row for each symbol and window with bars: open, high, low, close, mean and std of close. Bars are as in kline_panes."""
    return windows_of_panes(kline_panes(klines, time), interval, first_end, last_end)


def kline_windows_direct(klines: DataFrame, interval: str, time: str = "close_time") -> DataFrame:
    """The same from the bars themselves, as a check on the panes."""
    bars = expand_windows(klines.withColumn("close_time", F.col("open_time") + 60_000), F.col(time), interval)
    order = F.struct(time, "open_time", "close", "open")
    return bars.groupBy("symbol", "ts_ms").agg(S.first_by(F.col("open"), order).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), S.last_by(F.col("close"), order).alias("close"), F.avg("close").alias("mean"), F.stddev_samp("close").alias("std"))
