"""Queries on bar tables: ranges, latest rows, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.timeutil import interval_ms

_BARS = ("timestamp_dt", "ts_ms", "open", "high", "low", "close")


def _aligned(bars: DataFrame, interval: str) -> DataFrame:
    """Windows that follow each other without overlap."""
    return bars.where(F.col("ts_ms") % interval_ms(interval) == 0)


def _with_start(bars: DataFrame, interval: str, keys: tuple[str, ...] = ()) -> DataFrame:
    start = F.timestamp_millis(F.col("ts_ms") - interval_ms(interval)).cast("timestamp_ntz")
    return bars.select(*keys, start.alias("time"), *_BARS)


def ohlc_range(bars: DataFrame, interval: str, start: str, end: str, limit: int | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """Aligned bars that end from start to end, both included, in order; ``time`` is a bar's start. ``limit`` counts for each key."""
    inside = _aligned(bars, interval).where(F.col("timestamp_dt").between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")))
    if keys:
        return _with_start(_first(inside, keys, F.col("ts_ms"), limit).orderBy(*keys, "ts_ms"), interval, keys)
    inside = inside.orderBy("ts_ms")
    return _with_start(inside.limit(limit) if limit else inside, interval)


def _first(bars: DataFrame, keys: tuple[str, ...], order: Column, n: int | None) -> DataFrame:
    """The first n rows of each key, or all."""
    if not n:
        return bars
    return bars.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).where(F.col("_rank") <= n).drop("_rank")


def latest(bars: DataFrame, interval: str, n: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """The last n aligned bars (of each key), oldest first."""
    if keys:
        return _with_start(_first(_aligned(bars, interval), keys, F.desc("ts_ms"), n).orderBy(*keys, "ts_ms"), interval, keys)
    return _with_start(_aligned(bars, interval).orderBy(F.desc("ts_ms")).limit(n).orderBy("ts_ms"), interval)


def date_range(bars: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    return bars.groupBy(*keys).agg(F.min("timestamp_dt").alias("first_record"), F.max("timestamp_dt").alias("last_record"))


def statistics(bars: DataFrame, interval: str, keys: tuple[str, ...] = ()) -> DataFrame:
    return _aligned(bars, interval).groupBy(*keys).agg(F.count(F.lit(1)).alias("total_records"), F.min("timestamp_dt").alias("first_record"), F.max("timestamp_dt").alias("last_record"), F.min("low").alias("all_time_low"), F.max("high").alias("all_time_high"))


def change(bars: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Last close against first open (of each key), absolute and in per cent (null if the open is 0), and the extremes."""
    out = bars.groupBy(*keys).agg(F.max_by("close", "ts_ms").alias("close"), F.min_by("open", "ts_ms").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"))
    diff = F.col("close") - F.col("open")
    return out.select(*keys, "close", "open", "high", "low", diff.alias("change_abs"), (F.try_divide(diff, F.col("open")) * 100).alias("change_pct"))
