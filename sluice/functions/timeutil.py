"""Intervals, five-minute boundaries and hop windows over epoch milliseconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEP_MS = 300_000
INTERVALS = ("5m", "15m", "1h", "4h", "1d")
_UNITS = {"m": 60_000, "h": 3_600_000, "d": 86_400_000}


def interval_ms(interval: str) -> int:
    """Milliseconds of an interval such as 15m, 4h or 1d; other units raise ValueError."""
    if not interval[:-1].isdigit() or interval[-1:] not in _UNITS:
        raise ValueError(f"not an interval: {interval!r}")
    return int(interval[:-1]) * _UNITS[interval[-1]]


def floor_to(t: Column, step_ms: int) -> Column:
    """Start of the step that holds t."""
    return t - F.pmod(t, F.lit(step_ms))


def next_boundary(t: Column, step_ms: int = STEP_MS) -> Column:
    """First boundary after t."""
    return floor_to(t, step_ms) + step_ms


def _ends(lo: Column, hi: Column, step_ms: int, first_end: int | None, last_end: int | None) -> Column:
    lo = lo if first_end is None else F.greatest(lo, F.lit(first_end))
    hi = hi if last_end is None else F.least(hi, F.lit(last_end))
    return F.when(lo <= hi, F.sequence(lo, hi, F.lit(step_ms))).otherwise(F.array().cast("array<bigint>"))


def expand_windows(df: DataFrame, time: Column, interval: str, step_ms: int = STEP_MS, first_end: int | None = None, last_end: int | None = None) -> DataFrame:
    """One row for each window [end - interval, end) that holds the row, with its end as ``ts_ms``.

    A row stands in interval / step windows. Ends are cut to first_end..last_end before any row is made.
    """
    lo, hi = floor_to(time, step_ms) + step_ms, floor_to(time + interval_ms(interval), step_ms)
    return df.withColumn("ts_ms", F.explode(_ends(lo, hi, step_ms, first_end, last_end)))


#: Windows of more panes than this are put together from blocks of so many panes and single panes at their edges.
BLOCK = 12


def with_units(df: DataFrame, time: Column, interval: str, step_ms: int = STEP_MS) -> DataFrame:
    """Each row once for the pane that holds it and, for windows of more than BLOCK panes, once for the aligned block of panes.

    ``unit`` is the unit's length in ms, ``unit_end`` its end. Aggregates by unit are what cover_windows takes.
    """
    sizes = [step_ms] if interval_ms(interval) <= BLOCK * step_ms else [step_ms, BLOCK * step_ms]
    rows = df.withColumn("unit", F.explode(F.array(*[F.lit(s).cast("bigint") for s in sizes])))
    return rows.withColumn("unit_end", time - F.pmod(time, F.col("unit")) + F.col("unit"))


def cover_windows(units: DataFrame, interval: str, step_ms: int = STEP_MS, first_end: int | None = None, last_end: int | None = None) -> DataFrame:
    """One row for each window and unit of its cover, with the window's end as ``ts_ms``.

    A window's cover has each of its panes once: whole blocks inside it, and the panes that stand in no such block.
    A day is 24 blocks, or 23 and 12 panes, in place of 288 panes.
    """
    span, block, end = interval_ms(interval), BLOCK * step_ms, F.col("unit_end")
    ends = lambda lo, hi: _ends(lo, hi, step_ms, first_end, last_end)
    if span <= block:
        return units.withColumn("ts_ms", F.explode(ends(end, end + (span - step_ms))))
    block_end = end + F.pmod(-end, F.lit(block))
    edge = F.concat(ends(end, block_end - step_ms), ends(block_end + (span - block + step_ms), end + (span - step_ms)))
    return units.withColumn("ts_ms", F.explode(F.when(F.col("unit") == block, ends(end, end + (span - block))).otherwise(edge)))


def wall_clock(ts_ms: Column) -> Column:
    """UTC wall clock of epoch milliseconds, without zone."""
    return F.timestamp_millis(ts_ms).cast("timestamp_ntz")


def with_previous(df: DataFrame, keys: list[str], time: str, order: list[str], values: dict[str, str], bucket_ms: int = 3_600_000) -> DataFrame:
    """Adds the values of the row before, in order within the keys, over the whole history.

    Rows are ordered within time buckets, so a busy key is spread over many tasks. Only one row a bucket
    meets its neighbours to bridge the buckets' edges.
    """
    from pyspark.sql import Window

    bucketed = df.withColumn("_bucket", F.floor(F.col(time) / bucket_ms))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    packed = F.struct(*[F.col(c).alias(n) for n, c in values.items()])
    lasts = bucketed.groupBy(*keys, "_bucket").agg(F.max_by(packed, F.struct(*order)).alias("_last"))
    edges = lasts.withColumn("_edge", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_bucket"))).select(*keys, "_bucket", "_edge")
    joined = bucketed.withColumn("_own", F.lag(packed).over(inside)).join(edges, [*keys, "_bucket"], "left")
    before = F.coalesce("_own", "_edge")
    return joined.select(*df.columns, *[before[n].alias(n) for n in values])
