"""Hygiene of raw tables: duplicates, misplaced rows, gaps, completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Milliseconds without rows that make a gap.
GAP_MS = {"trades": 60_000, "klines": 90_000, "funding": 43_200_000}


def keep_one(df: DataFrame, keys: list[str], order: list[str], last: bool = True, within: list[str] | None = None) -> DataFrame:
    """One row for each key, the last (or first) in order; ``within`` confines it to a file or date."""
    rank = Window.partitionBy(*(within or []), *keys).orderBy(*[F.desc(c) if last else F.asc(c) for c in order])
    return df.withColumn("_rank", F.row_number().over(rank)).where("_rank = 1").drop("_rank")


def duplicate_report(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """For each file or symbol: duplicated keys, their rows, and the rows too many."""
    groups = df.groupBy(*by, *keys).count().where("count > 1")
    return groups.groupBy(*by).agg(F.count(F.lit(1)).alias("duplicate_keys"), F.sum("count").alias("rows"), (F.sum("count") - F.count(F.lit(1))).alias("extra_rows"))


def period_label(time: Column, period: str = "day") -> Column:
    """UTC day (yyyy-MM-dd) or month (yyyy-MM) of epoch milliseconds."""
    return F.date_format(F.timestamp_millis(time), {"day": "yyyy-MM-dd", "month": "yyyy-MM"}[period])


def rearrange(df: DataFrame, time: str, claimed: str, period: str = "day") -> DataFrame:
    """All rows under the period of their event time; ``moved`` tells which stood elsewhere."""
    label = period_label(F.col(time), period)
    return df.withColumn("moved", ~F.col(claimed).eqNullSafe(label)).withColumn(claimed, label)


def misplaced_counts(df: DataFrame, time: str, claimed: str, period: str = "day") -> DataFrame:
    """(claimed, target, count) of the rows that stand in a wrong file."""
    target = period_label(F.col(time), period)
    return df.where(~F.col(claimed).eqNullSafe(target)).groupBy(claimed, target.alias("target")).count()


def _gap(start: Column, end: Column, kind: str) -> list[Column]:
    return [F.lit(kind).alias("type"), (start + 1).alias("start"), (end - 1).alias("end"), ((end - start) / 3_600_000).alias("duration_hours")]


def internal_gaps(df: DataFrame, time: str, threshold_ms: int, by: list[str]) -> DataFrame:
    """Gaps between neighbouring rows inside a file (``by``: symbol and date)."""
    rows = df.select(*by, F.col(time).alias("t"))
    pairs = rows.withColumn("next", F.lead("t").over(Window.partitionBy(*by).orderBy("t")))
    return pairs.where(F.col("next") - F.col("t") > threshold_ms).select(*by, *_gap(F.col("t"), F.col("next"), "internal"))


def boundary_gaps(df: DataFrame, time: str, threshold_ms: int, keys: list[str], date: str) -> DataFrame:
    """Gaps between the last row of a file and the first of the next one; one row a file is gathered first."""
    files = df.groupBy(*keys, date).agg(F.min(time).alias("lo"), F.max(time).alias("hi"))
    nxt = Window.partitionBy(*keys).orderBy(date)
    pairs = files.withColumn("next_lo", F.lead("lo").over(nxt)).withColumn("next_date", F.lead(date).over(nxt))
    return pairs.where(F.col("next_lo") - F.col("hi") > threshold_ms).select(*keys, F.col(date).alias("after"), F.col("next_date").alias("before"), *_gap(F.col("hi"), F.col("next_lo"), "boundary"))


def gap_counts(gaps: DataFrame) -> DataFrame:
    return gaps.groupBy("type").agg(F.count(F.lit(1)).alias("gaps"), F.sum("duration_hours").alias("hours"))


def complete_days(df: DataFrame, by: list[str], rows: int = 1440) -> DataFrame:
    """Files and whether they hold exactly the expected number of rows."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).withColumn("complete", F.col("n") == rows)


def missing_dates(existing: DataFrame, date: str, first: str, last: str, period: str = "day") -> DataFrame:
    """Periods from first to last without a file."""
    every = F.expr(f"sequence(date'{first}', date'{last}', interval 1 {period})")
    wanted = existing.sparkSession.range(1).select(F.explode(every).alias("d")).select(F.date_format("d", {"day": "yyyy-MM-dd", "month": "yyyy-MM"}[period]).alias(date))
    return wanted.join(existing.select(date).distinct(), date, "left_anti")


def _judged(raw: DataFrame, columns: dict[str, Column], needed: list[str]) -> DataFrame:
    """The raw columns (as ``raw``), the parsed ones, and ``reason``: the first needed column that doesn't parse, null of good rows."""
    reason = F.coalesce(*[F.when(columns[c].isNull(), F.lit(c)) for c in needed])
    return raw.select(F.struct(*[F.col(f"`{c}`") for c in raw.columns]).alias("raw"), *[x.alias(c) for c, x in columns.items()], reason.alias("reason"))


def judged_trades(raw: DataFrame) -> DataFrame:
    """Trades from an exchange's strings (instId, tradeId, side, px, sz, ts), good and bad: see _judged."""
    columns = {"instrument_name": F.col("instId"), "trade_id": F.col("tradeId").try_cast("bigint"), "side": F.col("side"), "price": F.col("px").try_cast("double"), "size": F.col("sz").try_cast("double"), "created_time": F.col("ts").try_cast("bigint")}
    return _judged(raw, columns, ["trade_id", "price", "size", "created_time"])


def judged_klines(raw: DataFrame, column: str = "candle") -> DataFrame:
    """Bars from arrays [ts, open, high, low, close, ..] of strings, good and bad."""
    names = ["open_time", "open", "high", "low", "close"]
    return _judged(raw, {n: F.get(column, F.lit(k)).try_cast("bigint" if k == 0 else "double") for k, n in enumerate(names)}, names)


def judged_funding(raw: DataFrame) -> DataFrame:
    """Rates from strings (instId, fundingRate, fundingTime), good and bad."""
    columns = {"instrument_name": F.col("instId"), "funding_rate": F.col("fundingRate").try_cast("double"), "funding_time": F.col("fundingTime").try_cast("bigint")}
    return _judged(raw, columns, ["funding_rate", "funding_time"])


def accepted(judged: DataFrame) -> DataFrame:
    """Good rows, parsed."""
    return judged.where("reason IS NULL").drop("raw", "reason")


def rejected(judged: DataFrame) -> DataFrame:
    """(reason, raw) of the rows that don't parse, as JSON."""
    return judged.where("reason IS NOT NULL").select("reason", F.to_json("raw").alias("raw"))


def normalise_trades(raw: DataFrame) -> DataFrame:
    """Trades from an exchange's strings; rows that don't parse are left out (see rejected)."""
    return accepted(judged_trades(raw))


def normalise_klines(raw: DataFrame, column: str = "candle") -> DataFrame:
    """Bars from arrays of strings; rows that don't parse are left out."""
    return accepted(judged_klines(raw, column))


def normalise_funding(raw: DataFrame) -> DataFrame:
    """Rates from strings; rows that don't parse are left out."""
    return accepted(judged_funding(raw))
