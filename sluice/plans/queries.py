"""The market operators as queries over the tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.timeutil import INTERVALS
from sluice.operators import book, bronze, gold, serving, silver
from sluice.operators.klines import kline_windows
from sluice.operators.orderbook import book_features, book_windows
from sluice.operators.trades import trade_windows
from sluice.sources import fixtures as fx

SYMBOL = ("symbol",)
Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles to so many digits (after a small shift off the edges, no negative zero; milliseconds to one digit), plain names for quantiles."""
    kinds, cols = dict(df.dtypes), []
    for c in df.columns:
        x, n = F.col(f"`{c}`"), 1 if c.startswith("rate_") else digits
        cols.append((F.round(x + 1.3 * 10 ** -(n + 2), n) + 0.0 if kinds[c] == "double" else x).alias(c.replace("0.", "q")))
    return df.select(*cols)


def _klines(interval: str) -> Query:
    return lambda spark, d: rounded(kline_windows(fx.klines(spark, d), interval))


def _trades(interval: str, *groups: str) -> Query:
    def query(spark: SparkSession, d: str) -> DataFrame:
        return rounded(trade_windows(fx.trades(spark, d), interval, groups or ("volume", "ticks", "price", "size", "rate", "corr", "count")))

    return query


def ob_levels(spark, d):
    from sluice.operators.orderbook import levels

    both = levels(fx.order_books(spark, d))
    out = [both.select("id", "ts", F.lit(s).alias("side"), F.posexplode(f"{s}_float").alias("position", "l")) for s in ("bids", "asks")]
    return rounded(out[0].unionByName(out[1]).select("id", "ts", "side", "position", F.get("l", F.lit(0)).alias("price"), F.get("l", F.lit(1)).alias("size")))


def _features(books):
    keep = "best_bid best_ask sum_bid_50 sum_bid_20 sum_bid_5 sum_ask_50 sum_ask_20 sum_ask_5 bid_px_20 ask_px_20 total_money_bid_50 total_money_ask_50 total_money_50 total_depth_50 spread weighted_mid_price deep_imbalance concentration impact_slope_ask impact_slope_bid book_pressure".split()
    return rounded(book_features(books).select("id", "ts", *keep))


def ob_features(spark, d):
    return _features(fx.order_books(spark, d))


def ob_features_deep(spark, d):
    return _features(fx.deep_books(spark, d))


def _book_windows(interval: str, corr: bool) -> Query:
    def query(spark: SparkSession, d: str) -> DataFrame:
        out = book_windows(fx.order_books(spark, d), interval)
        picked = [c for c in out.columns if c.startswith("corr_") == corr and (corr or not c.startswith("timestamp")) or c in ("symbol", "ts_ms")]
        return rounded(out.select(*[F.col(f"`{c}`") for c in picked]))

    return query


def book_snapshots_minute(spark, d):
    books = book.minute_books(fx.book_messages(spark, d))
    text = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["price"].cast("bigint"), x["size"].cast("bigint"))), ",")
    return books.select("symbol", "ts", text("asks").alias("asks"), text("bids").alias("bids"))


def dedupe_keep_first(spark, d):
    return rounded(bronze.keep_one(fx.arrivals(spark, d), ["event_id"], ["arrival"], last=False))


def dedupe_keep_last(spark, d):
    return rounded(bronze.keep_one(fx.arrivals(spark, d), ["event_id"], ["arrival"], last=True))


def duplicate_report(spark, d):
    return bronze.duplicate_report(fx.arrivals(spark, d), ["event_id"], ["symbol"])


def rearrange_daily(spark, d):
    return rounded(bronze.rearrange(fx.misplaced(spark, d), "t", "dt"))


def rearrange_monthly(spark, d):
    return rounded(bronze.rearrange(fx.misplaced(spark, d).withColumn("dt", F.substring("dt", 1, 7)), "t", "dt", "month"))


def misplaced_counts(spark, d):
    return bronze.misplaced_counts(fx.misplaced(spark, d), "t", "dt")


def _dated(spark, d):
    return fx.trades(spark, d).withColumn("dt", bronze.period_label(F.col("created_time")))


def gaps_internal(spark, d):
    return rounded(bronze.internal_gaps(_dated(spark, d), "created_time", bronze.GAP_MS["trades"], ["symbol", "dt"]))


def gaps_boundary(spark, d):
    return rounded(bronze.boundary_gaps(_dated(spark, d), "created_time", bronze.GAP_MS["trades"], ["symbol"], "dt"))


def gap_counts(spark, d):
    dated = _dated(spark, d)
    both = bronze.internal_gaps(dated, "created_time", 60_000, ["symbol", "dt"]).drop("dt").unionByName(bronze.boundary_gaps(dated, "created_time", 60_000, ["symbol"], "dt").drop("after", "before"))
    return rounded(bronze.gap_counts(both), 2)


def normalised_trades(spark, d):
    return rounded(bronze.normalise_trades(fx.trade_messages(spark, d)))


def normalised_klines(spark, d):
    return rounded(bronze.normalise_klines(fx.candle_messages(spark, d)))


def normalised_funding(spark, d):
    return rounded(bronze.normalise_funding(fx.funding_messages(spark, d)), 8)


def rejected_messages(spark, d):
    """Messages that don't parse, counted by kind and reason."""
    judged = {"trade": bronze.judged_trades(fx.trade_messages(spark, d)), "candle": bronze.judged_klines(fx.candle_messages(spark, d)), "funding": bronze.judged_funding(fx.funding_messages(spark, d))}
    counts = [bronze.rejected(j).groupBy("reason").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(kind).alias("kind"), "reason", "rows") for kind, j in judged.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def truncated_snapshots(spark, d):
    """Deep books of one side alone, and of both, as messages: the ones with both sides, cut to fifty levels."""
    from sluice.operators.orderbook import parse_levels

    deep = fx.deep_books(spark, d).select("id", "ts", "action", F.when(F.col("id") % 7 != 0, parse_levels(F.col("asks"))).otherwise(F.array().cast("array<array<double>>")).alias("asks"), parse_levels(F.col("bids")).alias("bids"))
    kept = book.truncate_snapshots(deep)
    total = lambda c, k: F.aggregate(c, F.lit(0.0), lambda s, x: s + F.get(x, F.lit(k)))
    return rounded(kept.select("id", "ts", F.size("asks").alias("n_asks"), F.size("bids").alias("n_bids"), total("asks", 0).alias("ask_prices"), total("bids", 1).alias("bid_sizes")))


def pending_windows(spark, d):
    """Hours that the five-minute windows ask for and the hourly bars of U0 don't have."""
    hours = _bars_1h(spark, d).where("symbol = 'U0'")
    return silver.pending_ends(_bars_5m(spark, d).select("ts_ms"), hours.where("std IS NOT NULL"))


def complete_days(spark, d):
    return bronze.complete_days(fx.klines(spark, d).withColumn("dt", bronze.period_label(F.col("open_time"))), ["symbol", "dt"], 1440)


def _bars_5m(spark, d):
    return kline_windows(fx.klines(spark, d), "5m")


def silver_gaps_5m(spark, d):
    return silver.missing_ends(_bars_5m(spark, d), *fx.span(spark, d), "row_exists", SYMBOL)


def silver_gaps_1h_values(spark, d):
    """Hours that lack a row or any of its values (a deviation needs two bars)."""
    return silver.missing_ends(_bars_1h(spark, d), *fx.span(spark, d), "all_non_null", SYMBOL)


def _propagated(cascade: bool) -> Query:
    def query(spark: SparkSession, d: str) -> DataFrame:
        missing = silver_gaps_5m(spark, d).select("symbol", F.lit("5m").alias("interval"), "ts_ms")
        return silver.propagate(missing, fx.span(spark, d)[1], cascade, SYMBOL)

    return query


def gap_fill_1h(spark, d):
    stale = silver.propagate(silver_gaps_5m(spark, d).select("symbol", F.lit("5m").alias("interval"), "ts_ms"), fx.span(spark, d)[1], keys=SYMBOL).where("interval = '1h'")
    raw = fx.klines(spark, d).withColumn("close_time", F.col("open_time") + 60_000)
    return rounded(silver.fill(raw, "close_time", "1h", stale, lambda rows, i: kline_windows(rows.drop("close_time"), i), SYMBOL))


def upsert_merge(spark, d):
    old = fx.events(spark, d).select("event_id", "symbol", "value")
    new = fx.arrivals(spark, d).select(F.when(F.col("event_id") % 15 == 0, F.col("event_id") + 1_000_000_000).otherwise(F.col("event_id")).alias("event_id"), "symbol", F.when(F.col("event_id") % 20 != 0, F.col("value") * 2).alias("value"), "arrival")
    return rounded(silver.merge_by_key(old.withColumn("arrival", F.lit(-1)), new, ["event_id"], F.col("arrival")))


def gold_merge(spark, d):
    bars = lambda s, i: kline_windows(fx.klines(spark, d).where(F.col("symbol") == s), i).drop("symbol", "ts_ms")
    frames = [gold.prefixed(bars(s, i), f"{s}_{i}") for s, i in (("U0", "5m"), ("U1", "5m"), ("U0", "1h"))]
    rates = fx.funding(spark, d).select(F.timestamp_millis("funding_time").cast("timestamp_ntz").alias("timestamp_dt"), "instrument_name", "funding_rate", "funding_time")
    return rounded(gold.align(frames, left=gold.prefixed(rates, "funding", drop=("instrument_name",))))


def funding_ffill(spark, d):
    rows = _bars_5m(spark, d).select("symbol", "ts_ms", "close").join(fx.funding(spark, d).select(F.col("funding_time").alias("ts_ms"), "funding_rate"), "ts_ms", "left")
    return rounded(gold.forward_fill(rows.withColumn("dt", F.floor(F.col("ts_ms") / fx.DAY_MS)), ["funding_rate"], "ts_ms", ["symbol"], "dt").drop("dt"), 6)


def funding_asof(spark, d):
    rates = fx.funding(spark, d).select(F.col("funding_time").alias("created_time"), "funding_rate")
    return rounded(gold.as_of(fx.trades(spark, d).select("trade_id", "created_time", "price"), rates, "created_time", ["funding_rate"]), 6)


def funding_range_copy(spark, d):
    return rounded(silver.between(fx.funding(spark, d), "funding_time", fx.FIRST_MS + 2 * fx.DAY_MS, fx.FIRST_MS + 20 * fx.DAY_MS), 6)


def _bars_1h(spark, d):
    return kline_windows(fx.klines(spark, d), "1h")


def ohlc_range(spark, d):
    return rounded(serving.ohlc_range(_bars_1h(spark, d), "1h", "2024-01-05 00:00:00", "2024-01-12 00:00:00", keys=SYMBOL))


def ohlc_latest_n(spark, d):
    return rounded(serving.latest(_bars_1h(spark, d), "1h", 50, SYMBOL))


def ohlc_date_range(spark, d):
    return serving.date_range(_bars_1h(spark, d), SYMBOL)


def ohlc_statistics(spark, d):
    return rounded(serving.statistics(_bars_1h(spark, d), "1h", SYMBOL))


def candle_change(spark, d):
    return rounded(serving.change(serving.latest(_bars_1h(spark, d), "1h", 24, SYMBOL), SYMBOL))


def queries() -> dict[str, Query]:
    """All market queries by name."""
    found: dict[str, Query] = {f"klines_{i}": _klines(i) for i in INTERVALS}
    found |= {
        "trades_volume_1h": _trades("1h", "volume"), "trades_price_stats_1h": _trades("1h", "price"), "trades_size_stats_1h": _trades("1h", "size"),
        "trades_side_stats_1h": _trades("1h", "price", "size", "volume"), "trades_rate_1h": _trades("1h", "rate", "count"), "trades_corr_1h": _trades("1h", "corr"), "trades_ticks_1h": _trades("1h", "ticks"),
        "trades_features_5m": _trades("5m"), "trades_features_15m": _trades("15m"), "trades_features_1h": _trades("1h"), "trades_features_4h": _trades("4h"), "trades_features_1d": _trades("1d"),
        "ob_window_stats_1h": _book_windows("1h", False), "ob_window_stats_1d": _book_windows("1d", False), "ob_window_corr_1d": _book_windows("1d", True),
        "propagate_gaps_exact": _propagated(False), "propagate_gaps_cascade": _propagated(True),
    }
    plain = (ob_levels, ob_features, ob_features_deep, book_snapshots_minute, dedupe_keep_first, dedupe_keep_last, duplicate_report, rearrange_daily, rearrange_monthly, misplaced_counts, gaps_internal, gaps_boundary, gap_counts, complete_days, normalised_trades, normalised_klines, normalised_funding, rejected_messages, truncated_snapshots, pending_windows, silver_gaps_5m, silver_gaps_1h_values, gap_fill_1h, upsert_merge, gold_merge, funding_ffill, funding_asof, funding_range_copy, ohlc_range, ohlc_latest_n, ohlc_date_range, ohlc_statistics, candle_change)
    return found | {f.__name__: f for f in plain}
