"""Small cases worked out by hand, and properties of the market operators."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from sluice.functions import stats as S
from sluice.functions.ranks import window_ranks
from sluice.functions.timeutil import STEP_MS, cover_windows, expand_windows, interval_ms, with_previous, with_units
from sluice.operators import book, bronze, gold, serving, silver
from sluice.operators.klines import kline_windows, kline_windows_direct
from sluice.operators.orderbook import book_features, book_windows
from sluice.operators.trades import trade_windows

M5 = 300_000
TRADE = "symbol string, trade_id bigint, side string, price double, size double, created_time bigint"


def one(df):
    return df.collect()[0]


@pytest.mark.parametrize("interval", ["5m", "1h", "4h", "1d"])
def test_units_cover_a_window_once(spark, interval):
    first = 1_704_067_200_000
    df = spark.createDataFrame([(k, first + 97_001 * k) for k in range(700)], "k bigint, t bigint")
    want = {(r["k"], r["ts_ms"]) for r in expand_windows(df, F.col("t"), interval, first_end=first + M5, last_end=first + 40_000_000).collect()}
    units = with_units(df, F.col("t"), interval).groupBy("unit", "unit_end").agg(F.collect_list("k").alias("ks"))
    got = [(r["k"], r["ts_ms"]) for r in cover_windows(units, interval, first_end=first + M5, last_end=first + 40_000_000).select("ts_ms", F.explode("ks").alias("k")).collect()]
    assert len(got) == len(want) and set(got) == want


def test_windows_of_nulls_ties_and_constants(spark):
    first = 1_704_067_200_000
    rows = [("A", 1, "buy", 0.1, 1.0, first), ("A", 2, "buy", 0.1, 1.0, first), ("A", 3, "sell", 0.1, None, first + 4 * M5), ("A", 4, None, None, 2.0, first + 20 * M5), (None, 5, "buy", 3.0, 1.0, first), ("A", 6, "buy", 9.0, 1.0, None)]
    got = {(r["symbol"], r["ts_ms"]): r for r in trade_windows(spark.createDataFrame(rows, TRADE), "4h").collect()}
    r = got["A", first + 30 * M5]
    assert (r["trade_count"], r["price_skew_trade"], r["price_std_trade"], r["nunique_price_trade"], r["price_0.50_trade"], r["price_last_trade"], r["corr_price_time_trade"]) == (4, None, 0.0, 2, 0.1, None, None)
    assert (r["nunique_size_trade"], r["rate_max_ms_trade"], r["count_tick_up"], r["price_0.25_sell"], r["nunique_price_sell"]) == (3, 16.0 * M5, 0, 0.1, 1)
    assert got[None, first + M5]["price_mean_buy"] == 3.0 and got[None, first + M5]["price_0.50_buy"] == 3.0
    assert trade_windows(spark.createDataFrame([], TRADE), "1d").count() == 0


def test_nearest_rank(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (9.0,), (None,)], "x double").agg(S.sorted_values(F.col("x")).alias("v"))
    assert one(df.select(*[S.nearest_rank(F.col("v"), q).alias(str(i)) for i, q in enumerate((0.25, 0.5, 0.75))])) == (2.0, 4.0, 4.0)
    assert one(spark.createDataFrame([], "x double").agg(S.sorted_values(F.col("x")).alias("v")).select(S.nearest_rank(F.col("v"), 0.5)))[0] is None


def test_constant_series_have_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (None, 9.0)], "x double, y double")
    assert one(df.agg(S.safe_corr(F.col("x"), F.col("y")), S.safe_corr(F.col("y"), F.col("y")), S.count_unique(S.sorted_values(F.col("x")), F.max(F.col("x").isNull().cast("int"))))) == (None, pytest.approx(1.0), 2)


def test_rows_stand_in_every_window_that_holds_them(spark):
    end = 1_704_067_200_000 + 12 * M5
    df = spark.createDataFrame([(end - 3_600_000,), (end - 1,), (end,)], "t bigint")
    at = {(r["t"] - end, r["ts_ms"] - end) for r in expand_windows(df, F.col("t"), "1h").collect()}
    assert (-3_600_000, 0) in at and (-1, 0) in at and (0, 0) not in at
    assert len(at) == 3 * 12
    assert expand_windows(df, F.col("t"), "1h", first_end=end, last_end=end).count() == 2
    with pytest.raises(ValueError):
        interval_ms("5x")


def test_previous_values_bridge_buckets(spark):
    rows = [("a", k, k * 1_700_000) for k in (0, 1, 2, 5, 9, 9, 30)]
    df = spark.createDataFrame(rows, "s string, v bigint, t bigint")
    got = sorted(((r["t"], r["p"]) for r in with_previous(df, ["s"], "t", ["t", "v"], {"p": "v"}).collect()), key=lambda x: (x[0], -1 if x[1] is None else x[1]))
    assert [p for _, p in got] == [None, 0, 1, 2, 5, 9, 9]


def test_trade_windows_by_hand(spark):
    t = 1_704_067_200_000
    rows = [("s", 2, "buy", 10.0, 1.0, t), ("s", 1, "sell", 12.0, 2.0, t), ("s", 3, "buy", 11.0, 3.0, t + 1000), ("s", 4, "other", 5.0, 1.0, t + 4000)]
    r = one(trade_windows(spark.createDataFrame(rows, TRADE), "5m"))
    assert (r["price_first_trade"], r["price_first_buy"], r["price_last_trade"]) == (12.0, 10.0, 5.0)  # ties go by trade_id
    assert (r["volume_buy"], r["volume_sell"], r["count_buy"], r["trade_count"]) == (4.0, 2.0, 2, 4)
    assert (r["count_tick_up"], r["count_tick_down"]) == (1, 2)
    assert (r["rate_mean_ms_buy"], r["rate_max_ms_trade"]) == (1000.0, 3000.0) and r["rate_mean_ms_sell"] is None
    assert r["price_std_sell"] is None and r["price_skew_sell"] is None and r["nunique_price_sell"] == 1
    assert r["corr_price_time_trade"] > 0  # prices fall with time, so they rise with age
    assert len(r) == 91 + 3
    buys = one(trade_windows(spark.createDataFrame(rows[:1], TRADE), "5m"))
    assert (buys["volume_sell"], buys["price_mean_sell"], buys["nunique_price_sell"]) == (0.0, None, 0)


def test_panes_equal_bars(spark):
    t = 1_704_067_200_000
    rows = [("s", t + k * 97_000, 100.0 + k % 7, 101.0 + k % 11, 99.0 - k % 5, 100.0 + k % 13) for k in range(500)]
    df = spark.createDataFrame(rows, "symbol string, open_time bigint, open double, high double, low double, close double")
    for interval in ("5m", "1h", "4h"):
        a, b = ({r["ts_ms"]: r for r in f(df, interval).collect()} for f in (kline_windows, kline_windows_direct))
        assert a.keys() == b.keys()
        for k in a:
            for c in ("open", "high", "low", "close", "mean", "std"):
                x, y = a[k][c], b[k][c]
                assert x is None and y is None or math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9)
    shifted = {r["ts_ms"]: r["close"] for r in kline_windows(df, "5m", time="open_time").collect()}
    assert shifted != {r["ts_ms"]: r["close"] for r in kline_windows(df, "5m").collect()}


def test_book_features_by_hand(spark):
    df = spark.createDataFrame([("b", 1, "snapshot", '[["10","1"],["11","3"]]', "[[9,2],[8,2]]"), ("b", 2, "snapshot", "[[10,1]]", "[]"), ("b", 3, "update", "[]", "[]")], "symbol string, ts bigint, action string, asks string, bids string")
    a, b = book_features(df).orderBy("ts").collect()
    assert (a["best_ask"], a["best_bid"], a["spread"], a["sum_ask_50"], a["bid_px_20"]) == (10.0, 9.0, 1.0, 4.0, 9.0)
    assert a["total_money_50"] == 10 + 33 + 18 + 16 and math.isclose(a["weighted_mid_price"], 77 / 8)
    assert b["best_bid"] is None and b["spread"] is None and b["sum_bid_50"] == 0.0 and b["book_pressure"] is None
    w = book_windows(df, "5m").collect()
    assert len(w) == 1 and w[0]["snapshot_count"] == 2 and len(w[0]) == 77 + 3 and w[0]["rate_mean_ms"] == 1.0


def test_books_of_one_instant_go_by_id(spark):
    t, n = 1_704_067_200_000, 9
    rows = [("b", k, t + k // n * 3_600_000, f"[[{10 + k},1]]", f"[[{9 - k},1]]") for k in range(2 * n)]
    random.Random(1).shuffle(rows)
    books = spark.createDataFrame(rows, "symbol string, id bigint, ts bigint, asks string, bids string")
    for interval in ("1h", "1d"):
        got = {r["ts_ms"]: (r["spread_first"], r["spread_last"], r["rate_max_ms"]) for r in book_windows(books, interval).collect()}
        assert got[t + M5] == (1.0, 1.0 + 2 * (n - 1), 0.0)
        assert got[t + 13 * M5] == (1.0 + 2 * n * (interval == "1h"), 1.0 + 2 * (2 * n - 1), 0.0 if interval == "1h" else 3_600_000.0)
    unnamed = book_windows(books.drop("id"), "1h")
    assert unnamed.where("spread_first = spread_last").count() == 0 and unnamed.count() == 24


LEVELS = "array<struct<price:double,size:double>>"
MESSAGE = f"symbol string, ts bigint, seq bigint, action string, bids {LEVELS}, asks {LEVELS}"


def messages(spark, n=300, seed=1):
    import random

    rng, day = random.Random(seed), 1_704_067_200_000
    rows = [("m", day + 30_000, 0, "snapshot", [(1.0, 2.0), (2.0, 0.0)], [(3.0, 1.0)])]
    for k in range(1, n):
        level = [(float(rng.randint(1, 12)), float(rng.choice([0, 1, 2, 5])))]
        rows.append(("m", day + rng.randint(0, 80_000_000) // 10_000 * 10_000, k, rng.choice(["update"] * 20 + ["snapshot"]), level if k % 2 else [], [] if k % 2 else level))
    return spark.createDataFrame(rows, MESSAGE)


def test_books_relational_equals_ordered(spark):
    df = messages(spark)
    a, b = ({(r["ts"]): (r["asks"], r["bids"]) for r in f(df).collect()} for f in (book.minute_books, book.minute_books_by_day))
    assert len(a) == 1440 and a == b
    assert book.minute_books(df.limit(0)).count() == 0


def test_first_book_fills_the_minutes_before(spark):
    day = 1_704_067_200_000
    rows = [("m", day + 60_010, 1, "snapshot", [(1.0, 2.0)], []), ("m", day + 130_000, 2, "update", [(1.0, 0.0)], [])]
    got = {(r["ts"] - day) // 60_000: r["bids"] for r in book.minute_books(spark.createDataFrame(rows, MESSAGE)).collect()}
    assert len(got) == 1440 and got[0] == got[2] and len(got[0]) == 1 and got[3] == got[1439] == []


def test_gap_propagation(spark):
    missing = spark.createDataFrame([("5m", 0)], "interval string, ts_ms bigint")
    for cascade, reach in ((False, 55), (True, 65)):
        got = silver.propagate(missing, 10**9, cascade).groupBy("interval").agg(F.max("ts_ms")).collect()
        assert {r[0]: r[1] // 60_000 for r in got} | {"4h": 0, "1d": 0} == {"5m": 0, "15m": 10, "1h": reach, "4h": 0, "1d": 0}


def test_gaps_of_two_symbols(spark):
    key, of = ("symbol",), lambda df, *c: sorted(tuple(r[x] for x in c) for r in df.collect())
    table = spark.createDataFrame([("a", 0), ("a", M5), ("b", 0), ("b", 2 * M5)], "symbol string, ts_ms bigint")
    missing = silver.missing_ends(table, 0, 2 * M5, "row_exists", key)
    assert of(missing, "symbol", "ts_ms") == [("a", 2 * M5), ("b", M5)]
    wanted = spark.createDataFrame([("a",), ("b",), ("c",)], "symbol string")
    assert silver.missing_ends(table, 0, 2 * M5, "row_exists", key, wanted).where("symbol = 'c'").count() == 3
    stale = silver.propagate(missing.withColumn("interval", F.lit("5m")), 3 * M5, keys=key).where("interval = '15m'")
    assert of(stale, "symbol", "ts_ms") == [("a", 2 * M5), ("a", 3 * M5), ("b", M5), ("b", 2 * M5), ("b", 3 * M5)]
    raw = spark.createDataFrame([(s, k * M5, 1) for s in "ab" for k in range(6)], "symbol string, t bigint, v int")
    count = lambda rows, i: expand_windows(rows, F.col("t"), i).groupBy("symbol", "ts_ms").agg(F.sum("v").alias("n"))
    asked = spark.createDataFrame([("a", 3 * M5), ("b", 4 * M5)], "symbol string, ts_ms bigint")
    assert of(silver.fill(raw, "t", "15m", asked, count, key), "symbol", "ts_ms", "n") == [("a", 3 * M5, 3), ("b", 4 * M5, 3)]


def test_bars_of_two_symbols(spark):
    key, hour = ("symbol",), 3_600_000
    rows = [(s, k * hour, x + k, x + k + 2.0, x + k - 1.0, x + k + 1.0) for s, x in (("a", 10.0), ("b", 100.0)) for k in range(1, 4)]
    bars = spark.createDataFrame(rows, "symbol string, ts_ms bigint, open double, high double, low double, close double").withColumn("timestamp_dt", F.timestamp_millis("ts_ms").cast("timestamp_ntz"))
    last = serving.latest(bars, "1h", 2, key)
    assert [(r["symbol"], r["ts_ms"] // hour) for r in last.collect()] == [("a", 2), ("a", 3), ("b", 2), ("b", 3)]
    assert {r["symbol"]: (r["open"], r["close"], r["change_abs"]) for r in serving.change(last, key).collect()} == {"a": (12.0, 14.0, 2.0), "b": (102.0, 104.0, 2.0)}
    assert {r["symbol"]: (r["total_records"], r["all_time_low"], r["all_time_high"]) for r in serving.statistics(bars, "1h", key).collect()} == {"a": (3, 10.0, 15.0), "b": (3, 100.0, 105.0)}
    assert serving.date_range(bars, key).count() == 2
    inside = serving.ohlc_range(bars, "1h", "1970-01-01 02:00:00", "1970-01-01 03:00:00", 1, key)
    assert [(r["symbol"], r["ts_ms"] // hour) for r in inside.collect()] == [("a", 2), ("b", 2)]


def test_pending_windows(spark):
    ends = lambda *t: spark.createDataFrame([(x,) for x in t], "ts_ms bigint")
    assert [r[0] for r in silver.pending_ends(ends(1, 2, 2, 3), ends(2)).orderBy("ts_ms").collect()] == [1, 3]
    assert silver.windows_at(ends(1, 2, 3), ends(3, 3)).count() == 1
    kept = spark.createDataFrame([(1, 1.0), (2, None)], "ts_ms bigint, v double")
    assert [silver.complete_ends(kept, rule).count() for rule in ("all_non_null", "row_exists")] == [1, 2]


def test_merge_is_idempotent_and_nulls_overwrite(spark):
    old = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k bigint, v double")
    new = spark.createDataFrame([(2, None), (3, 3.0)], "k bigint, v double")
    once = silver.merge_by_key(old, new, ["k"])
    want = [(1, 1.0), (2, None), (3, 3.0)]
    assert sorted(map(tuple, once.collect())) == want == sorted(map(tuple, silver.merge_by_key(once, new, ["k"]).collect()))


def test_gaps_and_duplicates(spark):
    df = spark.createDataFrame([("s", "a", 0), ("s", "a", 10), ("s", "a", 100), ("s", "b", 300), ("s", "b", 300)], "symbol string, dt string, t bigint")
    assert [tuple(r)[3:5] for r in bronze.internal_gaps(df, "t", 50, ["symbol", "dt"]).collect()] == [(11, 99)]
    assert [tuple(r)[1:6] for r in bronze.boundary_gaps(df, "t", 50, ["symbol"], "dt").collect()] == [("a", "b", "boundary", 101, 299)]
    assert tuple(one(bronze.duplicate_report(df, ["t"], ["dt"]))) == ("b", 1, 2, 1)
    assert [r[0] for r in bronze.missing_dates(spark.createDataFrame([("2024-01-02",)], "dt string"), "dt", "2024-01-01", "2024-01-03").orderBy("dt").collect()] == ["2024-01-01", "2024-01-03"]


def test_normalised_messages(spark):
    raw = spark.createDataFrame([("i", "7", "buy", "1.5", "2", "99"), ("i", "x", "buy", "1", "2", "3")], "instId string, tradeId string, side string, px string, sz string, ts string")
    assert [tuple(r) for r in bronze.normalise_trades(raw).collect()] == [("i", 7, "buy", 1.5, 2.0, 99)]
    bars = spark.createDataFrame([(["60000", "1", "2", "0.5", "1.5", "x"],), (["?"],)], "candle array<string>")
    assert [tuple(r) for r in bronze.normalise_klines(bars).collect()] == [(60000, 1.0, 2.0, 0.5, 1.5)]


def test_forward_fill_and_as_of(spark):
    df = spark.createDataFrame([(k, v, k // 2) for k, v in enumerate([None, 1.0, None, None, None, 2.0])], "t bigint, v double, b bigint")
    for bucket in (None, "b"):
        assert [r["v"] for r in gold.forward_fill(df, ["v"], "t", bucket=bucket).orderBy("t").collect()] == [None, 1.0, 1.0, 1.0, 1.0, 2.0]
    left = spark.createDataFrame([(1, 5), (2, 10), (3, 11)], "id bigint, t bigint")
    right = spark.createDataFrame([(10, 0.5), (30, 0.7)], "t bigint, rate double")
    assert [r["rate"] for r in gold.as_of(left, right, "t", ["rate"], bucket_ms=4).orderBy("id").collect()] == [None, 0.5, 0.5]
    a = spark.createDataFrame([(1, 2)], "timestamp_dt bigint, x bigint")
    assert gold.align([a, a]).columns == ["timestamp_dt", "x", "x_dup"]


@pytest.mark.parametrize("group", [500_000, 6])
def test_window_ranks(spark, group):
    """Quantiles and distinct counts of all windows, with days in one piece and cut into bins, against plain lists."""
    rng = random.Random(group)
    rows = []
    for symbol in ("a", None):
        for _ in range(400):
            pane = rng.randrange(1, 700) * STEP_MS
            value = rng.choice([None, 0.0, 1.5, float(rng.randint(0, 9)), rng.random() * 100])
            rows.append((symbol, pane, rng.choice("xy"), value, rng.randint(0, 3), rng.randint(0, 1)))
    counts = spark.createDataFrame(rows, "symbol string, pane bigint, name string, value double, n bigint, b bigint")
    for interval, last in (("1d", None), ("1h", 500 * STEP_MS)):
        span = interval_ms(interval)
        got = {(r["symbol"], r["name"], r["ts_ms"]): r for r in window_ranks(counts, ["n", "b"], ("0.25", "0.50"), interval, None, last, group).collect()}
        ends = {(s, n, e) for s, p, n, *_ in rows for e in range(p, p + span, STEP_MS) if last is None or e <= last}
        assert set(got) == ends
        for key in rng.sample(sorted(ends, key=repr), 150):
            inside = [r for r in rows if (r[0], r[2]) == key[:2] and key[2] - span < r[1] <= key[2]]
            for j, w in ((4, "n"), (5, "b")):
                values = sorted(v for r in inside if r[3] is not None for v in [r[3]] * r[j])
                distinct = len({r[3] for r in inside if r[j]})
                want = [values[int(q * (len(values) - 1) + 0.5)] if values else None for q in (0.25, 0.5)]
                r = got[key]
                assert (r[f"n_{w}"], r[f"nunique_{w}"], [r[f"q_{w}_0.25"], r[f"q_{w}_0.50"]]) == (len(values), distinct, want)


def test_missing_ends_of_keys(spark):
    table = spark.createDataFrame([("a", k * STEP_MS, 1.0 if k % 3 else None) for k in range(0, 200, 2)] + [("b", 7, 1.0)], "symbol string, ts_ms bigint, v double")
    for rule in ("row_exists", "all_non_null"):
        got = sorted(tuple(r) for r in silver.missing_ends(table, 2 * STEP_MS, 150 * STEP_MS, rule, ("symbol",)).collect())
        have = {("a", k * STEP_MS) for k in range(0, 200, 2) if rule == "row_exists" or k % 3}
        assert got == sorted((s, k * STEP_MS) for s in "ab" for k in range(2, 151) if (s, k * STEP_MS) not in have)
    assert silver.missing_ends(table, 5, 4, "row_exists").count() == 0
    assert silver.missing_ends(table.limit(0), 0, 60 * STEP_MS, "row_exists").count() == 61
