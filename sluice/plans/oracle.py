"""SQL with the same rows as the market queries, written independently of the DataFrame code."""

from __future__ import annotations

FIRST, STEP, DAY = 1_704_067_200_000, 300_000, 86_400_000
MS = {"5m": 300_000, "15m": 900_000, "1h": 3_600_000, "4h": 14_400_000, "1d": 86_400_000}

EV = "ev AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) // 1000 AS t, CAST(regexp_extract(props, '(-?[0-9]+)', 1) AS BIGINT) AS k, 'U' || (user_id % 2) AS symbol FROM events)"
TR = EV + """, tr0 AS (SELECT symbol, event_id AS id, CASE WHEN event_type IN ('purchase', 'click') THEN 'buy' WHEN event_type IN ('view', 'signup') THEN 'sell' ELSE 'other' END AS side,
  value AS price, k + 1.0::DOUBLE AS size, t FROM ev),
tr AS (SELECT *, price * size AS turnover, lag(t) OVER s AS p_t, lag(price) OVER s AS p_price, lag(t) OVER ss AS p_st FROM tr0
  WINDOW s AS (PARTITION BY symbol ORDER BY t, id), ss AS (PARTITION BY symbol, side ORDER BY t, id))"""
KL = EV + ", kl AS (SELECT symbol, t // 60000 * 60000 AS open_time, arg_min(value, (t, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (t, event_id)) AS close FROM ev GROUP BY ALL)"
FU = "fu AS (SELECT 'U' AS instrument_name, arg_min(value, event_id) / 1e4 AS funding_rate, t // 28800000 * 28800000 AS funding_time FROM ev GROUP BY t // 28800000)"
OB = f"""li AS (SELECT l_orderkey, l_linestatus, l_extendedprice AS p, l_quantity AS q, l_linenumber AS a, l_partkey AS b, l_suppkey AS c FROM lineitem),
ob AS (SELECT 'BOOK' AS symbol, o_orderkey AS id, ((epoch_ms(o_orderdate) // {DAY}) % 30 + 30) % 30 * {DAY} + {FIRST} + (o_orderkey % 86400) * 1000 AS ts,
  coalesce(asks, []) AS asks, coalesce(bids, []) AS bids FROM orders JOIN (SELECT l_orderkey,
    list([p, q] ORDER BY p, a, b, c, q) FILTER (l_linestatus = 'O') AS asks, list([p, q] ORDER BY -p, a, b, c, p, q) FILTER (l_linestatus = 'F') AS bids FROM li GROUP BY 1) s ON o_orderkey = l_orderkey
  WHERE o_orderkey % 10 <> 0)"""
FEATURE_SQL = ", f1 AS (SELECT symbol, id, ts, asks, bids, bids[1][1] AS best_bid, asks[1][1] AS best_ask, " + ", ".join(f"coalesce(list_sum(list_transform({s}s[1:{k}], lambda x: x[2])), 0.0) AS sum_{s}_{k}" for s in ("bid", "ask") for k in (50, 20, 5)) + ", " + ", ".join(f"CASE WHEN len({s}s) >= 20 THEN {s}s[20][1] ELSE {s}s[1][1] END AS {s}_px_20, coalesce(list_sum(list_transform({s}s[1:50], lambda x: x[1] * x[2])), 0.0) AS total_money_{s}_50" for s in ("bid", "ask")) + """ FROM ob),
f2 AS (SELECT *, total_money_bid_50 + total_money_ask_50 AS total_money_50, sum_bid_50 + sum_ask_50 AS total_depth_50, best_ask - best_bid AS spread FROM f1),
bf AS (SELECT *, total_money_50 / (total_depth_50 + 1e-9) AS weighted_mid_price, sum_bid_50 / (total_depth_50 + 1e-9) AS deep_imbalance, (sum_bid_5 + sum_ask_5) / (total_depth_50 + 1e-9) AS concentration,
  (ask_px_20 - best_ask) / (sum_ask_20 + 1e-9) AS impact_slope_ask, (best_bid - bid_px_20) / (sum_bid_20 + 1e-9) AS impact_slope_bid, total_money_50 / (total_depth_50 + 1e-9) - (best_ask + best_bid) / 2 AS book_pressure FROM f2)"""

BF = OB + FEATURE_SQL
DEEP = "ob AS (SELECT vec_id AS id, vec_id * 60000 AS ts, 'DEEP' AS symbol, " + ", ".join(f"list_transform(range(1, 65), lambda i: [1000.0::DOUBLE {o} i, abs(embedding[i]::DOUBLE)]) AS {s}" for o, s in (("+", "asks"), ("-", "bids"))) + " FROM embeddings)" + FEATURE_SQL


def r(expression: str, name: str, digits: int = 4) -> str:
    """Rounded after a small shift, so that no result lies on the edge between two roundings; milliseconds to one digit."""
    digits = 1 if name.startswith("rate_") else digits
    return f"round({expression} + {1.3 * 10 ** -(digits + 2):.3g}, {digits}) + 0.0 AS {name}"


def windows(t: str, interval: str) -> str:
    """Ends of the windows that hold t."""
    return f"unnest(generate_series({t} // {STEP} * {STEP} + {STEP}, ({t} + {MS[interval]}) // {STEP} * {STEP}, {STEP}))"


def skew(x: str) -> str:
    n = f"count({x})"
    return f"CASE WHEN min({x}) <> max({x}) THEN CASE WHEN {n} = 2 THEN 0.0 ELSE skewness({x}) * ({n} - 2) / sqrt({n} * ({n} - 1.0)) END END"


def kurtosis(x: str) -> str:
    return f"CASE WHEN min({x}) <> max({x}) THEN kurtosis_pop({x}) END"


def nearest(x: str, q: str) -> str:
    return f"list_sort(list({x}) FILTER ({x} IS NOT NULL))[CAST(round({q} * (count({x}) - 1)) AS INT) + 1]"


def corr(x: str, y: str) -> str:
    varies = lambda a, b: f"stddev_pop({a}) FILTER ({b} IS NOT NULL) > 1e-9 * greatest(abs(min({a}) FILTER ({b} IS NOT NULL)), abs(max({a}) FILTER ({b} IS NOT NULL)))"
    return f"CASE WHEN {varies(x, y)} AND {varies(y, x)} THEN corr({x}, {y}) END"


def trades(interval: str, *groups: str) -> str:
    groups = groups or ("volume", "ticks", "price", "size", "rate", "corr", "count")
    start, cols = f"ts_ms - {MS[interval]}", ["count(*) AS trade_count"]
    sides = {"trade": "{}", "buy": "CASE WHEN side = 'buy' THEN {} END", "sell": "CASE WHEN side = 'sell' THEN {} END"}
    if "volume" in groups:
        for s in ("buy", "sell"):
            cols += [r(f"coalesce(sum({sides[s].format('size')}), 0.0)", f"volume_{s}"), r(f"coalesce(sum({sides[s].format('turnover')}), 0.0)", f"turnover_{s}"), f"count({sides[s].format('1')}) AS count_{s}"]
    if "ticks" in groups:
        cols += [f"count(CASE WHEN p_t >= {start} AND price {o} p_price THEN 1 END) AS count_tick_{n}" for o, n in ((">", "up"), ("<", "down"))]
    for s, form in sides.items():
        for c in [c for c in ("price", "size") if c in groups]:
            x, where = form.format(c), "" if s == "trade" else f" FILTER (side = '{s}')"
            if c == "price":
                cols += [r(f"arg_min(price, (t, id)){where}", f"price_first_{s}"), r(f"arg_max(price, (t, id)){where}", f"price_last_{s}")]
            cols += [r(f"avg({x})", f"{c}_mean_{s}"), r(f"stddev_samp({x})", f"{c}_std_{s}"), r(skew(x), f"{c}_skew_{s}"), r(kurtosis(x), f"{c}_kurtosis_{s}"), f"count(DISTINCT {x}) AS nunique_{c}_{s}"]
            cols += [r(f"min({x})", f"{c}_min_{s}"), r(f"max({x})", f"{c}_max_{s}")]
            cols += [r(nearest(x, q), f"{c}_q{q[2:]}_{s}") for q in ("0.25", "0.50", "0.75")]
        if "rate" in groups:
            p = "p_t" if s == "trade" else "p_st"
            gap = form.format(f"CASE WHEN {p} >= {start} THEN t - {p} END")
            cols += [r(f"avg({gap})", f"rate_mean_ms_{s}"), r(f"stddev_samp({gap})", f"rate_std_ms_{s}")] + [r(f"{f}({gap})::DOUBLE", f"rate_{f}_ms_{s}") for f in ("max", "min")]
    if "corr" in groups:
        cols += [r(corr("price", "size"), "corr_price_size_trade"), r(corr("price", "(ts_ms - t)"), "corr_price_time_trade"), r(corr("size", "(ts_ms - t)"), "corr_size_time_trade")]
    if "count" in groups:
        cols.append("max(t) AS last_trade_time_ms")
    return f"WITH {TR}, w AS (SELECT *, {windows('t', interval)} AS ts_ms FROM tr) SELECT symbol, make_timestamp(ts_ms * 1000) AS timestamp_dt, ts_ms, {', '.join(cols)} FROM w GROUP BY symbol, ts_ms"


BARS = "symbol, make_timestamp(ts_ms * 1000) AS timestamp_dt, ts_ms, arg_min(open, open_time) AS open, max(high) AS high, min(low) AS low, arg_max(close, open_time) AS close, avg(close) AS mean, stddev_samp(close) AS std"
BAR_COLUMNS = ("open", "high", "low", "close", "mean", "std")


def bars(interval: str, name: str = "b", where: str = "true") -> str:
    return f"{name}0 AS (SELECT *, {windows('(open_time + 60000)', interval)} AS ts_ms FROM kl WHERE {where}), {name} AS (SELECT {BARS} FROM {name}0 GROUP BY symbol, ts_ms)"


def klines(interval: str) -> str:
    return f"WITH {KL}, {bars(interval)} SELECT symbol, timestamp_dt, ts_ms, {', '.join(r(c, c) for c in BAR_COLUMNS)} FROM b"


FEATURES = "best_bid best_ask sum_bid_50 sum_bid_20 sum_bid_5 sum_ask_50 sum_ask_20 sum_ask_5 bid_px_20 ask_px_20 total_money_bid_50 total_money_ask_50 total_money_50 total_depth_50 spread weighted_mid_price deep_imbalance concentration impact_slope_ask impact_slope_bid book_pressure".split()
_ALL = ("mean", "std", "min", "q25", "q50", "q75", "max", "first", "last", "skew", "kurtosis")
STATS = {
    "wmp": ("weighted_mid_price", _ALL), "spread": ("spread", _ALL), "imbal": ("deep_imbalance", _ALL), "depth": ("total_depth_50", ("mean", "std", "min", "max", "first", "last")), "conc": ("concentration", ("mean", "std", "min", "max")),
    "impact_ask": ("impact_slope_ask", ("mean", "std", "min", "max")), "impact_bid": ("impact_slope_bid", ("mean", "std", "min", "max")), "pressure": ("book_pressure", ("sum", *_ALL)),
}


def book_windows(interval: str, correlations: bool) -> str:
    w = f"WITH {BF}, g AS (SELECT *, lag(ts) OVER (ORDER BY ts, id) AS p_t FROM bf), w AS (SELECT *, {windows('ts', interval)} AS ts_ms FROM g) SELECT symbol, ts_ms, "
    if correlations:
        age, pairs = "(ts_ms - ts)", {"wmp_imbal": ("weighted_mid_price", "deep_imbalance"), "wmp_depth": ("weighted_mid_price", "total_depth_50"), "wmp_pressure": ("weighted_mid_price", "book_pressure"), "spread_imbal": ("spread", "deep_imbalance"), "spread_impact": ("spread", "((impact_slope_ask + impact_slope_bid) / 2)")}
        pairs |= {"wmp_time": ("weighted_mid_price", age), "conc_time": ("concentration", age), "pressure_time": ("book_pressure", age)}
        return w + ", ".join(r(corr(*p), f"corr_{n}") for n, p in pairs.items()) + " FROM w GROUP BY symbol, ts_ms"
    plain, cols = {"mean": "avg({})", "std": "stddev_samp({})", "min": "min({})", "max": "max({})", "sum": "coalesce(sum({}), 0.0)", "first": "arg_min_null({}, (ts, id))", "last": "arg_max_null({}, (ts, id))"}, []
    for prefix, (x, kinds) in STATS.items():
        for k in kinds:
            e = plain[k].format(x) if k in plain else skew(x) if k == "skew" else kurtosis(x) if k == "kurtosis" else nearest(x, f"0.{k[1:]}")
            cols.append(r(e, f"{prefix}_{k}"))
    gap = f"CASE WHEN p_t >= ts_ms - {MS[interval]} THEN ts - p_t END"
    cols += ["count(*) AS snapshot_count", r(f"avg({gap})", "rate_mean_ms"), r(f"stddev_samp({gap})", "rate_std_ms"), r(f"min({gap})::DOUBLE", "rate_min_ms"), r(f"max({gap})::DOUBLE", "rate_max_ms"), "max(ts) AS last_update_time_ms"]
    return w + ", ".join(cols) + " FROM w GROUP BY symbol, ts_ms"


BOOK = f"""WITH m0 AS (SELECT ((epoch_ms(l_shipdate) // {DAY}) % 28 + 28) % 28 * {DAY} + {FIRST} AS dt, l_orderkey AS o, l_linenumber AS ln, l_partkey AS pk, l_suppkey AS sk, l_extendedprice AS x, l_quantity AS q, l_returnflag AS f FROM lineitem),
m1 AS (SELECT *, dt + (o * 7919 + ln * 104729) % {DAY} AS ts, CASE WHEN ln % 2 = 1 THEN 'bid' ELSE 'ask' END AS side, round(x / 1000) AS price, CASE WHEN f = 'R' THEN 0.0 ELSE q END AS size FROM m0),
m2 AS (SELECT *, row_number() OVER (PARTITION BY dt ORDER BY ts, o, ln, pk, sk, x, q) AS n FROM m1), m AS (SELECT *, n = 1 OR o % 997 = 0 AS snap FROM m2),
e AS (SELECT *, lead(ts) OVER (PARTITION BY dt, side, price ORDER BY n) AS t1, min(CASE WHEN snap THEN ts END) OVER (PARTITION BY dt ORDER BY n ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS t2 FROM m),
v AS (SELECT *, least(coalesce(least(t1, t2), t1, t2, dt + {DAY}), dt + {DAY}) AS te FROM e WHERE size > 0),
lv AS (SELECT dt, side, price, size, unnest(generate_series(ts // 60000 * 60000 + 60000, least(te // 60000 * 60000, dt + {DAY} - 60000), 60000)) AS ts FROM v),
bk AS (SELECT dt, ts, list(price::BIGINT || ':' || size::BIGINT ORDER BY price, size) FILTER (side = 'ask') AS asks, list(price::BIGINT || ':' || size::BIGINT ORDER BY price DESC, size DESC) FILTER (side = 'bid') AS bids FROM lv GROUP BY dt, ts),
b AS (SELECT dt, min(ts) // 60000 * 60000 + 60000 AS begin FROM m WHERE snap GROUP BY dt HAVING begin < dt + {DAY}), grid AS (SELECT dt, begin, unnest(generate_series(dt, dt + {DAY} - 60000, 60000)) AS minute FROM b)
SELECT 'MSG' AS symbol, minute AS ts, coalesce(array_to_string(asks[1:50], ','), '') AS asks, coalesce(array_to_string(bids[1:50], ','), '') AS bids FROM grid LEFT JOIN bk ON bk.dt = grid.dt AND bk.ts = greatest(minute, begin)"""

ARRIVALS = EV + ", ar AS (SELECT event_id, symbol, t, value, 0 AS arrival FROM ev UNION ALL SELECT event_id, symbol, t, value + 1, 1 FROM ev WHERE event_id % 10 = 0)"
MISPLACED = EV + f", mi AS (SELECT event_id, symbol, t, value, strftime(make_timestamp((t + CASE WHEN event_id % 7 = 0 THEN {DAY} ELSE 0 END) * 1000), '%Y-%m-%d') AS dt, strftime(make_timestamp(t * 1000), '%Y-%m-%d') AS own FROM ev)"
DATED = TR + ", d AS (SELECT symbol, t, strftime(make_timestamp(t * 1000), '%Y-%m-%d') AS dt FROM tr0)"
INTERNAL = "gi AS (SELECT symbol, dt, t, lead(t) OVER (PARTITION BY symbol, dt ORDER BY t) AS nx FROM d)"
BOUNDARY = "fl AS (SELECT symbol, dt, min(t) AS lo, max(t) AS hi FROM d GROUP BY symbol, dt), gb AS (SELECT *, lead(lo) OVER (PARTITION BY symbol ORDER BY dt) AS nx, lead(dt) OVER (PARTITION BY symbol ORDER BY dt) AS nd FROM fl)"
SPAN = f"sp AS (SELECT min(open_time + 60000) // {STEP} * {STEP} + {STEP} AS lo, max(open_time + 60000) // {STEP} * {STEP} + {STEP} AS hi FROM kl)"
EXPECTED = f"SELECT symbol, ts_ms FROM (SELECT DISTINCT symbol, lo, hi FROM b, sp), unnest(generate_series(lo, hi, {STEP})) x(ts_ms)"
MISSING = f"{KL}, {bars('5m')}, {SPAN}, mis AS ({EXPECTED} EXCEPT SELECT symbol, ts_ms FROM b)"


def propagated(cascade: bool) -> str:
    parts, names = [MISSING, "s_5m AS (SELECT symbol, ts_ms FROM mis)"], list(MS)
    for k, target in enumerate(names[1:], 1):
        sources = names[:k] if cascade else names[:1]
        union = " UNION ".join(f"SELECT symbol, unnest(generate_series(ts_ms, ts_ms + {MS[target] - STEP}, {STEP})) AS ts_ms FROM s_{s}" for s in sources)
        parts.append(f"s_{target} AS (SELECT DISTINCT symbol, ts_ms FROM ({union}) WHERE ts_ms <= (SELECT hi FROM sp))")
    return "WITH " + ", ".join(parts) + " " + " UNION ALL ".join(f"SELECT symbol, '{i}' AS \"interval\", ts_ms FROM s_{i}" for i in names)


H1 = f"WITH {KL}, {bars('1h')}"
_OHLC = "symbol, make_timestamp((ts_ms - 3600000) * 1000) AS time, timestamp_dt, ts_ms, " + ", ".join(r(c, c) for c in ("open", "high", "low", "close"))


def _gold() -> str:
    quoted = lambda s: f"symbol = '{s}'"
    parts = [bars("5m", "a", quoted("U0")), bars("5m", "b", quoted("U1")), bars("1h", "c", quoted("U0"))]
    cols = ", ".join(r(f"{t}.{c}", f'"{p}_{c}"') for t, p in (("a", "U0_5m"), ("b", "U1_5m"), ("c", "U0_1h")) for c in BAR_COLUMNS)
    return f"WITH {KL}, {FU}, {', '.join(parts)}, k AS (SELECT ts_ms FROM a UNION SELECT ts_ms FROM b UNION SELECT ts_ms FROM c) SELECT make_timestamp(k.ts_ms * 1000) AS timestamp_dt, {cols}, {r('funding_rate', 'funding_funding_rate')}, funding_time AS funding_funding_time FROM k LEFT JOIN a USING (ts_ms) LEFT JOIN b USING (ts_ms) LEFT JOIN c USING (ts_ms) LEFT JOIN fu ON funding_time = k.ts_ms"


def oracle_sql() -> dict[str, str]:
    """SQL by query name."""
    sql = {f"klines_{i}": klines(i) for i in MS} | {f"trades_features_{i}": trades(i) for i in MS}
    sql |= {"trades_volume_1h": trades("1h", "volume"), "trades_price_stats_1h": trades("1h", "price"), "trades_size_stats_1h": trades("1h", "size"), "trades_side_stats_1h": trades("1h", "price", "size", "volume"), "trades_rate_1h": trades("1h", "rate", "count"), "trades_corr_1h": trades("1h", "corr"), "trades_ticks_1h": trades("1h", "ticks")}
    sql |= {"ob_window_stats_1h": book_windows("1h", False), "ob_window_stats_1d": book_windows("1d", False), "ob_window_corr_1d": book_windows("1d", True)}
    level = "SELECT id, ts, '{0}' AS side, unnest(range(len({0}))) ::INT AS position, unnest({0}) AS l FROM ob"
    sql["ob_levels"] = f"WITH {OB}, x AS ({level.format('bids')} UNION ALL {level.format('asks')}) SELECT id, ts, side, position, {r('l[1]', 'price')}, {r('l[2]', 'size')} FROM x"
    sql["ob_features"] = f"WITH {BF} SELECT id, ts, {', '.join(r(c, c) for c in FEATURES)} FROM bf"
    sql["ob_features_deep"] = f"WITH {DEEP} SELECT id, ts, {', '.join(r(c, c) for c in FEATURES)} FROM bf"
    sql["book_snapshots_minute"] = BOOK
    for name, order in (("first", "arrival"), ("last", "arrival DESC")):
        sql[f"dedupe_keep_{name}"] = f"WITH {ARRIVALS} SELECT event_id, symbol, t, {r('value', 'value')}, arrival FROM ar QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY {order}) = 1"
    sql["duplicate_report"] = f"WITH {ARRIVALS}, g AS (SELECT symbol, event_id, count(*) AS n FROM ar GROUP BY ALL HAVING n > 1) SELECT symbol, count(*) AS duplicate_keys, sum(n)::BIGINT AS rows, (sum(n) - count(*))::BIGINT AS extra_rows FROM g GROUP BY symbol"
    sql["rearrange_daily"] = f"WITH {MISPLACED} SELECT event_id, symbol, t, {r('value', 'value')}, own AS dt, own <> dt AS moved FROM mi"
    sql["rearrange_monthly"] = f"WITH {MISPLACED} SELECT event_id, symbol, t, {r('value', 'value')}, own[1:7] AS dt, own[1:7] <> dt[1:7] AS moved FROM mi"
    sql["misplaced_counts"] = f"WITH {MISPLACED} SELECT dt, own AS target, count(*) AS count FROM mi WHERE dt <> own GROUP BY ALL"
    hours = r("(nx - {}) / 3600000", "duration_hours")
    sql["gaps_internal"] = f"WITH {DATED}, {INTERNAL} SELECT symbol, dt, 'internal' AS type, t + 1 AS start, nx - 1 AS \"end\", {hours.format('t')} FROM gi WHERE nx - t > 60000"
    sql["gaps_boundary"] = f"WITH {DATED}, {BOUNDARY} SELECT symbol, dt AS after, nd AS before, 'boundary' AS type, hi + 1 AS start, nx - 1 AS \"end\", {hours.format('hi')} FROM gb WHERE nx - hi > 60000"
    sql["gap_counts"] = f"WITH {DATED}, {INTERNAL}, {BOUNDARY}, u AS (SELECT 'internal' AS type, (nx - t) / 3600000 AS h FROM gi WHERE nx - t > 60000 UNION ALL SELECT 'boundary', (nx - hi) / 3600000 FROM gb WHERE nx - hi > 60000) SELECT type, count(*) AS gaps, {r('sum(h)', 'hours', 2)} FROM u GROUP BY type"
    sql["complete_days"] = f"WITH {KL} SELECT symbol, strftime(make_timestamp(open_time * 1000), '%Y-%m-%d') AS dt, count(*) AS n, count(*) = 1440 AS complete FROM kl GROUP BY ALL"
    messages = "tm AS (SELECT *, CASE WHEN event_type = 'error' THEN 'price' WHEN k = 13 THEN 'created_time' END AS reason FROM ev), cm AS (SELECT *, CASE WHEN high = low THEN 'low' END AS reason FROM kl), fm AS (SELECT *, CASE WHEN funding_rate < 1e-3 THEN 'funding_rate' END AS reason FROM fu)"
    M = f"WITH {KL}, {FU}, {messages}"
    sql["normalised_trades"] = f"{M} SELECT symbol AS instrument_name, event_id AS trade_id, CASE WHEN event_type IN ('purchase', 'click') THEN 'buy' ELSE 'sell' END AS side, {r('value', 'price')}, {r('(k + 1)::DOUBLE', 'size')}, t AS created_time FROM tm WHERE reason IS NULL"
    sql["normalised_klines"] = f"{M} SELECT open_time, {', '.join(r(c, c) for c in ('open', 'high', 'low', 'close'))} FROM cm WHERE reason IS NULL"
    sql["normalised_funding"] = f"{M} SELECT instrument_name, {r('funding_rate', 'funding_rate', 8)}, funding_time FROM fm WHERE reason IS NULL"
    sql["rejected_messages"] = M + " " + " UNION ALL ".join(f"SELECT '{kind}' AS kind, reason, count(*) AS rows FROM {t} WHERE reason IS NOT NULL GROUP BY reason" for kind, t in (("trade", "tm"), ("candle", "cm"), ("funding", "fm")))
    sql["truncated_snapshots"] = f"WITH {DEEP} SELECT id, ts, 50::INT AS n_asks, 50::INT AS n_bids, {r('list_sum(list_transform(asks[1:50], lambda x: x[1]))', 'ask_prices')}, {r('list_sum(list_transform(bids[1:50], lambda x: x[2]))', 'bid_sizes')} FROM ob WHERE id % 7 <> 0"
    sql["pending_windows"] = f"WITH {KL}, {bars('5m', 'a')}, {bars('1h')} SELECT DISTINCT ts_ms FROM a WHERE ts_ms NOT IN (SELECT ts_ms FROM b WHERE symbol = 'U0' AND std IS NOT NULL)"
    sql["silver_gaps_5m"] = f"WITH {MISSING} SELECT symbol, ts_ms FROM mis"
    sql["silver_gaps_1h_values"] = f"WITH {KL}, {bars('1h')}, {SPAN} {EXPECTED} EXCEPT SELECT symbol, ts_ms FROM b WHERE {' AND '.join(f'{c} IS NOT NULL' for c in BAR_COLUMNS)}"
    sql["propagate_gaps_exact"], sql["propagate_gaps_cascade"] = propagated(False), propagated(True)
    sql["gap_fill_1h"] = f"WITH {MISSING}, st AS (SELECT DISTINCT symbol, ts_ms FROM (SELECT symbol, unnest(generate_series(ts_ms, ts_ms + 3300000, {STEP})) AS ts_ms FROM mis) WHERE ts_ms <= (SELECT hi FROM sp)), h0 AS (SELECT *, unnest(generate_series((open_time + 60000) // {STEP} * {STEP} + {STEP}, (open_time + 3660000) // {STEP} * {STEP}, {STEP})) AS ts_ms FROM kl), h AS (SELECT {BARS} FROM h0 GROUP BY symbol, ts_ms) SELECT symbol, timestamp_dt, ts_ms, {', '.join(r(c, c) for c in BAR_COLUMNS)} FROM h SEMI JOIN st USING (symbol, ts_ms)"
    sql["upsert_merge"] = f"WITH {ARRIVALS}, nw AS (SELECT CASE WHEN event_id % 15 = 0 THEN event_id + 1000000000 ELSE event_id END AS event_id, symbol, CASE WHEN event_id % 20 <> 0 THEN value * 2 END AS value, arrival FROM ar), u AS (SELECT event_id, symbol, value, -1 AS arrival FROM ev UNION ALL SELECT * FROM nw) SELECT event_id, symbol, {r('value', 'value')}, arrival FROM u QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY arrival DESC) = 1"
    sql["gold_merge"] = _gold()
    sql["funding_ffill"] = f"WITH {MISSING}, {FU} SELECT symbol, ts_ms, {r('close', 'close', 6)}, {r('last_value(funding_rate IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY ts_ms ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 'funding_rate', 6)} FROM b LEFT JOIN fu ON funding_time = ts_ms"
    sql["funding_asof"] = f"WITH {TR}, {FU} SELECT id AS trade_id, t AS created_time, {r('price', 'price', 6)}, {r('funding_rate', 'funding_rate', 6)} FROM tr0 ASOF LEFT JOIN fu ON t >= funding_time"
    sql["funding_range_copy"] = f"WITH {EV}, {FU} SELECT instrument_name, {r('funding_rate', 'funding_rate', 6)}, funding_time FROM fu WHERE funding_time BETWEEN {FIRST + 2 * DAY} AND {FIRST + 20 * DAY}"
    aligned = "FROM b WHERE ts_ms % 3600000 = 0"
    sql["ohlc_range"] = f"{H1} SELECT {_OHLC} {aligned} AND timestamp_dt BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-12 00:00:00'"
    sql["ohlc_latest_n"] = f"{H1} SELECT {_OHLC} {aligned} QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ts_ms DESC) <= 50"
    sql["ohlc_date_range"] = f"{H1} SELECT symbol, min(timestamp_dt) AS first_record, max(timestamp_dt) AS last_record FROM b GROUP BY symbol"
    sql["ohlc_statistics"] = f"{H1} SELECT symbol, count(*) AS total_records, min(timestamp_dt) AS first_record, max(timestamp_dt) AS last_record, {r('min(low)', 'all_time_low')}, {r('max(high)', 'all_time_high')} {aligned} GROUP BY symbol"
    sql["candle_change"] = f"{H1}, x AS (SELECT * {aligned} QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ts_ms DESC) <= 24), y AS (SELECT symbol, arg_max(close, ts_ms) AS close, arg_min(open, ts_ms) AS open, max(high) AS high, min(low) AS low FROM x GROUP BY symbol) SELECT symbol, {', '.join(r(c, c) for c in ('close', 'open', 'high', 'low'))}, {r('close - open', 'change_abs')}, {r('(close - open) / open * 100', 'change_pct')} FROM y"
    return sql
