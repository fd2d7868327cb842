"""Order-book features of a snapshot and over hop windows: 77 columns a window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions import stats as S
from sluice.functions.ranks import pivoted, window_ranks
from sluice.functions.timeutil import STEP_MS, cover_windows, interval_ms, next_boundary, wall_clock, with_previous, with_units

EPSILON = 1e-9


def parse_levels(c: Column) -> Column:
    """[[price, size], ..] as doubles from JSON whose numbers may be strings."""
    return F.transform(F.from_json(c, "array<array<string>>"), lambda level: F.transform(level, lambda x: x.try_cast("double")))


def levels(books: DataFrame) -> DataFrame:
    """Snapshots with parsed sides; other actions are left out where the column exists."""
    rows = books.where(F.col("action") == "snapshot") if "action" in books.columns else books
    return rows.withColumn("bids_float", parse_levels(F.col("bids"))).withColumn("asks_float", parse_levels(F.col("asks")))


def _sum(side: str, k: int, value) -> Column:
    zero = F.lit(0.0)
    picked = F.coalesce(F.slice(f"{side}_float", 1, k), F.array().cast("array<array<double>>"))
    return F.aggregate(picked, zero, lambda s, level: s + F.coalesce(value(level), zero))


def _depth_price(side: str, k: int) -> Column:
    array = F.col(f"{side}_float")
    return F.when(F.size(array) >= k, F.get(F.get(array, F.lit(k - 1)), F.lit(0))).when(F.size(array) > 0, F.get(F.get(array, F.lit(0)), F.lit(0)))


def book_features(books: DataFrame) -> DataFrame:
    """Adds best prices, depth sums, spread, weighted mid, imbalance, concentration, slopes, pressure."""
    size, price = lambda level: F.get(level, F.lit(1)), lambda level: F.get(level, F.lit(0))
    out = levels(books)
    names = {"bids": "bid", "asks": "ask"}
    out = out.withColumns({f"best_{n}": F.get(F.get(f"{s}_float", F.lit(0)), F.lit(0)) for s, n in names.items()} | {f"sum_{n}_{k}": _sum(s, k, size) for s, n in names.items() for k in (50, 20, 5)} | {f"{n}_px_20": _depth_price(s, 20) for s, n in names.items()} | {f"total_money_{n}_50": _sum(s, 50, lambda level: price(level) * size(level)) for s, n in names.items()})
    depth = F.col("sum_bid_50") + F.col("sum_ask_50")
    out = out.withColumns({"total_money_50": F.col("total_money_bid_50") + F.col("total_money_ask_50"), "total_depth_50": depth, "spread": F.col("best_ask") - F.col("best_bid")})
    out = out.withColumns({
        "weighted_mid_price": F.col("total_money_50") / (depth + EPSILON), "deep_imbalance": F.col("sum_bid_50") / (depth + EPSILON), "concentration": (F.col("sum_bid_5") + F.col("sum_ask_5")) / (depth + EPSILON),
        "impact_slope_ask": (F.col("ask_px_20") - F.col("best_ask")) / (F.col("sum_ask_20") + EPSILON), "impact_slope_bid": (F.col("best_bid") - F.col("bid_px_20")) / (F.col("sum_bid_20") + EPSILON),
    })
    return out.withColumn("book_pressure", F.col("weighted_mid_price") - (F.col("best_ask") + F.col("best_bid")) / 2)


#: Output prefix: feature, and the statistics taken of it.
_ALL = ("mean", "std", "min", "0.25", "0.50", "0.75", "max", "first", "last", "skew", "kurtosis")
STATISTICS = {
    "wmp": ("weighted_mid_price", _ALL), "spread": ("spread", _ALL), "imbal": ("deep_imbalance", _ALL),
    "depth": ("total_depth_50", ("mean", "std", "min", "max", "first", "last")), "conc": ("concentration", ("mean", "std", "min", "max")),
    "impact_ask": ("impact_slope_ask", ("mean", "std", "min", "max")), "impact_bid": ("impact_slope_bid", ("mean", "std", "min", "max")),
    "pressure": ("book_pressure", ("sum", *_ALL)),
}


def book_windows(books: DataFrame, interval: str, first_end: int | None = None, last_end: int | None = None) -> DataFrame:
    """One row for each symbol and window with snapshots: symbol, timestamp_dt, ts_ms and 77 columns.

    ``books`` has symbol, ts (ms), action, asks, bids. Snapshots of one instant go by id where the column exists, then by a hash
    of their levels' text. Snapshots are reduced to panes and hour blocks first; the values that quantiles need go to the days of their windows (see functions.ranks).
    """
    t, end, span = F.col("ts"), F.col("unit_end"), interval_ms(interval)
    features = book_features(books)
    keys = ["ts", *(["id"] if "id" in books.columns else []), "_tie"]
    ready = features.withColumn("_tie", F.xxhash64("bids", "asks")).select("symbol", *keys, *(f for f, _ in STATISTICS.values()))
    plain = ready
    ready = with_previous(ready, ["symbol"], "ts", keys, {"p_time": "ts"})
    if first_end is not None:
        ready, plain = ready.where(t >= first_end - span), plain.where(t >= first_end - span)
    if last_end is not None:
        ready, plain = ready.where(t < last_end), plain.where(t < last_end)
    order, start = F.struct(*keys), F.col("ts_ms") - span
    taken = {"_rows": F.count(F.lit(1)), "_last_time": F.max(t)}  # of a unit's snapshots
    merged = {"snapshot_count": F.sum("_rows"), "last_update_time_ms": F.max("_last_time")}  # of a window's units
    series, out, ranks = [], {}, {}
    for prefix, (feature, kinds) in STATISTICS.items():
        m, x = S.Moments(prefix, shape="skew" in kinds), F.col(feature)
        series.append(m)
        taken |= m.taken(x)
        read = {"mean": m.mean, "std": m.std, "min": m.least, "max": m.largest, "skew": m.skew, "kurtosis": m.kurtosis}
        for kind in kinds:
            name = f"{prefix}_{kind}"
            if kind in read:
                out[name] = read[kind]
            elif kind in ("sum", "first", "last"):
                by_row = {"sum": S.total(x), "first": S.first_by(x, order), "last": S.last_by(x, order)}
                by_unit = {"sum": F.sum(f"_{name}"), "first": F.min_by(f"_{name}", end), "last": F.max_by(f"_{name}", end)}
                taken[f"_{name}"], merged[name], out[name] = by_row[kind], by_unit[kind], F.col(name)
            else:
                ranks[name] = (prefix, f"q_n_{kind}")
                out[name] = F.col(f"`{name}`")
    # of a unit's snapshots only the first has its predecessor outside; the gap counts where that one is in the window
    gap, inner, rate = (t - F.col("p_time")).cast("double"), F.col("p_time") >= end - F.col("unit"), S.Moments("gap")
    taken |= rate.taken(F.when(inner, gap)) | {"_gap_before": F.max(F.when(~inner, F.col("p_time"))), "_gap_edge": F.max(F.when(~inner, gap))}
    seen = rate.joined_by(F.when(F.col("_gap_before") >= start, F.col("_gap_edge")))
    series.append(rate)
    out |= {"snapshot_count": F.col("snapshot_count"), "rate_mean_ms": rate.mean, "rate_std_ms": rate.std, "rate_min_ms": rate.least, "rate_max_ms": rate.largest}
    age, wmp, slope = (end - t).cast("double"), F.col("weighted_mid_price"), (F.col("impact_slope_ask") + F.col("impact_slope_bid")) / 2
    pairs = {
        "wmp_imbal": (wmp, F.col("deep_imbalance")), "wmp_depth": (wmp, F.col("total_depth_50")), "wmp_pressure": (wmp, F.col("book_pressure")), "wmp_time": (wmp, age), "spread_imbal": (F.col("spread"), F.col("deep_imbalance")),
        "spread_impact": (F.col("spread"), slope), "conc_time": (F.col("concentration"), age), "pressure_time": (F.col("book_pressure"), age),
    }
    for name, (x, y) in pairs.items():
        p = S.PairMoments(name)
        series.append(p)
        taken |= p.taken(x, y)
        if name.endswith("_time"):
            seen |= p.y.moved(F.col("ts_ms") - end)
        out[f"corr_{name}"] = p.corr
    out["last_update_time_ms"] = F.col("last_update_time_ms")
    by_unit = with_units(ready, t, interval).groupBy("symbol", "unit", "unit_end").agg(*[c.alias(n) for n, c in taken.items()])
    window = Window.partitionBy("symbol", "ts_ms")
    rows = cover_windows(by_unit, interval, STEP_MS, first_end, last_end).withColumns(seen)
    rows = rows.withColumns({n: c for m in series for n, c in m.centre(window).items()})
    merged |= {n: c for m in series for n, c in m.merged().items()}
    windows = rows.groupBy("symbol", "ts_ms").agg(*[c.alias(n) for n, c in merged.items()])
    values = F.explode(F.array(*[F.struct(F.lit(p).alias("name"), F.col(STATISTICS[p][0]).alias("value")) for p in sorted({p for p, _ in ranks.values()})]))
    counts = plain.select("symbol", next_boundary(t).alias("pane"), values.alias("v")).groupBy("symbol", "pane", "v.name", "v.value").agg(F.count(F.lit(1)).alias("n"))
    quantiles = tuple(k for k in _ALL if k.startswith("0."))
    found = pivoted(window_ranks(counts, ["n"], quantiles, interval, first_end, last_end), ranks).withColumnsRenamed({"symbol": "_symbol", "ts_ms": "_ts_ms"})
    windows = windows.join(found, F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.col("ts_ms") == F.col("_ts_ms")), "left")
    return windows.select("symbol", wall_clock(F.col("ts_ms")).alias("timestamp_dt"), "ts_ms", *[c.alias(n) for n, c in out.items()])
