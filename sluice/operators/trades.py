"""Trade features over hop windows: 91 columns a window.

Trades are reduced to panes of five minutes and blocks of an hour, from which windows are put together, for all that merges. Quantiles and
distinct counts come from values counted by pane, which go to the days of their windows (see functions.ranks): two rows at most, whatever
the number of windows. So a busy symbol costs no more rows a window than its units, and no window's trades are held together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions import stats as S
from sluice.functions.ranks import pivoted, window_ranks
from sluice.functions.timeutil import STEP_MS, cover_windows, interval_ms, next_boundary, wall_clock, with_previous, with_units

SIDES = {"trade": None, "buy": "buy", "sell": "sell"}
QUANTILES = ("0.25", "0.50", "0.75")
#: Column groups; a query may ask for some of them only.
GROUPS = ("volume", "ticks", "price", "size", "rate", "corr", "count")


def prepare_trades(trades: DataFrame) -> DataFrame:
    """Adds turnover and what the in-window differences need; ties in time go by trade_id."""
    ready = trades.withColumn("turnover", F.col("price") * F.col("size"))
    order = ["created_time", "trade_id"]
    ready = with_previous(ready, ["symbol"], "created_time", order, {"p_time": "created_time", "p_price": "price"})
    return with_previous(ready, ["symbol", "side"], "created_time", order, {"p_side_time": "created_time"})


def _of(side: str, x: Column) -> Column:
    return x if SIDES[side] is None else F.when(F.col("side") == side, x)


def _value_ranks(trades: DataFrame, names: list[str], interval: str, first_end: int | None, last_end: int | None) -> DataFrame:
    """Quantiles by nearest rank, and distinct values (null is one), of each window and side."""
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("double").alias("value")) for n in names]))
    panes = trades.select("symbol", next_boundary(F.col("created_time")).alias("pane"), "side", pairs.alias("v"))
    counts = panes.groupBy("symbol", "pane", "v.name", "v.value").agg(*[F.count(_of(s, F.lit(1))).alias(s) for s in SIDES])
    columns = {f"{n}_{q}_{s}": (n, f"q_{s}_{q}") for n in names for s in SIDES for q in QUANTILES} | {f"nunique_{n}_{s}": (n, f"nunique_{s}") for n in names for s in SIDES}
    return pivoted(window_ranks(counts, list(SIDES), QUANTILES, interval, first_end, last_end), columns)


def trade_windows(trades: DataFrame, interval: str, groups: tuple[str, ...] = GROUPS, first_end: int | None = None, last_end: int | None = None) -> DataFrame:
    """One row for each symbol and window with trades: symbol, timestamp_dt, ts_ms and the groups' columns.

    ``trades`` has symbol, trade_id, side, price, size, created_time (ms). Only columns of the asked groups
    are computed. Constant series have null skew, kurtosis and correlation; empty sums are 0.
    """
    ready = trades.withColumn("turnover", F.col("price") * F.col("size"))
    if {"ticks", "rate"} & set(groups):
        ready = prepare_trades(trades)
    plain = trades
    t, end, order = F.col("created_time"), F.col("unit_end"), F.struct("created_time", "trade_id")
    span = interval_ms(interval)
    if first_end is not None:
        ready, plain = ready.where(t >= first_end - span), plain.where(t >= first_end - span)
    if last_end is not None:
        ready, plain = ready.where(t < last_end), plain.where(t < last_end)
    units = with_units(ready, t, interval)
    unit_start, start = end - F.col("unit"), F.col("ts_ms") - span
    taken: dict[str, Column] = {"_rows": F.count(F.lit(1))}  # of a unit's trades
    seen: dict[str, Column] = {}  # of a unit, from a window
    merged: dict[str, Column] = {"trade_count": F.sum("_rows")}  # of a window's units
    out: dict[str, Column] = {"trade_count": F.col("trade_count")}
    series: list[S.Moments | S.PairMoments] = []

    def add(name: str, by_unit: Column, of_units=F.sum) -> None:
        taken[f"_{name}"], merged[name], out[name] = by_unit, of_units(F.col(f"_{name}")), F.col(name)

    for side in SIDES:
        taken[f"_rows_{side}"] = F.count(_of(side, F.lit(1)))
    if "volume" in groups:
        for side in ("buy", "sell"):
            add(f"volume_{side}", S.total(_of(side, F.col("size"))))
            add(f"turnover_{side}", S.total(_of(side, F.col("turnover"))))
            add(f"count_{side}", F.count(_of(side, F.col("side"))))
    if "ticks" in groups:
        # of a unit's trades only the first has its predecessor outside; it counts where that one is in the window
        change, inner = F.col("price") - F.col("p_price"), F.col("p_time") >= unit_start
        taken |= {"_edge_time": F.max(F.when(~inner, F.col("p_time"))), "_edge_change": F.max(F.when(~inner, change))}
        for name, test in (("up", lambda c: c > 0), ("down", lambda c: c < 0)):
            taken[f"_tick_{name}"] = F.count(F.when(inner & test(change), 1))
            seen[f"_tick_{name}"] = F.col(f"_tick_{name}") + F.when((F.col("_edge_time") >= start) & test(F.col("_edge_change")), 1).otherwise(0)
            merged[f"count_tick_{name}"] = F.sum(f"_tick_{name}")
            out[f"count_tick_{name}"] = F.col(f"count_tick_{name}")
    valued = [n for n in ("price", "size") if n in groups]
    for side in SIDES:
        where = None if SIDES[side] is None else F.col("side") == side
        if "price" in groups:
            for name, by_order, by_unit in (("first", S.first_by, F.min_by), ("last", S.last_by, F.max_by)):
                taken[f"_{name}_{side}"] = by_order(F.col("price"), order, where)
                merged[f"price_{name}_{side}"] = by_unit(F.col(f"_{name}_{side}"), F.when(F.col(f"_rows_{side}") > 0, end))
                out[f"price_{name}_{side}"] = F.col(f"price_{name}_{side}")
        for name in valued:
            m = S.Moments(f"{name}_{side}", shape=True)
            series.append(m)
            taken |= m.taken(_of(side, F.col(name)))
            out |= {f"{name}_mean_{side}": m.mean, f"{name}_std_{side}": m.std, f"{name}_min_{side}": m.least, f"{name}_max_{side}": m.largest, f"{name}_skew_{side}": m.skew, f"{name}_kurtosis_{side}": m.kurtosis}
        if "rate" in groups:
            before, m = _of(side, F.col("p_time" if side == "trade" else "p_side_time")), S.Moments(f"gap_{side}")
            series.append(m)
            inner, edge = before >= unit_start, F.col(f"_gap_{side}_edge")
            taken |= m.taken(F.when(inner, (t - before).cast("double"))) | {f"_gap_{side}_before": F.max(F.when(~inner, before)), f"_gap_{side}_edge": F.max(F.when(~inner, (t - before).cast("double")))}
            seen |= m.joined_by(F.when(F.col(f"_gap_{side}_before") >= start, edge))
            out |= {f"rate_mean_ms_{side}": m.mean, f"rate_std_ms_{side}": m.std, f"rate_max_ms_{side}": m.largest, f"rate_min_ms_{side}": m.least}
    if "corr" in groups:
        age = (end - t).cast("double")
        for name, x, y in (("price_size", F.col("price"), F.col("size")), ("price_time", F.col("price"), age), ("size_time", F.col("size"), age)):
            p = S.PairMoments(name)
            series.append(p)
            taken |= p.taken(x, y)
            if name.endswith("time"):
                seen |= p.y.moved(F.col("ts_ms") - end)
            out[f"corr_{name}_trade"] = p.corr
    if "count" in groups:
        add("last_trade_time_ms", F.max(t), F.max)
    by_unit = units.groupBy("symbol", "unit", "unit_end").agg(*[c.alias(n) for n, c in taken.items()])
    rows = cover_windows(by_unit, interval, STEP_MS, first_end, last_end).withColumns(seen)
    if series:
        window = Window.partitionBy("symbol", "ts_ms")
        rows = rows.withColumns({n: c for m in series for n, c in m.centre(window).items()})
    merged |= {n: c for m in series for n, c in m.merged().items()}
    windows = rows.groupBy("symbol", "ts_ms").agg(*[c.alias(n) for n, c in merged.items()])
    windows = windows.select("symbol", "ts_ms", *[c.alias(n) for n, c in out.items()])
    if valued:
        ranks = _value_ranks(plain, valued, interval, first_end, last_end).withColumnsRenamed({"symbol": "_symbol", "ts_ms": "_ts_ms"})
        windows = windows.join(ranks, F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.col("ts_ms") == F.col("_ts_ms")), "left").drop("_symbol", "_ts_ms")
    keep = [c for c in windows.columns if c not in ("symbol", "ts_ms")]
    return windows.select("symbol", wall_clock(F.col("ts_ms")).alias("timestamp_dt"), "ts_ms", *[F.col(f"`{c}`") for c in keep])
