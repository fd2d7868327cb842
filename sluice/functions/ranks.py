"""Exact quantiles and distinct counts of overlapping windows, without sending a value to every window that holds it.

Values are counted by pane. A value goes to the day in which its windows end (two at most for windows up to a day), and there all windows are answered
together: in order of panes a window is a range of rows, and a wavelet matrix over the ranks of values finds the value at a rank of any
range in as many steps as ranks have bits. Values of a day beyond GROUP rows are cut into bins by value, so no task holds more than a bin: every window gets its
weights by bin, sums over bins find the bin of each rank, and only that bin is asked.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.timeutil import STEP_MS, interval_ms

DAY_MS = 86_400_000
#: Rows (different values of a pane) of one name, symbol and day that a task takes; more are cut into bins, BINS at most.
GROUP, BINS = 500_000, 256


class Wavelet:
    """Ranks of rows in their order, with weights: levels of bits from the most significant one, zeros before ones in each next level."""

    def __init__(self, ranks: np.ndarray, weights: np.ndarray | None = None) -> None:
        self.levels, order = [], np.arange(len(ranks))
        for bit in range(int(ranks.max(initial=0)).bit_length() - 1, -1, -1):
            zero = (ranks[order] >> bit) & 1 == 0
            count = np.concatenate([[0], np.cumsum(zero)])
            weight = None if weights is None else np.concatenate([[0], np.cumsum(np.where(zero, weights[order], 0))])
            self.levels.append((bit, count, weight))
            order = np.concatenate([order[zero], order[~zero]])

    def at(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The rank of the row in which the weights from lo to hi, added up in order of rank, pass k."""
        lo, hi, k, out = lo.copy(), hi.copy(), k.copy(), np.zeros(len(lo), np.int64)
        for bit, count, weight in self.levels:
            below = weight[hi] - weight[lo]
            up = k >= below
            k -= np.where(up, below, 0)
            out |= up.astype(np.int64) << bit
            ones = count[-1]
            lo, hi = np.where(up, ones + lo - count[lo], count[lo]), np.where(up, ones + hi - count[hi], count[hi])
        return out

    def fewer(self, hi: np.ndarray, than: np.ndarray) -> np.ndarray:
        """How many of the first ``hi`` rows have a rank below ``than``."""
        lo, hi, out = np.zeros(len(hi), np.int64), hi.copy(), np.zeros(len(hi), np.int64)
        if self.levels:
            beyond = than >> (self.levels[0][0] + 1) > 0
        else:
            beyond = than > 0
        everything = hi.copy()
        for bit, count, _ in self.levels:
            up = (than >> bit) & 1 == 1
            out += np.where(up, count[hi] - count[lo], 0)
            ones = count[-1]
            lo, hi = np.where(up, ones + lo - count[lo], count[lo]), np.where(up, ones + hi - count[hi], count[hi])
        return np.where(beyond, everything, out)


def _ranked(panes: np.ndarray, values: np.ndarray, weights: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(weight, distinct, value at rank) of windows: weights and distinct values of each window, and a function of ranks; NaN stands for null."""
    here = weights > 0
    panes, values, weights = panes[here], values[here], weights[here]
    order = np.argsort(panes, kind="stable")
    panes, values, weights = panes[order], values[order], weights[order]
    lo, hi = np.searchsorted(panes, starts, "right"), np.searchsorted(panes, ends, "right")
    known, ranks = np.unique(values, return_inverse=True)  # one NaN, the last
    counted = np.where(np.isnan(values), 0, weights)
    total = np.concatenate([[0], np.cumsum(counted)])
    before, by_value = np.zeros(len(ranks), np.int64), np.lexsort((np.arange(len(ranks)), ranks))
    same = ranks[by_value][1:] == ranks[by_value][:-1]
    before[by_value[1:]] = np.where(same, by_value[:-1] + 1, 0)  # place of the same value's row before, from 1
    distinct = Wavelet(before).fewer(hi, lo + 1) - lo
    tree = Wavelet(ranks, counted)
    return total[hi] - total[lo], distinct, lambda at, k: known[tree.at(lo[at], hi[at], k)] if len(known) else np.zeros(0)


def nearest_rank(share: float, weight: np.ndarray) -> np.ndarray:
    """Place of a quantile among so many values, from 0; halves go up."""
    return np.floor(share * (weight - 1) + 0.5).astype(np.int64)


def _columns(table: pa.Table, names: list[str]) -> list[np.ndarray]:
    return [table[c].combine_chunks().to_numpy(zero_copy_only=False) for c in names]


def _answer(weights: list[str], quantiles: tuple[str, ...], span: int, first_end: int | None, last_end: int | None):
    """All windows of a day over one bin of values; quantiles only where the bin is the only one."""

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        symbol, name, day, bin_, bins = (k.as_py() for k in key)
        panes, values, *counts = _columns(table, ["pane", "value", *weights])
        ends = np.arange(day * DAY_MS + STEP_MS, (day + 1) * DAY_MS + 1, STEP_MS)
        ends = ends[(ends >= (first_end or ends[0])) & (ends <= (last_end or ends[-1]))]
        ordered = np.sort(panes)
        ends = ends[np.searchsorted(ordered, ends, "right") > np.searchsorted(ordered, ends - span, "right")]
        n = len(ends)
        out: dict[str, object] = {"symbol": pa.array([symbol] * n, pa.string()), "name": pa.array([name] * n, pa.string()), "ts_ms": ends, "day": np.full(n, day), "bin": np.full(n, bin_, np.int32), "bins": np.full(n, bins, np.int32)}
        for w, c in zip(weights, counts, strict=True):
            total, out[f"nunique_{w}"], value_at = _ranked(panes, values, c, ends - span, ends)
            out[f"n_{w}"] = total
            some = np.flatnonzero((total > 0) & (bins == 1))
            for q in quantiles:
                found = np.full(n, np.nan)
                found[some] = value_at(some, nearest_rank(float(q), total[some]))
                out[f"q_{w}_{q}"] = pa.array(found, mask=np.isnan(found))
        return pa.table(out)

    return answer


def _refine(weights: list[str], span: int):
    """Values at ranks within one bin: rows (ts_ms, w, q, k) that ask meet the bin's values."""

    def refine(key: tuple, table: pa.Table, asked: pa.Table) -> pa.Table:
        panes, values, *counts = _columns(table, ["pane", "value", *weights])
        ends, which, q, k = _columns(asked, ["ts_ms", "w", "q", "k"])
        found = np.full(len(ends), np.nan)
        for j, c in enumerate(counts):
            mine = np.flatnonzero(which == j)
            if len(mine):
                _, _, value_at = _ranked(panes, values, c, ends[mine] - span, ends[mine])
                found[mine] = value_at(np.arange(len(mine)), k[mine])
        symbol, name = key[0].as_py(), key[1].as_py()
        return pa.table({"symbol": pa.array([symbol] * len(ends), pa.string()), "name": pa.array([name] * len(ends), pa.string()), "ts_ms": ends, "w": which, "q": q, "value": found})

    return refine


def window_ranks(
    counts: DataFrame, weights: list[str], quantiles: tuple[str, ...], interval: str, first_end: int | None = None, last_end: int | None = None, group: int = GROUP,
) -> DataFrame:
    """(symbol, name, ts_ms, and of each weight n_, nunique_ and q_ columns) of all windows with rows.

    ``counts`` has symbol, pane (its end, ms), name, value (double; null and NaN are one value to nunique, none to the quantiles) and the weights,
    numbers of rows (bigint). Of a weight w, ``n_w`` is the number of rows with a value, ``nunique_w`` that of different values, and
    ``q_w_<quantile>`` the value at rank round(quantile * (n - 1)), null without values. Equal (pane, name, value) rows are added first.
    """
    span, key = interval_ms(interval), ["symbol", "name", "day"]
    day = lambda c: F.floor((c - 1) / DAY_MS)
    lo, hi = F.col("pane"), F.col("pane") + (span - STEP_MS)
    lo = lo if first_end is None else F.greatest(lo, F.lit(first_end))
    hi = hi if last_end is None else F.least(hi, F.lit(last_end))
    counted = counts.groupBy("symbol", "name", "pane", "value").agg(*[F.sum(w).alias(w) for w in weights])
    dealt = counted.where(lo <= hi).withColumn("day", F.explode(F.sequence(day(lo), day(hi))))
    # the sizes read all weights, so that their plan and the one below share the shuffle of the counts
    big = dealt.groupBy(*key).agg(F.count(F.greatest(*weights) if len(weights) > 1 else F.col(weights[0])).alias("size"), F.percentile_approx("value", [k / BINS for k in range(1, BINS)], 4 * BINS).alias("edges")).where(F.col("size") > group)
    parts = F.least(F.lit(BINS), F.ceil(F.col("size") / group)).cast("int")
    edges = big.select(*[F.col(c).alias(f"_{c}") for c in key], F.array_distinct(F.transform(F.sequence(F.lit(1), parts - 1), lambda k: F.get("edges", F.floor(k * BINS / parts).cast("int") - 1))).alias("edges"))
    same = F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.col("name") == F.col("_name")) & (F.col("day") == F.col("_day"))
    bin_of = F.size(F.filter("edges", lambda e: F.coalesce(F.col("value") > e, F.lit(False))))

    def binned(how: str) -> DataFrame:
        both = dealt.join(edges, same, how).withColumn("bin", F.coalesce(bin_of, F.lit(0))).withColumn("bins", F.coalesce(F.size("edges") + 1, F.lit(1)))
        return both.select(*key, "bin", "bins", "pane", F.col("value").cast("double").alias("value"), *weights)

    stats = [f"{kind}_{w}" for w in weights for kind in ("n", "nunique")]
    ranked = [f"q_{w}_{q}" for w in weights for q in quantiles]
    schema = "symbol string, name string, ts_ms bigint, day bigint, bin int, bins int, " + ", ".join(f"nunique_{w} bigint, n_{w} bigint, " + ", ".join(f"`q_{w}_{q}` double" for q in quantiles) for w in weights)
    answered = lambda how: binned(how).groupBy(*key, "bin", "bins").applyInArrow(_answer(weights, quantiles, span, first_end, last_end), schema)
    first = answered("left")

    # windows of several bins: the bin of each rank, by weights added up in order of bins
    window = Window.partitionBy("symbol", "name", "ts_ms")
    ordered = window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    several = answered("inner").withColumns({f"all_{w}": F.sum(f"n_{w}").over(window) for w in weights} | {f"below_{w}": F.coalesce(F.sum(f"n_{w}").over(ordered), F.lit(0)) for w in weights})
    questions = []
    for j, w in enumerate(weights):
        for m, q in enumerate(quantiles):
            k = F.floor(F.lit(float(q)) * (F.col(f"all_{w}") - 1) + 0.5) - F.col(f"below_{w}")
            questions.append(F.when((k >= 0) & (k < F.col(f"n_{w}")), F.struct(F.lit(j).alias("w"), F.lit(m).alias("q"), k.cast("bigint").alias("k"))))
    asked = several.select(*key, "bin", "ts_ms", F.explode(F.array_compact(F.array(*questions))).alias("a")).select(*key, "bin", "ts_ms", "a.w", "a.q", "a.k")
    keyed = [*key, "bin"]
    second = binned("inner").groupBy(*keyed).cogroup(asked.groupBy(*keyed)).applyInArrow(_refine(weights, span), "symbol string, name string, ts_ms bigint, w int, q int, value double")
    refined = second.select("symbol", "name", "ts_ms", *[F.lit(None).cast("bigint").alias(c) for c in stats], *[F.when((F.col("w") == j) & (F.col("q") == m), F.col("value")).alias(f"q_{w}_{q}") for j, w in enumerate(weights) for m, q in enumerate(quantiles)])
    both = first.select("symbol", "name", "ts_ms", *stats, *[F.col(f"`{c}`") for c in ranked]).unionByName(refined)
    return both.groupBy("symbol", "name", "ts_ms").agg(*[F.sum(c).alias(c) for c in stats], *[F.max(F.col(f"`{c}`")).alias(c) for c in ranked])


def pivoted(ranks: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """(symbol, ts_ms and the columns): each taken as (name, column) of window_ranks."""
    return ranks.groupBy("symbol", "ts_ms").agg(*[F.max(F.when(F.col("name") == name, F.col(f"`{c}`"))).alias(out) for out, (name, c) in columns.items()])
