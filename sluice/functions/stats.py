"""Aggregates that Spark lacks or defines in another way; all give null where a statistic is undefined."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sorted_values(x: Column) -> Column:
    """All values that aren't null, in order: what the quantiles of a group share."""
    return F.sort_array(F.collect_list(x))


def nearest_rank(ordered: Column, q: float) -> Column:
    """The value at rank round(q * (n - 1)) of an ordered array, without interpolation; null if empty."""
    at = F.round(F.lit(q) * (F.size(ordered) - 1)).cast("int")
    return F.when(F.size(ordered) > 0, F.get(ordered, at))


def count_unique(ordered: Column, has_null: Column) -> Column:
    """Distinct values of a group; null counts as one value."""
    return (F.size(F.array_distinct(ordered)) + has_null).cast("bigint")


#: A series whose deviation is no more than this share of its largest value is constant up to rounding.
LEAST_SPREAD = 1e-9


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation; null where a series is constant up to rounding (LEAST_SPREAD)."""
    a, b = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    varies = lambda c: F.stddev_pop(c) > LEAST_SPREAD * F.greatest(F.abs(F.min(c)), F.abs(F.max(c)))
    return F.when(varies(a) & varies(b), F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)))


def first_by(x: Column, order: Column, where: Column | None = None) -> Column:
    """The value of the first row, of those where the condition holds; a null value isn't skipped."""
    return F.min_by(F.struct(x.alias("x")), order if where is None else F.when(where, order))["x"]


def last_by(x: Column, order: Column, where: Column | None = None) -> Column:
    return F.max_by(F.struct(x.alias("x")), order if where is None else F.when(where, order))["x"]


def total(x: Column) -> Column:
    """Sum, 0 of nothing."""
    return F.coalesce(F.sum(x), F.lit(0.0))


class Moments:
    """Statistics of a series that merge: taken of units, then of all units of a window.

    ``taken`` are aggregates of rows by unit; ``mean`` is the window's mean, over its units; ``merged`` are aggregates of a window's units,
    from which ``mean``, ``std``, ``skew`` and the like are read. Central moments are shifted to the window's mean, so nothing cancels.
    """

    def __init__(self, name: str, shape: bool = False) -> None:
        self.name, self.shape = name, shape

    def _c(self, part: str) -> Column:
        return F.col(f"_{self.name}_{part}")

    def taken(self, x: Column) -> dict[str, Column]:
        n, m2 = F.count(x), F.var_pop(x) * F.count(x)
        out = {"n": n, "m": F.coalesce(F.avg(x), F.lit(0.0)), "m2": F.coalesce(m2, F.lit(0.0)), "lo": F.min(x), "hi": F.max(x)}
        if self.shape:
            zero = F.lit(0.0)
            out |= {"m3": F.coalesce(F.skewness(x) * F.pow(m2, 1.5) / F.sqrt(n), zero), "m4": F.coalesce((F.kurtosis(x) + 3) * m2 * m2 / n, zero)}
        return {f"_{self.name}_{k}": v for k, v in out.items()}

    def joined_by(self, x: Column) -> dict[str, Column]:
        """A unit's parts with one more value, unless it's null (without shape)."""
        one = F.when(x.isNotNull(), 1).otherwise(0)
        n = self._c("n") + one
        m = self._c("m") + F.coalesce((x - self._c("m")) / n, F.lit(0.0))
        m2 = self._c("m2") + F.coalesce((x - self._c("m")) * (x - self._c("m")) * self._c("n") / n, F.lit(0.0))
        return {f"_{self.name}_{k}": v for k, v in {"n": n, "m": m, "m2": m2, "lo": F.least(self._c("lo"), x), "hi": F.greatest(self._c("hi"), x)}.items()}

    def moved(self, by: Column) -> dict[str, Column]:
        """A unit's parts for values that are all larger by so much."""
        return {f"_{self.name}_{k}": self._c(k) + by for k in ("m", "lo", "hi")}

    def centre(self, window) -> dict[str, Column]:
        n = self._c("n")
        return {f"_{self.name}_c": F.try_divide(F.sum(n * self._c("m")).over(window), F.sum(n).over(window))}

    def merged(self) -> dict[str, Column]:
        n, m2, d = self._c("n"), self._c("m2"), self._c("m") - self._c("c")
        out = {"n": F.sum(n), "c": F.first(self._c("c")), "m2": F.sum(m2 + n * d * d), "lo": F.min(self._c("lo")), "hi": F.max(self._c("hi"))}
        if self.shape:
            m3, m4 = self._c("m3"), self._c("m4")
            out |= {"m3": F.sum(m3 + 3 * d * m2 + n * d * d * d), "m4": F.sum(m4 + 4 * d * m3 + 6 * d * d * m2 + n * d * d * d * d)}
        return {f"_{self.name}_{k}": v for k, v in out.items()}

    @property
    def mean(self) -> Column:
        return self._c("c")

    @property
    def least(self) -> Column:
        return self._c("lo")

    @property
    def largest(self) -> Column:
        return self._c("hi")

    @property
    def std(self) -> Column:
        spread = F.when(self._c("lo") < self._c("hi"), self._c("m2")).otherwise(F.lit(0.0))
        return F.when(self._c("n") > 1, F.sqrt(F.try_divide(spread, self._c("n") - 1)))

    @property
    def skew(self) -> Column:
        return F.when(self._c("lo") < self._c("hi"), F.try_divide(F.sqrt(self._c("n")) * self._c("m3"), F.pow(self._c("m2"), 1.5)))

    @property
    def kurtosis(self) -> Column:
        return F.when(self._c("lo") < self._c("hi"), F.try_divide(self._c("n") * self._c("m4"), self._c("m2") * self._c("m2")) - 3)


class PairMoments:
    """Two series whose Pearson correlation merges in the same way; rows with a null in either don't count."""

    def __init__(self, name: str) -> None:
        self.name, self.x, self.y = name, Moments(f"{name}_x"), Moments(f"{name}_y")

    def taken(self, x: Column, y: Column) -> dict[str, Column]:
        a, b = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
        return self.x.taken(a) | self.y.taken(b) | {f"_{self.name}_xy": F.coalesce(F.covar_pop(a, b) * F.count(a), F.lit(0.0))}

    def centre(self, window) -> dict[str, Column]:
        return self.x.centre(window) | self.y.centre(window)

    def merged(self) -> dict[str, Column]:
        d = lambda s: s._c("m") - s._c("c")
        return self.x.merged() | self.y.merged() | {f"_{self.name}_xy": F.sum(F.col(f"_{self.name}_xy") + self.x._c("n") * d(self.x) * d(self.y))}

    @property
    def corr(self) -> Column:
        """As safe_corr."""
        varies = lambda s: F.sqrt(F.try_divide(s._c("m2"), s._c("n"))) > LEAST_SPREAD * F.greatest(F.abs(s._c("lo")), F.abs(s._c("hi")))
        return F.when(varies(self.x) & varies(self.y), F.try_divide(F.col(f"_{self.name}_xy"), F.sqrt(self.x._c("m2")) * F.sqrt(self.y._c("m2"))))
