"""Completeness of feature tables: missing windows, what they invalidate, filling, keyed merges."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.timeutil import INTERVALS, STEP_MS, expand_windows, interval_ms


def complete_ends(table: DataFrame, rule: str = "all_non_null", keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, ts_ms) of finished windows: every value present, or with rule "row_exists" any row."""
    if rule == "row_exists":
        return table.select(*keys, "ts_ms").distinct()
    whole = F.lit(True)
    for c in table.columns:
        whole = whole & F.col(f"`{c}`").isNotNull()
    return table.where(whole).select(*keys, "ts_ms").distinct()


def expected_ends(spark, start_ms: int, now_ms: int, step_ms: int = STEP_MS) -> DataFrame:
    """(ts_ms) of all windows from start to now, both included."""
    return spark.range(start_ms, now_ms + 1, step_ms).select(F.col("id").alias("ts_ms"))


#: Windows whose presence is one mask.
MASK = 48


def missing_ends(table: DataFrame, start_ms: int, now_ms: int, rule: str = "all_non_null", keys: tuple[str, ...] = (), of: DataFrame | None = None) -> DataFrame:
    """(keys, ts_ms) that are expected but not complete. ``now_ms`` is an argument, so a run can be repeated.

    With ``keys`` (such as the symbol) every window is expected of each key in ``of``, or else in the table. Complete windows are bits of a mask,
    one for each key and MASK windows; only masks meet what is expected, and rows are made of missing windows alone.
    """
    number = (now_ms - start_ms) // STEP_MS + 1
    slot = (F.col("ts_ms") - start_ms) / STEP_MS
    ends = complete_ends(table, rule, keys).where(F.col("ts_ms").between(start_ms, now_ms) & ((F.col("ts_ms") - start_ms) % STEP_MS == 0)).withColumn("_slot", slot.cast("bigint"))
    masks = ends.groupBy(*keys, F.expr(f"_slot DIV {MASK}").alias("_block")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(_slot % {MASK} AS int))")).alias("_mask"))
    blocks = F.sequence(F.lit(0).cast("bigint"), F.lit((number - 1) // MASK).cast("bigint")) if number > 0 else F.array().cast("array<bigint>")
    named = (table if of is None else of).select(*keys).distinct() if keys else table.sparkSession.range(1).select()
    expected = named.select(*keys, F.explode(blocks).alias("_block"))
    joined = expected.join(masks, [*keys, "_block"], "left")
    absent = F.filter(F.sequence(F.lit(0), F.lit(MASK - 1)), lambda i: (F.getbit(F.coalesce("_mask", F.lit(0).cast("bigint")), i) == 0) & (F.col("_block") * MASK + i < number))
    return joined.select(*keys, "_block", F.explode(absent).alias("_bit")).select(*keys, ((F.col("_block") * MASK + F.col("_bit")) * STEP_MS + start_ms).alias("ts_ms"))


def pending_ends(wanted: DataFrame, existing: DataFrame) -> DataFrame:
    """Window ends that were asked for and aren't there yet."""
    return wanted.select("ts_ms").distinct().join(existing.select("ts_ms").distinct(), "ts_ms", "left_anti")


def windows_at(windows: DataFrame, ends: DataFrame) -> DataFrame:
    """The windows that end at the asked times."""
    return windows.join(ends.select("ts_ms").distinct(), "ts_ms", "left_semi")


def propagate(missing: DataFrame, now_ms: int, cascade: bool = False, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, interval, ts_ms): the windows that missing ones make stale; ``missing`` has keys, interval, ts_ms.

    A missing window at X invalidates windows of a longer interval I from X to X + I - 5 minutes. Exactly
    those follow from the five-minute windows; with ``cascade`` every interval's stale windows invalidate the
    longer ones in turn, which reaches further.
    """
    spread = lambda df, to: df.select(*keys, F.lit(to).alias("interval"), F.explode(F.sequence("ts_ms", F.col("ts_ms") + (interval_ms(to) - STEP_MS), F.lit(STEP_MS))).alias("ts_ms")).where(F.col("ts_ms") <= now_ms)
    stale = {i: missing.where(F.col("interval") == i).select(*keys, "interval", "ts_ms") for i in INTERVALS}
    for k, source in enumerate(INTERVALS[:-1]):
        if k and not cascade:
            break
        for target in INTERVALS[k + 1 :]:
            stale[target] = stale[target].unionByName(spread(stale[source], target)).distinct()
    out = stale[INTERVALS[0]]
    for i in INTERVALS[1:]:
        out = out.unionByName(stale[i])
    return out.distinct()


def fill(raw: DataFrame, time: str, interval: str, stale: DataFrame, aggregate: Callable[[DataFrame, str], DataFrame], keys: tuple[str, ...] = ()) -> DataFrame:
    """Windows of ``stale`` (keys, ts_ms) computed anew from raw rows. Only raw rows that such a window holds are read on."""
    wanted, on = stale.select(*keys, "ts_ms"), [*keys, "ts_ms"]
    times = raw.select(*keys, F.col(time).alias("_t")).distinct()
    needed = expand_windows(times, F.col("_t"), interval).join(wanted, on, "left_semi").select(*keys, "_t").distinct()
    rows = raw.withColumn("_t", F.col(time)).join(needed, [*keys, "_t"], "left_semi").select(*raw.columns)
    return aggregate(rows, interval).join(wanted, on, "left_semi")


def merge_by_key(existing: DataFrame, new: DataFrame, keys: list[str], arrival: Column | None = None) -> DataFrame:
    """Upsert: rows of ``new`` replace those of equal key whole, nulls too; of equal keys in new the last in ``arrival`` counts."""
    order = arrival if arrival is not None else F.lit(0)
    both = existing.withColumn("_new", F.lit(0)).withColumn("_at", F.lit(None).cast("string")).unionByName(new.withColumn("_at", order.cast("string")).withColumn("_new", F.lit(1)))
    rank = Window.partitionBy(*keys).orderBy(F.desc("_new"), F.desc(F.length("_at")), F.desc("_at"))
    return both.withColumn("_rank", F.row_number().over(rank)).where("_rank = 1").drop("_rank", "_new", "_at")


def between(df: DataFrame, time: str, start_ms: int, end_ms: int) -> DataFrame:
    """Rows from start to end, both included: a copy without aggregation."""
    return df.where(F.col(time).between(start_ms, end_ms))
