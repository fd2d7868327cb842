"""Streams: raw messages into bronze tables, feature windows at five-minute boundaries, rates passed through.

All sinks are idempotent by key, so a batch that runs again after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.functions.timeutil import INTERVALS, STEP_MS, interval_ms, wall_clock
from sluice.operators.bronze import accepted, rejected
from sluice.sources import tables
from sluice.streaming.recent import changed_panes, in_panes

#: A stream holds raw rows of this span for its longest windows.
DAY_MS = 86_400_000
KEEP_MS = 2 * DAY_MS


def parse(stream: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """JSON values as columns; values that don't parse are left out."""
    rows = stream.select(F.from_json(F.col(column).cast("string"), schema).alias("r"))
    return rows.where("r is not null").select("r.*")


def first_seen(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """The first message of each key within the delay; later ones are dropped, state goes with the watermark."""
    stamped = stream.withColumn("_time", F.timestamp_millis(time)).withWatermark("_time", delay)
    return stamped.dropDuplicatesWithinWatermark(keys).drop("_time")


def to_bronze(
    stream: DataFrame, path: str, schema: str, keys: list[str], time: str, checkpoint: str, period: str = "day", judge: Callable[[DataFrame], DataFrame] | None = None, **trigger,
) -> StreamingQuery:
    """Micro-batches merged into a bronze table, of equal keys the latest; failures stop the query.

    With ``judge`` (raw rows to parsed ones with ``raw`` and ``reason``, as bronze.judged_trades) rows that don't parse aren't lost: they go to
    path-rejected, and path-counts has the numbers of rows and rejected rows of each batch. Both are kept by batch, so a batch that runs again replaces its own.
    """

    def sink(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if judge is not None:
            seen, judged = Observation(), judge(batch)
            counted = judged.observe(seen, F.count(F.lit(1)).alias("rows"), F.count("reason").alias("rejected"))
            rejected(counted).write.mode("overwrite").parquet(f"{path}-rejected/batch={number}")
            counts = seen.get
            spark.createDataFrame([(counts["rows"], counts["rejected"])], "rows bigint, rejected bigint").write.mode("overwrite").parquet(f"{path}-counts/batch={number}")
            batch = accepted(judged)
        tables.merge(spark, path, batch, schema, keys, time, period)

    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def to_silver(
    stream: DataFrame, root: str, schema: str, keys: list[str], time: str, aggregate: Callable[[DataFrame, str, int, int], DataFrame], checkpoint: str,
    intervals: tuple[str, ...] = INTERVALS, late_ms: int = 0, units: Callable[[DataFrame], DataFrame] | None = None, initial: DataFrame | None = None,
    revise: bool = True, keep_ms: int = KEEP_MS, **trigger,
) -> StreamingQuery:
    """Windows of all intervals whenever event time passes a five-minute boundary, and again when late rows change them.

    Rows are state by symbol and pane (see recent.changed_panes): of equal ``keys`` the latest, for ``keep_ms`` behind the newest row. A trigger gives out
    the panes that it changed; they are reduced by ``units`` (rows with ``pane`` to rows with symbol and pane; rows themselves without it) and replace
    what root/recent held of them, in partitions of an hour. Then ``aggregate(units, interval, first_end, last_end)`` makes the windows that end after the
    boundary reached before and not after the new one, boundaries that a burst skips included, and with ``revise`` those emitted before
    that hold a changed pane. They are merged into root/interval by symbol and ts_ms. A trigger so costs what its changed panes and the recent hours
    of the windows over them cost, whatever came before; partitions of no more use are deleted when the date changes. root/changes has the panes changed by each batch. ``initial`` are raw rows of the
    days before (a bronze table's latest partitions): a stream that starts from them gives the windows of one that ran all along.
    """
    if initial is not None:
        initial = initial.select(*stream.columns)

    def replaced(spark: SparkSession, new: DataFrame, panes: DataFrame) -> None:
        """Puts whole panes in the place of what root/recent has of them."""
        tables.finish_swap(spark, f"{root}/recent")
        new = new.withColumn("dt", _hour(F.col("pane")))
        old = tables.read(spark, f"{root}/recent", ", ".join(f"`{c}` {t}" for c, t in new.dtypes if c not in ("symbol", "dt")))
        hours = panes.select("symbol", _hour(F.col("pane")).alias("dt")).distinct()
        kept = old.join(F.broadcast(hours), ["symbol", "dt"], "left_semi").join(panes, ["symbol", "pane"], "left_anti") if tables.exists(spark, f"{root}/recent") else None
        tables.swap(spark, f"{root}/recent", new if kept is None else new.unionByName(kept.select(*new.columns)))

    def sink(batch: DataFrame, number: int) -> None:
        spark, seen, stage = batch.sparkSession, Observation(), f"{root}/stage"
        made = batch.observe(seen, F.max(time).alias("newest"))
        (made if units is None else units(made)).write.mode("overwrite").parquet(stage)  # the only action on the state
        done, before, since = _state(spark, f"{root}/state")
        if done is None and initial is not None and not initial.isEmpty():
            known = in_panes(initial, time)
            new = known if units is None else units(known)
            replaced(spark, new, new.select("symbol", "pane").distinct())
            before, least = initial.agg(F.max(time), F.min(time)).first()
            since = least // STEP_MS * STEP_MS
            done = (before - late_ms) // STEP_MS * STEP_MS
        newest = seen.get.get("newest")
        if newest is None:
            return
        new = spark.read.parquet(stage)
        new.select("symbol", "pane").distinct().write.mode("overwrite").parquet(f"{root}/changes/batch={number}")
        panes = spark.read.parquet(f"{root}/changes/batch={number}")
        replaced(spark, new, panes)
        newest = max(newest, before or newest)
        reached, first = (newest - late_ms) // STEP_MS * STEP_MS, panes.agg(F.min("pane")).first()[0]
        oldest = first if done is None else done + STEP_MS
        begin = min(oldest, first) if revise else oldest
        for interval in intervals if begin <= reached else ():
            span = interval_ms(interval)
            recent = spark.read.parquet(f"{root}/recent").where((F.col("dt") >= _hour(F.lit(begin - span))) & F.col("pane").between(begin - span + STEP_MS, reached)).drop("dt")
            stale = panes.select("symbol", F.explode(F.sequence("pane", F.col("pane") + (span - STEP_MS), F.lit(STEP_MS))).alias("ts_ms")).distinct()
            stale = stale.where(F.col("ts_ms") - span >= (since or 0)).withColumn("_stale", F.lit(True))
            windows = aggregate(recent, interval, begin, reached)
            wanted = windows.join(stale, ["symbol", "ts_ms"], "left").where((F.col("ts_ms") >= oldest) | F.col("_stale")) if revise else windows
            _upsert_windows(spark, f"{root}/{interval}", wanted.select(*windows.columns))
        if newest // DAY_MS > (before or newest) // DAY_MS:
            _forget(spark, f"{root}/recent", newest - keep_ms - max(map(interval_ms, intervals)))
        spark.createDataFrame([(max(reached, done or reached), newest, since)], _STATE).coalesce(1).write.mode("append").parquet(f"{root}/state")

    panes = changed_panes(stream, keys, time, keep_ms, initial)
    return panes.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def _hour(pane: Column) -> Column:
    """The hour in which a pane lies, as the name of a partition."""
    return F.date_format(F.timestamp_millis(pane - 1), "yyyy-MM-dd-HH")


def _forget(spark: SparkSession, path: str, before_ms: int) -> None:
    """Deletes the partitions of the hours before."""
    label = spark.range(1).select(_hour(F.lit(before_ms + 1))).first()[0]
    old = spark.read.parquet(path).where(F.col("dt") < label).select("symbol", "dt").distinct()
    for r in old.collect():  # one row a symbol and hour of the days that go
        tables.delete(spark, f"{path}/symbol={r['symbol']}/dt={r['dt']}")


_STATE = "reached bigint, newest bigint, since bigint"


def _state(spark: SparkSession, path: str) -> tuple[int | None, int | None, int | None]:
    """The boundary reached, the newest time seen, and where the rows known from before begin."""
    if not tables.exists(spark, path):
        return None, None, None
    return tuple(spark.read.schema(_STATE).parquet(path).agg(F.max("reached"), F.max("newest"), F.max("since")).first())


def _upsert_windows(spark: SparkSession, path: str, new: DataFrame) -> None:
    schema = ", ".join(f"`{c}` {t}" for c, t in new.dtypes if c != "symbol")
    tables.merge(spark, path, new, schema, ["ts_ms"], "ts_ms")


def pass_through(stream: DataFrame, path: str, schema: str, key: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Rows copied as they are, upserted by key into monthly partitions."""
    return to_bronze(stream, path, schema, [key], key, checkpoint, "month", None, **trigger)


def stream_bars(stream: DataFrame, interval: str, lateness: str = "0 seconds") -> DataFrame:
    """Bars over hop windows as a streaming aggregate; a window comes out when the watermark passes its end.

    ``stream`` has symbol, open_time, open, high, low, close; bars count at their close. Meant for intervals of up
    to four hours: a day's windows at five-minute steps are better made by to_silver.
    """
    close = F.col("open_time") + 60_000
    rows = stream.withColumn("_time", F.timestamp_millis(close)).withWatermark("_time", lateness)
    hop = F.window("_time", f"{interval_ms(interval) // 1000} seconds", f"{STEP_MS // 1000} seconds")
    out = rows.groupBy("symbol", hop.alias("w")).agg(F.min_by("open", "open_time").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "open_time").alias("close"), F.avg("close").alias("mean"), F.stddev_samp("close").alias("std"))
    end = F.unix_millis("w.end")
    return out.select("symbol", wall_clock(end).alias("timestamp_dt"), end.alias("ts_ms"), "open", "high", "low", "close", "mean", "std")

