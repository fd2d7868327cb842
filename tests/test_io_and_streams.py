"""Tables, connectors and streams on local files."""

from __future__ import annotations

import io
import json
import os
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from sluice.operators import book, bronze
from sluice.operators.klines import kline_panes, kline_windows, windows_of_panes
from sluice.sources import connectors, fixtures, tables
from sluice.sources.schemas import KLINES, TRADES
from sluice.streaming import jobs
from tests.test_operators import MESSAGE

SF = "/root/testdata/sf0.001"


def service(symbol, after, limit):
    """A paged service: rows at every multiple of 7, newest first, before the cursor."""
    return [{"symbol": symbol, "t": t} for t in range((after - 1) // 7 * 7, -1, -7)][:limit]


def poll(at):
    return ([{"data": [{"x": at}]}, {"event": "subscribed"}] if at < 3 else []), min(at + 1, 3)


def test_paged_source(spark):
    connectors.register(spark)
    df = spark.read.format("paged").option("schema", "symbol string, t bigint").option("fetch", "tests.test_io_and_streams:service").option("symbols", "a,b").option("time", "t").option("start", 100).option("end", 5000).option("partitionms", 1000).load()
    assert sorted(map(tuple, df.collect())) == [(s, t) for s in "ab" for t in range(105, 5001, 7)]


def test_polled_source(spark, tmp_path):
    connectors.register(spark)
    stream = spark.readStream.format("polled").option("poll", "tests.test_io_and_streams:poll").load()
    q = stream.writeStream.format("memory").queryName("polled_rows").option("checkpointLocation", f"{tmp_path}/c").trigger(processingTime="100 milliseconds").start()
    for _ in range(4):
        q.processAllAvailable()
    q.stop()
    assert sorted(json.loads(r[0])["x"] for r in jobs.parse(spark.table("polled_rows"), "x int").select(F.to_json(F.struct("x"))).collect()) == [0, 1, 2]


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("rows.csv", "instrument_name,trade_id,side,price,size,created_time\nx,1,buy,1.5,2,3\n")
        z.writestr("note.txt", "no rows")
        z.writestr("more.csv", "instrument_name,trade_id,side,price,size,created_time\ny,2,sell,0.5,1,4\n")
    assert [tuple(r) for r in connectors.read_zipped_csv(spark, f"{tmp_path}/a.zip", TRADES).collect()] == [("x", 1, "buy", 1.5, 2.0, 3), ("y", 2, "sell", 0.5, 1.0, 4)]
    lines = [json.dumps({"instId": "m", "action": "SNAPSHOT", "ts": "60", "asks": [["1.5", "2"], ["bad"]], "bids": []}), "not json"]
    with tarfile.open(tmp_path / "b.tar.gz", "w:gz") as t:
        body = "\n".join(lines).encode()
        info = tarfile.TarInfo("x.data")
        info.size = len(body)
        t.addfile(info, io.BytesIO(body))
    row = connectors.message_levels(connectors.read_book_archives(spark, f"{tmp_path}/b.tar.gz")).collect()
    assert len(row) == 1 and row[0]["action"] == "snapshot" and [tuple(x) for x in row[0]["asks"]] == [(1.5, 2.0)]


def test_tables(spark, tmp_path):
    path = f"{tmp_path}/t"
    bars = fixtures.klines(spark, SF)
    assert tables.read(spark, path, KLINES).count() == 0 and not tables.exists(spark, path)
    tables.merge(spark, path, bars, KLINES, ["open_time"], "open_time")
    tables.merge(spark, path, bars.limit(20).withColumn("close", F.lit(-1.0)), KLINES, ["open_time"], "open_time")
    got = tables.read(spark, path, KLINES)
    assert got.count() == bars.count() and got.where("close = -1").count() == 20
    assert tables.latest_periods(got).select("dt").distinct().count() == 2
    assert tables.day_and_before(got, "2024-01-05").select("dt").distinct().count() == 2
    assert len(tables.list_files(spark, path)) > 2 and tables.symbols(got).count() == 2
    tables.write_csv(got.drop("dt"), f"{tmp_path}/csv", "open_time")
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").count() == got.count()
    assert tables.delete(spark, path) and not tables.exists(spark, path)


def test_a_swap_that_is_cut_off_leaves_the_old_table_or_the_new_one(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    bars = fixtures.klines(spark, SF)
    tables.merge(spark, path, bars, KLINES, ["open_time"], "open_time")
    changed = bars.withColumn("close", F.lit(-1.0))
    state = lambda: {r["close"] == -1.0 for r in tables.read(spark, path, KLINES).collect()}
    whole, overwrite = bars.count(), tables.overwrite

    def failing(at, part_way):
        calls = iter(range(10))

        def write(df, to):
            if next(calls) == at:
                if part_way:  # some partitions are replaced, others not
                    overwrite(df.where("symbol = 'U0' AND dt < '2024-01-10'"), to)
                raise RuntimeError("lost")
            overwrite(df, to)

        return write

    monkeypatch.setattr(tables, "overwrite", failing(0, True))
    with pytest.raises(RuntimeError):
        tables.merge(spark, path, changed, KLINES, ["open_time"], "open_time")
    assert state() == {False} and tables.read(spark, path, KLINES).count() == whole
    monkeypatch.setattr(tables, "overwrite", failing(1, True))
    with pytest.raises(RuntimeError):
        tables.merge(spark, path, changed, KLINES, ["open_time"], "open_time")
    assert state() == {True} and tables.read(spark, path, KLINES).count() == whole
    assert {r[0] == -1.0 for r in spark.read.parquet(path).select("close").distinct().collect()} == {True, False}
    monkeypatch.setattr(tables, "overwrite", overwrite)
    tables.merge(spark, path, changed.limit(1), KLINES, ["open_time"], "open_time")
    assert {r[0] for r in spark.read.parquet(path).select("close").distinct().collect()} == {-1.0}
    assert not tables.exists(spark, f"{path}-swap")


def _files(df, path, order, n):
    """The rows as n JSON files in order of time, for a file stream."""
    import os

    os.makedirs(path)
    rows = [json.loads(r) for r in df.orderBy(order).toJSON().collect()]
    step = -(-len(rows) // n)
    for k in range(n):
        with open(f"{path}/{k:03}.json", "w") as f:
            f.write("\n".join(json.dumps(r) for r in rows[k * step : (k + 1) * step]))
        os.utime(f"{path}/{k:03}.json", (k + 1, k + 1))


def test_stream_windows_equal_batch(spark, tmp_path):
    bars = fixtures.klines(spark, SF).where("open_time < 1704067200000 + 86400000").cache()
    _files(bars, f"{tmp_path}/in", "open_time", 3)
    stream = spark.readStream.schema(bars.schema).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")
    made = lambda rows, i, lo, hi: kline_windows(rows.select("symbol", "open_time", "open", "high", "low", "close"), i, "open_time", lo, hi)
    q = jobs.to_silver(stream, f"{tmp_path}/silver", KLINES, ["open_time"], "open_time", made, f"{tmp_path}/check", ("5m", "1h"), availableNow=True)
    q.awaitTermination()
    reached = spark.read.parquet(f"{tmp_path}/silver/state").agg(F.max("reached")).first()[0]
    for interval in ("5m", "1h"):
        got = {(r["symbol"], r["ts_ms"]): (r["open"], r["close"], round(r["mean"], 6)) for r in spark.read.parquet(f"{tmp_path}/silver/{interval}").collect()}
        want = {(r["symbol"], r["ts_ms"]): (r["open"], r["close"], round(r["mean"], 6)) for r in kline_windows(bars, interval, "open_time", last_end=reached).collect()}
        assert got == want and got


def test_native_stream_bars(spark, tmp_path):
    bars = fixtures.klines(spark, SF).where("open_time < 1704067200000 + 43200000").cache()
    _files(bars, f"{tmp_path}/in", "open_time", 2)
    stream = spark.readStream.schema(bars.schema).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")
    q = jobs.stream_bars(stream, "1h").writeStream.format("memory").queryName("bars_1h").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").start()
    q.processAllAvailable()
    q.stop()
    got = {(r["symbol"], r["ts_ms"]): (r["open"], r["close"]) for r in spark.table("bars_1h").collect()}
    want = {(r["symbol"], r["ts_ms"]): (r["open"], r["close"]) for r in kline_windows(bars, "1h").collect()}
    assert got and got.items() <= want.items()


def test_bronze_sink_and_first_seen(spark, tmp_path):
    rows = spark.createDataFrame([("s", 1, 10.0), ("s", 1, 11.0), ("s", 2, 5.0)], "symbol string, t bigint, v double")
    _files(rows, f"{tmp_path}/in", "v", 1)
    read = lambda: spark.readStream.schema(rows.schema).json(f"{tmp_path}/in")
    jobs.to_bronze(read(), f"{tmp_path}/b", "t bigint, v double", ["t"], "t", f"{tmp_path}/c1", availableNow=True).awaitTermination()
    jobs.pass_through(read(), f"{tmp_path}/b", "t bigint, v double", "t", f"{tmp_path}/c2", availableNow=True).awaitTermination()
    assert tables.read(spark, f"{tmp_path}/b", "t bigint, v double").where("dt = '1970-01'").count() == 2
    q = jobs.first_seen(read(), ["symbol", "t"], "t", "1 hour").writeStream.format("memory").queryName("seen").option("checkpointLocation", f"{tmp_path}/c3").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("seen").count() == 2


def test_live_books(spark, tmp_path):
    day = 1_704_067_200_000
    rows = [("m", day + 1, 1, "snapshot", [(1.0, 2.0)], []), ("m", day + 50_000, 2, "update", [(2.0, 1.0)], []), ("m", day + 130_000, 3, "update", [(1.0, 0.0)], []), ("m", day + 300_000, 4, "snapshot", [], [(9.0, 1.0)])]
    _files(spark.createDataFrame(rows, MESSAGE), f"{tmp_path}/in", "seq", 2)
    stream = spark.readStream.schema(spark.createDataFrame([], MESSAGE).schema).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")
    q = book.live_books(stream).writeStream.format("memory").queryName("live").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").start()
    q.processAllAvailable()
    q.stop()
    got = {(r["ts"] - day) // 60_000: [x["price"] for x in r["bids"]] for r in spark.table("live").collect()}
    assert got == {0: [2.0, 1.0], 2: [2.0]}


class FiledTopic:
    """A topic whose partitions are files of one message a line."""

    def __init__(self, options):
        self.path = options["path"]

    def _lines(self, partition):
        with open(f"{self.path}/{partition}") as f:
            return f.read().splitlines()

    def ends(self):
        return {p: (0, len(self._lines(p))) for p in os.listdir(self.path)}

    def fetch(self, partition, lo, hi):
        return enumerate(self._lines(partition)[lo:hi], lo)


def test_topic_from_some_messages_back(spark, tmp_path):
    """Starts N messages before each partition's end, goes on from the checkpoint, and sees partitions that come later; a table of it is the warm-up."""
    connectors.register(spark)
    os.makedirs(f"{tmp_path}/t")

    def send(partition, lo, hi):
        with open(f"{tmp_path}/t/{partition}", "a") as f:
            f.write("".join(f"{partition}-{k}\n" for k in range(lo, hi)))

    options = {"client": "tests.test_io_and_streams:FiledTopic", "path": f"{tmp_path}/t", "back": "5", "most": "3"}
    send(0, 0, 20)
    send(1, 0, 3)
    back = {f"0-{k}" for k in range(15, 20)} | {f"1-{k}" for k in range(3)}
    table = spark.read.format("topic").options(**options).load()
    assert {r["value"] for r in table.collect()} == back and table.rdd.getNumPartitions() == 3

    def run():
        stream = spark.readStream.format("topic").options(**options).load()
        stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
        return sorted(r["value"] for r in spark.read.parquet(f"{tmp_path}/out").collect())

    assert run() == sorted(back)
    send(0, 20, 24)
    send(2, 0, 7)
    assert run() == sorted(back | {f"0-{k}" for k in range(20, 24)} | {f"2-{k}" for k in range(7)})
    ends = spark.createDataFrame([("t", 0, 0, 20), ("t", 1, 2, 3), ("u", 0, 0, 2)], "topic string, partition int, begin bigint, end bigint")
    assert json.loads(connectors.starting_offsets(ends, 5)) == {"t": {"0": 15, "1": 2}, "u": {"0": 0}}


def test_live_books_of_silent_minutes(spark, tmp_path):
    """Minutes without messages have the book before them; one symbol's messages move the other's time on; a late message is dropped."""
    day, level = 1_704_067_200_000, lambda p, z: [(p, z)]
    rows = [("m", day + 1, 1, "update", level(1.0, 2.0), []), ("m", day + 200_000, 2, "update", level(2.0, 1.0), []), ("n", day + 430_000, 3, "update", [], level(5.0, 1.0)), ("m", day + 1_000, 4, "update", level(9.0, 9.0), [])]
    for k, r in enumerate(rows):
        _files(spark.createDataFrame([r], MESSAGE), f"{tmp_path}/one{k}", "seq", 1)
        os.makedirs(f"{tmp_path}/in", exist_ok=True)
        os.rename(f"{tmp_path}/one{k}/000.json", f"{tmp_path}/in/{k}.json")
        os.utime(f"{tmp_path}/in/{k}.json", (k + 1, k + 1))
    stream = spark.readStream.schema(spark.createDataFrame([], MESSAGE).schema).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")
    q = book.live_books(stream, silent=True).writeStream.format("memory").queryName("silent").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").start()
    q.processAllAvailable()
    q.stop()
    got = {(r["symbol"], (r["ts"] - day) // 60_000): [x["price"] for x in r["bids"]] for r in spark.table("silent").collect()}
    assert got == {("m", k): [1.0] if k < 3 else [2.0, 1.0] for k in range(7)}


def test_rejected_messages_are_kept(spark, tmp_path):
    raw = fixtures.trade_messages(spark, SF)
    _files(raw, f"{tmp_path}/in", "tradeId", 2)
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")
    judge = lambda rows: bronze.judged_trades(rows).withColumn("symbol", F.col("instrument_name"))
    schema = "instrument_name string, trade_id bigint, side string, price double, size double, created_time bigint"
    jobs.to_bronze(stream, f"{tmp_path}/t", schema, ["trade_id"], "created_time", f"{tmp_path}/c", judge=judge, availableNow=True).awaitTermination()
    judged = bronze.judged_trades(raw)
    good, bad = bronze.accepted(judged).count(), bronze.rejected(judged).count()
    assert good and bad and tables.read(spark, f"{tmp_path}/t", schema).count() == good
    assert spark.read.parquet(f"{tmp_path}/t-rejected").count() == bad
    assert tuple(spark.read.parquet(f"{tmp_path}/t-counts").agg(F.sum("rows"), F.sum("rejected"), F.count("batch")).first()) == (good + bad, bad, 2)


def test_catalogue(spark, tmp_path):
    day = 86_400_000
    spark.sql(f"CREATE DATABASE sluice_test LOCATION '{tmp_path}/db'")
    try:
        rows = spark.createDataFrame([(1, 0, 1.5), (2, day, None), (3, 2 * day, 2.5)], "id bigint, ts_ms bigint, x double")
        rows.limit(0).createOrReplaceTempView("sluice_view")
        tables.save_table(rows, "sluice_test.windows")
        assert tables.list_tables(spark, "sluice_test") == ["windows"]
        assert tables.table_exists(spark, "sluice_test.windows") and not tables.table_exists(spark, "sluice_test.other")
        assert "dt" in {r["col_name"] for r in tables.table_info(spark, "sluice_test.windows").collect()}
        assert [r["id"] for r in tables.read_sql(spark, "SELECT id FROM sluice_test.windows WHERE ts_ms >= :since ORDER BY id", since=day).collect()] == [2, 3]
        tables.drop_table(spark, "sluice_test.windows")
        assert tables.list_tables(spark, "sluice_test") == []
    finally:
        spark.catalog.dropTempView("sluice_view")
        spark.sql("DROP DATABASE sluice_test CASCADE")


DAY = 86_400_000
FIRST = 1_704_067_200_000


def _bar_stream(spark, bars, path):
    return spark.readStream.schema(bars.schema).option("maxFilesPerTrigger", 1).json(path)


def _bars_to_silver(stream, root, check, intervals=("1h", "1d"), **more):
    """Windows of bars from panes that the sink keeps."""
    made = lambda panes, i, lo, hi: windows_of_panes(panes, i, lo, hi)
    q = jobs.to_silver(stream, root, KLINES, ["open_time"], "open_time", made, check, intervals, units=lambda rows: kline_panes(rows, "open_time"), availableNow=True, **more)
    q.awaitTermination()


def _silver(spark, root, interval):
    rows = spark.read.parquet(f"{root}/{interval}").collect()
    assert len({(r["symbol"], r["ts_ms"]) for r in rows}) == len(rows)
    return {(r["symbol"], r["ts_ms"]): (r["open"], r["high"], r["low"], r["close"], round(r["mean"], 9)) for r in rows}


def _batch(bars, interval, reached):
    return {(r["symbol"], r["ts_ms"]): (r["open"], r["high"], r["low"], r["close"], round(r["mean"], 9)) for r in kline_windows(bars, interval, "open_time", last_end=reached).collect()}


def _write(path, rows, n):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{n:03}.json", "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))
    os.utime(f"{path}/{n:03}.json", (n + 1, n + 1))


def test_stream_revises_windows_for_late_rows_and_restarts(spark, tmp_path):
    """Rows that come hours late, and second versions of rows, give the windows of a batch over what came last; also after a restart."""
    bars = fixtures.klines(spark, SF.replace("0.001", "0.01")).where(F.col("open_time") < FIRST + 2 * DAY).orderBy("open_time")
    rows = [r.asDict() for r in bars.collect()]
    late = rows[5::9]
    files = [[r for r in rows[: len(rows) // 2] if r not in late], [r for r in rows[len(rows) // 2 : -40] if r not in late], late, [*rows[-40:], {**rows[3], "close": 1e6}]]
    path, root = f"{tmp_path}/in", f"{tmp_path}/silver"
    for n, part in enumerate(files[:2]):
        _write(path, part, n)
    _bars_to_silver(_bar_stream(spark, bars, path), root, f"{tmp_path}/check")
    for n, part in enumerate(files[2:], 2):
        _write(path, part, n)
    _bars_to_silver(_bar_stream(spark, bars, path), root, f"{tmp_path}/check")
    final = spark.createDataFrame([{**r, "close": 1e6} if r == rows[3] else r for r in rows], bars.schema)
    reached = spark.read.parquet(f"{root}/state").agg(F.max("reached")).first()[0]
    assert reached > FIRST + DAY
    for interval in ("1h", "1d"):
        assert _silver(spark, root, interval) == _batch(final, interval, reached)
    assert spark.read.parquet(f"{root}/changes").groupBy("batch").count().count() == 4
    fixed = f"{tmp_path}/fixed"
    _bars_to_silver(_bar_stream(spark, bars, path), fixed, f"{tmp_path}/check2", ("1h",), revise=False)
    assert _silver(spark, fixed, "1h") != _batch(final, "1h", reached)


def test_stream_forgets_old_rows(spark, tmp_path):
    """State and recent panes end some days behind the newest row; a row beyond that changes nothing."""
    bars = fixtures.klines(spark, SF.replace("0.001", "0.01")).where(F.col("open_time") < FIRST + 9 * DAY).orderBy("open_time")
    rows = [r.asDict() for r in bars.collect()]
    path, root = f"{tmp_path}/in", f"{tmp_path}/silver"
    for n in range(3):
        _write(path, [r for r in rows if n * 3 * DAY <= r["open_time"] - FIRST < (n + 1) * 3 * DAY and r != rows[7]], n)
    _write(path, [rows[7]], 3)
    _bars_to_silver(_bar_stream(spark, bars, path), root, f"{tmp_path}/check")
    kept = spark.read.parquet(f"{root}/recent").agg(F.min("pane")).first()[0]
    assert kept >= rows[-1]["open_time"] - 4 * DAY
    reached = spark.read.parquet(f"{root}/state").agg(F.max("reached")).first()[0]
    without = spark.createDataFrame([r for r in rows if r != rows[7]], bars.schema)
    for interval in ("1h", "1d"):
        assert _silver(spark, root, interval) == _batch(without, interval, reached)
    held = spark.read.format("statestore").option("stateVarName", "rows").option("flattenCollectionTypes", True).load(f"{tmp_path}/check")
    assert 0 < held.count() < len(rows) / 2


def test_warm_start_equals_a_run_from_the_beginning(spark, tmp_path):
    bars = fixtures.klines(spark, SF.replace("0.001", "0.01")).where(F.col("open_time") < FIRST + 3 * DAY).orderBy("open_time")
    rows = [r.asDict() for r in bars.collect()]
    cut = FIRST + 2 * DAY + 12_345_678
    before, after = [r for r in rows if r["open_time"] < cut and r != rows[-200]], [r for r in rows if r["open_time"] >= cut]
    after = [*after, rows[-200]] if rows[-200]["open_time"] < cut else after  # a late row of the days before
    all_along, warm = f"{tmp_path}/all", f"{tmp_path}/warm"
    _write(f"{tmp_path}/one", before, 0)
    _write(f"{tmp_path}/one", after, 1)
    _write(f"{tmp_path}/two", after, 0)
    _bars_to_silver(_bar_stream(spark, bars, f"{tmp_path}/one"), all_along, f"{tmp_path}/c1")
    _bars_to_silver(_bar_stream(spark, bars, f"{tmp_path}/two"), warm, f"{tmp_path}/c2", initial=spark.createDataFrame(before, bars.schema))
    for interval in ("1h", "1d"):
        whole, got = _silver(spark, all_along, interval), _silver(spark, warm, interval)
        assert got.items() <= whole.items() and {k for k in whole if k[1] > cut} <= got.keys()
