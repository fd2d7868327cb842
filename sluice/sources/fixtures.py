"""Market-shaped tables derived from the general test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

DAY_MS = 86_400_000
#: 2024-01-01T00:00 UTC, the first day of books and messages derived from tables of other years.
FIRST_MS = 1_704_067_200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _millis(c: str):
    return F.unix_millis(F.col(c).cast("timestamp"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, user_id, event_type, value, t (ms), k (the number in props), symbol."""
    k = F.regexp_extract("props", "(-?[0-9]+)", 1).cast("bigint")
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", _millis("ts").alias("t"), k.alias("k"), F.concat(F.lit("U"), F.col("user_id") % 2).alias("symbol"))


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = F.when(F.col("event_type").isin("purchase", "click"), "buy").when(F.col("event_type").isin("view", "signup"), "sell").otherwise("other")
    return events(spark, sf_dir).select("symbol", F.col("event_id").alias("trade_id"), side.alias("side"), F.col("value").alias("price"), (F.col("k") + 1.0).alias("size"), F.col("t").alias("created_time"))


def klines(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.struct("t", "event_id")
    bars = events(spark, sf_dir).groupBy("symbol", (F.col("t") - F.pmod("t", F.lit(60_000))).alias("open_time"))
    return bars.agg(F.min_by("value", order).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", order).alias("close"))


def span(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """The first end of a five-minute window over the bars, and the last one that holds the newest bar's close: one aggregate of the events."""
    step = 300_000
    lo, hi = (x - x % step + step for x in events(spark, sf_dir).select((F.col("t") - F.pmod("t", F.lit(60_000)) + 60_000).alias("close")).agg(F.min("close"), F.max("close")).first())
    return lo, hi


def funding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("funding_time", F.col("t") - F.pmod("t", F.lit(28_800_000)))
    kept = rows.groupBy("funding_time").agg(F.min_by("value", "event_id").alias("v"))
    return kept.select(F.lit("U").alias("instrument_name"), (F.col("v") / 1e4).alias("funding_rate"), "funding_time")


def order_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One book for each order, spread over 30 days: symbol, ts, action, asks, bids (JSON)."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.struct(F.col("l_extendedprice").alias("p"), "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").alias("q")).alias("x"), "l_linestatus")
    level = lambda x: F.array(x["p"].cast("string"), x["q"].cast("string"))
    flipped = lambda x: F.struct((-x["p"]).alias("n"), x["l_linenumber"].alias("a"), x["l_partkey"].alias("b"), x["l_suppkey"].alias("c"), x["p"].alias("p"), x["q"].alias("q"))
    sides = lines.groupBy("l_orderkey").agg(
        F.to_json(F.transform(F.array_sort(F.collect_list(F.when(F.col("l_linestatus") == "O", F.col("x")))), level)).alias("asks"),
        F.to_json(F.transform(F.array_sort(F.transform(F.collect_list(F.when(F.col("l_linestatus") == "F", F.col("x"))), flipped)), level)).alias("bids"),
    )
    orders = table(spark, sf_dir, "orders")
    day = F.pmod(F.floor(_millis("o_orderdate") / DAY_MS), F.lit(30)) * DAY_MS + FIRST_MS
    keyed = orders.select("o_orderkey", (day + (F.col("o_orderkey") % 86_400) * 1000).alias("ts"), F.when(F.col("o_orderkey") % 10 == 0, "update").otherwise("snapshot").alias("action"))
    return keyed.join(sides, keyed.o_orderkey == sides.l_orderkey).select(F.lit("BOOK").alias("symbol"), F.col("o_orderkey").alias("id"), "ts", "action", "asks", "bids")


def deep_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One book of 64 levels a side for each vector: prices step away from 1000, sizes are the vector's absolute values."""
    side = lambda sign: F.to_json(F.transform("embedding", lambda x, i: F.array((1000.0 + sign * (i + 1)).cast("string"), F.abs(x.cast("double")).cast("string"))))
    return table(spark, sf_dir, "embeddings").select(F.lit("DEEP").alias("symbol"), F.col("vec_id").alias("id"), (F.col("vec_id") * 60_000).alias("ts"), F.lit("snapshot").alias("action"), side(1).alias("asks"), side(-1).alias("bids"))


def book_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as messages of 28 days: symbol, ts, seq, action, bids, asks."""
    day = F.pmod(F.floor(_millis("l_shipdate") / DAY_MS), F.lit(28)) * DAY_MS + FIRST_MS
    ts = day + F.pmod(F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104_729, F.lit(DAY_MS))
    seq = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    rows = table(spark, sf_dir, "lineitem").withColumn("ts", ts).withColumn("seq", seq).withColumn("dt", day)
    rows = rows.withColumn("first", F.row_number().over(Window.partitionBy("dt").orderBy("ts", "seq")) == 1)
    level = F.array(F.struct(F.round(F.col("l_extendedprice") / 1000).alias("price"), F.when(F.col("l_returnflag") == "R", 0.0).otherwise(F.col("l_quantity")).alias("size")))
    none = F.array().cast("array<struct<price:double,size:double>>")
    bid = F.col("l_linenumber") % 2 == 1
    action = F.when(F.col("first") | (F.col("l_orderkey") % 997 == 0), "snapshot").otherwise("update")
    return rows.select(F.lit("MSG").alias("symbol"), "ts", "seq", action.alias("action"), F.when(bid, level).otherwise(none).alias("bids"), F.when(bid, none).otherwise(level).alias("asks"))


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and, for every tenth, a second arrival with another value."""
    rows = events(spark, sf_dir).select("event_id", "symbol", "t", "value")
    again = rows.where("event_id % 10 = 0").withColumn("value", F.col("value") + 1)
    return rows.withColumn("arrival", F.lit(0)).unionByName(again.withColumn("arrival", F.lit(1)))


def misplaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events under a claimed date that is a day late for every seventh."""
    claimed = F.date_format(F.timestamp_millis(F.col("t") + F.when(F.col("event_id") % 7 == 0, DAY_MS).otherwise(0)), "yyyy-MM-dd")
    return events(spark, sf_dir).select("event_id", "symbol", "t", "value", claimed.alias("dt"))


def trade_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as an exchange's strings: errors lack a price, and where k is 13 the time isn't a number."""
    rows = events(spark, sf_dir)
    side = F.when(F.col("event_type").isin("purchase", "click"), "buy").otherwise("sell")
    return rows.select(F.col("symbol").alias("instId"), F.col("event_id").cast("string").alias("tradeId"), side.alias("side"), F.when(F.col("event_type") != "error", F.col("value").cast("string")).alias("px"), (F.col("k") + 1).cast("string").alias("sz"), F.when(F.col("k") == 13, "soon").otherwise(F.col("t").cast("string")).alias("ts"))


def candle_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars as arrays of strings; those whose high is their low are cut short."""
    rows = klines(spark, sf_dir).select("symbol", "high", "low", F.array(*[F.col(c).cast("string") for c in ("open_time", "open", "high", "low", "close")]).alias("candle"))
    return rows.select("symbol", F.when(F.col("high") == F.col("low"), F.slice("candle", 1, 3)).otherwise(F.col("candle")).alias("candle"))


def funding_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates as strings; a rate below a thousandth is written as a dash."""
    rows = funding(spark, sf_dir)
    return rows.select(F.col("instrument_name").alias("instId"), F.when(F.col("funding_rate") < 1e-3, "-").otherwise(F.col("funding_rate").cast("string")).alias("fundingRate"), F.col("funding_time").cast("string").alias("fundingTime"))
