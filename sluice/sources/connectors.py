"""Archives, paged services and message topics as DataFrames."""

from __future__ import annotations

import io
import json
import tarfile
import zipfile
from collections.abc import Iterator
from importlib import import_module

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

PAGE_ROWS = 100


def _archive_lines(spark: SparkSession, path: str, read) -> DataFrame:
    """(path, line) of text in archives; an archive is opened where it is read."""

    def lines(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for name, content in zip(part["path"], part["content"]):
                held = []
                for line in read(content):
                    held.append(line)
                    if len(held) == 10_000:
                        yield pd.DataFrame({"path": name, "line": held})
                        held = []
                yield pd.DataFrame({"path": name, "line": held})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(lines, "path string, line string")


def _zip_csv(content: bytes) -> Iterator[str]:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        for name in z.namelist():
            if name.endswith(".csv"):
                with z.open(name) as member:
                    lines = io.TextIOWrapper(member, "utf-8")
                    next(lines, None)
                    for line in lines:
                        yield line.rstrip("\r\n")


def _tar_lines(content: bytes) -> Iterator[str]:
    with tarfile.open(fileobj=io.BytesIO(content)) as t:
        names = t.getnames()
        picked = next((n for n in names if n.endswith(".data")), None) or next((n for n in names if n.endswith(".csv")), None)
        if picked:
            for line in t.extractfile(picked):
                yield line.decode().rstrip("\n")


def read_zipped_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of the CSVs in each ZIP archive, their headers left out. Members are read line by line."""
    row = F.from_csv("line", schema)
    return _archive_lines(spark, path, _zip_csv).select(row.alias("r")).select("r.*")


def read_book_archives(spark: SparkSession, path: str) -> DataFrame:
    """Messages (instId, action, ts, asks, bids; sides as arrays of arrays) of JSON lines in .tar.gz archives; lines that don't parse are left out."""
    schema = "instId string, action string, ts string, asks array<array<string>>, bids array<array<string>>"
    rows = _archive_lines(spark, path, _tar_lines).select(F.from_json("line", schema).alias("r")).select("r.*")
    return rows.withColumn("ts", F.col("ts").try_cast("bigint")).where("ts is not null").withColumn("action", F.lower("action"))


def read_book_csv(spark: SparkSession, path: str) -> DataFrame:
    """Snapshots from quoted CSV (ts, bids, asks, action) with JSON sides."""
    return spark.read.schema("ts bigint, bids string, asks string, action string").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def message_levels(rows: DataFrame) -> DataFrame:
    """Sides as arrays of (price, size) doubles; levels that don't parse are left out."""
    side = lambda c: F.filter(F.transform(F.coalesce(c, F.array().cast("array<array<string>>")), lambda x: F.struct(F.get(x, F.lit(0)).try_cast("double").alias("price"), F.get(x, F.lit(1)).try_cast("double").alias("size"))), lambda x: x["price"].isNotNull() & x["size"].isNotNull())
    return rows.withColumn("asks", side(F.col("asks"))).withColumn("bids", side(F.col("bids")))


def _named(name: str):
    """A function by module:name."""
    module, _, function = name.partition(":")
    return getattr(import_module(module), function)


class PagedSource(DataSource):
    """A service that gives newest rows first, in pages before a cursor.

    Options: fetch (module:function of (symbol, after, limit) to a list of dicts), symbols (comma-joined), time,
    start, end (ms, both included). Each symbol and day of the range is a partition of its own.
    """

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return self.options["schema"]

    def reader(self, schema: StructType) -> DataSourceReader:
        return _PagedReader(schema, dict(self.options))


class _PagedReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema, self.options = schema, options

    def partitions(self) -> list[InputPartition]:
        start, end = int(self.options["start"]), int(self.options["end"])
        step = int(self.options.get("partitionms", 86_400_000))
        return [InputPartition((s, lo, min(end, lo + step - 1))) for s in self.options["symbols"].split(",") for lo in range(start, end + 1, step)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        symbol, start, end = partition.value
        fetch, time = _named(self.options["fetch"]), self.options["time"]
        after = end + 1
        while page := fetch(symbol, after, PAGE_ROWS):
            for row in page:
                if start <= row[time] <= end:
                    yield tuple(row.get(c) for c in self.schema.names)
            oldest = min(r[time] for r in page)
            if oldest < start or oldest >= after:
                return
            after = oldest


class PolledSource(DataSource):
    """A subscription polled for messages: option poll is module:function of (offset) to (messages, next offset)."""

    @classmethod
    def name(cls) -> str:
        return "polled"

    def schema(self) -> str:
        return "value string"

    def simpleStreamReader(self, schema: StructType) -> SimpleDataSourceStreamReader:
        return _PolledReader(self.options["poll"])


class _PolledReader(SimpleDataSourceStreamReader):
    def __init__(self, poll: str):
        self.poll = poll

    def initialOffset(self) -> dict:
        return {"at": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        messages, at = _named(self.poll)(start["at"])
        wanted = [m for m in messages if m.get("data")]
        return iter([(json.dumps(x),) for m in wanted for x in m["data"]]), {"at": at}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return self.read(start)[0]


class _Span(InputPartition):
    """Messages of one topic partition from an offset to another one."""

    def __init__(self, partition: str, lo: int, hi: int) -> None:
        super().__init__((partition, lo, hi))
        self.partition, self.lo, self.hi = partition, lo, hi


class TopicSource(DataSource):
    """A topic in partitions, as a stream or a table of (partition, offset, value), read by tasks.

    Option client is module:function of the options; what it returns has ``ends()``, giving (begin, end) offsets by partition, and
    ``fetch(partition, lo, hi)``, giving (offset, value) pairs. With option back reading starts so many messages before the end of each partition,
    or at its beginning if it has fewer; else at the beginning. A task reads at most option most messages (10,000).
    """

    @classmethod
    def name(cls) -> str:
        return "topic"

    def schema(self) -> str:
        return "partition string, offset bigint, value string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _TopicTable(dict(self.options))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _TopicStream(dict(self.options))


class _Topic:
    def __init__(self, options: dict[str, str]) -> None:
        self.options, self.back, self.most = options, int(options.get("back", -1)), int(options.get("most", 10_000))

    def client(self):
        return _named(self.options["client"])(self.options)

    def begins(self) -> dict[str, int]:
        return {str(p): lo if self.back < 0 else max(lo, hi - self.back) for p, (lo, hi) in self.client().ends().items()}

    def ends(self) -> dict[str, int]:
        return {str(p): hi for p, (_, hi) in self.client().ends().items()}

    def spans(self, start: dict[str, int], end: dict[str, int]) -> list[_Span]:
        """Partitions that are new since ``start`` begin at 0."""
        return [_Span(p, lo, min(lo + self.most, hi)) for p, hi in sorted(end.items()) for lo in range(start.get(p, 0), hi, self.most)]

    def read(self, span: _Span) -> Iterator[tuple]:
        for offset, value in self.client().fetch(span.partition, span.lo, span.hi):
            yield span.partition, offset, value


class _TopicTable(_Topic, DataSourceReader):
    def partitions(self) -> list[_Span]:
        return self.spans(self.begins(), self.ends())


class _TopicStream(_Topic, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return self.begins()

    def latestOffset(self) -> dict:
        return self.ends()

    def partitions(self, start: dict, end: dict) -> list[_Span]:
        return self.spans(start, end)

    def commit(self, end: dict) -> None:
        pass


def starting_offsets(ends: DataFrame, back: int) -> str:
    """What startingOffsets of a Kafka reader takes to start ``back`` messages before the end of each partition.

    ``ends`` has topic, partition, begin, end: one row a partition.
    """
    at = F.greatest(F.col("begin"), F.col("end") - back)
    topics = ends.groupBy("topic").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("partition").cast("string"), at)))).alias("offsets"))
    found = topics.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("topic", F.to_json("offsets")))))).alias("j")).first()["j"]
    return json.dumps({topic: json.loads(offsets) for topic, offsets in json.loads(found).items()})


def register(spark: SparkSession) -> None:
    """Makes the formats "paged", "polled" and "topic" known to the session."""
    for source in (PagedSource, PolledSource, TopicSource):
        spark.dataSource.register(source)


def topic_reader(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", most: int = 500):
    """A stream reader of a Kafka topic (needs Spark's Kafka package on the classpath)."""
    return spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", starting).option("maxOffsetsPerTrigger", most)


def topic_writer(df: DataFrame, servers: str, topic: str, checkpoint: str):
    """A stream writer of all columns as JSON values to a Kafka topic."""
    values = df.select(F.to_json(F.struct("*")).alias("value"))
    return values.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("kafka.acks", "1").option("kafka.retries", "3").option("topic", topic).option("checkpointLocation", checkpoint)
