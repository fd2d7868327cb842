"""Partitioned Parquet tables: one folder a dataset, partitions symbol and dt (day or month of event time)."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.operators.bronze import period_label
from sluice.operators.silver import merge_by_key


def _file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table or file is there, by the file system that the path names."""
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.delete(p, True)


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Paths of all files below, in order; nothing if the path isn't there."""
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return []
    found, it = [], fs.listFiles(p, True)
    while it.hasNext():
        found.append(it.next().getPath().toString())
    return sorted(found)


def _pending(spark: SparkSession, path: str) -> tuple[str, StructType] | None:
    """Where a swap that isn't done has its rows, and their columns."""
    mark = f"{path}-swap"
    if not exists(spark, mark):
        return None
    stage, schema = spark.read.text(mark, wholetext=True).first()[0].split("\n", 1)
    return stage, StructType.fromJson(json.loads(schema))


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table with its partition columns; an empty one if the path isn't there. Other errors are raised.

    While a swap is under way, or was cut off, its partitions are read from where they are staged: all of them or none are new.
    """
    full = f"{schema}, symbol string, dt string"
    table = spark.read.schema(full).parquet(path) if exists(spark, path) else spark.createDataFrame([], full)
    if (found := _pending(spark, path)) is None:
        return table
    new = spark.read.schema(full).parquet(found[0])
    return table.join(new.select("symbol", "dt").distinct(), ["symbol", "dt"], "left_anti").select(*table.columns).unionByName(new)


def symbols(table: DataFrame) -> DataFrame:
    return table.select("symbol").distinct()


def latest_periods(table: DataFrame, n: int = 2) -> DataFrame:
    """Rows of the last n partitions; the scan prunes the others."""
    last = [r["dt"] for r in table.select("dt").distinct().orderBy(F.desc("dt")).limit(n).collect()]
    return table.where(F.col("dt").isin(last))


def day_and_before(table: DataFrame, day: str) -> DataFrame:
    """Rows of a day and the one before it: what windows that end on the day may hold."""
    before = F.date_format(F.date_sub(F.lit(day).cast("date"), 1), "yyyy-MM-dd")
    return table.where((F.col("dt") == day) | (F.col("dt") == before))


def overwrite(df: DataFrame, path: str) -> None:
    """Writes rows by symbol and dt; partitions that the rows touch are replaced, others stay."""
    df.repartition("symbol", "dt").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("symbol", "dt").parquet(path)


def swap(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """As overwrite, for rows that may come from the table itself, and all at once: a failure leaves the old table or the new one.

    Rows are staged; then a mark beside the table, made by one rename, says that they count, and readers take them from there; then partitions are
    replaced and the mark goes. A swap that was cut off behind its mark is finished first; rows that come from the table itself must be read
    after that (see merge). One writer a table is meant.
    """
    finish_swap(spark, path)
    stage = f"{path}-stage-{uuid.uuid4().hex}"
    overwrite(rows, stage)
    if not exists(spark, stage):
        return
    fs, new = _file_system(spark, f"{stage}-mark")
    out = fs.create(new, True)
    out.write(bytearray(f"{stage}\n{json.dumps(rows.schema.jsonValue())}".encode()))
    out.close()
    if not fs.rename(new, _file_system(spark, f"{path}-swap")[1]):
        raise OSError(f"can't mark the swap of {path}")
    finish_swap(spark, path)


def finish_swap(spark: SparkSession, path: str) -> None:
    """Puts staged partitions of a marked swap in their places."""
    if (found := _pending(spark, path)) is None:
        return
    stage, schema = found
    overwrite(spark.read.schema(schema).parquet(stage), path)
    delete(spark, f"{path}-swap")
    delete(spark, stage)


def merge(spark: SparkSession, path: str, new: DataFrame, schema: str, keys: list[str], time: str, period: str = "day", arrival: Column | None = None) -> None:
    """Upsert by key within symbol: only partitions that new rows touch are read and rewritten.

    The merged rows are swapped in all at once, so a failed write leaves the old table or the new one.
    """
    finish_swap(spark, path)  # before the table is read: what the rows come from must stay until they are staged
    new = new.withColumn("dt", period_label(F.col(time), period))
    touched = new.select("symbol", "dt").distinct()
    old = read(spark, path, schema).join(touched, ["symbol", "dt"], "left_semi")
    swap(spark, path, merge_by_key(old, new.select(*old.columns), ["symbol", "dt", *keys], arrival))


def write_csv(df: DataFrame, path: str, order: str) -> None:
    """CSV files with a header, rows in order within and between files: as many as the sort has ranges, so no task gets the whole table."""
    df.orderBy(order).write.mode("overwrite").option("header", True).csv(path)


def save_table(df: DataFrame, name: str) -> None:
    """A catalogue table with a partition for each day of ts_ms."""
    df.withColumn("dt", period_label(F.col("ts_ms"))).write.mode("overwrite").partitionBy("dt").saveAsTable(name)


def table_info(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {name}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Names of the catalogue's tables, in order; temporary views aren't tables."""
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def read_sql(spark: SparkSession, query: str, **parameters) -> DataFrame:
    """Rows of a query over catalogue tables; ``:name`` in it stands for a parameter's value."""
    return spark.sql(query, args=parameters)
