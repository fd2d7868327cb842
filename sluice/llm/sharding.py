"""Sharding by a two-pass external shuffle.

Pass one scatters rows over buckets by a seeded hash of id and text; the number of buckets follows the
measured size of the table, so a bucket fits the memory of a task. Pass two puts each bucket into
random order with a Fisher-Yates shuffle and writes it. Buckets in order of number make one random
order of all rows; row p of that order goes to shard p mod n, so shard sizes differ by one row at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.rowkeys import free_name
from sluice.llm.storage import new_path

#: Text bytes a bucket should hold.
BUCKET_BYTES = 32 << 20
#: Bytes a row counts besides its text.
ROW_BYTES = 8


def row_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 8."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("bigint")


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A uniformly random order of range(n)."""
    order, picks = list(range(n)), rng.integers(0, np.arange(n, 0, -1)) if n else []
    for i, step in enumerate(picks.tolist() if n else []):
        j = i + step
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def shuffle_to_buckets(docs: DataFrame, path: str, seed: int, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Writes every row of the table, shuffled, under ``path`` and returns what was written.

    Adds ``bucket`` and ``bucket_row`` (place in the bucket, from 0) as last columns; input columns of
    these names are replaced. All other columns stay. Rows keep whatever nulls they have. Rows are scattered by id
    and text, so only rows equal in both must share a bucket. An empty table writes an empty one.
    The order depends on seed, ids and texts alone, not on how the input was split, so a task that
    runs again writes the same rows.
    """
    rest = [c for c in docs.columns if c not in ("bucket", "bucket_row")]
    docs = docs.select(*rest)
    total = docs.select(F.sum(row_size(F.col(text_col)))).first()[0] or 0
    n = max(1, -(-total // bucket_bytes))
    digest = F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), F.col(text_col))
    scattered = docs.withColumn("bucket", F.pmod(digest, F.lit(n)).cast("int"))
    ordered = scattered.repartitionById(n, F.col("bucket")).sortWithinPartitions("bucket", id_col, F.xxhash64(text_col))
    schema = scattered.schema.add("bucket_row", "long")
    at = len(rest)

    def permute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def bucket(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(batches)
            order = fisher_yates(table.num_rows, np.random.default_rng([seed, table.column(at)[0].as_py()]))
            table = table.take(pa.array(order)).append_column("bucket_row", pa.array(np.arange(table.num_rows)))
            return table.to_batches(2_000)

        for batch in batches:
            numbers = batch.column(at).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if held and held[-1].column(at)[0].as_py() != numbers[lo]:
                    yield from bucket(held)
                    held = []
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield from bucket(held)

    ordered.mapInArrow(permute, schema).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def assign_shards(shuffled: DataFrame, n_shards: int = 24) -> DataFrame:
    """Adds ``shard`` and ``slot`` to what shuffle_to_buckets returned: counts at most one apart, slots without gaps.

    Only a count for each bucket is gathered; the buckets' places are a running sum over these counts. Columns of these two names that
    the table has already are replaced; any other name may occur.
    """
    shuffled = shuffled.drop("shard", "slot")
    begin = free_name(shuffled)
    totals = shuffled.groupBy("bucket").count().orderBy("bucket").toArrow()
    first = np.cumsum([0, *totals.column("count").to_pylist()])[:-1]
    # a table of known size, so Spark sends it to all executors only while it is small
    places = shuffled.sparkSession.createDataFrame(totals.drop_columns("count").append_column(begin, pa.array(first, pa.int64())))
    at = F.col(begin) + F.col("bucket_row")
    return shuffled.join(places, "bucket").withColumn("shard", F.pmod(at, F.lit(n_shards)).cast("int")).withColumn("slot", F.floor(at / n_shards).cast("bigint")).drop(begin)


def shard_documents(docs: DataFrame, n_shards: int = 24, seed: int = 20240, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Shuffles, writes and numbers all rows; the files under ``path`` stay as the operator's output.

    Columns named bucket, bucket_row, shard and slot are replaced by the operator's own.
    """
    path = path or new_path(docs.sparkSession, "shuffled")
    return assign_shards(shuffle_to_buckets(docs, path, seed, id_col, text_col, bucket_bytes), n_shards)
