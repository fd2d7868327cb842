"""Keys of rows for operators that compare documents: an id, or a key of its own for a further text of an id that several texts share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.storage import written


def free_name(docs: DataFrame) -> str:
    """A name that no column has."""
    return "_" * (1 + max(map(len, docs.columns)))


def with_keys(docs: DataFrame, id_col: str, text_col: str, name: str) -> tuple[DataFrame, DataFrame | None]:
    """The rows with the bigint column ``name``, and (key, id) of the keys that aren't ids, None if there are none.

    Rows with equal id and text (null is empty) share a key, all others have different ones; a null id has a null key. Of the texts of one id the
    least by digest has the id as its key; the keys of all others are beyond the largest id, in order of id and digest. So they come
    last wherever keys give an order. Ids must be integers with some room above the largest.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    id_, digests = F.col(f"`{id_col}`").cast("bigint"), [F.xxhash64(text), F.xxhash64(F.lit(7), text)]
    pairs = docs.where(id_.isNotNull()).select(id_.alias("id"), digests[0].alias("h1"), digests[1].alias("h2"))
    ends = pairs.groupBy("id").agg(F.min("h1").alias("a"), F.max("h1").alias("b"), F.min("h2").alias("c"), F.max("h2").alias("d"))
    several = written(ends.where("a < b OR c < d").select("id"), "several")
    if several.isEmpty():
        return docs.withColumn(name, id_), None
    texts = pairs.join(several, "id").distinct()
    least = texts.groupBy("id").agg(F.min(F.struct("h1", "h2")).alias("least"))
    further = texts.join(least, "id").where(F.struct("h1", "h2") > F.col("least")).select("id", "h1", "h2")
    beyond = pairs.agg(F.max("id")).first()[0] + 1
    order = ["id", "h1", "h2"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = further.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    keys = written(ordered.withColumn("key", F.lit(beyond) + F.monotonically_increasing_id()), "keys")
    other = keys.select(*[F.col(c).alias(name + c) for c in keys.columns])
    same = (id_ == F.col(name + "id")) & (digests[0] == F.col(name + "h1")) & (digests[1] == F.col(name + "h2"))
    keyed = docs.join(other, same, "left").withColumn(name, F.coalesce(F.col(name + "key"), id_))
    return keyed.select(*[F.col(f"`{c}`") for c in docs.columns], name), keys.select("key", "id")


def with_ids(rows: DataFrame, columns: list[str], keys: DataFrame | None) -> DataFrame:
    """The rows with ids in place of keys in these columns."""
    if keys is None:
        return rows
    for c in columns:
        other = keys.select(F.col("key").alias("_of_key"), F.col("id").alias("_of_id"))
        rows = rows.join(other, F.col(c) == F.col("_of_key"), "left").withColumn(c, F.coalesce("_of_id", c)).drop("_of_key", "_of_id")
    return rows
