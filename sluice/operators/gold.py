"""Feature tables of several sources side by side in time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def prefixed(df: DataFrame, prefix: str, key: str = "timestamp_dt", drop: tuple[str, ...] = ()) -> DataFrame:
    """Columns renamed to prefix_column, the key kept."""
    return df.select(key, *[F.col(f"`{c}`").alias(f"{prefix}_{c}") for c in df.columns if c != key and c not in drop])


def align(frames: list[DataFrame], key: str = "timestamp_dt", left: DataFrame | None = None) -> DataFrame:
    """All frames full-outer joined on the key; ``left`` is joined to the result, keeping its rows only.

    Names that meet twice get the suffix _dup. Equal keys of all joins share one partitioning.
    """

    def join(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
        b = b.select(key, *[F.col(f"`{c}`").alias(f"{c}_dup" if c in a.columns else c) for c in b.columns if c != key])
        return a.join(b, key, how)

    out = reduce(lambda a, b: join(a, b, "full_outer"), frames)
    return join(out, left, "left") if left is not None else out


def forward_fill(df: DataFrame, columns: list[str], order: str, keys: list[str] | None = None, bucket: str | None = None) -> DataFrame:
    """Nulls replaced by the last value before them.

    With ``bucket`` (a column that rises with the order, such as a day) rows are only sorted within buckets, and
    one row a bucket carries values over.
    """
    keys = keys or []
    if bucket is None:
        frame = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(frame) for c in columns})
    inside = Window.partitionBy(*keys, bucket).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    ends = df.groupBy(*keys, bucket).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_{c}") for c in columns])
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, bucket, *[F.last(f"_{c}", ignorenulls=True).over(before).alias(f"_{c}") for c in columns])
    filled = df.join(carried, [*keys, bucket], "left")
    return filled.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(inside), F.col(f"_{c}")) for c in columns}).select(*df.columns)


def as_of(left: DataFrame, right: DataFrame, time: str, values: list[str], bucket_ms: int = 86_400_000, keys: list[str] | None = None) -> DataFrame:
    """Each left row with the values of the latest right row of its keys at or before it; time in epoch milliseconds."""
    both = left.withColumn("_left", F.lit(1)).unionByName(right.select(*(keys or []), time, *values).withColumn("_left", F.lit(0)), allowMissingColumns=True)
    both = both.withColumn("_bucket", F.floor(F.col(time) / bucket_ms)).withColumn("_order", F.struct(time, "_left"))
    packed = both.withColumn("_value", F.when(F.col("_left") == 0, F.struct(*values)))
    filled = forward_fill(packed, ["_value"], "_order", keys, "_bucket").where("_left = 1")
    return filled.select(*[c for c in left.columns], *[F.col("_value")[v].alias(v) for v in values])
