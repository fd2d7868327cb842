"""Where multi-step operators put the tables that cut their lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from sluice.sources.tables import delete


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the one the cluster names in ``spark.checkpoint.dir``.

    Where that is unset, a temporary folder of this machine is made and set, but only if the session runs on this
    machine alone (a local master). Anywhere else executors would write to disks of their own, so it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


#: Paths that this process has given out and not deleted.
_given: list[str] = []


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    _given.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return _given[-1]


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables that the steps inside wrote, once they are done: their results must be written elsewhere by then."""
    before = len(_given)
    yield
    for path in _given[before:]:
        delete(spark, path)
    del _given[before:]


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """The same rows, written to the shared folder and read back: later steps start from the files."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
