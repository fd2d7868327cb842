"""Sessions, and the package's own code on executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: What the library relies on: UTC wall clocks, ANSI arithmetic, runtime re-planning.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

#: Rows in an Arrow batch, where the session has Spark's default of 10,000: rows hold whole long texts.
BATCH_ROWS = 2_000

_shipped: set[str] = set()


def session(app: str = "sluice", **settings: str) -> SparkSession:
    """A session with the library's settings; dotted keys go in as ``spark__x__y``."""
    builder = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package's modules to the executors once in an application, and sets small Arrow batches."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, BATCH_ROWS)
    if spark.sparkContext.applicationId not in _shipped:
        root = Path(__file__).parent
        at = os.path.join(tempfile.mkdtemp(prefix="spark-"), "sluice.zip")
        with zipfile.ZipFile(at, "w") as z:
            for p in sorted([*root.rglob("*.py"), *root.rglob("*.csv")]):
                z.write(p, p.relative_to(root.parent))
        spark.sparkContext.addPyFile(at)
        _shipped.add(spark.sparkContext.applicationId)
    return spark
