"""Spark results against SQL on the same files."""

from __future__ import annotations

import os
from glob import glob

import duckdb
import pandas as pd


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def _rows(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    return sorted([tuple(None if pd.isna(x) else x for x in row) for row in df.astype(object).itertuples(index=False)], key=repr)


def difference(spark_df, sql: str, con) -> str:
    """What differs first, or nothing."""
    got, want = spark_df.toPandas(), con.execute(sql).fetch_df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(set(got.columns) ^ set(want.columns))}"
    if len(got) != len(want):
        return f"rows {len(got)} and {len(want)}"
    a, b = _rows(got), _rows(want)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    names = sorted(got.columns)
    return "" if not bad else f"{len(bad)} rows differ, first {[(n, p, q) for n, p, q in zip(names, *bad[0]) if p != q][:4]} in {bad[0][0][:3]}"
