"""Runs a query beside its SQL twin and compares the rows, whatever their order."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(_plain(v) for v in row) for row in frame.itertuples(index=False, name=None))


def _plain(value) -> str:
    if pd.isna(value):
        return ""
    if isinstance(value, float) and value.is_integer():
        value = int(value)
    return repr(value.item() if hasattr(value, "item") else value)


def difference(spark_rows: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs first, or None."""
    ours = spark_rows.toPandas()
    twin = con.execute(sql).fetchdf()
    if sorted(ours.columns) != sorted(twin.columns):
        return f"columns {sorted(ours.columns)} / {sorted(twin.columns)}"
    if len(ours) != len(twin):
        return f"{len(ours)} rows / {len(twin)}"
    for left, right in zip(rows_of(ours), rows_of(twin)):
        if left != right:
            return f"{left} / {right}"
    return None
