"""Compare a Spark result with the SQL twin's result, ignoring row order."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def _sorted_rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object)
    rows = frame.where(frame.notna(), None).itertuples(index=False, name=None)
    return sorted(rows, key=lambda row: tuple((value is None, str(value)) for value in row))


def arrow_types(table) -> dict[str, str]:
    return {f.name: str(f.type).replace("large_", "") for f in table.schema}


def difference(spark_frame, connection, sql: str) -> str | None:
    """None if both agree on columns, types and rows, else what differs."""
    expected = connection.sql(sql).to_arrow_table()
    actual = spark_frame.toArrow()
    if arrow_types(actual) != arrow_types(expected):
        return f"types {arrow_types(actual)} != {arrow_types(expected)}"
    left, right = (
        _sorted_rows(table.to_pandas(integer_object_nulls=True)) for table in (actual, expected)
    )
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)} rows"
    for a, b in zip(left, right):
        if a != b:
            return f"{a} != {b}"
    return None
