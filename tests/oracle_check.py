"""Run queries on Spark and their SQL on DuckDB, and compare the results exactly."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(tables: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{tables}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def normal(frame: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples of Python values, columns in the order of their names."""
    columns = sorted(frame.columns)
    plain = frame[columns].astype(object)
    rows = [tuple(row) for row in plain.itertuples(index=False, name=None)]
    return sorted(rows, key=repr)


def differences(actual: pd.DataFrame, expected: pd.DataFrame) -> str | None:
    """None if both hold the same rows under the same names and kinds, else what differs."""
    if sorted(actual.columns) != sorted(expected.columns):
        return f"columns {sorted(actual.columns)} against {sorted(expected.columns)}"
    kinds = [
        (name, actual[name].dtype.kind, expected[name].dtype.kind)
        for name in sorted(actual.columns)
        if actual[name].dtype.kind != expected[name].dtype.kind
    ]
    if kinds:
        return f"kinds {kinds}"
    ours, theirs = normal(actual), normal(expected)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(ours)} rows differ, such as {str(wrong[0])[:600]}"
    return None
