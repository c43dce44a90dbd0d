"""Run a query in Spark and its SQL in DuckDB and compare all rows."""

from __future__ import annotations

import math
import os
from collections import Counter
from pathlib import Path

import duckdb

DATA = os.environ.get("DRAYAGE_DATA", "/root/testdata/sf0.001")


def oracle(folder: str = DATA) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def differences(spark_rows, spark_columns, sql_result) -> str | None:
    """Says how the results differ; None when they hold the same rows."""
    sql_columns = [d[0] for d in sql_result.description]
    if sorted(spark_columns) != sorted(sql_columns):
        return f"columns {sorted(spark_columns)} and {sorted(sql_columns)}"
    order = sorted(spark_columns)
    left = Counter(tuple(_plain(r[c]) for c in order) for r in spark_rows)
    at = [sql_columns.index(c) for c in order]
    right = Counter(tuple(_plain(r[i]) for i in at) for r in sql_result.fetchall())
    if left == right:
        return None
    return (
        f"{left.total()} and {right.total()} rows; only in Spark {list((left - right).items())[:3]}; "
        f"only in SQL {list((right - left).items())[:3]}"
    )


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value
