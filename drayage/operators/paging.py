"""Paging through an ordered table and finding what is new in it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drayage.operators import ranking

# Rows a single top-k task holds without trouble.
SHALLOW_ROWS = 100_000


def offset_page(df: DataFrame, order: Sequence[str], start: int, size: int) -> DataFrame:
    """The page of ``size`` rows that begins at offset ``start``, in order.

    Shallow pages are a top-k. Deep ones are taken by position and sorted, as a top-k
    would keep everything before them in one task; the rows and their order are the same.
    """
    if start + size <= SHALLOW_ROWS:
        return df.orderBy(*order).offset(start).limit(size)
    numbered = ranking.positions(df, [], order, "__pos")
    return numbered.filter(F.col("__pos").between(start + 1, start + size)).orderBy("__pos").drop("__pos")


def assign_pages(
    df: DataFrame,
    order: Sequence[str],
    size: int = 20,
    rows_per_task: int = ranking.ROWS_PER_TASK,
) -> DataFrame:
    """Add ``page``, counted from 0, to every row of the table."""
    numbered = ranking.positions(df, [], order, "__pos", rows_per_task)
    return numbered.withColumn("page", F.floor((F.col("__pos") - 1) / size)).drop("__pos")


def new_items(before: DataFrame, now: DataFrame, key: str) -> DataFrame:
    """Rows of ``now`` whose key was not there ``before``."""
    return now.join(before.select(key).distinct(), key, "left_anti")
