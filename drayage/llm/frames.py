"""Small helpers shared by the operators: column renaming, white space, slices of Arrow batches."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from drayage.session import workspace

#: The six characters that separate words everywhere in this package.
SPACES = " \t\n\x0b\x0c\r"

#: A word, as a regular expression of Java and of DuckDB.
WORD = r"[^\x20\x09-\x0D]+"


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns named ``c0``, ``c1``, ... and the map from the old names.

    Whatever the caller's columns are called, they clash with none of ours.
    """
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), {
        name: f"c{i}" for i, name in enumerate(df.columns)
    }


def without_spaces(text: Column) -> Column:
    """``text`` without any of the six white space characters."""
    for space in SPACES:
        text = F.replace(text, F.lit(space), F.lit(""))
    return text


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written in the shared folder, in little space, and read from there."""
    path = workspace(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    drop_shuffles(df.sparkSession)
    return df.sparkSession.read.parquet(path)


def drop_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files that no plan in use needs any more. It does so when
    the driver's garbage is collected, which may be long after a step's result is written."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in small slices, so that few texts are Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
