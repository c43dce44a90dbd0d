"""Parquet tables of the test data set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Read ``name.parquet``, with zone-less timestamps taken as UTC."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    plain = {
        f.name: F.col(f.name).cast("timestamp")
        for f in df.schema
        if isinstance(f.dataType, T.TimestampNTZType)
    }
    return df.withColumns(plain) if plain else df
