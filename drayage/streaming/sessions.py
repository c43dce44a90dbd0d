"""Session expiry, continuously."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def expire_sessions_stream(
    beats: DataFrame, ttl_seconds: int, *, delay: str, key: str = "session_id"
) -> DataFrame:
    """Sessions that have ended: no heartbeat for ``ttl_seconds`` as of the watermark.

    Beats later than ``delay`` are dropped by the watermark and counted in the
    query's progress. Nothing here filters on the window, as Spark would apply
    such a filter before the beats are merged into sessions.
    """
    return (
        beats.withWatermark("ts", delay)
        .groupBy(key, F.session_window("ts", f"{ttl_seconds} seconds"))
        .agg(
            F.min("ts").alias("born_at"),
            F.max("ts").alias("last_beat"),
            F.count(F.lit(1)).alias("beats"),
        )
        .select(
            key, "born_at", "last_beat", "beats",
            (F.col("last_beat") + F.make_dt_interval(secs=F.lit(ttl_seconds))).alias("dead_at"),
        )
    )
