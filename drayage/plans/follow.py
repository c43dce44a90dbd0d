"""Following logs from a directory to a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from drayage.functions.text import parse_log_line
from drayage.sources.tail import tail_logs
from drayage.streaming.sinks import append_table, sink_lines


def parse_logs(lines: DataFrame) -> DataFrame:
    """Path, level, stamped_at and message of each log line."""
    parsed = parse_log_line(F.col("line"))
    return lines.select("path", parsed.alias("p")).select("path", "p.*")


def follow_logs(
    spark: SparkSession, folder: str, target: str, checkpoint: str, once: bool = False, **options
) -> StreamingQuery:
    """Tail a log folder into a table of parsed lines."""
    stream = parse_logs(tail_logs(spark, folder, **options))
    return sink_lines(stream, append_table(target), checkpoint, once)
