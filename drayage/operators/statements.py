"""Statement output: framed values, printed lines and errors."""

from __future__ import annotations

import builtins

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drayage.functions.codec import decode_frame


def parse_frames(lines: DataFrame, prefix: str, line: str = "line") -> DataFrame:
    """Keep the lines that start with the prefix and decode them.

    A malformed frame keeps its row and says why in ``status``.
    """
    framed = lines.filter(F.startswith(F.col(line), F.lit(prefix)))
    frame = F.col("__frame")
    return framed.withColumn("__frame", decode_frame(F.col(line), prefix)).select(
        *[c for c in lines.columns if c != line],
        frame["size"].alias("size"),
        frame["data"].alias("data"),
        frame["status"].alias("status"),
    )


def first_frame(lines: DataFrame, prefix: str) -> DataFrame:
    """The value frame of each statement, one row per statement.

    Status is that of the first framed line, or ``no_frame``. ``frame_pos``
    tells where it is.
    """
    is_frame = F.startswith("line", F.lit(prefix))
    first = lines.groupBy("stmt_id").agg(
        F.min(F.when(is_frame, F.col("pos"))).alias("frame_pos"),
        F.min_by(F.when(is_frame, F.col("line")), F.when(is_frame, F.col("pos"))).alias("line"),
    )
    frame = F.col("__frame")
    return first.withColumn("__frame", decode_frame(F.col("line"), prefix)).select(
        "stmt_id",
        "frame_pos",
        frame["data"].alias("data"),
        F.coalesce(frame["status"], F.lit("no_frame")).alias("status"),
    )


def printed_lines(lines: DataFrame, prefix: str) -> DataFrame:
    """The lines before the first frame of their statement, all if it has none.

    The cut is one small row per statement; no task holds a statement's lines.
    """
    is_frame = F.startswith("line", F.lit(prefix))
    cuts = lines.filter(is_frame).groupBy("stmt_id").agg(F.min("pos").alias("frame_pos"))
    s, c = lines.alias("s"), cuts.alias("c")
    before = F.col("c.frame_pos").isNull() | (F.col("s.pos") < F.col("c.frame_pos"))
    return (
        s.join(c, F.col("s.stmt_id").eqNullSafe(F.col("c.stmt_id")), "left")
        .filter(before)
        .select("s.stmt_id", "s.pos", "s.line")
    )


def builtin_errors(spark: SparkSession) -> DataFrame:
    """Dimension of the exception types Python itself defines (about 70 rows)."""
    names = sorted(
        name for name, value in vars(builtins).items()
        if isinstance(value, type) and issubclass(value, BaseException)
    )
    return spark.createDataFrame([(name,) for name in names], "builtin string")


def classify_errors(statements: DataFrame, ename: str = "ename") -> DataFrame:
    """Add ``error_type``: the builtin exception that ``ename`` names, else StatementError."""
    dim = F.broadcast(builtin_errors(statements.sparkSession))
    return (
        statements.join(dim, F.col(ename) == F.col("builtin"), "left")
        .withColumn("error_type", F.coalesce("builtin", F.lit("StatementError")))
        .drop("builtin")
    )
