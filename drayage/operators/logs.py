"""Log pages, process output and delivery delay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drayage.functions.text import split_lines
from drayage.operators import ranking


def explode_lines(texts: DataFrame, text: str = "text") -> DataFrame:
    """One row per line of each text, numbered from 0."""
    return texts.select(
        *[c for c in texts.columns if c != text],
        F.posexplode(split_lines(F.col(text))).alias("line_no", "line"),
    )


def tail_lines(lines: DataFrame, n: int = 500) -> DataFrame:
    """The latest ``n`` lines of each source."""
    return ranking.first_n(lines, ["source"], [F.col("pos").desc()], n, "from_end")


def poll_delta(snapshots: DataFrame) -> DataFrame:
    """What each poll of a rotating log page shows that the one before did not.

    From each page the longest run of leading lines that all occur in the
    previous page is dropped and the rest kept, repeats included. A line is new
    to its page when no copy of it comes from the page before; both facts meet
    in one aggregation, which also shrinks repeated lines before the shuffle.
    """
    shown = snapshots.select(
        "source", "line",
        F.explode(F.array(
            F.struct("poll", F.col("pos").alias("pos")),
            F.struct((F.col("poll") + 1).alias("poll"), F.lit(None).cast("long").alias("pos")),
        )).alias("at"),
    )
    per_line = shown.groupBy("source", F.col("at.poll").alias("poll"), "line").agg(
        F.min("at.pos").alias("first_pos"),
        F.bool_or(F.col("at.pos").isNull()).alias("seen_before"),
    )
    cuts = (
        per_line.filter(~F.col("seen_before"))
        .groupBy("source", "poll")
        .agg(F.min("first_pos").alias("cut"))
    )
    s, c = snapshots.alias("s"), cuts.alias("c")
    same_page = F.col("s.source").eqNullSafe(F.col("c.source")) & (F.col("s.poll") == F.col("c.poll"))
    return (
        s.join(c, same_page)
        .filter(F.col("s.pos") >= F.col("c.cut"))
        .select("s.source", "s.poll", "s.pos", "s.line")
    )


def drain_batches(
    output: DataFrame,
    exits: DataFrame,
    batch_size: int = 100,
    rows_per_task: int = ranking.ROWS_PER_TASK,
) -> DataFrame:
    """Process output in polls of at most ``batch_size`` lines, the exit code last.

    Lines carry a null code. The code comes in a poll of its own after the last
    line; a process without lines has it in poll 0.
    """
    ranked = ranking.positions(output, ["pid"], ["pos"], "__rank", rows_per_task)
    lines = ranked.select(
        "pid",
        F.floor((F.col("__rank") - 1) / batch_size).alias("poll"),
        "pos",
        "line",
        F.lit(None).cast("int").alias("returncode"),
    )
    counts = output.groupBy("pid").agg(F.count(F.lit(1)).alias("n"))
    ends = exits.join(counts, "pid", "left").select(
        "pid",
        F.ceil(F.coalesce("n", F.lit(0)) / batch_size).alias("poll"),
        F.lit(None).cast("long").alias("pos"),
        F.lit(None).cast("string").alias("line"),
        "returncode",
    )
    return lines.unionByName(ends)


def delivery_lag(stamped: DataFrame, keys: list[str], tolerance_seconds: float = 5.0) -> DataFrame:
    """Absolute delay between a line's own stamp and its receipt, per group, in microseconds."""
    lag = F.abs(F.unix_micros("received_at") - F.unix_micros("stamped_at"))
    return stamped.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("lines"),
        F.max(lag).alias("max_lag"),
        F.sum(lag).alias("total_lag"),
        F.count_if(lag <= int(tolerance_seconds * 1_000_000)).alias("in_time"),
    )
