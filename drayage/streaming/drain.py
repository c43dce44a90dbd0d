"""Bounded batches of process output with the exit code last, continuously."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


class ExitLast(StatefulProcessor):
    """State of a bucket of processes: their last line positions so far, and exit codes still held back.

    ``log`` takes a row for each process of a micro-batch without reading what is there; it is read and
    written anew when codes are due, and when it has grown to twice what is left. ``size`` holds its
    rows, the rows left when it was last written, and the earliest time a code is held until.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.log = handle.getListState("log", "pid string, last_pos long, returncode int, until long")
        self.size = handle.getValueState("size", "rows long, left long, until long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        news: dict = {}
        for batch in rows:
            millis = batch["ts"].astype("datetime64[ms]").astype("int64")
            for pid, pos, code, at in zip(*(c.tolist() for c in (batch["pid"], batch["pos"], batch["returncode"], millis))):
                _add(news, pid, *((None, int(code), at) if pd.notna(code) else (None if pd.isna(pos) else int(pos), None, None)))
        rows, left, until = self.size.get() or (0, 0, None)
        self.log.appendList([(pid, *of) for pid, of in news.items()])
        due = min((at for _, _, at in news.values() if at is not None), default=None)
        if due is not None and (until is None or due < until):
            self.handle.registerTimer(due)
            until = due
        rows += len(news)
        if rows > 2 * left + 1000:
            rows = left = self._write(self._read())
        self.size.update((rows, left, until))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        stored, expired = self.size.get(), expiredTimerInfo.getExpiryTimeInMs()
        if stored is None or stored[2] is None or expired < stored[2]:
            return  # released with an earlier one
        passed = max(expired, timerValues.getCurrentWatermarkInMs())
        held = self._read()
        ended = {pid: of for pid, of in held.items() if of[2] is not None and of[2] <= passed}
        left = self._write({pid: of for pid, of in held.items() if pid not in ended})
        until = min((at for pid, (_, _, at) in held.items() if at is not None and pid not in ended), default=None)
        if until is not None:
            self.handle.registerTimer(until)
        if left:
            self.size.update((left, left, until))
        else:
            self.size.clear()
        if ended:
            yield pd.DataFrame({
                "pid": pd.Series(list(ended), dtype="object"),
                "last_pos": pd.Series([of[0] for of in ended.values()], dtype="Int64"),
                "returncode": pd.Series([of[1] for of in ended.values()], dtype="Int32"),
            })

    def _read(self) -> dict:
        held: dict = {}
        for pid, *of in self.log.get():
            _add(held, pid, *of)
        return held

    def _write(self, held: dict) -> int:
        if held:
            self.log.put([(pid, *of) for pid, of in held.items()])
        else:
            self.log.clear()
        return len(held)

    def close(self) -> None:
        pass


def _add(held: dict, pid: str | None, last: int | None, code: int | None, until: int | None) -> None:
    """Puts what is new of a process, its last position or its exit, to what is held of it."""
    of = held.get(pid)
    if of is None:
        held[pid] = (last, code, until)
        return
    if last is None or (of[0] is not None and of[0] > last):
        last = of[0]
    held[pid] = (last, *((of[1], of[2]) if code is None else (code, until)))


def drain_stream(
    output: DataFrame, exits: DataFrame, batch_size: int = 100, *, delay: str, buckets: int = 256
) -> DataFrame:
    """Streaming :func:`drayage.operators.logs.drain_batches`.

    ``pos`` counts the lines of a process from 0. A line's poll follows from its
    position, so lines need no state and pass straight through. An exit code is
    held until the watermark shows that lines up to its time have arrived, and
    takes the poll after the last line. ``delay`` says how late rows may be: later exits are
    dropped, and later lines do not move the poll of the exit. Only the last position per process and
    partition reaches the state, however many lines a process writes. Processes share ``buckets`` keys
    of the state, so that many of them make few groups.
    """
    pid_type = output.schema["pid"].dataType
    # Text keys: one null among numbers would make pandas read them all as floats.
    pid = F.col("pid").cast("string").alias("pid")
    lines = output.select(
        "pid",
        F.floor(F.col("pos") / batch_size).alias("poll"),
        "pos",
        "line",
        F.lit(None).cast("int").alias("returncode"),
    )
    marks = output.select(pid, "pos", "ts").mapInPandas(
        _last_positions, "pid string, pos long, ts timestamp, returncode int"
    )
    ends = exits.select(
        pid, F.lit(None).cast("long").alias("pos"), "ts", F.col("returncode").cast("int")
    )
    released = (
        marks.unionByName(ends)
        .withWatermark("ts", delay)
        .withColumn("bucket", F.pmod(F.xxhash64("pid"), F.lit(buckets)).cast("string"))
        .groupBy("bucket")
        .transformWithStateInPandas(
            statefulProcessor=ExitLast(),
            outputStructType="pid string, last_pos long, returncode int",
            outputMode="append",
            timeMode="EventTime",
        )
        .select(
            F.col("pid").cast(pid_type).alias("pid"),
            F.coalesce(F.floor(F.col("last_pos") / batch_size) + 1, F.lit(0)).alias("poll"),
            F.lit(None).cast("long").alias("pos"),
            F.lit(None).cast("string").alias("line"),
            "returncode",
        )
    )
    return lines.unionByName(released)


def _last_positions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The last position and time per process within one Arrow batch."""
    for batch in batches:
        tops = batch.groupby("pid", as_index=False, dropna=False).agg({"pos": "max", "ts": "max"})
        yield tops.assign(returncode=pd.Series([None] * len(tops), dtype="Int32"))
