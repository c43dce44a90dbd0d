"""Delivery of streamed lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

Deliver = Callable[[DataFrame, int], None]


def sink_lines(
    stream: DataFrame, deliver: Deliver, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Hand each micro-batch to ``deliver(lines, batch_id)``.

    Delivery is at least once: after a failure the last batch comes again under
    the same id. With ``once`` the query ends when it has read what is there.
    """
    writer = stream.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def append_table(path: str) -> Deliver:
    """A delivery that writes each batch below its own id, so a repeat replaces itself."""

    def deliver(lines: DataFrame, batch_id: int) -> None:
        lines.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return deliver
