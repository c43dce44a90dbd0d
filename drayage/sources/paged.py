"""Tables that a provider serves in pages by offset."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

Provider = Callable[[int, int], pa.Table]

# Tasks of one scan at most; each costs the provider a start of its own.
MOST_TASKS = 1_024


class PageRange(InputPartition):
    """Pages from offset ``start`` on; ``stop`` is None for the last range, which
    reads until an empty page."""

    def __init__(self, start: int, stop: int | None):
        self.start = start
        self.stop = stop


def scan_paged(
    spark: SparkSession,
    name: str,
    provider: Provider,
    schema: str,
    page_size: int = 20,
    total: int | None = None,
    pages_per_task: int = 64,
) -> DataFrame:
    """Read a paged listing as a table, many pages at a time.

    ``provider(offset, size)`` returns a page as an Arrow table and must be
    picklable. Where the total is unknown, single-row requests find it by
    doubling and halving, so the pages can still be read in parallel. A task takes
    ``pages_per_task`` pages, or more where that would make over ``MOST_TASKS`` tasks.
    """

    class Reader(DataSourceReader):
        def partitions(self) -> list[PageRange]:
            known = _find_total(provider) if total is None else total
            step = page_size * max(pages_per_task, -(-known // (page_size * MOST_TASKS)))
            starts = list(range(0, max(known, 1), step))
            return [PageRange(s, s + step) for s in starts[:-1]] + [PageRange(starts[-1], None)]

        def read(self, partition: PageRange) -> Iterator[pa.RecordBatch]:
            offset = partition.start
            while partition.stop is None or offset < partition.stop:
                left = page_size if partition.stop is None else partition.stop - offset
                # A provider may serve less than it is asked for; the next page starts behind that.
                page = provider(offset, min(page_size, left))
                if page.num_rows == 0:
                    break
                yield from page.to_batches()
                offset += page.num_rows

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def reader(self, schema) -> DataSourceReader:
            return Reader()

    spark.dataSource.register(Source)
    return spark.read.format(name).load()


def _find_total(provider: Provider) -> int:
    """Number of rows served, from about 2 * log2(rows) requests for one row."""
    if provider(0, 1).num_rows == 0:
        return 0
    last, beyond = 0, 1
    while provider(beyond, 1).num_rows:
        last, beyond = beyond, beyond * 2
    while beyond - last > 1:
        middle = (last + beyond) // 2
        if provider(middle, 1).num_rows:
            last = middle
        else:
            beyond = middle
    return beyond
