"""The poll delta of rotating log pages, continuously."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

# Consecutive polls of a source that share a state key, and so a task.
BLOCK = 16


def _page_delta(keep_ms: int | None):
    """The deltas of a (bucket of sources, block of polls), whose state is the latest page of each source."""

    def run(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        block, now = int(key[1]), state.getCurrentProcessingTimeMs()
        latest = {
            source: (poll, at, lines) for source, poll, at, lines in zip(*(state.getOption or ((), (), (), ())))
            if keep_ms is None or now - at < keep_ms
        }
        pages: dict[tuple, list[tuple[int, str]]] = {}
        for batch in frames:
            for source, poll, pos, line in zip(*(batch[c].tolist() for c in ("source", "poll", "pos", "line"))):
                pages.setdefault((source, poll), []).append((pos, line))
        lines = {page: {line for _, line in shown} for page, shown in pages.items()}
        for source, (poll, _, seen) in latest.items():
            lines.setdefault((source, poll), set()).update(seen)

        fresh = []
        for (source, poll), page in pages.items():
            if poll // BLOCK == block:  # else the last page of the block before
                seen = lines.get((source, poll - 1), ())
                cut = min((pos for pos, line in page if line not in seen), default=None)
                if cut is not None:
                    fresh += [(source, poll, pos, line) for pos, line in page if pos >= cut]
            if source not in latest or poll > latest[source][0]:
                latest[source] = (poll, now, list(lines[source, poll]))

        # After the last page of a block the next one belongs to the next block.
        closing = (block + 1) * BLOCK - 1
        kept = [(source, *page) for source, page in latest.items() if page[0] != closing]
        if kept:
            state.update(tuple(map(list, zip(*kept))))
            if keep_ms is not None:
                state.setTimeoutDuration(max(1, keep_ms - now + min(at for _, _, at, _ in kept)))
        elif state.exists:
            state.remove()
        if fresh:
            yield pd.DataFrame(fresh, columns=["source", "poll", "pos", "line"])

    return run


@dataclass
class _Page:
    """What is known of a page: lines due (-1: not stated) and come, whether the polls just before and
    after it are said to be empty, and whether its delta is out."""

    due: int = -1
    have: int = 0
    alone: bool = False
    ended: bool = False
    done: bool = False

    @property
    def complete(self) -> bool:
        return self.done or 0 <= self.due <= self.have


class PageAssembly(StatefulProcessor):
    """State of (bucket of sources, block of polls): pages that are not complete, or not yet compared.

    ``pages`` holds a :class:`_Page` of each in one value; ``parts`` holds the lines as they came, one
    part for each poll and micro-batch, so that adding to a page never rewrites what it has.
    """

    def __init__(self, first_poll: int, keep_ms: int | None):
        self.first_poll, self.keep_ms = first_poll, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.pages = handle.getValueState(
            "pages", "part long, source array<string>, poll array<long>, due array<long>, have array<long>, "
            "alone array<boolean>, ended array<boolean>, done array<boolean>", self.keep_ms)
        self.parts = handle.getMapState(
            "parts", "poll long, part long", "source array<string>, pos array<long>, line array<string>", self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        low = int(key[1]) * BLOCK
        part, *columns = self.pages.get() or (0, *[()] * 7)
        pages = {(source, poll): _Page(*page) for source, poll, *page in zip(*columns)}
        came: dict[int, list[tuple]] = {}
        touched, ended = set(), False
        for batch in rows:
            for source, poll, pos, line, due, idle in zip(*(
                batch[c].tolist() for c in ("source", "poll", "pos", "line", "due", "idle")
            )):
                # The page before the block only says what was seen; its own delta is another block's.
                if low - 1 <= poll < low + BLOCK:
                    page = pages.setdefault((source, poll), _Page())
                    touched.add((source, poll))
                    if due >= 0:
                        page.due, page.alone = max(page.due, due), page.alone or idle > 0
                    elif not page.done:
                        page.have += 1
                        came.setdefault(poll, []).append((source, pos, line))
                last = poll - idle - 1
                if idle > 0 and last >= self.first_poll and low - 1 <= last < low + BLOCK - 1:
                    pages.setdefault((source, last), _Page()).ended = ended = True

        ready = [
            (source, poll) for source, poll in touched | {(source, poll + 1) for source, poll in touched}
            if poll >= low and self._ready(pages, source, poll)
        ]
        stored = {tuple(at): list(zip(*held)) for at, held in self.parts.iterator()} if part and (ready or ended) else {}
        lines: dict[tuple, list[tuple[int, str]]] = {}
        for poll, held in [*((poll, held) for (poll, _), held in stored.items()), *came.items()]:
            for source, pos, line in held:
                lines.setdefault((source, poll), []).append((pos, line))
        fresh = []
        for source, poll in ready:
            page, shown = pages[source, poll], lines.get((source, poll), ())
            first = page.alone or poll == self.first_poll
            before = set() if first else {line for _, line in lines.get((source, poll - 1), ())}
            cut = min((pos for pos, line in shown if line not in before), default=None)
            if cut is not None:
                fresh += [(source, poll, pos, line) for pos, line in shown if pos >= cut]
        for page in ready:
            pages[page].done = True
        self._keep(pages, part, came, stored, low)
        if fresh:
            yield pd.DataFrame(fresh, columns=["source", "poll", "pos", "line"])

    def _ready(self, pages: dict, source: str, poll: int) -> bool:
        page, before = pages.get((source, poll)), pages.get((source, poll - 1))
        if page is None or page.done or not page.complete:
            return False
        return page.alone or poll == self.first_poll or (before is not None and before.complete)

    def _keep(self, pages: dict, part: int, came: dict, stored: dict, low: int) -> None:
        """Keeps of a page what it or its successor in the block still needs, and of a whole block nothing."""

        def needed(source: str, poll: int) -> bool:
            page, after = pages[source, poll], pages.get((source, poll + 1))
            if poll >= low and not page.done:
                return True
            return poll < low + BLOCK - 1 and not page.ended and not (after is not None and after.done)

        wanted = {page for page in pages if needed(*page)}
        for at, held in stored.items():
            left = [row for row in held if (row[0], at[0]) in wanted]
            if not left:
                self.parts.removeKey(at)
            elif len(left) < len(held):
                self.parts.updateValue(at, tuple(map(list, zip(*left))))
        for poll, held in came.items():
            left = [row for row in held if (row[0], poll) in wanted]
            if left:
                self.parts.updateValue((poll, part), tuple(map(list, zip(*left))))
        # That a page is out matters to the one before, while that is not.
        known = [
            (source, poll, *astuple(page)) for (source, poll), page in pages.items()
            if (source, poll) in wanted
            or (poll > low and (source, poll - 1) in pages and not pages[source, poll - 1].done)
        ]
        if known:
            self.pages.update((part + bool(came), *map(list, zip(*known))))
        else:
            self.pages.clear()

    def close(self) -> None:
        pass


def assembled_delta_stream(
    snapshots: DataFrame, sizes: DataFrame, first_poll: int = 0, keep_ms: int | None = None, buckets: int = 256
) -> DataFrame:
    """Streaming :func:`drayage.operators.logs.poll_delta` of pages that come in parts, in any order.

    ``sizes(source, poll, n_lines)`` says of every poll from ``first_poll`` on how many lines its
    page has, none included; it may come before or after the lines. With a further column ``idle``, the
    number of polls just before this one that have none, those need no row of their own.
    A page waits in the state
    until all its lines and those of the page before are there, however many micro-batches and
    whichever polls come between; a poll never stated holds back the one after it. Work and state
    are keyed by blocks of ``BLOCK`` polls and ``buckets`` as in :func:`poll_delta_stream`, and a block that is out
    leaves nothing behind. Rows must not repeat. ``keep_ms`` ends the wait for what never comes.
    """
    source = snapshots.schema["source"].dataType
    none = F.lit(0).cast("long")
    lines = snapshots.select("source", "poll", F.col("pos").cast("long").alias("pos"), "line", F.lit(-1).cast("long").alias("due"), none.alias("idle"))
    stated = sizes.select(
        "source", "poll", F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("string").alias("line"), F.col("n_lines").cast("long").alias("due"),
        (F.coalesce(F.col("idle").cast("long"), none) if "idle" in sizes.columns else none).alias("idle"),
    )
    poll, last = F.col("poll").cast("long"), F.col("poll").cast("long") - F.col("idle") - 1
    # The last page of a block goes to the next one too, and both learn that no page follows a page.
    blocks = F.array_distinct(F.array(
        F.floor(poll / BLOCK), F.floor((poll + 1) / BLOCK),
        *[F.when((F.col("idle") > 0) & (last >= first_poll), F.floor(at / BLOCK)) for at in (last, last + 1)],
    ))
    shown = lines.unionByName(stated).select(
        F.col("source").cast("string").alias("source"), _bucket(buckets),
        F.explode(F.array_compact(blocks).cast("array<string>")).alias("block"),
        poll.alias("poll"), "pos", "line", "due", "idle",
    )
    return shown.groupBy("bucket", "block").transformWithStateInPandas(
        statefulProcessor=PageAssembly(first_poll, keep_ms),
        outputStructType="source string, poll long, pos long, line string",
        outputMode="append",
        timeMode="None" if keep_ms is None else "ProcessingTime",
    ).withColumns({
        "source": F.col("source").cast(source),
        "poll": F.col("poll").cast(snapshots.schema["poll"].dataType),
    })


def poll_delta_stream(snapshots: DataFrame, keep_ms: int | None = None, buckets: int = 256) -> DataFrame:
    """Streaming :func:`drayage.operators.logs.poll_delta`.

    A page must arrive whole in one micro-batch, and not before the page that
    precedes it; :func:`assembled_delta_stream` takes pages in parts and in any order. State and work are keyed by short blocks of polls and not by
    source, so a busy source, which has many pages, is spread over all tasks. The sources
    share ``buckets`` keys in each block, so that many sources with few lines make few groups; a group
    holds what a ``buckets``-th of the sources show in ``BLOCK`` + 1 polls. The last page of a block is sent
    to the next block too, as what was seen before.

    The latest page of a source stays in the state, unless ``keep_ms`` lets it
    go after that time; Spark then runs batches all the time to look for expired
    state, so a query that is to end by itself must not ask for it.
    """
    source = snapshots.schema["source"].dataType
    poll = F.col("poll").cast("long")
    block = F.floor(poll / BLOCK)
    closes = F.pmod(poll, F.lit(BLOCK)) == BLOCK - 1
    # Text: one null among numbers would make pandas read them all as floats.
    shown = snapshots.select(
        F.col("source").cast("string").alias("source"),
        _bucket(buckets),
        F.explode(
            F.when(closes, F.array(block, block + 1)).otherwise(F.array(block)).cast("array<string>")
        ).alias("block"),
        poll.alias("poll"),
        F.col("pos").cast("long").alias("pos"),
        "line",
    )
    return shown.groupBy("bucket", "block").applyInPandasWithState(
        _page_delta(keep_ms),
        outputStructType="source string, poll long, pos long, line string",
        stateStructType="sources array<string>, polls array<long>, at array<long>, lines array<array<string>>",
        outputMode="append",
        timeoutConf="NoTimeout" if keep_ms is None else "ProcessingTimeTimeout",
    ).withColumns({
        "source": F.col("source").cast(source),
        "poll": F.col("poll").cast(snapshots.schema["poll"].dataType),
    })


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col("source").cast("string")), F.lit(buckets)).cast("string").alias("bucket")
