"""Best-fit packing of token sequences, online, with a fixed number of open bins.

``pieces`` encodes whole texts and cuts only those that fit no sequence; all pieces of a cut
document but the first fill a sequence each. ``packed`` deals the pieces to tasks of about
``PER_TASK``. A task reads them as a stream, in windows that put longer pieces first, and places
each in the open bin where it leaves least room. Open bins are keyed by their free tokens in a
bitset, so the best one is its lowest set bit from the piece's length on. A bin without room
closes; if none fits and ``OPEN_BINS`` are open, the fullest closes first. So a task holds a window
of rows and one list of bins, however many rows it reads.

A null text counts as empty and is a piece of the end token alone. Rows repeated are packed row by
row, and a null id is carried as it is. Other columns of ``packed``'s input are carried whatever
they are called, but for ``sequence_id`` and ``offset``, which the result replaces. An empty table
gives no rows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drayage.llm.cached import REMEMBERED_BYTES, UNIT, byte_encoder, kept
from drayage.llm.frames import numbered
from drayage.llm.frames import pieces as slices
from drayage.llm.frames import stored

CAPACITY = 1024
#: The id that ends each document.
END = 2
OPEN_BINS = 2048
WINDOW = 4096
PER_TASK = 8192


class OpenBins:
    """At most ``most`` bins of ``capacity``, found by their free room."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.rooms = 0
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.open = self.opened = 0

    def place(self, length: int) -> tuple[int, int]:
        """The bin that takes ``length`` and the offset there."""
        fitting = self.rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            bin_ = self._take(room)
        else:
            if self.open >= self.most:
                self._take((self.rooms & -self.rooms).bit_length() - 1)
            room, bin_ = self.capacity, self.opened
            self.opened += 1
        left = room - length
        if left:
            self.bins[left].append(bin_)
            self.rooms |= 1 << left
            self.open += 1
        return bin_, self.capacity - room

    def _take(self, room: int) -> int:
        bin_ = self.bins[room].pop()
        if not self.bins[room]:
            self.rooms &= ~(1 << room)
        self.open -= 1
        return bin_


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document of ``n`` tokens; only the first may be shorter."""
    first = n % capacity or capacity
    return [(0, min(first, n)), *((at, capacity) for at in range(first, n, capacity))]


def pieces(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length`` and ``ids``, little-endian unsigned 32-bit integers.

    ``tokenizer_file`` is installed wherever tasks run.
    """
    docs, names = numbered(docs)

    def run(batches):
        known = kept("byte_encoder", (tokenizer_file,), lambda: byte_encoder(tokenizer_file, 2 * REMEMBERED_BYTES))
        last = struct.pack("<I", end)
        for batch in slices(batches, 128):
            found = known.values([UNIT.findall(t or "") for t in batch.column(1).to_pylist()])
            owner, rows = [], []
            for i, values in enumerate(found):
                values.append(last)
                ids = b"".join(values)
                for k, (start, length) in enumerate(cuts(len(ids) // 4, capacity)):
                    owner.append(i)
                    rows.append((k, start, length, ids[4 * start : 4 * (start + length)]))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.binary()))]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(owner)), *columns], ["doc_id", "piece", "start", "length", "ids"]
                )

    texts = docs.select(F.col(names[id_col]).alias("doc_id"), F.col(names[text_col]).cast("string").alias("text"))
    schema = T.StructType([texts.schema["doc_id"]]).add("piece", "integer").add("start", "long").add("length", "long")
    return texts.mapInArrow(run, schema.add("ids", "binary"))


def packed(
    items: DataFrame, length_col: str = "length", capacity: int = CAPACITY, open_bins: int = OPEN_BINS, window: int = WINDOW, per_task: int = PER_TASK
) -> DataFrame:
    """``items``, read twice, with ``sequence_id`` and ``offset``: no length passes ``capacity``."""
    items = items.drop("sequence_id", "offset")
    at = items.columns.index(length_col)
    tasks = max(1, -(-items.count() // per_task))
    # Even shares whatever the keys; a task that is run again gets the same rows, in the same order.
    dealt = items.repartition(tasks).sortWithinPartitions(F.xxhash64(*items.columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(capacity, open_bins)
        base = TaskContext.get().partitionId() << 40
        waiting: list[pa.RecordBatch] = []

        def place(rows: pa.Table):
            lengths = np.asarray(rows.column(at)).astype(np.int64)
            if len(lengths) and (lengths.min() < 1 or lengths.max() > capacity):
                raise ValueError(f"lengths are from 1 to {capacity}")
            order = np.argsort(-lengths, kind="stable")
            places = np.array([bins.place(n) for n in lengths[order].tolist()], np.int64).reshape(-1, 2)
            rows = rows.take(pa.array(order))
            rows = rows.append_column("sequence_id", pa.array(base + places[:, 0])).append_column("offset", pa.array(places[:, 1]))
            return rows.to_batches()

        for batch in slices(batches, window):
            waiting.append(batch)
            if sum(b.num_rows for b in waiting) >= window:
                rows = pa.Table.from_batches(waiting)
                yield from place(rows.slice(0, window))
                waiting = rows.slice(window).to_batches()
        if waiting:
            yield from place(pa.Table.from_batches(waiting))

    return dealt.mapInArrow(run, T.StructType(items.schema.fields).add("sequence_id", "long").add("offset", "long"))


def sequences(placed: DataFrame) -> DataFrame:
    """``sequence_id``, ``pieces`` and ``ids``: the sequences written out, each of bounded length."""
    inside = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate("inside", F.lit(b""), lambda ids, x: F.concat(ids, x["ids"]))
    grouped = placed.groupBy("sequence_id").agg(inside.alias("inside"))
    return grouped.select("sequence_id", F.size("inside").alias("pieces"), whole.alias("ids"))


def packed_documents(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """The pieces of ``docs`` and where they lie; without ``keep_ids`` their CRC-32 stands for the ids.

    Encoded once: the pieces are a written table by the time they are packed.
    """
    found = stored(pieces(docs, tokenizer_file, id_col=id_col, text_col=text_col), "pieces")
    if not keep_ids:
        found = found.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packed(found)
