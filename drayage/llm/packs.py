"""Word windows of all documents, compared across the cluster in packed form.

One row for each window would move and sort tens of bytes for each word of the corpus. Here
the documents are dealt into slices of a few megabytes. A slice hashes its windows with
array operations and sends, to each part of the hash space, the sorted hashes that fall
there as one binary value. A part puts together what all slices sent and answers each slice
with one value for each hash that it asked about. Asking slices hash their texts again, in the
same order, to read the answer. So a window costs a few bytes in each direction, a window
that a slice holds many times is sent once, and no part or slice grows with the corpus, as
their numbers do.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drayage.llm.frames import drop_shuffles, numbered
from drayage.session import workspace

#: Bytes of text in a slice, and about as many hashes in a part.
SLICE_BYTES = 4 << 20
PART_HASHES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE_BASE, _WINDOW_BASE, _OTHER_BASE = (
    np.uint64(x) for x in (0x9DDFEA08EB382D69, 0xC3A5C85C97CB3127, 0xB492B66FBE98F273)
)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


def _ranges(values: np.ndarray, base: np.uint64, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial hash of ``values[start:end]`` for each pair, the same wherever it lies."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(base, len(values)), out=sums[1:])
    return (sums[ends] - sums[starts]) * _powers(_inverse(base), len(values) + 1)[starts]


class Words:
    """The words of the documents of a slice, in the order of their ids and texts.

    ``doc`` is the place of each word's document in that order, ``first`` the first word of each
    document (and, at the end, the number of words)."""

    def __init__(self, ids: pa.Array, texts: pa.Array):
        plain, raw = ids.to_pylist(), texts.cast(pa.binary()).to_pylist()
        order = sorted(range(len(plain)), key=lambda i: (plain[i] is None, plain[i] or 0, raw[i]))
        self.ids = [plain[i] for i in order]
        texts_ = [raw[i] for i in order]
        lengths = np.array([len(t) for t in texts_], np.int64)
        edges = np.r_[0, np.cumsum(lengths)]
        self.data = np.frombuffer(b"".join(texts_), np.uint8)
        full = ~_SPACE[self.data]
        begin = np.zeros(len(full) + 1, bool)
        begin[edges] = True
        before = np.r_[False, full[:-1]] if len(full) else full
        after = np.r_[full[1:], False] if len(full) else full
        self.starts = np.flatnonzero(full & (~before | begin[:-1]))
        self.ends = np.flatnonzero(full & (~after | begin[1:])) + 1
        self.first = np.searchsorted(self.starts, edges)
        self.doc = np.repeat(np.arange(len(texts_)), np.diff(self.first))
        hashes = np.empty(len(self.starts), np.uint64)
        for at in range(0, len(hashes), 200_000):
            s, e = self.starts[at : at + 200_000], self.ends[at : at + 200_000]
            bytes_ = self.data[s[0] : e[-1]].astype(np.uint64) + np.uint64(1)
            hashes[at : at + 200_000] = _ranges(bytes_, _BYTE_BASE, s - s[0], e - s[0])
        self.hashes = mixed(hashes)

    def whole(self, length: int) -> np.ndarray:
        """Whether a window of ``length`` words that starts here ends in the same document."""
        ok = np.zeros(len(self.doc), bool)
        if len(ok) >= length:
            ok[: len(ok) - length + 1] = self.doc[: len(ok) - length + 1] == self.doc[length - 1 :]
        return ok

    def windows(self, length: int, at: np.ndarray, base: np.uint64 = _WINDOW_BASE) -> np.ndarray:
        """Hashes of the windows of ``length`` words that start at ``at``."""
        return mixed(_ranges(self.hashes, base, at, at + length) + np.uint64(length))

    def other_windows(self, length: int, at: np.ndarray) -> np.ndarray:
        """A second hash of the same windows."""
        return self.windows(length, at, _OTHER_BASE)


class Asked:
    """The different hashes of a slice in the order in which they are sent: by part, then by the
    ``bits`` that tell them apart there, 32 or 48, then by ``others``, second hashes that tell
    apart what those bits do not. ``of`` is the place in that order of each hash given, ``at`` the
    place where a hash was given first."""

    def __init__(self, hashes: np.ndarray, parts: int, bits: int = 32, others: np.ndarray | None = None):
        n, self.low = np.uint64(parts), np.uint64((1 << bits) - 1)
        keys = (hashes % n) << np.uint64(bits) | (hashes // n) & self.low
        if others is None:
            self.keys, self.at, self.of, self.counts = np.unique(
                keys, return_index=True, return_inverse=True, return_counts=True
            )
        else:
            order = np.lexsort((others, keys))
            new = np.ones(len(order), bool)
            new[1:] = (np.diff(keys[order]) != 0) | (np.diff(others[order]) != 0)
            # The sort is stable, so the first of each pair comes first.
            self.at = order[new]
            self.keys = keys[self.at]
            self.of = np.empty(len(order), np.int64)
            self.of[order] = np.cumsum(new) - 1
            self.counts = np.bincount(self.of, minlength=len(self.at))
        self.parts, self.edges = np.unique(self.keys >> np.uint64(bits), return_index=True)
        self.edges = np.r_[self.edges, len(self.keys)].astype(np.int64)

    def sent(self):
        """For each part that is asked: its number, the range in the order, and the packed hashes."""
        for part, s, e in zip(self.parts.tolist(), self.edges[:-1].tolist(), self.edges[1:].tolist()):
            yield part, s, e, packed(self.keys[s:e] & self.low)


def planes(numbers: np.ndarray) -> bytes:
    """Unsigned numbers byte plane by byte plane, so that high bytes, mostly zero, compress."""
    width = numbers.dtype.itemsize
    return numbers.view(np.uint8).reshape(-1, width).T.tobytes()


def from_planes(data: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(dtype).ravel()


def packed(ascending: np.ndarray) -> bytes:
    return planes(np.diff(ascending, prepend=ascending.dtype.type(0)))


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, np.uint64), dtype=np.uint64)


def sliced(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """``docs`` as a table ``slice, id, text`` in the shared folder, bucketed by slice, and how many
    parts the hash space should have. Reading it by slice moves nothing; rows with the same id
    share a slice. A null text becomes an empty one; ids are whole numbers or null. There are
    65,536 parts at most, so that 48 bits beside the part fit a number."""
    plain, names = numbered(docs)
    text = F.coalesce(F.col(names[text_col]).cast("string"), F.lit(""))
    rows = plain.select(F.col(names[id_col]).cast("long").alias("id"), text.alias("text"))
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, -(-size // SLICE_BYTES))
    name = f"slices_{uuid.uuid4().hex}"
    (
        rows.withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(slices)))
        .repartition(partitions, "slice")
        .write.bucketBy(partitions, "slice").option("compression", "zstd")
        .option("path", workspace(spark, "slices")).saveAsTable(name)
    )
    drop_shuffles(spark)
    return spark.table(name), min(1 << 16, max(1, size // 6 // PART_HASHES, 2 * partitions))


def by_slice(table: DataFrame, answers: DataFrame | None, run: Callable, schema: str) -> DataFrame:
    """``run(slice, words, answers)`` for each slice, with the rows of ``answers`` for it."""
    texts = table.groupBy("slice")
    if answers is None:
        def alone(key, texts):
            return run(key[0].as_py(), Words(*_columns(texts)), None)

        return texts.applyInArrow(alone, schema)

    def together(key, texts, answers):
        return run(key[0].as_py(), Words(*_columns(texts)), answers)

    return texts.cogroup(answers.groupBy("slice")).applyInArrow(together, schema)


def _columns(texts: pa.Table) -> tuple[pa.Array, pa.Array]:
    one = lambda c: c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
    texts = texts.combine_chunks()
    return one(texts["id"]), one(texts["text"])


def answer_of(answers: pa.Table, step: int, asked: Asked, read: Callable[[bytes, int], np.ndarray], none) -> np.ndarray:
    """The answers of a step for each of the hashes asked, in their order; ``none`` where there is none."""
    out = np.full(len(asked.keys), none)
    at = {part: (s, e) for part, s, e in zip(asked.parts.tolist(), asked.edges[:-1].tolist(), asked.edges[1:].tolist())}
    for of, part, data in zip(*(answers[c].to_pylist() for c in ("step", "part", "answer"))):
        if of == step:
            s, e = at[part]
            out[s:e] = read(data, e - s)
    return out
