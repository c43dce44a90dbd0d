"""Substring dedup by level-wise doubling.

Windows of a few words that occur at one place only can be part of no longer window that
occurs twice. So the windows of ``FIRST_WORDS`` words are counted for all texts; only where
a window is repeated, and so is the one that starts where it ends, they are joined to one of
twice the length, which is counted in turn, until no candidates survive or the length
sought is reached. Of the windows of that length that remain, each but the first one (of the
smallest id, then the earliest) marks its words, whatever other windows mark.

Candidates are found with 32 bits of a hash beside the part, where a collision only adds work;
windows of the full length are told apart, within a slice and between slices, by 48 bits of it
and a second hash of 64 bits.

A null text has no words, nor has an empty one; both come back with nothing removed. A null id
sorts behind all others. Rows with the same id are in the order of their texts, and of equal
rows one counts as the earlier, so the rest of them go. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from drayage.llm.frames import stored
from drayage.llm.packs import Asked, Words, answer_of, by_slice, planes, from_planes, sliced, unpacked

WINDOW_WORDS = 20
FIRST_WORDS = 5

_SENT = "slice long, part long, hashes binary, more binary"
_ANSWERS = "slice long, part long, step int, answer binary"


def repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_WORDS,
                   first: int = FIRST_WORDS) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``n_words``, ``n_removed``, ``removed`` (ranges of
    words, as ``start, end`` pairs of 64-bit integers, little-endian) and ``kept_text``, the words
    that stay, with one space between them. ``window`` is ``first`` times a power of two."""
    lengths = [first]
    while lengths[-1] < window:
        lengths.append(2 * lengths[-1])
    if lengths[-1] != window:
        raise ValueError("window must be first times a power of two")
    table, parts = sliced(docs, id_col, text_col)
    answers = None
    for step in range(len(lengths)):
        last = step == len(lengths) - 1
        sent = by_slice(table, answers, _asker(lengths[: step + 1], parts, last), _SENT)
        found = sent.groupBy("part").applyInArrow(_earlier(step) if last else _repeated(step), _ANSWERS)
        found = stored(found, "answers")
        answers = found if answers is None else answers.union(found)
        if found.isEmpty():
            break
    schema = "doc_id long, n_words long, n_removed long, removed binary, kept_text string"
    done = by_slice(table, answers, _remover(lengths, parts), schema)
    return done


def _candidates(words: Words, answers: pa.Table | None, lengths: list[int], parts: int) -> np.ndarray:
    """Where windows of the last length start whose halves are repeated."""
    at = np.flatnonzero(words.whole(lengths[0]))
    for step, length in enumerate(lengths[:-1]):
        asked = Asked(words.windows(length, at), parts)
        elsewhere = answer_of(answers, step, asked, _bits, False)
        repeated = np.zeros(len(words.doc), bool)
        repeated[at[(elsewhere | (asked.counts > 1))[asked.of]]] = True
        both = repeated & words.whole(2 * length)
        both[: max(0, len(both) - length)] &= repeated[length:]
        at = np.flatnonzero(both)
    return at


def _told_apart(words: Words, length: int, at: np.ndarray, parts: int) -> Asked:
    """The different windows of the last length, by both hashes."""
    return Asked(words.windows(length, at), parts, 48, words.other_windows(length, at))


def _bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def _asker(lengths: list[int], parts: int, last: bool):
    def run(slice_, words, answers):
        at = _candidates(words, answers, lengths, parts)
        asked = _told_apart(words, lengths[-1], at, parts) if last else Asked(words.windows(lengths[-1], at), parts)
        rows = []
        if last:
            # The first of the same windows in this slice stands for all.
            at = at[asked.at]
            checks = words.other_windows(lengths[-1], at).astype("<u8")
            ids = np.array([np.iinfo(np.int64).max if i is None else i for i in words.ids], "<i8")[words.doc[at]]
        for part, s, e, hashes in asked.sent():
            more = planes(checks[s:e]) + planes(ids[s:e]) if last else None
            rows.append((slice_, part, hashes, more))
        columns = list(zip(*rows)) or [[], [], [], []]
        return pa.table(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
            ["slice", "part", "hashes", "more"],
        )

    return run


def _answer(rows: list, step: int) -> pa.Table:
    columns = list(zip(*rows)) or [[], [], []]
    slices, part, data = columns
    return pa.table(
        [pa.array(slices, pa.int64()), pa.array(part, pa.int64()), pa.array([step] * len(rows), pa.int32()),
         pa.array(data, pa.binary())],
        ["slice", "part", "step", "answer"],
    )


def _gathered(table: pa.Table) -> tuple[list[int], list[int], np.ndarray, np.ndarray]:
    """The slices, their parts, all hashes, and the borders between the slices."""
    lists = [unpacked(h) for h in table["hashes"].to_pylist()]
    edges = np.r_[0, np.cumsum([len(x) for x in lists])].astype(np.int64)
    return table["slice"].to_pylist(), table["part"].to_pylist(), np.concatenate(lists), edges


def _repeated(step: int):
    """Answers each hash with whether another slice has it too."""

    def run(table):
        slices, parts, hashes, edges = _gathered(table)
        _, of, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        more = counts[of] > 1
        rows = []
        for slice_, part, s, e in zip(slices, parts, edges[:-1], edges[1:]):
            if more[s:e].any():
                rows.append((slice_, part, np.packbits(more[s:e]).tobytes()))
        return _answer(rows, step)

    return run


def _earlier(step: int):
    """Answers each window with whether another slice has the same one with a smaller id."""

    def run(table):
        slices, parts, hashes, edges = _gathered(table)
        data = table["more"].to_pylist()
        checks = np.concatenate([from_planes(d[: len(d) // 2], "<u8") for d in data])
        ids = np.concatenate([from_planes(d[len(d) // 2 :], "<i8") for d in data])
        order = np.lexsort((ids, checks, hashes))
        new = np.r_[True, (hashes[order][1:] != hashes[order][:-1]) | (checks[order][1:] != checks[order][:-1])]
        later = np.empty(len(order), bool)
        later[order] = ~new
        rows = []
        for slice_, part, s, e in zip(slices, parts, edges[:-1], edges[1:]):
            if later[s:e].any():
                rows.append((slice_, part, np.packbits(later[s:e]).tobytes()))
        return _answer(rows, step)

    return run


def _remover(lengths: list[int], parts: int):
    window = lengths[-1]

    def run(slice_, words, answers):
        at = _candidates(words, answers, lengths, parts)
        asked = _told_apart(words, window, at, parts)
        later = answer_of(answers, len(lengths) - 1, asked, _bits, False)
        # The first one of the slice, if no other slice has an earlier one, is the only one to stay.
        goes = np.ones(len(at), bool)
        goes[asked.at] = later
        edges = np.zeros(len(words.doc) + 1, np.int64)
        np.add.at(edges, at[goes], 1)
        np.add.at(edges, at[goes] + window, -1)
        removed = np.cumsum(edges[:-1]) > 0
        data = words.data.tobytes()
        rows = []
        for i, id_ in enumerate(words.ids):
            s, e = int(words.first[i]), int(words.first[i + 1])
            gone = removed[s:e]
            borders = np.flatnonzero(np.diff(np.r_[False, gone, False]))
            kept = np.flatnonzero(~gone) + s
            text = b" ".join([data[a:b] for a, b in zip(words.starts[kept].tolist(), words.ends[kept].tolist())])
            rows.append((id_, e - s, int(gone.sum()), borders.astype("<i8").tobytes(), text))
        columns = list(zip(*rows)) or [[], [], [], [], []]
        return pa.table(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()),
             pa.array(columns[3], pa.binary()), pa.array([t.decode() for t in columns[4]], pa.string())],
            ["doc_id", "n_words", "n_removed", "removed", "kept_text"],
        )

    return run
