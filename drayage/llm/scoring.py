"""Stupid-backoff scores of whole documents from n-gram counts over all documents.

Each slice of documents asks the parts of the hash space for the counts of its n-grams: what
it sends are rows (part, slice, hashes, own counts); a part adds the counts of all slices up,
which makes it the count table of its hashes, joins them to the hashes asked, and the answers
come back to the slice, where each n-gram gets its score and each document its sum. Words and
pairs are counted first; a longer n-gram is counted only where the two shorter ones in it
occur often enough, as it cannot occur more often than they do.

A word scores count(n-gram) / count(its history) for the longest n-gram that ends there, stays
in the document and occurs ``SEEN`` times or more; each step to a shorter one costs a factor
``BACKOFF``, and a single word scores count(word) / count(all words). Occurrences include the
document's own, so with ``SEEN`` = 2 no n-gram vouches for itself. N-grams are told apart by
their part and 48 bits, so about one in 10^8 shares its count with another.

Scores are logarithms to the base 10 in millionths, rounded for each word, so that their sums
do not depend on the order. A null text has no words; without words the sum is 0 and the mean
null. Rows repeated count as often as they occur. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drayage.llm.frames import stored
from drayage.llm.packs import Asked, Words, answer_of, by_slice, from_planes, planes, sliced, unpacked

ORDER = 3
SEEN = 2
BACKOFF = 0.4


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``n_words``, ``log_score`` (the sum, in
    millionths) and ``mean_log`` for each word."""
    table, parts = sliced(docs, id_col, text_col)
    answers = None
    for lengths in [[1, 2][:order], *[[n] for n in range(3, order + 1)]]:
        sent = by_slice(
            table, answers, _asker(lengths, parts), "slice long, part long, step int, hashes binary, counts binary"
        )
        found = stored(sent.groupBy("part", "step").applyInArrow(
            _added_up, "slice long, part long, step int, answer binary, words long"
        ), "counts")
        answers = found if answers is None else answers.union(found)
    # The number of all words comes with the answers about single words.
    total = answers.agg(F.sum("words")).first()[0] or 0
    done = by_slice(table, answers, _scorer(order, parts, total), "doc_id long, n_words long, log_score long")
    return done.withColumn(
        "mean_log", F.when(F.col("n_words") > 0, F.col("log_score") / F.lit(1e6) / F.col("n_words"))
    )


def _counts(words: Words, answers: pa.Table | None, order: int, parts: int) -> list[np.ndarray]:
    """For each length the counts of the n-grams that start at each word, 0 where not asked for."""
    counts = []
    for length in range(1, order + 1):
        at, asked = _asked(words, length, counts, parts)
        found = answer_of(answers, length, asked, lambda data, _: from_planes(data, "<u8"), np.uint64(0))
        here = np.zeros(len(words.doc), np.float64)
        here[at] = found[asked.of]
        counts.append(here)
    return counts


def _asked(words: Words, length: int, counts: list[np.ndarray], parts: int) -> tuple[np.ndarray, Asked]:
    """Where n-grams start whose counts are asked for: all but those with a part that is too rare."""
    due = words.whole(length)
    if length > 2:
        seen = counts[length - 2] >= SEEN
        due &= seen & np.r_[seen[1:], False]
    at = np.flatnonzero(due)
    return at, Asked(words.windows(length, at), parts, 48)


def _asker(lengths: list[int], parts: int):
    def run(slice_, words, answers):
        rows = []
        known = _counts(words, answers, lengths[0] - 1, parts)
        for length in lengths:
            _, asked = _asked(words, length, known, parts)
            for part, s, e, hashes in asked.sent():
                rows.append((slice_, part, length, hashes, planes(asked.counts[s:e].astype("<u4"))))
        columns = list(zip(*rows)) or [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], ["slice", "part", "step", "hashes", "counts"])

    return run


def _added_up(table):
    lists = [unpacked(h) for h in table["hashes"].to_pylist()]
    counts = np.concatenate([from_planes(c, "<u4") for c in table["counts"].to_pylist()])
    edges = np.r_[0, np.cumsum([len(x) for x in lists])].astype(np.int64)
    _, of = np.unique(np.concatenate(lists), return_inverse=True)
    sums = np.bincount(of, counts).astype("<u8")[of]
    step = table["step"].to_pylist()
    words = [int(counts[s:e].sum()) if n == 1 else 0 for n, s, e in zip(step, edges[:-1], edges[1:])]
    answers = [planes(sums[s:e]) for s, e in zip(edges[:-1], edges[1:])]
    return pa.table(
        [table["slice"], table["part"], table["step"], pa.array(answers, pa.binary()), pa.array(words, pa.int64())],
        ["slice", "part", "step", "answer", "words"],
    )


def _scorer(order: int, parts: int, total: int):
    def run(slice_, words, answers):
        n = len(words.doc)
        counts = _counts(words, answers, order, parts)
        inside = np.arange(n) - words.first[words.doc]  # words before it in its document
        score = counts[0] / max(1, total)
        for length in range(2, order + 1):
            ends = np.arange(length - 1, n)
            gram, history = counts[length - 1][ends - length + 1], counts[length - 2][ends - length + 1]
            due = inside[ends] >= length - 1
            seen = due & (gram >= SEEN)
            score[ends[due]] *= BACKOFF
            score[ends[seen]] = gram[seen] / history[seen]
        logs = np.floor(np.log10(score) * 1e6 + 0.5).astype(np.int64) if n else np.zeros(0, np.int64)
        sums = np.r_[0, np.cumsum(logs)]
        first = words.first
        return pa.table(
            [pa.array(words.ids, pa.int64()), pa.array(np.diff(first)), pa.array(sums[first[1:]] - sums[first[:-1]])],
            ["doc_id", "n_words", "log_score"],
        )

    return run
