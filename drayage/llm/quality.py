"""Quality rules and an isolation forest over their statistics.

Each text gets statistics of its words, lines and characters. The base rules reject texts
with too few words or too many repeated word windows. The forest judges the rest: random
splits of the ranges that the statistics have over all texts part rare combinations early
from a sample of good texts, so a short mean path over many trees marks an unusual
document. How short is too short comes from rows labelled good or bad: between the shortest
paths of the good rows, but for the ``1 - KEEP_GOOD`` shortest, and the longest path of the
bad rows below that.

The threshold is made from the paths of all labelled rows that pass the base rules. A tree is grown
from ``TREE_ROWS`` good ones, as the method has it; where there are more than all trees take, the rows for
them are drawn by a hash of the id.
Statistics, their ranges and the scores cover every text in full.

A null text has no words and is rejected by the base rules; so is an empty one. Rows
repeated are judged row by row. Without labelled rows of both kinds that pass the base
rules, these alone decide. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drayage.llm.frames import numbered, pieces, stored

TREES = 100
TREE_ROWS = 256
KEEP_GOOD = 0.999
SEED = 7

#: Splits above a leaf at most.
DEPTH = 12
WINDOW = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What the forest sees: shares that do not grow with the length of a text, x as x / (x + 0.1),
#: so that random splits tell small shares apart too.
FEATURES = (
    "symbols_per_word", "repeated_words", "upper_letters", "punctuation", "exclaimed_words",
    "words_with_symbols", "words_like_the_last",
)

_SYMBOLS = re.compile(r"[#*$%&|<>]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_MARKS = re.compile(r"[^\w\s]")


def statistics(text: str) -> tuple[list[int], list[float]]:
    """The counts and the features of one whole text."""
    words = text.encode().split()  # bytes: the six white space characters only
    n = len(words)
    decoded = b"".join(words).decode()
    chars = len(decoded)
    symbols = len(_SYMBOLS.findall(text))

    lines = [line for line in text.split("\n") if line.encode().strip()]
    dup_lines = len(lines) - len(set(lines))

    repeated = 0
    if n > WINDOW:
        windows = list(zip(*(words[i:] for i in range(WINDOW))))
        if len(set(windows)) < len(windows):
            seen: dict[tuple, int] = {}
            for window in windows:
                seen[window] = seen.get(window, 0) + 1
            until = 0
            for at, window in enumerate(windows):
                if seen[window] > 1:
                    repeated += at + WINDOW - max(at, until)
                    until = at + WINDOW
    some, all_chars = max(n, 1), max(chars, 1)
    shares = [
        symbols / some,
        repeated / some,
        len(_UPPER.findall(text)) / all_chars,
        len(_MARKS.findall(text)) / all_chars,
        sum(w[-1:] in b"!?" for w in words) / some,
        sum(w[-1:] in b"#*$%&|<>" for w in words) / some,
        sum(a == b for a, b in zip(words, words[1:])) / some,
    ]
    features = [x / (x + 0.1) for x in shares]
    return [n, chars, symbols, dup_lines, repeated], features


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 10 or 100 * n_repeat_words > 20 * n_words


@dataclass
class Forest:
    """Trees as arrays: for each node the feature and the split, its left child (the right one
    is next to it) and, for leaves, the path length."""

    feature: np.ndarray
    split: np.ndarray
    child: np.ndarray
    length: np.ndarray
    threshold: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """The mean path length of each row over the trees, shorter for unusual rows."""
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for feature, split, child, length in zip(self.feature, self.split, self.child, self.length):
            node = np.zeros(len(rows), np.int64)
            while True:
                inner = child[node] > 0
                if not inner.any():
                    break
                right = rows[every, feature[node]] >= split[node]
                node = np.where(inner, child[node] + right, node)
            total += length[node]
        return total / max(1, len(self.feature))


def _mean_path(rows: int) -> float:
    """The mean path to a row in a random search tree of so many rows."""
    return 0.0 if rows < 2 else 2 * (math.log(rows - 1) + 0.5772156649) - 2 * (rows - 1) / rows if rows > 2 else 1.0


def grow(good: np.ndarray, low: np.ndarray, high: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS,
         depth: int = DEPTH, seed: int = SEED) -> Forest:
    """Isolation trees over random parts of ``good``. A node splits the range of a random feature
    that it has, of the ranges ``low`` to ``high`` at the root, at a random place; a leaf holds one
    good row at most or lies ``depth`` splits deep."""
    rng = np.random.default_rng(seed)
    grown = []
    for _ in range(trees if len(good) else 0):
        part = good[rng.choice(len(good), min(rows, len(good)), replace=False)]
        feature, split, child, length = [0], [0.0], [0], [0.0]
        todo = [(0, part, low, high, 0)]
        while todo:
            node, here, least, most, above = todo.pop()
            wide = np.flatnonzero(most > least)
            if above >= depth or len(here) < 2 or not len(wide):
                length[node] = above + _mean_path(len(here))
                continue
            f = int(rng.choice(wide))
            at = most[f] - rng.random() * (most[f] - least[f])
            feature[node], split[node], child[node] = f, at, len(feature)
            right = here[:, f] >= at
            below, over = most.copy(), least.copy()
            below[f] = over[f] = at
            for side in ((here[~right], least, below), (here[right], over, most)):
                todo.append((len(feature), *side, above + 1))
                feature.append(0), split.append(0.0), child.append(0), length.append(0.0)
        grown.append((feature, split, child, length))
    width = max((len(t[0]) for t in grown), default=1)
    padded = [np.array([t[i] + [0] * (width - len(t[i])) for t in grown]).reshape(len(grown), width) for i in range(4)]
    return Forest(padded[0].astype(int), padded[1].astype(float), padded[2].astype(int), padded[3].astype(float), -1.0)


def calibrated(forest: Forest, least: float | None, below: float | None) -> Forest:
    """Sets the threshold half way between ``least``, the shortest path of the good rows that are to
    pass, and ``below``, the longest of the bad rows under it."""
    if least is not None and below is not None and len(forest.feature):
        forest.threshold = float((least + below) / 2)
    return forest


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the counts, ``features`` and ``base_failed`` of each row."""
    docs, names = numbered(docs)
    texts = docs.select(F.col(names[id_col]).alias("doc_id"), F.col(names[text_col]).cast("string").alias("text"))

    def run(batches):
        for piece in pieces(batches):
            counts, features = zip(*[statistics(t or "") for t in piece.column(1).to_pylist()])
            failed = [base_failed(c[0], c[4]) for c in counts]
            made = [pa.array(c, pa.int64()) for c in zip(*counts)]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), *made, pa.array(features, pa.list_(pa.float64())), pa.array(failed)],
                ["doc_id", *COUNTS, "features", "base_failed"],
            )

    schema = T.StructType([texts.schema["doc_id"]])
    for name in COUNTS:
        schema = schema.add(name, "long")
    return texts.mapInArrow(run, schema.add("features", T.ArrayType(T.DoubleType())).add("base_failed", "boolean"))


def fit(described_: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Forest:
    """A forest for documents whose statistics are given, with a threshold from ``labels``."""
    passing = described_.filter("NOT base_failed").select("doc_id", "features")
    bounds = passing.agg(*[
        f(F.col("features")[i]).alias(f"{n}{i}") for i in range(len(FEATURES)) for n, f in (("low", F.min), ("high", F.max))
    ]).first()
    marks = labels.select(F.col(id_col).alias("of"), F.col(label_col).alias("label")).filter("label IS NOT NULL")
    marked = stored(passing.join(marks, F.col("doc_id") == F.col("of")).select(
        F.xxhash64(F.col("doc_id").cast("string")).alias("drawn"), "features", "label"
    ), "marked")
    good = marked.filter("label = 1").select("drawn", "features")
    drawn = np.array([r.features for r in first_drawn(good, TREES * TREE_ROWS)]).reshape(-1, len(FEATURES))
    low, high = (np.array([bounds[f"{n}{i}"] or 0.0 for i in range(len(FEATURES))]) for n in ("low", "high"))
    forest = grow(drawn, low, high)
    if not len(drawn):
        return forest
    paths = stored(scored(marked.select("label", "features"), forest), "paths")
    n = paths.filter("label = 1").count()
    least = paths.filter("label = 1").orderBy("path").limit(int((1 - KEEP_GOOD) * n) + 1).agg(F.max("path")).first()[0]
    below = paths.filter(~(F.col("label") == 1) & (F.col("path") < F.lit(least))).agg(F.max("path")).first()[0]
    return calibrated(forest, least, below)


def scored(rows: DataFrame, forest: Forest) -> DataFrame:
    """``label`` and ``path`` of each row."""

    def run(batches):
        for piece in pieces(batches, 8192):
            features = piece.column(1).flatten().to_numpy(zero_copy_only=False).reshape(piece.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(forest.scores(features))], ["label", "path"])

    return rows.mapInArrow(run, T.StructType([rows.schema["label"], T.StructField("path", T.DoubleType())]))


def first_drawn(rows: DataFrame, most: int) -> list[Row]:
    """The first ``most`` of ``rows`` by their hash ``drawn``, then by their other columns. A threshold
    on the hash thins the rows before they are sorted, or each partition would send ``most`` of them."""
    n = rows.count()
    share = min(1.0, 1.2 * most / max(1, n))
    near = rows
    while share < 1.0:
        near = rows.filter(F.col("drawn") <= F.lit(int((2 * share - 1) * 2**63)))
        if near.count() >= most:
            break
        # Few different ids, and their hashes fell unevenly.
        share, near = 2 * share, rows
    return near.orderBy(*rows.columns).limit(most).collect()


def judged(described_: DataFrame, forest: Forest) -> DataFrame:
    """Adds ``path``, the mean path length, and ``kept``; drops ``features``."""
    at = described_.columns.index("features")

    def run(batches):
        for piece in pieces(batches, 8192):
            rows = piece.column(at).flatten().to_numpy(zero_copy_only=False).reshape(piece.num_rows, len(FEATURES))
            path = forest.scores(rows)
            failed = piece.column(at + 1).to_numpy(zero_copy_only=False)
            kept = ~failed & (path >= forest.threshold)
            yield pa.RecordBatch.from_arrays(
                [*piece.columns[:at], *piece.columns[at + 1 :], pa.array(path), pa.array(kept)],
                [*piece.schema.names[:at], *piece.schema.names[at + 1 :], "path", "kept"],
            )

    schema = T.StructType([f for f in described_.schema if f.name != "features"])
    return described_.mapInArrow(run, schema.add("path", "double").add("kept", "boolean"))


def verdicts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, the counts, ``base_failed``, ``path``, ``kept``."""
    found = stored(described(docs, id_col, text_col), "statistics")
    return judged(found, fit(found, labels, id_col))


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns. The statistics are made again
    on the way, which takes less than a second copy of the texts."""
    forest = fit(stored(described(docs, id_col, text_col), "statistics"), labels, id_col)
    plain, names = numbered(docs)
    at = plain.columns.index(names[text_col])

    def run(batches):
        for piece in pieces(batches):
            counts, features = zip(*[statistics(t or "") for t in piece.column(at).to_pylist()])
            fine = forest.scores(np.array(features)) >= forest.threshold
            kept = [bool(f) and not base_failed(c[0], c[4]) for f, c in zip(fine, counts)]
            yield piece.filter(pa.array(kept))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
