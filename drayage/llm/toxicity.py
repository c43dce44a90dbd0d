"""Toxicity by a linear classifier on character n-grams, scaled by naive Bayes log-count ratios.

A text's features are the hashes of the n-grams of lower-cased characters within its words,
present or not.
Over all labelled training texts Spark counts in how many toxic and other texts each feature
occurs. From these counts comes the log-count ratio of every feature that occurs, times the square
of the standard errors by which it differs from none, so that the penalty of the regression weighs
more on what the counts tell less surely; no feature is left out. A logistic
regression on the features so scaled is fitted on ``FIT_ROWS`` training rows at most, drawn by a
hash of the id, in one task, which keeps two bytes for each feature of these rows and the products
of the few that tell the least loss. The scores read whole texts and nothing else; the model is a table of fixed size.

A null text counts as empty; texts without features of the training texts get the score of the
intercept.
Rows repeated are scored row by row; a null id belongs to the training part but has no label.
Without training rows of both classes every score is the share of toxic rows among them, zero
without any. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drayage.llm.frames import numbered, pieces, stored
from drayage.llm.packs import from_planes, planes
from drayage.llm.regression import fit, shortened

ORDERS = (4, 5, 6, 8)
HASH_BITS = 20
TIMES = (2, 3)
BLOCK = 1 << 14
#: Standard errors between a log-count ratio and none at which it is taken as it is.
APART = 4.0
FIT_ROWS = 20_000
SMOOTHING = 1.0
PENALTY = 1e-4
#: The fit ends when its loss is this near the least one.
GAP = 5e-4
#: Length of the intercept's feature: the longer, the less the penalty holds it.
BIAS = 10.0
THRESHOLD = 0.7

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_APART = np.array([c < 128 and not chr(c).isalnum() for c in range(129)])


def features(text: str) -> np.ndarray:
    """The different features of a text: its hashed n-grams within words, and those that occur
    ``TIMES`` or more, each number being a feature of its own. Whatever is neither a letter nor a
    digit of ASCII nor beyond it parts words; one such place before or behind a word may be part
    of an n-gram, as a space."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    apart = _APART[np.minimum(codes, 128)]
    codes = np.where(apart, np.uint32(32), codes).astype(np.uint64)
    upto = np.cumsum(apart)
    found = []
    gram = codes
    for order in range(2, max(ORDERS) + 1):
        if len(codes) < order:
            break
        gram = gram[:-1] * _FACTOR + codes[order - 1 :]
        if order in ORDERS:
            # No space from the second to the last but one character.
            whole = gram[upto[order - 2 : len(upto) - 1] == upto[: len(upto) - order + 1]]
            mixed = (whole ^ (whole >> np.uint64(29))) * _FACTOR
            found.append((mixed >> np.uint64(64 - HASH_BITS)).astype(np.int32))
    grams, counts = np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.int32), np.empty(0))
    often = [(grams[counts >= k] * np.int64(2 * k + 1) * 40503 + k) % (1 << HASH_BITS) for k in TIMES]
    # Sorted by ourselves, as the hashing of numpy's unique without counts takes many times longer.
    marked = np.sort(np.concatenate([grams, *often]).astype(np.int32))
    return marked[np.diff(marked, prepend=np.int32(-1)) != 0]


@dataclass
class Model:
    """Weights of all hashes, zero for those in no training text, and the intercept."""

    weights: np.ndarray
    intercept: float

    def score(self, text: str) -> float:
        found = features(text)
        return float(1 / (1 + np.exp(-np.clip(self.intercept + self.weights[found].sum(), -500, 500))))


def held_out(id_col: str):
    """The third of the ids whose labels are not learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(texts: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """A model from ``texts(doc_id, text, label)``."""
    texts = stored(texts, "labelled")
    totals = {int(r["label"]): r["n"] for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    weights = np.zeros(1 << HASH_BITS, np.float64)
    if set(totals) != {0, 1}:
        share = totals.get(1, 0) / max(1, sum(totals.values()))
        return Model(weights, float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))

    def count(batches):
        seen = np.zeros((2, 1 << HASH_BITS), np.int32)
        for piece in pieces(batches):
            for text, label in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                seen[label, features(text)] += 1
        blocks = range(0, seen.shape[1], BLOCK)
        packed = [[planes(row[at : at + BLOCK]) for at in blocks] for row in seen]
        yield pa.RecordBatch.from_arrays(
            [pa.array(blocks, pa.int64()), *[pa.array(p, pa.binary()) for p in packed]], ["block", "other", "toxic"]
        )

    def add(table):
        sums = [sum(from_planes(p, np.int32).astype(np.int64) for p in table[c].to_pylist()) for c in ("other", "toxic")]
        return pa.table([table["block"][:1], *[pa.array([planes(x)], pa.binary()) for x in sums]], ["block", "other", "toxic"])

    # Each task sends its counts as arrays, one for each block of features, and so do the sums.
    counts = texts.select("text", "label").mapInArrow(count, "block long, other binary, toxic binary")
    counts = counts.groupBy("block").applyInArrow(add, "block long, other binary, toxic binary").collect()
    other, toxic = np.zeros((2, 1 << HASH_BITS), np.int64)
    for r in counts:
        other[r["block"] : r["block"] + BLOCK] = from_planes(r["other"], np.int64)
        toxic[r["block"] : r["block"] + BLOCK] = from_planes(r["toxic"], np.int64)
    scales = _scales(other, toxic, totals)

    del counts, other, toxic

    def found(batches):
        for piece in pieces(batches):
            rows = [shortened(features(text)) for text in piece.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*piece.columns[:2], pa.array(rows, pa.binary()), *piece.columns[3:]], ["a", "b", "found", "label", "weight"]
            )

    # A few more rows than wanted by a hash, of which the first in its order are taken.
    hashed = texts.select(
        F.xxhash64(F.col("doc_id").cast("string")).alias("a"), F.xxhash64("text").alias("b"), "text", "label", F.lit(1).alias("weight")
    )
    share = min(1.0, 1.2 * fit_rows / sum(totals.values()))
    near = hashed.filter(F.pmod(F.xxhash64("a"), F.lit(1_000_000)) < int(share * 1_000_000) + 1)
    keys = near.select("a", "b", "label").orderBy("a", "b", "label").limit(fit_rows).collect()
    if len(keys) == fit_rows:
        # Up to the last key wanted; only the keys are sorted, not what was found. Of rows equal in
        # the last key one is taken, and counts for as many as are wanted.
        of = F.struct("a", "b", "label")
        last = F.struct(*[F.lit(keys[-1][c]).cast(t).alias(c) for c, t in (("a", "long"), ("b", "long"), ("label", "int"))])
        near = near.filter(of < last).unionByName(near.filter(of == last).limit(1).withColumn("weight", F.lit(keys.count(keys[-1]))))
    chosen = stored(near.mapInArrow(found, "a long, b long, found binary, label int, weight int"), "fit-rows")

    def fitted(batches):
        rows = [tuple(r.values()) for batch in batches for r in batch.to_pylist() for _ in range(r["weight"])]
        rows.sort(key=lambda r: r[:2] + r[3:])
        marks = np.array([r[3] for r in rows])
        rows = [r[2] for r in rows]
        weights, intercept = fit(rows, marks, scales, PENALTY, BIAS, GAP)
        yield pa.RecordBatch.from_pydict({"weights": [weights.tobytes()], "intercept": [intercept]})

    # So many rows fit one task, which spares the driver their memory.
    one = chosen.coalesce(1).mapInArrow(fitted, "weights binary, intercept double").first()
    return Model(np.frombuffer(one["weights"]), one["intercept"])


def _scales(other: np.ndarray, toxic: np.ndarray, totals: dict[int, int]) -> np.ndarray:
    """The log-count ratio of each feature that occurs, by how surely it differs from none."""
    toxic, other = toxic + SMOOTHING, other + SMOOTHING
    ratio = np.log(toxic / (totals[1] + 2 * SMOOTHING)) - np.log(other / (totals[0] + 2 * SMOOTHING))
    errors = ratio**2 / (1 / toxic + 1 / other)
    return np.where(toxic + other > 2 * SMOOTHING, ratio * errors / APART**2, 0.0)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``score`` and ``predicted``."""
    docs, names = numbered(docs)
    texts = docs.select(F.col(names[id_col]).alias("doc_id"), F.col(names[text_col]).cast("string").alias("text"))

    def run(batches):
        for piece in pieces(batches):
            scores = np.array([model.score(t or "") for t in piece.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(scores, pa.float64()), pa.array((scores >= THRESHOLD).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    schema = T.StructType([texts.schema["doc_id"]]).add("score", "double").add("predicted", "integer")
    return texts.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Trains on the labelled rows that are not held out and scores every row of ``docs``:
    ``doc_id``, ``held_out``, ``score`` and ``predicted``."""
    plain, names = numbered(docs)
    learnt = plain.select(F.col(names[id_col]).alias("doc_id"), F.coalesce(F.col(names[text_col]).cast("string"), F.lit("")).alias("text"))
    marks = labels.select(F.col(id_col).alias("of"), (F.col(label_col) == 1).cast("int").alias("label"))
    marks = marks.filter(F.col("label").isNotNull() & ~held_out("of"))
    # Sorted on both sides, as neither has a bound.
    model = train(learnt.filter(~held_out("doc_id")).join(marks.hint("merge"), F.col("doc_id") == F.col("of")).drop("of"))
    return scored(docs, model, id_col, text_col).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
