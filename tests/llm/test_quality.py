import re
from collections import Counter

import numpy as np
import pytest
from fixtures import SCHEMA, TEXTS, awkward, words
from pyspark.sql import functions as F

from drayage.llm import quality
from drayage.llm.queries import QUERIES


def plain(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(5)}
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(covered),
    )


@pytest.mark.parametrize("text", [t for _, t in TEXTS] + ["a b c d e a b c d e f", "x\nx\n \nx y\n\n", "é é é é é é é", "a b c d e f g a b c d e h"])
def test_counts(text):
    if text is None or len(text) < 10_000:
        assert tuple(quality.statistics(text or "")[0]) == plain(text)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_awkward_rows(spark):
    marks = labels(spark, [(1, 1, 0), (7, 1, 0), (9, 1, 0), (12, 0, 0), (99, 0, 0), (None, 1, 1), (3, None, 0), (1, 1, 0)])
    rows = quality.verdicts(awkward(spark), marks).collect()
    assert len(rows) == len(TEXTS)
    assert all(not (r.kept and r.base_failed) for r in rows)
    assert all(r.base_failed for r in rows if r.n_words < 10)
    docs = awkward(spark)
    good = quality.good_documents(docs, marks)
    assert good.columns == docs.columns and good.count() == sum(r.kept for r in rows)


def test_base_rules_alone_without_labels(spark):
    rows = quality.verdicts(awkward(spark), labels(spark, [])).collect()
    assert all(r.kept != r.base_failed for r in rows)
    assert quality.verdicts(spark.createDataFrame([], SCHEMA), labels(spark, [])).count() == 0


def test_query_against_brute_force_and_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op2_quality"](spark, folder).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain(docs[r.doc_id])
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
    judged = [r for r in rows if r.doc_id in marks and not r.base_failed]
    good = [r.kept for r in judged if marks[r.doc_id] == 1]
    bad = [r.kept for r in judged if marks[r.doc_id] == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.05 * len(bad)


def test_first_rows_by_hash_are_the_same_behind_a_threshold(spark):
    rows = spark.range(3000).select(F.xxhash64("id").alias("drawn"), (F.col("id") % 7).alias("label"))
    plain = sorted(tuple(r) for r in rows.collect())
    for most in (1, 40, 2600, 3000, 5000):
        assert [tuple(r) for r in quality.first_drawn(rows, most)] == plain[:most]
    # Rows of one id share one hash, far from the first share of all.
    same = spark.range(500).select(F.lit(5).cast("long").alias("drawn"), F.col("id").alias("label"))
    assert [r.label for r in quality.first_drawn(same, 20)] == list(range(20))
    assert quality.first_drawn(same.limit(0), 20) == []


def test_threshold_comes_from_all_labelled_rows(spark, monkeypatch):
    """Trees see few rows; the threshold lies where the rows of both labels have it."""
    monkeypatch.setattr(quality, "LABELLED_ROWS", 50, raising=False)
    monkeypatch.setattr(quality, "TREE_ROWS", 1)
    rng = np.random.default_rng(3)
    rows = [(i, rng.random(len(quality.FEATURES)) ** (3 if i % 5 else 1), int(i % 5 > 0)) for i in range(4000)]
    found = spark.createDataFrame([(i, f.tolist(), False) for i, f, _ in rows], "doc_id long, features array<double>, base_failed boolean")
    marks = spark.createDataFrame([(i, label) for i, _, label in rows], "doc_id long, quality int")
    forest = quality.fit(found, marks)
    good, bad = (forest.scores(np.array([f for _, f, label in rows if label == of])) for of in (1, 0))
    least = np.sort(good)[int((1 - quality.KEEP_GOOD) * len(good))]
    assert forest.threshold == pytest.approx((least + bad[bad < least].max()) / 2)


def test_other_names_of_the_id(spark):
    docs = awkward(spark).withColumnRenamed("doc_id", "number")
    marks = spark.createDataFrame([(1, 1), (7, 0), (None, 1)], "number long, quality int")
    assert quality.verdicts(docs, marks, id_col="number").count() == docs.count()
    assert set(quality.good_documents(docs, marks, id_col="number").columns) == set(docs.columns)
