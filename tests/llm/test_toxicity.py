import math
import zlib
from collections import Counter

import numpy as np
import pytest
from fixtures import SCHEMA, TEXTS, awkward

from drayage.llm import regression, toxicity
from drayage.llm.queries import QUERIES
from drayage.llm.regression import fit, lengthened, shortened


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_awkward_rows(spark):
    rows = toxicity.toxicity(awkward(spark), labels(spark, [(1, 1, 0), (7, 1, 1), (10, 1, 0), (12, 0, 1), (4, 1, 0), (None, 0, 1), (3, 1, None)])).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_without_labels_or_rows(spark):
    assert {r.predicted for r in toxicity.toxicity(awkward(spark), labels(spark, [])).collect()} == {0}
    assert toxicity.toxicity(spark.createDataFrame([], SCHEMA), labels(spark, [(1, 1, 1)])).count() == 0


def test_held_out_rows_of_the_query(spark):
    folder = "/root/testdata/sf0.1"
    marks = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op10_toxicity"](spark, folder).collect()
    held = [r for r in rows if r.held_out and r.doc_id in marks]
    toxic = [r.predicted for r in held if marks[r.doc_id] == 1]
    clean = [r.predicted for r in held if marks[r.doc_id] == 0]
    assert len(toxic) > 50 and sum(toxic) >= 0.9 * len(toxic) and sum(clean) <= 0.01 * len(clean)


def test_labels_of_held_out_rows_are_not_learnt(spark):
    docs = awkward(spark, [(i, f"text {'idiot fool' if i % 2 else 'kind friend'} number {i}") for i in range(60)])
    true = [(i, 1, i % 2) for i in range(60)]
    other = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in true]
    scores = [sorted((r.doc_id, r.score) for r in toxicity.toxicity(docs, labels(spark, m)).collect()) for m in (true, other)]
    assert scores[0] == scores[1]
    assert all((s > 0.5) == bool(i % 2) for i, s in scores[0])


def test_held_out_rows_of_a_small_table(spark):
    folder = "/root/testdata/sf0.01"
    marks = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [r for r in QUERIES["op10_toxicity"](spark, folder).collect() if r.held_out and r.doc_id in marks]
    toxic = [r.predicted for r in held if marks[r.doc_id] == 1]
    clean = [r.predicted for r in held if marks[r.doc_id] == 0]
    assert len(toxic) == 18 and sum(toxic) >= 12 and sum(clean) <= 0.01 * len(clean)


def test_rare_insults_count(spark):
    # Each word is in 8 of the 64 rows of its class, too few for four standard deviations.
    insults = ["blorgface", "snivelwort", "mudgrub", "twitterpate", "crudnoggin", "vexhound", "dimwattle", "gnashpot"]
    others = ["lantern", "quarry", "pebbles", "hymnbook", "saffron", "juniper", "velvet", "kitchen"]
    rows = [(i, f"a quiet row {(insults if i % 2 else others)[i // 2 % 8]}", i % 2) for i in range(128)]
    model = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string, label int"))
    assert all(model.score(f"a quiet row {w}") > 0.7 for w in insults)
    assert all(model.score(f"a quiet row {w}") < 0.3 for w in others)


def plain_grams(text):
    """Features by plain string work: the n-grams of padded words, and how often each occurs."""
    words = "".join(" " if ord(c) < 128 and not c.isalnum() else c for c in text.lower()).split(" ")
    seen = Counter(
        f" {word} "[at : at + order]
        for word in words if word
        for order in toxicity.ORDERS
        for at in range(len(word) + 3 - order)
    )
    return seen


def test_features_are_those_of_plain_string_work():
    for text in ["blorgface and twitterpate", "Na\u00efve caf\u00e9s, na\u00efve caf\u00e9s; na\u00efve", "", "a", "x" * 5000, "one\ntwo\x00three \U0001f600\U0001f600\U0001f600"]:
        found = toxicity.features(text)
        assert (lengthened(shortened(found)) == found).all()
        grams = plain_grams(text)
        # Each n-gram alone gives its own number, through a text in which it is the only one of its order.
        wanted = set()
        for gram, times in grams.items():
            number = hashed(gram)
            wanted.add(number)
            wanted |= {(number * (2 * k + 1) * 40503 + k) % (1 << toxicity.HASH_BITS) for k in toxicity.TIMES if times >= k}
        assert set(found.tolist()) == wanted


def hashed(gram):
    factor, all_ = 0x9E3779B97F4A7C15, (1 << 64) - 1
    value = ord(gram[0])
    for c in gram[1:]:
        value = (value * factor + ord(c)) & all_
    return ((value ^ value >> 29) * factor & all_) >> 64 - toxicity.HASH_BITS


def test_fit_reaches_the_least_loss():
    draw = np.random.default_rng(3)
    for n, width in ((1, 4), (40, 30), (120, 400)):
        rows = [np.flatnonzero(draw.random(width) < 0.2).astype(np.int32) for _ in range(n)]
        labels = (draw.random(n) < 0.4).astype(int)
        scales = draw.normal(size=width) * 2
        dense = np.array([np.isin(np.arange(width), r) for r in rows]) * scales
        dense = np.column_stack([dense, np.full(n, 3.0)])
        signs, penalty = 2.0 * labels - 1, 1e-2

        def loss(w):
            return np.mean(np.logaddexp(0, -signs * (dense @ w))) + penalty / 2 * w @ w

        # Newton's method on the whole matrix, with halved steps.
        best = np.zeros(width + 1)
        for _ in range(60):
            wrong = 1 / (1 + np.exp(signs * (dense @ best)))
            slope = penalty * best - dense.T @ (signs * wrong) / n
            bend = penalty * np.eye(width + 1) + dense.T @ (dense * (wrong * (1 - wrong))[:, None]) / n
            step, size = np.linalg.solve(bend, -slope), 1.0
            while loss(best + size * step) > loss(best) and size > 1e-9:
                size /= 2
            best = best + size * step
        assert np.abs(slope).max() < 1e-8
        weights, intercept = fit([shortened(r) for r in rows], labels, scales, penalty, 3.0, 1e-7)
        found = np.append(np.divide(weights, scales), intercept / 3.0)
        assert loss(best) - 1e-9 <= loss(found) <= loss(best) + 1e-6
        assert np.abs(dense @ found - dense @ best).max() < 0.02


def test_the_last_of_equal_rows_count_as_often_as_wanted(spark):
    data = [(1, "same", 1)] * 30
    model = toxicity.train(spark.createDataFrame([*data, (2, "other", 0)], "doc_id long, text string, label int"), 31)
    few = toxicity.train(spark.createDataFrame([*data[:3], (2, "other", 0)], "doc_id long, text string, label int"), 4)
    assert model.score("same") > 0.5 > model.score("other") and few.score("same") > 0.5 > few.score("other")


def test_counts_and_ratios_of_all_rows():
    other, toxic = np.array([0, 5, 40, 0]), np.array([0, 5, 0, 3])
    scales = toxicity._scales(other, toxic, {0: 90, 1: 30})
    for k in range(4):
        ratio = math.log((toxic[k] + 1) / 32) - math.log((other[k] + 1) / 92)
        surely = ratio**2 / (1 / (toxic[k] + 1) + 1 / (other[k] + 1)) / toxicity.APART**2
        assert math.isclose(scales[k], ratio * surely if k else 0.0)


def counted(times):
    """Rows whose features lean to either class, and their scales if each row occurred ``times``."""
    draw, width = np.random.default_rng(5), 3000
    marks = (np.arange(400) % 4 == 0).astype(int)
    shares = np.arange(1, width + 1) ** -0.7 * np.exp(np.outer(2 * marks - 1, 0.4 * draw.normal(size=width)))
    rows = [np.flatnonzero(draw.random(width) < p).astype(np.int32) for p in np.clip(shares, 0, 0.95)]
    rows[7] = rows[7][:0]
    sums = [times * sum(np.bincount(r, minlength=width) for r, m in zip(rows, marks) if m == k) for k in (0, 1)]
    return rows, marks, toxicity._scales(*sums, {0: 300 * times, 1: 100 * times})


def judged(rows, marks, scales, weights, intercept, penalty):
    """The loss of a fit, and how much above the least one it is at most by its slope."""
    used = np.flatnonzero(scales)
    dense = np.array([np.isin(used, r) for r in rows]) * scales[used]
    dense, at = np.column_stack([dense, np.full(len(rows), 10.0)]), np.append(weights[used] / scales[used], intercept / 10.0)
    margins = (2.0 * marks - 1) * (dense @ at)
    slope = penalty * at - dense.T @ ((2.0 * marks - 1) * np.exp(-np.logaddexp(0, margins))) / len(rows)
    return np.logaddexp(0, -margins).mean() + penalty / 2 * at @ at, slope @ slope / (2 * penalty)


def test_fit_of_few_passes_whatever_the_counts(monkeypatch):
    passes, joined = [], regression._joined
    monkeypatch.setattr(regression, "_joined", lambda rows: passes.append(len(rows)) or joined(rows))
    for times in (1, 30, 1000):
        rows, marks, scales = counted(times)
        passes.clear()
        weights, intercept = fit([shortened(r) for r in rows], marks, scales, 1e-4, 10.0, 5e-4)
        assert len(passes) <= 10
        assert judged(rows, marks, scales, weights, intercept, 1e-4)[1] <= 5e-4


def test_fit_by_chosen_rows_and_by_all():
    for times, noise in ((1, 0.0), (1, 0.1), (30, 0.0), (30, 0.1)):
        rows, marks, scales = counted(times)
        marks = np.where(np.random.default_rng(2).random(len(marks)) < noise, 1 - marks, marks)
        losses = {}
        # All rows at once; more and more of them; too many for their products.
        for first, most, gap in ((400, 400, 1e-9), (16, 400, 5e-4), (16, 399, 5e-4), (16, 40, 5e-4), (16, 15, 5e-4)):
            with pytest.MonkeyPatch.context() as patch:
                patch.setattr(regression, "FIRST_ROWS", first)
                patch.setattr(regression, "CHOSEN_ROWS", most)
                found = fit([shortened(r) for r in rows], marks, scales, 1e-4, 10.0, gap)
            losses[first, most] = judged(rows, marks, scales, *found, 1e-4)[0]
        least = losses.pop((400, 400))
        assert all(least - 1e-9 <= loss <= least + 5e-4 for loss in losses.values()), losses


def test_products_are_those_of_whole_rows():
    draw = np.random.default_rng(4)
    dense = draw.random((60, 500)) < draw.random(500) ** 4
    dense[9] = False
    scales, signs = draw.normal(size=500), np.where(draw.random(60) < 0.5, 1.0, -1.0)
    rows = [np.flatnonzero(r) for r in dense]
    wanted = ((dense * scales) @ (dense * scales).T + 4.0) * signs[:, None] * signs
    for old in (0, 1, 25):
        found = regression._products(wanted[:old, :old], np.concatenate(rows), np.array([len(r) for r in rows]), signs, scales, 2.0)
        assert np.allclose(found, wanted, 1e-12)
