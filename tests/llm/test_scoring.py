import math
from collections import Counter

import pytest
from fixtures import SCHEMA, TEXTS, awkward, words

from drayage.llm import packs, scoring


def brute(texts):
    docs = [words(t) for _, t in texts]
    counts = Counter(tuple(w[i : i + n]) for w in docs for n in (1, 2, 3) for i in range(len(w) - n + 1))
    total = sum(map(len, docs))
    out = []
    for (i, _), w in zip(texts, docs):
        log = 0
        for k in range(len(w)):
            factor = 1.0
            for n in range(min(3, k + 1), 0, -1):
                gram = tuple(w[k - n + 1 : k + 1])
                if n == 1:
                    score = counts[gram] / total
                elif counts[gram] >= 2:
                    score = counts[gram] / counts[gram[:-1]]
                else:
                    factor *= 0.4
                    continue
                break
            log += math.floor(math.log10(score * factor) * 1e6 + 0.5)
        out.append((str(i), len(w), log))
    return sorted(out)


TEXTS_ = [(1, "a b c d a b c"), (2, "a b c"), (2, "a b c"), (3, "d"), (4, None), (5, "z z z z"), (None, "b c q")]


@pytest.mark.parametrize("texts", [TEXTS, TEXTS_])
@pytest.mark.parametrize("slice_bytes", [packs.SLICE_BYTES, 300])
def test_against_plain_counts(spark, monkeypatch, texts, slice_bytes):
    monkeypatch.setattr(packs, "SLICE_BYTES", slice_bytes)
    rows = scoring.scores(awkward(spark, texts)).collect()
    for got, want in zip(sorted((str(r.doc_id), r.n_words, r.log_score) for r in rows), brute(texts)):
        # A rounding of the last millionth for each word.
        assert got[:2] == want[:2] and abs(got[2] - want[2]) <= 1 + want[1] // 1000
    assert all((r.mean_log is None) == (r.n_words == 0) for r in rows)


def test_no_rows(spark):
    assert scoring.scores(spark.createDataFrame([], SCHEMA)).count() == 0
