import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from fixtures import PASSAGE, SCHEMA, TEXTS, awkward, words

from drayage.llm import packs, substrings


def brute(texts, window=20):
    rows = sorted(range(len(texts)), key=lambda k: (texts[k][0] is None, texts[k][0] or 0, (texts[k][1] or "").encode()))
    seen, out = set(), []
    for k in rows:
        w = words(texts[k][1])
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            gram = tuple(w[p : p + window])
            if gram in seen:
                gone[p : p + window] = [True] * window
            seen.add(gram)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((str(texts[k][0]), len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def found(df):
    return sorted((str(r.doc_id), r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in df.collect())


LOOPS = [
    (1, "a b c d e " * 12), (2, " ".join("x" for _ in range(70))), (3, "x " * 19), (4, "x " * 20),
    (5, f"one {PASSAGE} two {PASSAGE} three"), (6, f"{PASSAGE} tail"), (7, PASSAGE.replace("shared30", "other")),
    (7, PASSAGE.replace("shared30", "other")), (8, "a b c d e " * 3 + "z " + "a b c d e " * 5),
    (9, "\n".join(PASSAGE.split())), (10, "é" + PASSAGE), (None, PASSAGE), (None, PASSAGE), (12, None),
]


@pytest.mark.parametrize("texts", [TEXTS, LOOPS])
@pytest.mark.parametrize("slice_bytes", [packs.SLICE_BYTES, 400])
def test_against_brute_force(spark, monkeypatch, texts, slice_bytes):
    monkeypatch.setattr(packs, "SLICE_BYTES", slice_bytes)
    assert found(substrings.repeated_words(awkward(spark, texts))) == brute(texts)


def test_ranges_tell_what_went(spark):
    rows = {r.doc_id: r for r in substrings.repeated_words(awkward(spark, LOOPS[5:6] + [(1, PASSAGE)])).collect()}
    import numpy as np

    assert np.frombuffer(rows[6].removed, "<i8").tolist() == [0, 60] and rows[6].kept_text == "tail"


def test_other_windows_and_no_rows(spark):
    texts = [(1, "p q r s t u v w"), (2, "o p q r s"), (3, "r s t u v w x")]
    assert found(substrings.repeated_words(awkward(spark, texts), window=4, first=2)) == brute(texts, 4)
    with pytest.raises(ValueError):
        substrings.repeated_words(awkward(spark, texts), window=10, first=4)
    assert substrings.repeated_words(spark.createDataFrame([], SCHEMA)).count() == 0


def test_windows_whose_first_hashes_are_the_same(monkeypatch):
    whole = packs.Words.windows

    def short(self, length, at, base=packs._WINDOW_BASE):
        found = whole(self, length, at, base)
        return found & np.uint64(1) if base == packs._WINDOW_BASE else found

    monkeypatch.setattr(packs.Words, "windows", short)
    once = " ".join(f"once{i}" for i in range(50))
    slices = [[(1, f"{once} {PASSAGE}"), (3, "x " * 25)], [(2, f"other {PASSAGE}"), (4, f"z {once}")], [(5, PASSAGE), (6, "x " * 20)]]
    words_ = [packs.Words(*(pa.array(c) for c in zip(*rows))) for rows in slices]
    none = pa.table([[], [], [], []], schema=pa.schema([("slice", pa.int64()), ("part", pa.int64()), ("step", pa.int32()), ("answer", pa.binary())]))
    sent = pa.concat_tables([substrings._asker([20], 1, True)(n, w, none) for n, w in enumerate(words_)])
    answers = substrings._earlier(0)(sent)
    out = []
    for n, w in enumerate(words_):
        mine = answers.filter(pc.equal(answers["slice"], n))
        for r in substrings._remover([20], 1)(n, w, mine).to_pylist():
            out.append((str(r["doc_id"]), r["n_words"], r["n_removed"], hashlib.sha256(r["kept_text"].encode()).hexdigest()))
    assert sorted(out) == brute([r for rows in slices for r in rows])
