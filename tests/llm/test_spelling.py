import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from fixtures import SCHEMA, TEXTS, awkward

from drayage.llm import spelling


def near(a, b):
    """Whether one inserted, deleted or replaced character tells the two apart."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def some_words(seed, alphabet, n):
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        word = "".join(rng.choice(alphabet) for _ in range(rng.randint(7, 10)))
        at = rng.randrange(len(word))
        out |= {word, word[:at] + rng.choice(alphabet) + word[at + 1 :], word[:at] + rng.choice(alphabet) + word[at:]}
    return sorted(out)


@pytest.mark.parametrize("grams", [spelling.BROADCAST_GRAMS, 0])
def test_all_near_pairs_are_found(spark, monkeypatch, grams):
    monkeypatch.setattr(spelling, "BROADCAST_GRAMS", grams)
    # Of few letters, so that grams repeat within words, tie in frequency, and words have many neighbours.
    for seed, alphabet in enumerate(("ab", "abc", "aé日\U0001f600z", "abcdefghijklmnop")):
        words = [w for w in some_words(seed, alphabet, 250)]
        table = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")
        rows = spelling.near_pairs(table).collect()
        number = {w: i for i, w in enumerate(words)}
        assert all(number[r.word] == r.n and number[r.other] == r.other_n for r in rows)
        wanted = sorted((a, b) for a, b in itertools.permutations(words, 2) if near(a, b))
        assert sorted((r.word, r.other) for r in rows) == wanted and wanted


def test_pivots_are_the_rarest_disjoint_grams_of_the_prefix():
    rng = random.Random(1)
    for _ in range(300):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(4, 12)))
        grams = [word[i : i + 2] for i in range(len(word) - 1)]
        held = {g: rng.randint(1, 6) for g in grams}
        prefix, pivots = spelling.prefix_and_pivots(grams, [held[g] for g in grams])
        order = sorted((held[g], g) for g in grams)
        assert prefix == [i for i, g in enumerate(grams) if (held[g], g) <= order[2]]
        sums = {
            (i, j): held[grams[i]] + held[grams[j]] for i, j in itertools.combinations(prefix, 2) if j - i >= 2
        }
        assert sums[tuple(pivots)] == min(sums.values())


def test_forms_lead_to_their_roots(spark):
    # Each word is ten times as frequent as the one before.
    texts = [(i, t) for i, t in enumerate(["colourings " * 2, "colouring " * 20, "colorings colouring"])]
    texts += [(10 + i, "colorins " * 200) for i in range(3)] + [(20, "Colouring étéétéé étéétéé <x> unrelatedword unrelatedword")]
    rows = {r.word: r for r in spelling.variants(awkward(spark, texts)).collect()}
    assert rows["unrelatedword"].form is None and rows["unrelatedword"].root == "unrelatedword"
    assert rows["unrelatedword"].n_near == 0 and rows["unrelatedword"].form_n is None
    for r in rows.values():
        others = [rows[w] for w in rows if near(w, r.word)]
        best = min(others, key=lambda o: (-o.n, o.word), default=None)
        ok = best is not None and best.n >= 10 * r.n
        assert (r.n_near, r.form, r.form_n) == (len(others), best.word if ok else None, best.n if ok else None)
        root = r.word
        while rows[root].form:
            root = rows[root].form
        assert r.root == root


def test_roots_of_long_chains(spark):
    rows = [(f"w{i}", f"w{i + 1}", 10 ** (i + 1)) for i in range(15)] + [(f"v{i}", "w0", 1) for i in range(50)]
    found = {r.word: r.root for r in spelling.roots(spark.createDataFrame(rows, "word string, form string, form_n long")).collect()}
    assert found == {r[0]: "w15" for r in rows}


def counts_of(texts):
    """The words and their counts by plain code."""
    lower = str.maketrans(spelling.UPPER, spelling.UPPER.lower())
    found = Counter()
    for i, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += len(run) >= 7
    return {w: n for w, n in found.items() if n >= 2}


def test_awkward_and_empty_tables(spark):
    rng = random.Random(3)
    texts = [*TEXTS, *((i % 40 or None, f"{rng.choice(['Wörterbuch', 'DICTIONARY', 'dictionary', 'naïvetés'])}{i % 9 * 'x'}") for i in range(400))]
    rows = spelling.variants(awkward(spark, texts)).collect()
    assert {r.word: r.n for r in rows} == counts_of(texts)
    assert spelling.variants(spark.createDataFrame([], SCHEMA)).count() == 0
    assert spelling.variants(awkward(spark, [(1, None), (None, ""), (2, "short words only")])).count() == 0
