"""Spelling variants: words one edit apart, found by pivotal grams, and the forms they stand for.

Every word keeps, of its bigrams in the order of how many words hold them, the first three and
whatever is as rare as the third: its prefix. Of these, two that do not overlap are its pivots,
chosen by dynamic programming so that the fewest words hold them. One edit spoils one of two
disjoint grams at most. So of two near words, the one whose prefix ends at the rarer gram has a
pivot that the other word's prefix holds too, moved by one place at most; both ask.

Pivots and prefixes meet in a join. A single edit leaves one side of an untouched gram as it is, and
of the other side one half. So the key holds the gram with one side, up to the word's end, the half
that is spared, and the partner's length, which differs by one at most. That bounds the gram's
position and splits a common gram into many keys, few of which are shared by words that are not
near. Candidates are compared in full by their Levenshtein distance.

A null text has no words; a null id counts as an empty one in the hash that spoils words. Rows
repeated count again. An empty table, or one without words, gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drayage.llm.frames import numbered
from drayage.llm.frames import pieces as slices
from drayage.llm.frames import stored

#: Code points of a word and occurrences of it, at least.
LEAST_LENGTH = 7
LEAST_COUNT = 2
#: One run in so many loses a code point, so that there are misspellings to find.
SPOILT = 31
#: A form is this many times as frequent as what it stands for.
RATIO = 10
EDITS = 1
GRAM = 2
#: Most rows of the table of grams that is sent to all executors, a few MB; a larger one is joined by gram.
BROADCAST_GRAMS = 65_536

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def counted_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word`` and ``n``: the words of all documents, some of them spoilt by a hash of document and run."""
    docs, names = numbered(docs)
    # A run shorter than a word can't become one.
    runs = F.regexp_extract_all(F.col(names[text_col]).cast("string"), F.lit(rf"[A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}}"), 0)
    said = docs.select(F.coalesce(F.col(names[id_col]).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    said = said.select("id", F.translate("run", UPPER, UPPER.lower()).alias("run"))
    said = said.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.pmod("h", F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = said.select(F.when(F.col("h") % SPOILT == 0, cut).otherwise(F.col("run")).alias("word"))
    counts = words.filter(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= LEAST_COUNT)


def prefix_and_pivots(grams: list[str], held: list[int], edits: int = EDITS) -> tuple[list[int], list[int]]:
    """Places of a word's prefix grams, and of its pivots among them.

    ``held`` is how many words hold each gram. The pivots are ``edits + 1`` disjoint grams of the
    prefix that are held least, in sum.
    """
    wanted = GRAM * edits + 1
    rank = [(h, g) for h, g in zip(held, grams)]
    last = sorted(rank)[wanted - 1]
    prefix = [i for i, r in enumerate(rank) if r <= last]
    # best[k]: the least sum of k disjoint grams among those seen so far, with their places.
    rows: list[list[tuple[int, tuple[int, ...]] | None]] = [[(0, ())] + [None] * (edits + 1)]
    for n, place in enumerate(prefix):
        before = max(k for k in range(n + 1) if k == 0 or prefix[k - 1] <= place - GRAM)
        row = list(rows[-1])
        for k in range(1, edits + 2):
            without = rows[before][k - 1]
            if without is not None:
                sum_ = without[0] + held[place]
                if row[k] is None or sum_ < row[k][0]:
                    row[k] = (sum_, (*without[1], place))
        rows.append(row)
    return prefix, list(rows[-1][edits + 1][1])


def near_pairs(words: DataFrame) -> DataFrame:
    """``word``, ``n``, ``other`` and ``other_n`` for each pair of near words, once in each order.

    ``words(word, n)`` are different words of at least four code points; the table is read several times.
    """
    spots = F.sequence(F.lit(1), F.length("word") - 1)
    grams = F.transform(spots, lambda i: F.substring("word", i, F.lit(GRAM)))
    held = words.select(F.explode(F.array_distinct(grams)).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("held"))

    # Two letters of an alphabet: nearly always few, and sent to all tasks only then. Otherwise a
    # word's grams are joined with their counts and come together again by the word.
    held = stored(held, "grams")
    known = None
    if held.count() <= BROADCAST_GRAMS:
        known = words.sparkSession.sparkContext.broadcast({r["gram"]: r["held"] for r in held.collect()})
        found = words.select("word", "n", grams.alias("grams"), F.lit(None).cast("array<bigint>").alias("held"))
    else:
        found = words.select("word", "n", F.posexplode(grams).alias("place", "gram")).join(held, "gram")
        found = found.groupBy("word", "n").agg(F.sort_array(F.collect_list(F.struct("place", "gram", "held"))).alias("grams"))
        found = found.select("word", "n", F.col("grams.gram").alias("grams"), F.col("grams.held").alias("held"))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            prefixes, pivots = [], []
            for grams_, held_ in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                prefix, pivot = prefix_and_pivots(grams_, held_ or [known.value[g] for g in grams_])
                prefixes.append(prefix)
                pivots.append(pivot)
            places = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prefixes, places), pa.array(pivots, places)], ["word", "n", "prefix", "pivots"]
            )

    schema = T.StructType([words.schema["word"], words.schema["n"]])
    for name in ("prefix", "pivots"):
        schema = schema.add(name, T.ArrayType(T.IntegerType()))
    chosen = stored(found.mapInArrow(choose, schema), "pivots")

    length = F.length("word")

    def keyed(places: str, partners):
        """A row for each gram at ``places``, each length of a partner and each part that the edit spares."""
        at = chosen.select("word", "n", F.explode(places).alias("place")).select("*", F.explode(partners).alias("partner"))
        place, partner = F.col("place"), F.col("partner")
        keys = []
        # The edit is behind the gram: what is before it stays, and so does one half of what follows.
        rest = partner - place - GRAM
        half = F.shiftright(rest, 1)
        same = F.substring("word", F.lit(1), place + GRAM)
        keys.append((same, F.substring("word", place + GRAM + 1, half)))
        keys.append((same, F.substring("word", length - (rest - half) + 1, rest - half)))
        # The edit is before the gram, which the partner then has at another place.
        rest = place + partner - length
        half = F.shiftright(rest, 1)
        same = F.substring("word", place + 1, length)
        keys.append((same, F.substring("word", F.lit(1), half)))
        keys.append((same, F.substring("word", F.greatest(place - (rest - half), F.lit(0)) + 1, rest - half)))
        hashes = [F.xxhash64(F.lit(k), partner, *key) for k, key in enumerate(keys)]
        return at.select("word", "n", F.explode(F.array(*hashes)).alias("key"))

    pivots = keyed("pivots", F.array(length - 1, length, length + 1))
    others = keyed("prefix", F.array(length)).select("key", F.col("word").alias("other"), F.col("n").alias("other_n"))
    candidates = pivots.join(others, "key").filter(
        (F.col("word") != F.col("other")) & (F.levenshtein("word", "other", EDITS) == EDITS)
    )
    first = F.col("word") < F.col("other")
    one = F.struct(F.col("word").alias("word"), F.col("n").alias("n"))
    two = F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"))
    pairs = candidates.select(F.when(first, one).otherwise(two).alias("a"), F.when(first, two).otherwise(one).alias("b")).distinct()
    both = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p")
    return pairs.select(both).select(
        F.col("p.a.word").alias("word"), F.col("p.a.n").alias("n"), F.col("p.b.word").alias("other"), F.col("p.b.n").alias("other_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` for each word of ``forms(word, form, form_n)``: its form's form and so on to the last."""
    # Each form is RATIO times as frequent as the one before, which bounds the steps; each round doubles those taken.
    most = forms.agg(F.max("form_n")).first()[0] or 0
    steps = max(1, math.ceil(math.log(max(most, 1), RATIO)) + 1)
    up = forms.select("word", F.col("form").alias("root"))
    for _ in range(max(1, math.ceil(math.log2(steps)))):
        up = stored(up, "roots")
        further = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        up = up.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return up


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: ``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n``."""
    words = stored(counted_words(docs, id_col, text_col), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other")))
    near = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    judged = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "best.other", (-F.col("best.less")).alias("other_n"))
    form = F.col("other_n") >= RATIO * F.col("n")
    judged = stored(judged.select("word", "n", "n_near", F.when(form, F.col("other")).alias("form"), F.when(form, F.col("other_n")).alias("form_n")), "near")
    up = roots(judged.filter("form IS NOT NULL"))
    return judged.join(up, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.col("n_near").cast("long").alias("n_near"), "form_n"
    )
