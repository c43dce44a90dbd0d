import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from fixtures import SCHEMA, TEXTS, awkward
from tokenizers import Tokenizer

from drayage.llm import cached, packing
from drayage.llm.cached import UNIT, byte_encoder
from drayage.llm.queries import QUERIES

FILE = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  two  blanks ", "\n\n\n", "tab\t\nfeed \n x", "a  b　\nc", "x\x1c y\x1f\n z", "it's we'll 'S  12 345",
    "<|endoftext|> as text", "▁ lower ▁block", "é ñ 日本 \U0001f600 \n", "\r\n a \r b", "\x00 null \x00", "no-blank" * 300, "   ",
]


def encode(texts):
    tokenizer = Tokenizer.from_file(FILE)
    tokenizer.encode_special_tokens = True
    return [[*e.ids, packing.END] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check(rows, docs):
    """``rows`` hold every piece of ``docs`` (id, text), and the sequences have neither gaps nor overlaps."""
    wanted = sorted(
        (i if i is not None else -1, k, start, n, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[start : start + n])))
        for (i, _), ids in zip(docs, encode([t for _, t in docs]))
        for k, (start, n) in enumerate(packing.cuts(len(ids), packing.CAPACITY))
    )
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    inside = defaultdict(list)
    for r in rows:
        inside[r.sequence_id].append((r.offset, r.length))
    for spans in inside.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    return len(inside)


def test_cuts():
    assert packing.cuts(1, 4) == [(0, 1)] and packing.cuts(4, 4) == [(0, 4)]
    assert packing.cuts(9, 4) == [(0, 1), (1, 4), (5, 4)] and packing.cuts(8, 4) == [(0, 4), (4, 4)]


def test_best_fit_with_bounded_space():
    rng = random.Random(5)
    for most in (1, 3, 20):
        bins, plain, closed = packing.OpenBins(32, most), {}, set()
        for _ in range(500):
            n = rng.randint(1, 32)
            chosen, offset = bins.place(n)
            assert chosen not in closed
            fits = [room for room in plain.values() if room >= n]
            if fits:
                assert plain[chosen] == min(fits)
            else:
                assert offset == 0 and chosen not in plain
                if len(plain) == most:
                    # The fullest has closed; with ties, any of them.
                    least = min(plain.values())
                    gone = next(b for b, room in plain.items() if room == least and b not in sum(bins.bins, []))
                    closed.add(gone)
                    del plain[gone]
                plain[chosen] = 32
            assert offset == 32 - plain[chosen]
            plain[chosen] -= n
            if not plain[chosen]:
                closed.add(chosen)
                del plain[chosen]
            assert bins.open == len(plain) <= most


def test_units_encoded_together_keep_their_tokens():
    rng = random.Random(2)
    some = [" ", " ", "\n", "\t", ".", ",", "'", "s", "é", "a", "1", "²", "\xa0", "\u3000", "ªº", "日", "\r", "x", "ll", "\x1c"]
    texts = [*ODD, *("".join(rng.choice(some) for _ in range(rng.randint(0, 30))) for _ in range(20_000))]
    parts = [UNIT.findall(t) for t in texts]
    assert all("".join(p) == t for p, t in zip(parts, texts))
    ids_of = byte_encoder(FILE).of(parts)
    for units, ids in zip(parts, encode(texts)):
        assert b"".join(ids_of[u] for u in units) == b"".join(i.to_bytes(4, "little") for i in ids[:-1])


def test_values_make_each_unit_once():
    texts = ["a word, a word and '{}", "", "x\ny  z", "word"]
    for most, made in ((1 << 20, 1), (0, 3)):
        known, given = byte_encoder(FILE, most), []
        make = known.make
        known.make = lambda units: given.extend(units) or make(units)
        for _ in range(3):
            parts = [UNIT.findall(t) for t in texts]
            for values, ids in zip(known.values(parts), encode(texts)):
                assert b"".join(values) == b"".join(i.to_bytes(4, "little") for i in ids[:-1])
        assert len(given) <= made * len(set().union(*parts)) and len(set(given)) == len(set().union(*parts))


def test_units_joined_without_line_feeds(monkeypatch):
    """Each unit that begins with a blank costs the tokenizer its own tokens only."""
    units = [" word", " a", " 12", " '{}", " é日\U0001f600", " ▁", " <|endoftext|>", "b", "\n", "  ", " x\ty"]
    sent, made = [], cached.byte_tokenizer

    class Sent:
        def __init__(self, path):
            self.of = made(path)

        def __getattr__(self, name):
            return getattr(self.of, name)

        def encode_batch_fast(self, texts, **options):
            sent.extend(texts)
            return self.of.encode_batch_fast(texts, **options)

    monkeypatch.setattr(cached, "byte_tokenizer", Sent)
    found = byte_encoder(FILE).make(units)
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [ids[:-1] for ids in encode(units)]
    assert "".join(units[:7]) in sent


def test_awkward_rows(spark):
    texts = [*TEXTS, *enumerate(ODD, 100)]
    for keep in (False, True):
        placed = packing.packed_documents(awkward(spark, texts), FILE, keep_ids=keep)
        if keep:
            whole = {r.sequence_id: r for r in packing.sequences(placed).collect()}
            rows = placed.selectExpr("*", "crc32(ids) AS ids_crc32").collect()
            for r in rows:
                assert bytes(whole[r.sequence_id].ids[4 * r.offset : 4 * (r.offset + r.length)]) == bytes(r.ids)
            assert sum(len(w.ids) for w in whole.values()) == 4 * sum(r.length for r in rows)
        else:
            rows = placed.collect()
        check(rows, texts)


def test_no_rows(spark):
    assert packing.packed_documents(spark.createDataFrame([], SCHEMA), FILE).count() == 0


def test_other_columns_and_many_tasks(spark):
    items = spark.range(3000).selectExpr("id % 7 + 1 AS size", "CAST(NULL AS STRING) AS room", "id AS offset", "'x' AS bins")
    placed = packing.packed(items, "size", capacity=10, open_bins=64, window=64, per_task=500)
    rows = placed.collect()
    assert placed.columns == ["size", "room", "bins", "sequence_id", "offset"] and len(rows) == 3000
    filled = defaultdict(int)
    for r in rows:
        filled[r.sequence_id] += r["size"]
    assert max(filled.values()) <= 10 and len(filled) <= 1.1 * sum(filled.values()) / 10
    again = packing.packed(items, "size", capacity=10, open_bins=64, window=64, per_task=500).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_few_sequences(spark):
    folder = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    rows = QUERIES["op12_packing"](spark, folder).collect()
    assert check(rows, docs) <= 1.015 * -(-sum(r.length for r in rows) // packing.CAPACITY)
