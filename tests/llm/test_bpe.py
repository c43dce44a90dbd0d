import hashlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from fixtures import SCHEMA, TEXTS, awkward
from hypothesis import given, settings
from hypothesis import strategies as st

from drayage.llm import bpe
from drayage.llm.queries import QUERIES

FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
with open(FILE, "rb") as lines:
    RANKS = bpe.read_ranks(lines)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
DECODER = bpe.Decoder(ENCODER.transducer.vocabulary.bytes_of)


def check(text):
    ids = ENCODER.ids(text)
    assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode_ordinary(text)
    assert "".join(DECODER.stream(ids, 2)) == text


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    check(text)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(sorted(RANKS)), max_size=8))
def test_tokens_in_a_row(tokens):
    check(b"".join(tokens).decode("utf-8", "ignore"))


@pytest.mark.parametrize("text", ["a" * 5000, "=" * 301, " " * 70 + "x", "don't  'll'", "x \n y\n\n z ", " a  b ", "\U0001f600" * 9])
def test_chosen_texts(text):
    check(text)


def test_memory_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_WORDS", 5)
    monkeypatch.setattr(bpe, "REMEMBERED_STEPS", 20)
    encoder = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    for text in ["many different words in one short text, again and again", "and again"] * 3:
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == LIBRARY.encode_ordinary(text)


def test_starts_that_go_on_alike_share_transitions(monkeypatch):
    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()]
    encoder = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    met, step = [], bpe.Transducer._step
    monkeypatch.setattr(bpe.Transducer, "_step", lambda *a: met.append(1) or step(*a))
    for text in texts:
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == LIBRARY.encode_ordinary(text)
    # 81,912 transitions; 125,637 before tokens that cannot follow were left out.
    assert len(met) < 100_000


def test_what_is_remembered_stays_small():
    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()]
    encoder = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    transducer = encoder.transducer
    for text in [*texts, " ".join(map(str, range(500_000)))]:
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == LIBRARY.encode_ordinary(text)
        # Each task of an executor holds as much; up to 900,000 words and 400,000 moves and pairs were too much.
        assert len(encoder.spaced) + len(encoder.older) <= 250_000
        assert len(transducer.moves) <= 50_000 and len(transducer.vocabulary._goes) <= 50_000


def test_moves_go_while_states_stay(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_MOVES", 5)
    encoder = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    for text in pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()[:100]:
        assert np.frombuffer(encoder.ids(text or ""), "<u4").tolist() == LIBRARY.encode_ordinary(text or "")
    assert len(encoder.transducer.moves) <= 5 and encoder.transducer.steps > 5_000


def test_marks_behind_known_words_are_looked_up(monkeypatch):
    encoder = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    text = "a word, word. word, Word! word: word; word?"
    assert np.frombuffer(encoder.ids(text), "<u4").tolist() == LIBRARY.encode_ordinary(text)
    met, encode = [], bpe.Transducer.encode
    monkeypatch.setattr(bpe.Transducer, "encode", lambda *a: met.append(a[1]) or encode(*a))
    assert np.frombuffer(encoder.ids(text), "<u4").tolist() == LIBRARY.encode_ordinary(text)
    assert met == [b"a"]


def test_invalid_bytes_become_replacement_characters():
    ids = np.array([RANKS[b"\xff"], RANKS[b"a"]], "<u4").tobytes()
    assert "".join(DECODER.stream(ids)) == "�a"


def test_awkward_rows(spark):
    coded = bpe.encode(awkward(spark), FILE, public_tokenizers.PATTERN)
    found = sorted((r.doc_id is None, r.doc_id or 0, bytes(r.ids), r.n_tokens) for r in coded.collect())
    expected = sorted(
        (i is None, i or 0, np.array(LIBRARY.encode_ordinary(t or ""), "<u4").tobytes(), len(LIBRARY.encode_ordinary(t or "")))
        for i, t in TEXTS
    )
    assert found == expected
    texts = sorted((r.doc_id or 0, r.text) for r in bpe.decode(coded, FILE).collect())
    assert texts == sorted((i or 0, t or "") for i, t in TEXTS)


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert bpe.encode(empty, FILE, public_tokenizers.PATTERN).count() == 0


def test_query_on_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op3_bpe"](spark, folder).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = LIBRARY.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
