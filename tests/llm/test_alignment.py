import hashlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from fixtures import SCHEMA, TEXTS, awkward
from pyspark.sql.types import LongType, StructField, StructType
from tokenizers import Tokenizer

from drayage.llm import alignment
from drayage.llm.perfect import PerfectHash
from drayage.llm.queries import QUERIES
from test_packing import ODD

FIRST, SECOND = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def brute_force(texts):
    """The numbers and groups of each text, from both libraries over whole texts."""
    first = Tokenizer.from_file(FIRST)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=SECOND)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in plain}
    shown |= {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(plain)))}
    aligned, held = [], Counter()
    for text in texts:
        aligned.append(None)
        if not text:
            continue
        a, b = first.encode(f" {text}", add_special_tokens=False).ids, second.encode(text)
        bytes_a = [bytes(shown[c] for c in first.id_to_token(i)) for i in a]
        bytes_b = [
            bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()
            for i in b
        ]
        if not b"".join(bytes_a) == b"".join(bytes_b) == f" {text}".encode():
            continue
        ends_a, ends_b = (np.cumsum([len(x) for x in y]).tolist() for y in (bytes_a, bytes_b))
        upto_a, upto_b = ({end: k for k, end in enumerate(ends, 1)} for ends in (ends_a, ends_b))
        groups, from_a, from_b = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            to_a, to_b = upto_a[end], upto_b[end]
            groups.append((a[from_a:to_a], b[from_b:to_b]))
            from_a, from_b = to_a, to_b
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        held.update(set(links))
        aligned[-1] = (len(a), len(b), groups, links)
    highest = Counter()
    for (x, _), n in held.items():
        highest[x] = max(highest[x], n)
    out = []
    for found in aligned:
        if found is None:
            out.append((0,) * 6 + (None,))
            continue
        n_a, n_b, groups, links = found
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(held[p] == highest[p[0]] for p in links)
        out.append((n_a, n_b, len(groups), len(links), best, sum(held[p] for p in links), said))
    return out


def same(rows, docs):
    key = lambda r: (str(r[0]), str(r[1:]))
    wanted = sorted(((i, *found) for (i, _), found in zip(docs, brute_force([t for _, t in docs]))), key=key)
    assert sorted(((r.doc_id, *(r[n] for n in NAMES), r.groups) for r in rows), key=key) == wanted


@pytest.mark.parametrize("round_pairs", [alignment.ROUND_PAIRS, 3000])
def test_awkward_rows(spark, round_pairs):
    texts = [*TEXTS, *enumerate(ODD, 100), (200, "▁"), (201, "x\n\n \n y"), (202, "<s> </s> <unk> <0x41>")]
    same(alignment.alignments(awkward(spark, texts), FIRST, SECOND, round_pairs=round_pairs).collect(), texts)


def test_trees_of_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(alignment, "FAN_IN", 2)
    monkeypatch.setattr(alignment, "SENT_PAIRS", 1)
    monkeypatch.setattr(alignment, "HELD_PAIRS", 1)
    texts = [(i, f"Some words {i} that differ in {i % 7} ways, naïvely\n and  again") for i in range(60)]
    same(alignment.alignments(awkward(spark, texts).repartition(9), FIRST, SECOND).collect(), texts)


def test_no_rows(spark):
    assert alignment.alignments(spark.createDataFrame([], SCHEMA), FIRST, SECOND).count() == 0
    rows = alignment.alignments(awkward(spark, [(1, None), (None, ""), (1, None)]), FIRST, SECOND).collect()
    assert len(rows) == 3 and all(r.n_a == r.count_sum == 0 and r.groups is None for r in rows)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    rows = {r.doc_id: r for r in QUERIES["op13_alignment"](spark, folder).collect()}
    for doc, found in zip(docs, brute_force([d.text for d in docs])):
        r = rows[doc.doc_id]
        digest = "" if found[6] is None else hashlib.sha256(found[6].encode()).hexdigest()
        assert (*(r[n] for n in NAMES), r.groups_sha256) == (*found[:6], digest)


def test_units_aligned_together_as_alone(monkeypatch):
    aligner = alignment.Aligner(FIRST, SECOND)
    texts = [" ".join((t or "").split()) for _, t in TEXTS] + ["a word, another word 12,345 'S déjà vu 日本 \U0001f600"]
    units = sorted(set().union(*aligner.parts([t for t in texts if t])))
    alone = [aligner.align([u])[0] for u in units]
    good = [u for u, found in zip(units, alone) if found is not None]
    slow, calls = aligner._aligned, []
    monkeypatch.setattr(aligner, "_aligned", lambda *a: calls.append(a) or slow(*a))
    for said in (True, False):
        together = aligner.align(good, said)
        assert not calls, "no unit is aligned by itself where all tokens give their bytes"
        firsts = aligner.first(good)
        for unit, first, found in zip(good, firsts, together):
            second = aligner.second.encode("\n" + unit)[aligner.ahead :]
            assert found == slow(unit.encode(), np.frombuffer(first, "<u4").tolist(), second, said)
    assert aligner.align(units) == alone and aligner.align([]) == []


def test_tasks_of_a_worker_share_what_a_round_looked_up(monkeypatch):
    class Texts:
        schema = {"doc_id": StructField("doc_id", LongType())}

        def mapInArrow(self, run, schema):  # noqa: N802
            return run

    schema = StructType([Texts.schema["doc_id"], *[StructField(name, LongType()) for name in NAMES]])
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["one text, and another", "and one more text"])], ["doc_id", "text"])
    aligner = alignment.Aligner(FIRST, SECOND)
    units = [unit for of in aligner.parts(batch.column(1).to_pylist()) for unit in of]
    pairs = np.unique(np.frombuffer(b"".join([found.links for found in aligner.align(units)]), np.int64))
    met, align = [], alignment.Aligner.align
    monkeypatch.setattr(alignment.Aligner, "align", lambda self, units, said=True: met.extend(units) or align(self, units, said))
    for count in (3, 5):
        rows = []
        for bucket in range(alignment.BUCKETS):
            keys = pairs[alignment._bucket(pairs) == bucket]
            if len(keys):
                hash_ = PerfectHash.of(keys)
                placed = np.empty_like(keys)
                placed[hash_.index(keys)] = keys
                rows.append((bucket, len(keys), hash_.sizes.tobytes(), hash_.words.tobytes(), alignment._packed(placed).tobytes(),
                             np.full(len(keys), count, "<u4").tobytes(), np.packbits(np.ones(len(keys), bool)).tobytes()))
        task = alignment._looked_up(Texts(), SimpleNamespace(value=rows), FIRST, SECOND, schema, True, True)
        met.clear()
        first, again = (pa.Table.from_batches(task(iter([batch]))) for _ in range(2))
        assert first == again and len(met) == len(set(met)) > 0
        # Another round has its own counts.
        assert first["count_sum"].to_pylist() == [count * n for n in first["n_links"].to_pylist()]


def test_perfect_hash():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 63, 64, 5000, 200_000):
        keys = rng.choice(1 << 40, n, replace=False).astype(np.int64) if n < 100_000 else np.arange(n, dtype=np.int64) * 3
        found = PerfectHash.of(keys)
        assert sorted(found.index(keys).tolist()) == list(range(n))
        assert found.index(np.zeros(0, np.int64)).tolist() == []
        others = found.index(rng.choice(1 << 41, 100).astype(np.int64))
        assert ((others >= -1) & (others < max(n, 1))).all()
        assert 64 * len(found.words) <= 8 * n + 1000
