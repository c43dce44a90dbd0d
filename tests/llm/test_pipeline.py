import re

import corpus_pipeline
import numpy as np
import pytest
from fixtures import words
from test_quality import plain
from test_simhash import brute, plain_code

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows that each stage was given and those it gave."""
    folder = str(tmp_path_factory.mktemp("stages"))
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    tables = [docs.collect()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        tables.append(docs.collect())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == corpus_pipeline.COLUMNS
    return tables


def test_good_documents_stay_and_bad_ones_go(spark, stages):
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1]}
    fine = [r for r in stages[0] if plain(r.text)[0] >= 10 and 5 * plain(r.text)[4] <= plain(r.text)[0]]
    assert kept <= {r.doc_id for r in fine}
    good = [r.doc_id in kept for r in fine if marks.get(r.doc_id) == 1]
    assert sum(good) >= 0.99 * len(good)
    assert not [r.doc_id for r in fine if marks.get(r.doc_id) == 0 and r.doc_id in kept]


def test_one_of_each_group_of_copies_stays(stages):
    norm = lambda r: re.sub(r"[\x20\x09-\x0D]", "", r.text)
    best = {}
    for r in stages[1]:
        rank = (-len(r.text), r.doc_id)
        if norm(r) not in best or rank < best[norm(r)][0]:
            best[norm(r)] = (rank, r)
    assert sorted(r for _, r in best.values()) == sorted(stages[2])


def test_one_of_each_near_group_stays(stages):
    rows = sorted(stages[2])
    roots = brute([plain_code(r.text) for r in rows])
    assert sorted(r for r, root, i in zip(rows, roots, range(len(rows))) if root == i) == sorted(stages[3])


def test_the_mix_comes_near_its_targets(stages):
    from test_mixing import filled

    count = lambda rows: {s: sum(len(words(r.text)) for r in rows if r.source == s) for s in {r.source for r in stages[3]}}
    sizes, taken = count(stages[3]), count(stages[4])
    for source, target in filled(sizes).items():
        assert abs(taken[source] - target) <= 200 + 0.02 * target
    texts = {r.doc_id: set(words(r.text)) for r in stages[3]}
    assert all(set(words(r.text)) <= texts[r.doc_id] for r in stages[4])


def test_ids_decode_to_the_mix(stages):
    import public_tokenizers

    from drayage.llm import bpe

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        decoder = bpe.Decoder({i: t for t, i in bpe.read_ranks(lines).items()})
    decoded = sorted((r.doc_id, "".join(decoder.stream(bytes(r.ids)))) for r in stages[5])
    assert decoded == sorted((r.doc_id, r.text) for r in stages[4])
    assert all(r.intact and r.n_tokens == len(np.frombuffer(r.ids, "<u4")) for r in stages[5])


def test_run_gives_the_last_stage(spark, stages):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted((r.doc_id, bytes(r.ids)) for r in rows) == sorted((r.doc_id, bytes(r.ids)) for r in stages[5])
