import pytest
from fixtures import SCHEMA, awkward, words

from drayage.llm import mixing


def filled(sizes):
    """Targets by sharing again and again, as the rule is told."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, target, free = sum(sizes.values()), {}, list(names)
    while free:
        rest = total - sum(target.values())
        share = {s: weight[s] * rest / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return target | share
        target |= {s: 3 * sizes[s] for s in over}
        free = [s for s in free if s not in over]
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 10, "c": 10_000, "d": 5}, {"a": 7}, {"a": 0, "b": 9, None: 3}, {"a": 0, None: 0},
    {f"s{i:02d}": (i * 37) % 11 * 100 for i in range(25)},
])
def test_targets(spark, sizes):
    rows = [("1" if s is None else "0" + s, n) for s, n in sizes.items()]
    found = {r.key: r.target for r in mixing.with_targets(spark.createDataFrame(rows, "key string, source_size long")).collect()}
    expected = filled(sizes)
    assert {k: pytest.approx(v) for k, v in found.items()} == {"1" if s is None else "0" + s: v for s, v in expected.items()}


def corpus(spark):
    texts = [(i, " ".join(f"w{i}.{j}" for j in range(1 + i * 13 % 400))) for i in range(300)]
    return awkward(spark, [*texts, (3, texts[3][1]), (3, "other text"), (None, "no id"), (990, None), (991, "")])


def test_taken_words_come_near_their_targets(spark):
    rows = mixing.taken_words(corpus(spark)).collect()
    assert len(rows) == 305
    by = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        at = by.setdefault((r.target, r.source_size), [0, 0])
        at[0], at[1] = at[0] + r.taken, at[1] + r.size
    for (target, source_size), (taken, size) in by.items():
        assert size == source_size and abs(taken - target) <= 3 * mixing.BLOCK_WORDS + 0.02 * target
    again = mixing.taken_words(corpus(spark).repartition(7)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_slots_take_each_block_once_in_a_pass(spark):
    _, taken = mixing.plan(corpus(spark), shard_blocks=50, block_words=16)
    rows = taken.select("n", "slot", "pass", "block", "shard").distinct().collect()
    assert len({(r.n, r.slot) for r in rows}) == len(rows) == len({(r.n, r["pass"], r.block) for r in rows})
    per_shard = {}
    for r in rows:
        per_shard[r.shard] = per_shard.get(r.shard, 0) + 1
    assert len(per_shard) > 3 and max(per_shard.values()) <= 50
    full = [v for k, v in per_shard.items() if k < max(per_shard)]
    assert min(full) >= 45  # less only where a source has no block left


def test_mixed_documents_hold_the_words_taken(spark):
    docs = corpus(spark)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    taken, texts = {}, {}
    for r in mixing.taken_words(docs).collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(words(r.text))
    got = {}
    for r in mixed.collect():
        assert r.n_chars == len(r.text)
        got[r.doc_id] = got.get(r.doc_id, 0) + len(words(r.text))
        assert any(set(words(r.text)) <= set(t) for t in texts[r.doc_id])
    assert got == {k: v for k, v in taken.items() if v}


def test_no_rows_and_no_words(spark):
    assert mixing.taken_words(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = mixing.taken_words(awkward(spark, [(1, None), (2, " ")])).collect()
    assert [(r.size, r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 2
    assert mixing.mixed_documents(awkward(spark, [(1, None)])).count() == 0
