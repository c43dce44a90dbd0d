import hashlib
import re

from fixtures import SCHEMA, TEXTS, awkward

from drayage.llm import exact


def groups(texts):
    by = {}
    for i, t in texts:
        by.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0, i))
    return by


def test_groups_of_awkward_rows(spark):
    found = exact.duplicate_groups(awkward(spark)).collect()
    expected = groups(TEXTS)
    assert len(found) == len(TEXTS)
    by_digest = {hashlib.sha256(n.encode()).hexdigest(): sorted(m) for n, m in expected.items()}
    kept = {}
    for row in found:
        members = by_digest[row.text_sha256]
        assert row.group_size == len(members)
        assert row.keep_id == members[0][3]
        kept.setdefault(row.text_sha256, []).append(row.kept)
    assert all(k.count(True) == 1 for k in kept.values()) and len(kept) == len(by_digest)


def test_distinct_documents_keep_all_columns(spark):
    docs = awkward(spark)
    found = exact.distinct_documents(docs)
    assert found.columns == docs.columns
    rows = found.collect()
    assert len(rows) == len(groups(TEXTS))
    # The longest of the copies stays.
    assert {3} == {r.doc_id for r in rows if (r.text or "").startswith("The quick")}


def test_hot_group_is_cut_and_put_together(spark):
    copies = [(i, "hot text " + " " * (i % 7)) for i in range(900)]
    others = [(1000 + i, f"text number {i}") for i in range(600)]
    found = exact.duplicate_groups(awkward(spark, copies + others)).collect()
    hot = [r for r in found if r.group_size > 1]
    assert len(hot) == 900 and {r.group_size for r in hot} == {900} and {r.keep_id for r in hot} == {6}
    assert sum(r.kept for r in hot) == 1 and sum(r.kept for r in found) == 601
    assert exact.distinct_documents(awkward(spark, copies + others)).count() == 601


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact.duplicate_groups(empty).count() == 0
    assert exact.distinct_documents(empty).count() == 0
