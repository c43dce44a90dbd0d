import re

import numpy as np
import pytest
import xxhash
from fixtures import SCHEMA, TEXTS, awkward
from pyspark.sql import functions as F

from drayage.llm import simhash
from drayage.llm.components import components


class Sets:
    def __init__(self, n):
        self.up = list(range(n))

    def root(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self.up[b] = a


def plain_code(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(codes):
    sets, array = Sets(len(codes)), np.array(codes, np.uint64)
    for i in range(len(codes)):
        for j in np.flatnonzero(np.bitwise_count(array[i + 1 :] ^ array[i]) <= 4) + i + 1:
            sets.join(i, int(j))
    return [sets.root(i) for i in range(len(codes))]


def near_codes(seed, clusters, most, bits=6):
    rng = np.random.default_rng(seed)
    found = set()
    for base in rng.integers(0, 2**64, clusters, dtype=np.uint64).tolist():
        for _ in range(int(rng.integers(1, most))):
            for bit in rng.integers(0, 64, int(rng.integers(0, bits))).tolist():
                base ^= 1 << bit
            found.add(base)
    return sorted(found)


def partition(roots):
    return {frozenset(i for i, r in enumerate(roots) if r == root) for root in set(roots)}


@pytest.mark.parametrize("seed", range(6))
def test_forest_against_all_pairs(seed):
    codes = near_codes(seed, 40, 20)
    a, b = simhash.forest(np.array(codes, np.uint64), 4)
    sets, at = Sets(len(codes)), {c: i for i, c in enumerate(codes)}
    for x, y in zip(a.tolist(), b.tolist()):
        sets.join(at[x], at[y])
    assert partition([sets.root(i) for i in range(len(codes))]) == partition(brute(codes))


@pytest.mark.parametrize("node_codes", [50_000, 6])
def test_links_against_all_pairs(spark, node_codes):
    """With small top nodes, large ones are split again and again."""
    codes = near_codes(9, 30, 25)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    links = simhash.links(spark.createDataFrame([(c,) for c in signed], "code long"), node_codes=node_codes).collect()
    sets, at = Sets(len(codes)), {c: i for i, c in enumerate(signed)}
    for r in links:
        sets.join(at[r.a], at[r.b])
    assert partition([sets.root(i) for i in range(len(codes))]) == partition(brute(codes))


def test_components_of_a_path_a_star_and_a_cycle(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 300)] + [(501, 502), (502, 503), (503, 501), (502, 501), (7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(1, 41)) and all(found[100 + i] == 100 for i in range(1, 300))
    assert found[502] == found[503] == 501


def test_awkward_rows_against_brute_force(spark):
    rows = simhash.near_components(awkward(spark)).collect()
    codes = [plain_code(t) for _, t in TEXTS]
    roots = brute(codes)
    expected = []
    for k, (i, _) in enumerate(TEXTS):
        ids = [j for r, (j, _) in zip(roots, TEXTS) if r == roots[k] and j is not None]
        expected.append((str(i), codes[k], str(min(ids, default=None))))
    assert sorted((str(r.doc_id), r.code % (1 << 64), str(r.component_id)) for r in rows) == sorted(expected)


def test_one_document_of_each_component_stays(spark):
    docs = awkward(spark)
    kept = simhash.distinct_documents(docs)
    assert kept.columns == docs.columns
    rows = [r.doc_id for r in kept.collect()]
    assert rows.count(1) == 1 and not {2, 3} & set(rows)


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_components(empty).count() == 0
    assert simhash.distinct_documents(empty).count() == 0


def test_query_on_whole_table(spark):
    from drayage.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    codes = [plain_code(t) for _, t in docs]
    roots = brute(codes)
    rows = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op8_simhash"](spark, folder).collect()}
    assert rows == {i: (f"{c:016x}", docs[r][0]) for (i, _), c, r in zip(docs, codes, roots)}
