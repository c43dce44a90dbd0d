import re

import pytest
from fixtures import SCHEMA, TEXTS, awkward

from drayage.llm import secret_scan as s


def brute(text):
    found = []
    for rank, rule in enumerate((*s.BASE, *s.KNOWN)):
        for m in re.finditer(rule.pattern, text or "", re.ASCII):
            if len(m[rule.group]) >= rule.at_least:
                found.append((m.start(), rank, rule.kind, m.end()))
    return sorted(found)


SECRETS = [
    (1, "token=abc password=secret123 API_KEY : \"abcdefgh\" tokentoken=token :abcdefgh"),
    (2, "é" * 50 + "AKIA" + "Z" * 15 + " AKIA" + "Q" * 16 + "\nsecret='x' apikey=  zzzzzz"),
    (3, " ".join(f"token=value{i:06d}" for i in range(2000))),
    (4, "0123456789abcdef01234567 ABCDEF0123456789abcdef0123456789 " + "f" * 23 + " " + "a" * 100_000),
    (5, "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1" * 20 + " xoxb-1234567890-abc AIza" + "x" * 35),
    (6, "PASSWD:hunter22 ſecret=abcdefg toKen=abcdefg"), (6, "PASSWD:hunter22 ſecret=abcdefg toKen=abcdefg"),
]


@pytest.mark.parametrize("texts", [TEXTS, SECRETS])
def test_spans_against_a_plain_scan(spark, texts):
    rows = s.find_secrets(awkward(spark, texts)).collect()
    found = sorted((str(r.doc_id), [tuple(x) for x in r.found]) for r in rows)
    assert found == sorted((str(i), brute(t)) for i, t in texts)


def test_queries_derived_from_rules():
    assert s.trigram_query("[0-9a-f]{24,}") == []
    assert s.trigram_query("AKIA[A-Z0-9]+") == [[frozenset({"aki", "kia"})]]
    assert s.trigram_query("ab?cde|x") == []
    assert s.trigram_query("xab?cdey") == [[frozenset({"xab", "abc", "bcd", "cde", "dey"}), frozenset({"xac", "acd", "cde", "dey"})]]
    assert s.trigram_query("(?i:abcd).*(efgh)+") == [[frozenset({"abc", "bcd"})], [frozenset({"efg", "fgh"})]]


def test_rules_without_trigrams_and_rules_only_with_them(spark):
    docs = awkward(spark, SECRETS)
    for rules in ((s.BASE[2],), (s.BASE[1],)):
        total = sum(len(r.found) for r in s.find_secrets(docs, rules).collect())
        assert total == sum(x[2] == rules[0].kind for _, t in SECRETS for x in brute(t))


def test_no_rows(spark):
    assert s.find_secrets(spark.createDataFrame([], SCHEMA)).count() == 0
