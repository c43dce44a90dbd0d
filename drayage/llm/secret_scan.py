"""Secret scans over a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived: a
conjunction of clauses, each of them a choice between sets of trigrams that must occur
together. The index holds, for each trigram that some query names, the documents that
contain it, in lower case. Intersecting these postings gives the candidates of each
rule; the rule's expression then verifies them. Rules without a mandatory trigram run
over every document.

A document is known in the index by its id and two hashes of its text, so that rows
repeated with the same id and text share their postings and each get their spans; a
null id is an id of its own. A null text counts as empty and has no spans. An empty
table gives no rows. Positions count code points, ends are exclusive.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass
from re import _constants as op
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drayage.llm.frames import numbered


@dataclass(frozen=True)
class Rule:
    """Leftmost matches of ``pattern`` that do not overlap; those whose ``group`` has fewer
    than ``at_least`` characters are dropped."""

    kind: str
    pattern: str
    group: int = 0
    at_least: int = 1


# The base rules.
BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    # A run of 24 or more is a match of [0-9a-f]+ that is long enough, and the other way round.
    Rule("hex", "[0-9a-f]{24,}", 0, 24),
)
# Formats of well-known credentials.
KNOWN = (
    Rule("private_key", "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)

#: A choice between sets of trigrams; a query is a list of such clauses, all of which must hold.
Clause = list[frozenset[str]]
#: Literal strings that are spelled out side by side at most; beyond that they are cut.
MOST_STRINGS = 64


def trigram_query(pattern: str) -> list[Clause]:
    """What every match of ``pattern`` contains, in lower case; no clause if nothing is sure."""
    clauses: list[Clause] = []

    def close(strings: set[str]) -> set[str]:
        if strings and all(len(s) >= 3 for s in strings):
            clauses.append(_smallest({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}))
        return {""}

    def walk(items, strings: set[str]) -> set[str]:
        """``strings`` are the ways in which what lies just before ``items`` may end."""
        for kind, value in items:
            spelled = _spelled(kind, value)
            if spelled is not None and len(strings) * len(spelled) <= MOST_STRINGS:
                strings = {a + b for a, b in itertools.product(strings, spelled)}
            elif kind is op.SUBPATTERN:
                strings = walk(value[3], strings)
            elif kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] >= 1:
                close(walk(value[2], strings))
                strings = {""}
            else:
                strings = close(strings)
        return strings

    close(walk(parser.parse(pattern), {""}))
    return clauses


def _smallest(branches: set[frozenset[str]]) -> Clause:
    """Without the branches that another branch, with fewer trigrams, covers."""
    return sorted((b for b in branches if not any(o < b for o in branches)), key=sorted)


def _spelled(kind, value) -> set[str] | None:
    """The strings that a part of a pattern stands for, in lower case, if they are few."""
    if kind is op.LITERAL:
        return {chr(value).lower()}
    if kind is op.IN and all(k is op.LITERAL for k, _ in value):
        return {chr(v).lower() for _, v in value}
    if kind is op.BRANCH:
        found = [_spelled_all(branch) for branch in value[1]]
        return None if None in found else set().union(*found)
    if kind is op.SUBPATTERN:
        return _spelled_all(value[3])
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and tuple(value[:2]) == (0, 1):
        once = _spelled_all(value[2])
        return None if once is None else once | {""}
    return None


def _spelled_all(items) -> set[str] | None:
    strings = {""}
    for kind, value in items:
        spelled = _spelled(kind, value)
        if spelled is None or len(strings) * len(spelled) > MOST_STRINGS:
            return None
        strings = {a + b for a, b in itertools.product(strings, spelled)}
    return strings


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index of ``docs(key, text)``: one row for each of ``trigrams`` and each
    document that contains it."""
    low = F.lower("low_text")
    found = F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams])
    lowered = docs.select("key", F.col("text").alias("low_text")).select("key", low.alias("low"))
    return (
        lowered.select("key", F.explode(F.array_compact(found)).alias("trigram"))
        .groupBy("key", "trigram")
        .agg(F.lit(1).alias("one"))
        .drop("one")
    )


def candidates(index: DataFrame, queries: dict[str, list[Clause]]) -> DataFrame:
    """Intersects postings: each document with the kinds whose query it satisfies."""
    terms = [
        (kind, c, b, trigram, len(branch), len(clauses))
        for kind, clauses in queries.items()
        for c, clause in enumerate(clauses)
        for b, branch in enumerate(clause)
        for trigram in branch
    ]
    # As many rows as the rules have trigrams.
    table = index.sparkSession.createDataFrame(
        terms, "kind string, clause int, branch int, trigram string, need int, clauses int"
    )
    branches = (
        index.join(F.broadcast(table), "trigram")
        .groupBy("key", "kind", "clauses", "clause", "branch", "need")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n = need")
    )
    return (
        branches.groupBy("key", "kind", "clauses")
        .agg(F.count_distinct("clause").alias("n"))
        .filter("n = clauses")
        .groupBy("key")
        .agg(F.collect_set("kind").alias("kinds"))
    )


def find_secrets(
    docs: DataFrame,
    rules: tuple[Rule, ...] = (*BASE, *KNOWN),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id`` and ``found``, an array of structs
    (start, rank, kind, end), where ``rank`` is the rule's place in ``rules``, in order."""
    docs, names = numbered(docs)
    text = F.coalesce(F.col(names[text_col]).cast("string"), F.lit(""))
    keyed = docs.select(F.col(names[id_col]).alias("doc_id"), text.alias("text")).withColumn(
        "key",
        F.struct(
            F.col("doc_id").isNull().alias("no_id"),
            F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
            F.xxhash64("text").alias("hash"),
            F.xxhash64(F.lit(1), "text").alias("other"),
        ),
    )
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {kind: clauses for kind, clauses in queries.items() if clauses}
    vocabulary = sorted({t for clauses in indexed.values() for c in clauses for b in c for t in b})
    if vocabulary:
        found = candidates(postings(keyed, vocabulary), indexed)
        keyed = keyed.join(found.withColumnRenamed("key", "__key"), F.col("key") == F.col("__key"), "left")
    else:
        keyed = keyed.withColumn("kinds", F.array().cast("array<string>"))
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    spans = []
    for rank, rule in enumerate(rules):
        due = F.array_contains("kinds", rule.kind) if rule.kind in indexed else F.lit(True)
        hit = F.coalesce(due, F.lit(False)) & F.col("text").rlike(rule.pattern)
        spans.append(F.when(hit, _spans(F.col("text"), rule, rank)).otherwise(none))
    return keyed.select("doc_id", F.array_sort(F.concat(*spans)).alias("found"))


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """The spans of a rule: what lies between the matches and the matches give the places."""
    pattern = F.lit(rule.pattern)
    wide = F.transform(
        F.arrays_zip(
            F.split(text, rule.pattern, -1).alias("between"),
            F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"),
            F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("part"),
        ),
        lambda x: F.struct(
            F.length(x["between"]).cast("long").alias("before"),
            F.length(x["match"]).cast("long").alias("length"),
            F.length(x["part"]).alias("part"),
        ),
    )
    # The last piece has no match behind it.
    matches = F.filter(wide, lambda x: x["length"].isNotNull())
    placed = F.zip_with(
        matches,
        _sums_before(F.transform(matches, lambda x: x["before"] + x["length"])),
        lambda x, before: F.struct(
            (before + x["before"]).alias("start"),
            F.lit(rank).alias("rank"),
            F.lit(rule.kind).alias("kind"),
            (before + x["before"] + x["length"]).alias("end"),
            x["part"].alias("part"),
        ),
    )
    kept = F.filter(placed, lambda x: x["part"] >= rule.at_least)
    return F.transform(kept, lambda x: F.struct(x["start"], x["rank"], x["kind"], x["end"]))


def _sums_before(lengths: Column, block: int = 256) -> Column:
    """For each number the sum of those before it, block by block, so that arrays that grow
    by appending stay short."""
    long_ = F.lit(0).cast("long")

    def before(numbers: Column, start: Column) -> Column:
        begin = F.struct(start.alias("sum"), F.array().cast("array<bigint>").alias("all"))
        return F.aggregate(
            numbers,
            begin,
            lambda acc, n: F.struct(
                (acc["sum"] + n).alias("sum"), F.array_append(acc["all"], acc["sum"]).alias("all")
            ),
        )["all"]

    blocks = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(lengths), F.lit(1)), F.lit(block)),
        lambda at: F.slice(lengths, at, block),
    )
    totals = F.transform(blocks, lambda b: F.aggregate(b, long_, lambda a, n: a + n))
    return F.flatten(F.zip_with(blocks, before(totals, long_), before))


def listed(found: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def of_kinds(found: Column, kinds: list[str]) -> Column:
    """The spans of some kinds, in order."""
    return F.filter(found, lambda s: s["kind"].isin(kinds))
