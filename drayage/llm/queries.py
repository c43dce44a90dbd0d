"""The registered queries of this package and the DuckDB SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drayage.llm import (
    alignment,
    bpe,
    chat,
    exact,
    mixing,
    packing,
    quality,
    scoring,
    secret_scan,
    simhash,
    spelling,
    substrings,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


@query("""
WITH n AS (
    SELECT doc_id, length(coalesce(text, '')) AS chars,
           regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm
    FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id)
""")
def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.duplicate_groups(documents(spark, folder))


@query()
def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.round_trip(documents(spark, folder), ranks, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _secrets_sql() -> str:
    """Each rule's matches and what lies between them, as the operator places its spans."""
    either = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
    assign = (
        "((" + "|".join(map(either, ("password", "passwd", "secret", "token")))
        + "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+))"
    )
    parts = []
    for rank, rule in enumerate((*secret_scan.BASE, *secret_scan.KNOWN)):
        pattern, group = (assign, 3) if rule.kind == "assign" else (f"({rule.pattern})", 1)
        parts.append(f"""
    SELECT r, {rank} AS rank, '{rule.kind}' AS kind, pos,
           list_sum(list_transform(between[1:pos], lambda x: length(x)))
           + coalesce(list_sum(list_transform(found[1:pos - 1], lambda x: length(x))), 0) AS s,
           length(found[pos]) AS n, length(part[pos]) AS p, {rule.at_least} AS least
    FROM (SELECT r, unnest(range(1, len(found) + 1)) AS pos, found, between, part
          FROM (SELECT r, regexp_extract_all(t, '{pattern}', 1) AS found,
                       regexp_extract_all(t, '{pattern}', {group}) AS part,
                       string_split_regex(t, '{pattern.replace("(", "(?:").replace("(?:?:", "(?:")}') AS between
                FROM d WHERE regexp_matches(t, '{pattern}')))""")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
spans AS (
    SELECT r, rank, kind, s::BIGINT AS s, (kind || ':' || s::BIGINT || ':' || (s + n)::BIGINT) AS said
    FROM ({" UNION ALL ".join(parts)}) WHERE p >= least),
found AS (
    SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
           count(*) FILTER (kind = 'hex') AS n_hex,
           string_agg(said, ',' ORDER BY s, rank) FILTER (rank < {len(secret_scan.BASE)}) AS base,
           string_agg(said, ',' ORDER BY s, rank) AS spans
    FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN found USING (r)
"""


@query(_secrets_sql())
def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find_secrets(documents(spark, folder))
    base = secret_scan.of_kinds(F.col("found"), [r.kind for r in secret_scan.BASE])
    count = lambda kind: F.size(secret_scan.of_kinds(F.col("found"), [kind])).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed(F.col("found")).alias("spans"),
    )


@query()
def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_components(documents(spark, folder)).select(
        "doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _mixing_sql() -> str:
    m = mixing
    weights = f"[{', '.join(map(str, m.WEIGHTS))}]"
    rounds = "perm0 AS (SELECT *, slot // blocks AS pass, slot % blocks AS x FROM slots)"
    for i in range(m.ROUNDS):
        rounds += f""",
keyed{i} AS (SELECT *, ((({m.SEED} + (n + 1) * 7919 + (pass + 1) * 104729) % {m.PRIME} * 48271 % {m.PRIME}
             + {i + 1} * 69621) % {m.PRIME} * 16807 % {m.PRIME}) % blocks AS key FROM perm{i}),
perm{i + 1} AS (SELECT * EXCLUDE (key, x), CASE WHEN ((greatest(x, (key - x + blocks) % blocks) % {m.PRIME} * 1103515245
             + key * 12345 + {i * 777}) % {m.PRIME} // 65536) % 2 = 1 THEN (key - x + blocks) % blocks ELSE x END AS x
             FROM keyed{i})"""
    return f"""
WITH d AS (
    SELECT doc_id, source, substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 3) AS chunk,
           coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
ranked AS (
    SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n, ({m.MOST_PASSES} * source_size)::DOUBLE AS cap FROM sizes),
weighed AS (SELECT *, {weights}[1 + n % {len(m.WEIGHTS)}]::DOUBLE AS weight FROM ranked),
leveled AS (
    SELECT *, cap / weight AS ratio,
           ((sum(source_size) OVER ())::DOUBLE
            - coalesce(sum(cap) OVER (ORDER BY cap / weight, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (ORDER BY cap / weight, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighed),
sources AS (
    SELECT source, n, source_size, (source_size + {m.BLOCK_WORDS - 1}) // {m.BLOCK_WORDS} AS blocks,
           least(cap, weight * (SELECT arg_min(level, (ratio, n)) FROM leveled WHERE level <= ratio)) AS target
    FROM leveled),
shares AS (
    SELECT *, CASE WHEN source_size > 0 THEN target * blocks / source_size ELSE 0.0 END AS share FROM sources),
totals AS (SELECT sum(share) AS whole, round(sum(share))::BIGINT AS total FROM shares),
expected AS (
    SELECT *, slots * share / whole AS mean, floor(slots * share / whole + 1e-9)::BIGINT AS sure FROM (
        SELECT n, blocks, share, whole, shard, least({m.SHARD_BLOCKS}, total - shard * {m.SHARD_BLOCKS}) AS slots
        FROM shares, totals, range(0, (total + {m.SHARD_BLOCKS - 1}) // {m.SHARD_BLOCKS}) AS s(shard))),
parted AS (SELECT *, greatest(mean - sure, 0.0) AS part FROM expected),
places AS (
    SELECT *, slots - sum(sure) OVER (PARTITION BY shard) AS rest, sum(part) OVER (PARTITION BY shard) AS parts,
           sum(part) OVER (PARTITION BY shard ORDER BY n ROWS UNBOUNDED PRECEDING) - part AS place FROM parted),
draws AS (
    SELECT shard, ('0x' || substr(md5('{m.SEED}:' || shard || ':' || j), 1, 8))::BIGINT::DOUBLE / 4294967296.0 * parts AS place
    FROM (SELECT shard, parts, unnest(range(1, rest::BIGINT + 1)) AS j FROM places WHERE n = 0)),
more AS (
    SELECT shard, n, count(*) AS more FROM (
        SELECT shard, draw, last_value(n IGNORE NULLS) OVER (
            PARTITION BY shard ORDER BY place, draw, n ROWS UNBOUNDED PRECEDING) AS n
        FROM (SELECT shard, place, 0 AS draw, n FROM places UNION ALL SELECT shard, place, 1, NULL FROM draws))
    WHERE draw = 1 GROUP BY ALL),
counts AS (
    SELECT n, shard, blocks, sure + coalesce(more, 0) AS c,
           coalesce(sum(sure + coalesce(more, 0)) OVER (
               PARTITION BY n ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first
    FROM places LEFT JOIN more USING (shard, n)),
slots AS (
    SELECT n, blocks, unnest(range(first, least(first + c, blocks * {m.MOST_PASSES})::BIGINT)) AS slot FROM counts),
{rounds},
uses AS (SELECT n, x AS block, count(*) AS uses FROM perm{m.ROUNDS} GROUP BY ALL),
placed AS (
    SELECT doc_id, size, source_size, target, n, row_number() OVER () AS r, coalesce(sum(size) OVER (
        PARTITION BY n ORDER BY chunk, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM d JOIN sources ON d.source IS NOT DISTINCT FROM sources.source),
parts AS (
    SELECT r, n, start, size, unnest(range(start // {m.BLOCK_WORDS}, (start + size - 1) // {m.BLOCK_WORDS} + 1)) AS block
    FROM placed WHERE size > 0),
taken AS (
    SELECT r, sum(uses * (least((block + 1) * {m.BLOCK_WORDS}, start + size) - greatest(block * {m.BLOCK_WORDS}, start))) AS w
    FROM parts JOIN uses USING (n, block) GROUP BY r)
SELECT doc_id, size, source_size, target, coalesce(w, 0)::BIGINT AS taken FROM placed LEFT JOIN taken USING (r)
"""


@query(_mixing_sql())
def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken_words(documents(spark, folder))


@query()
def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.verdicts(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


@query()
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def _chat_sql() -> str:
    def escaped(column: str) -> str:
        out = f"replace({column}, '\\', '\\\\')"
        for control in chat.CONTROLS:
            out = f"replace({out}, '{control}', '{control[0]}\\{control[1:]}')"
        return out

    role = f"replace({escaped('role')}, chr(10), '\\' || chr(10))"
    frame = len(chat.BEGIN) + len(chat.END) + 1
    return f"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, n, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(n, role)),
sized AS (SELECT *, length({role}) + length({escaped('text')}) + {frame} AS chars FROM c),
ends AS (
    SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS upto,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS back
    FROM sized)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars,
       count(*) FILTER (role = 'assistant' OR back = 1) AS n_examples,
       sum(upto) FILTER (role = 'assistant' OR back = 1)::BIGINT AS example_chars
FROM ends GROUP BY conv_id
"""


@query(_chat_sql())
def op1_chat(spark: SparkSession, folder: str) -> DataFrame:
    turns = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    return chat.read_back(chat.examples(turns.union(more)))


@query("""
WITH w AS (
    SELECT row_number() OVER (ORDER BY doc_id, coalesce(text, '')) AS r, doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
spots AS (SELECT r, unnest(range(1, len(words) - 18)) AS p, words FROM w),
windows AS (
    SELECT r, p, row_number() OVER (PARTITION BY md5(array_to_string(words[p:p + 19], ' ')) ORDER BY r, p) AS n FROM spots),
gone AS (SELECT DISTINCT r, unnest(range(p, p + 20)) AS i FROM windows WHERE n > 1),
kept AS (
    SELECT r, string_agg(word, ' ' ORDER BY i) AS text
    FROM (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w) ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, len(words) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN (SELECT r, count(*) AS n FROM gone GROUP BY r) USING (r) LEFT JOIN kept USING (r)
""")
def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.repeated_words(documents(spark, folder)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


@query(f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
w AS (SELECT r, unnest(words) AS a, unnest(range(1, len(words) + 1)) AS i FROM d),
g AS (SELECT r, i, lag(a, 2) OVER d AS c, lag(a) OVER d AS b, a FROM w WINDOW d AS (PARTITION BY r ORDER BY i)),
n1 AS (SELECT a, count(*) AS n FROM g GROUP BY ALL),
n2 AS (SELECT b, a, count(*) AS n FROM g WHERE b IS NOT NULL GROUP BY ALL),
n3 AS (SELECT c, b, a, count(*) AS n FROM g WHERE c IS NOT NULL GROUP BY ALL),
s AS (
    SELECT r, CASE
        WHEN n3.n >= {scoring.SEEN} THEN n3.n::DOUBLE / h2.n
        WHEN n2.n >= {scoring.SEEN} THEN n2.n::DOUBLE / h1.n * CASE WHEN g.c IS NULL THEN 1.0 ELSE {scoring.BACKOFF} END
        ELSE n1.n::DOUBLE / (SELECT count(*) FROM g) * CASE WHEN g.b IS NULL THEN 1.0 ELSE {scoring.BACKOFF} END
             * CASE WHEN g.c IS NULL THEN 1.0 ELSE {scoring.BACKOFF} END END AS score
    FROM g JOIN n1 ON g.a = n1.a LEFT JOIN n1 h1 ON g.b = h1.a LEFT JOIN n2 ON g.a = n2.a AND g.b = n2.b
    LEFT JOIN n2 h2 ON g.b = h2.a AND g.c = h2.b LEFT JOIN n3 ON g.a = n3.a AND g.b = n3.b AND g.c = n3.c)
SELECT doc_id, len(words) AS n_words, coalesce(l, 0)::BIGINT AS log_score
FROM d LEFT JOIN (SELECT r, sum(floor(log10(score) * 1e6 + 0.5)) AS l FROM s GROUP BY r) USING (r)
""")
def op7_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.scores(documents(spark, folder)).select("doc_id", "n_words", "log_score")


def _spelling_sql() -> str:
    s = spelling
    lower = f"translate(run, '{s.UPPER}', '{s.UPPER.lower()}')"
    return f"""
WITH RECURSIVE crc_table AS (
    -- The table of CRC-32 by its rule: eight times, a shift and the polynomial where a bit falls out.
    SELECT list(list_reduce(list_prepend(b, range(0, 8)),
               lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
    FROM range(0, 256) AS r(b)),
runs AS (
    SELECT id, {lower} AS run FROM (
        SELECT coalesce(doc_id::VARCHAR, '') AS id,
               unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]{{{s.LEAST_LENGTH},}}')) AS run FROM documents)),
said AS (SELECT id, run, count(*) AS n, hex(encode(id || ':' || run)) AS x FROM runs GROUP BY id, run),
hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(range(0, length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
        lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) AS h
    FROM said, crc_table),
spoilt AS (
    SELECT CASE WHEN h % {s.SPOILT} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                ELSE run END AS word, n FROM hashed),
words AS (
    SELECT word, sum(n)::BIGINT AS n FROM spoilt WHERE length(word) >= {s.LEAST_LENGTH}
    GROUP BY word HAVING sum(n) >= {s.LEAST_COUNT}),
less AS (
    SELECT DISTINCT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS part
    FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
    SELECT a.word AS word, b.word AS other FROM less a JOIN less b ON a.part = b.part AND a.i = b.i AND a.word <> b.word
    UNION SELECT word, part FROM less SEMI JOIN words ON less.part = words.word
    UNION SELECT part, word FROM less SEMI JOIN words ON less.part = words.word),
near AS (
    SELECT p.word, count(*) AS n_near, arg_min(struct_pack(w := other, n := o.n), struct_pack(m := -o.n, w := encode(other))) AS best
    FROM pairs p JOIN words o ON p.other = o.word GROUP BY p.word),
judged AS (
    SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best.n >= {s.RATIO} * n THEN best.w END AS form,
           CASE WHEN best.n >= {s.RATIO} * n THEN best.n END AS form_n
    FROM words LEFT JOIN near ON words.word = near.word),
up AS (
    SELECT word, form AS root, 1 AS steps FROM judged WHERE form IS NOT NULL
    UNION ALL SELECT up.word, judged.form, steps + 1 FROM up JOIN judged ON up.root = judged.word WHERE judged.form IS NOT NULL)
SELECT judged.word, form, coalesce(u.root, judged.word) AS root, n, n_near, form_n
FROM judged LEFT JOIN (SELECT word, arg_max(root, steps) AS root FROM up GROUP BY word) u ON judged.word = u.word
"""


@query(_spelling_sql())
def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(documents(spark, folder))


@query()
def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_documents(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"), keep_ids=False)


@query()
def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    first, second = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    found = alignment.alignments(documents(spark, folder), first, second)
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        F.coalesce(F.sha2(F.col("groups").cast("binary"), 256), F.lit("")).alias("groups_sha256"),
    )
