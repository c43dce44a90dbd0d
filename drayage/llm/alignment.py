"""Alignment of two tokenizers' tokens, and in how many documents each pair of ids is linked.

Two tokenizers cut the same bytes. Places where tokens of both end part them into groups, and
within a group every token of one is linked with every token of the other. Both tokenizers never
cross the units of ``cached``, so units are aligned apart and remembered.

A first pass aligns the documents and writes, for each task and each bucket of ids, the different
pairs with their counts. The pairs of a bucket are united in a tree and get a minimal perfect hash.
Dense vectors, one count at each pair's number, are filled for groups of tasks and summed in a
tree. Keys stored by number verify each look-up. The second pass aligns the documents again and
looks up the counts. Its tables are broadcast in rounds of at most ``ROUND_PAIRS`` pairs; ids being
bounded by the vocabularies, so are the rounds.

Texts that are null, empty, or not reproduced byte by byte by both tokenizers have no tokens: all
numbers are zero and ``groups`` is null. Rows repeated count as documents of their own; a null id
is carried. An empty table gives no rows.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drayage.llm.cached import CHUNK, LETTER, REMEMBERED_BYTES, UNIT, Remembered, byte_encoder, byte_tokenizer, kept
from drayage.llm.frames import numbered
from drayage.llm.frames import pieces as slices
from drayage.llm.frames import stored
from drayage.llm.perfect import PerfectHash

BUCKETS = 128
#: Tables united or summed at once.
FAN_IN = 128
#: Pairs, with repeats over documents, that a task holds before it counts them, and different
#: ones before it sends them.
HELD_PAIRS = 1 << 21
SENT_PAIRS = 1 << 22
#: Most pairs whose counts are sent to all executors at once: 13 bytes each.
ROUND_PAIRS = 1 << 24
#: Ids of the second tokenizer, at most.
SECOND = 1 << 20

#: Bits for each number of a document.
LANE = 48

SPACE = "▁"


@dataclass(frozen=True, slots=True)
class Chunk:
    """A chunk's alignment: its groups as text and numbers, and the links as pair numbers of eight bytes."""

    n_a: int
    n_b: int
    n_groups: int
    groups: str
    links: bytes


class Aligner:
    """Aligns chunks by a byte-level BPE (A) and a BPE of pieces with word starts (B)."""

    def __init__(self, byte_file: str, piece_file: str):
        import sentencepiece

        tokenizer = byte_tokenizer(byte_file)
        self.first = byte_encoder(byte_file).make
        self.second = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        # Byte-level entries write the other bytes as the characters from 256 on.
        shown = {chr(b): b for b in plain} | {
            chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))
        }
        special = tokenizer.get_added_tokens_decoder()
        self.bytes_a = [b""] * tokenizer.get_vocab_size()
        for token, i in tokenizer.get_vocab().items():
            self.bytes_a[i] = token.encode() if i in special else bytes(shown[c] for c in token)
        sp = self.second
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        if len(pieces) > SECOND:
            raise ValueError("the second vocabulary is too large for pair numbers")
        if any("\n" in p or re.search(rf"[^\s{SPACE}][ {SPACE}]", p) for p in pieces):
            raise ValueError("pieces of the second vocabulary cross word starts")
        # Smaller units where no piece holds a stop or comma behind a letter either.
        self.unit = CHUNK if any(re.search(f"{LETTER}[.,]", p) for p in pieces) else UNIT
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)
        ]
        # A unit is encoded behind a line feed, which no piece holds, so that its first blank stays as it is.
        self.ahead = len(sp.encode("\n"))
        self.length_a, self.length_b = ([len(t) for t in tokens] for tokens in (self.bytes_a, self.bytes_b))
        self.sizes_a, self.sizes_b = (np.array(lengths, np.int64) for lengths in (self.length_a, self.length_b))

    def parts(self, texts: list[str]) -> list[list[str]]:
        return [self.unit.findall(" " + t) if t else [] for t in texts]

    def align(self, units: list[str], said: bool = True) -> list[Chunk | None]:
        """The alignment of each unit; None where the tokens do not give its bytes."""
        if not units:
            return []
        firsts = self.first(units)
        ahead = self.ahead
        seconds = [ids[ahead:] for ids in self.second.encode(["\n" + u for u in units], num_threads=1)]
        data = [u.encode() for u in units]
        return self._together(data, firsts, seconds, said) or [
            self._aligned(d, np.frombuffer(a, "<u4").tolist(), b, said) for d, a, b in zip(data, firsts, seconds)
        ]

    def links(self, units: list[str]) -> list[bytes | None]:
        """The links of each unit alone."""
        return [a and a.links for a in self.align(units, said=False)]

    def _together(self, data: list[bytes], firsts: list[bytes], seconds: list[list[int]], said: bool) -> list[Chunk] | None:
        """The alignments of all units at once, by where their tokens end in the units' bytes one behind the
        other; None if any unit's tokens do not give its bytes."""
        a = np.frombuffer(b"".join(firsts), "<u4").astype(np.int64)
        list_b = [*chain.from_iterable(seconds)]
        b = np.array(list_b, np.int64)
        whole = b"".join(data)
        bytes_a, bytes_b = self.bytes_a, self.bytes_b
        if b"".join([bytes_a[i] for i in a.tolist()]) != whole or b"".join([bytes_b[i] for i in list_b]) != whole:
            return None
        size_a, size_b = self.sizes_a[a], self.sizes_b[b]
        ends_a, ends_b = np.cumsum(size_a), np.cumsum(size_b)
        upto = np.cumsum([len(d) for d in data])
        upto_a, upto_b = np.cumsum([len(f) // 4 for f in firsts]), np.cumsum([len(x) for x in seconds])
        n_a, n_b = (np.diff(x, prepend=0) for x in (upto_a, upto_b))
        if min(n_a.min(), n_b.min(), size_a.min(), size_b.min()) < 1:
            return None
        if (ends_a[upto_a - 1] != upto).any() or (ends_b[upto_b - 1] != upto).any():
            return None
        ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        # Of each group the tokens of both, and of each token of A its links.
        last_a, last_b = np.searchsorted(ends_a, ends) + 1, np.searchsorted(ends_b, ends) + 1
        in_a, in_b = np.diff(last_a, prepend=0), np.diff(last_b, prepend=0)
        first_a, first_b = last_a - in_a, last_b - in_b
        each = np.repeat(in_b, in_a)
        at = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        links = (np.repeat(a, each) * SECOND + b[np.repeat(np.repeat(first_b, in_a), each) + at]).tobytes()
        upto_groups = np.searchsorted(ends, upto) + 1
        cuts = [0, *(8 * np.cumsum(in_a * in_b)[upto_groups - 1]).tolist()]
        groups = [""] * len(data)
        if said:
            texts_a, texts_b = [*map(str, a.tolist())], [*map(str, list_b)]
            texts = [
                (texts_a[i] if m == 1 else ",".join(texts_a[i : i + m])) + "|" + (texts_b[j] if n == 1 else ",".join(texts_b[j : j + n]))
                for i, m, j, n in zip(first_a.tolist(), in_a.tolist(), first_b.tolist(), in_b.tolist())
            ]
            edges = [0, *upto_groups.tolist()]
            groups = [";".join(texts[i:j]) for i, j in zip(edges, edges[1:])]
        n_groups = np.diff(upto_groups, prepend=0)
        return [
            Chunk(*numbers, text, links[i:j])
            for *numbers, text, i, j in zip(n_a.tolist(), n_b.tolist(), n_groups.tolist(), groups, cuts, cuts[1:])
        ]

    def _aligned(self, data: bytes, a: list[int], b: list[int], said: bool) -> Chunk | None:
        if b"".join([self.bytes_a[i] for i in a]) != data or b"".join([self.bytes_b[i] for i in b]) != data:
            return None
        length_a, length_b = self.length_a, self.length_b
        groups, links = [], []
        at_a = at_b = j = n = end_a = end_b = 0
        for i, token in enumerate(a, 1):
            end_a += length_a[token]
            while end_b < end_a:
                end_b += length_b[b[j]]
                j += 1
            if end_a == end_b:
                n += 1
                if i - at_a == 1 and j - at_b == 1:
                    links.append(token * SECOND + b[at_b])
                    if said:
                        groups.append(f"{token}|{b[at_b]}")
                else:
                    group_a, group_b = a[at_a:i], b[at_b:j]
                    links += [x * SECOND + y for x in group_a for y in group_b]
                    if said:
                        groups.append(f"{','.join(map(str, group_a))}|{','.join(map(str, group_b))}")
                at_a, at_b = i, j
        return Chunk(len(a), len(b), n, ";".join(groups), np.array(links, np.int64).tobytes())


def _bucket(pairs: np.ndarray) -> np.ndarray:
    """All pairs of an id of the first tokenizer share a bucket, which so knows the id's highest count."""
    return (pairs // SECOND) % BUCKETS


def _read(data: bytes, type_=np.int64) -> np.ndarray:
    return np.frombuffer(data, type_)


def _united(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, ascending, and the sum of each one's counts."""
    all_keys, all_counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(all_keys, kind="stable")
    all_keys = all_keys[order]
    starts = np.flatnonzero(np.r_[True, all_keys[1:] != all_keys[:-1]]) if len(all_keys) else np.zeros(0, np.int64)
    return all_keys[starts], np.add.reduceat(all_counts[order], starts) if len(starts) else np.zeros(0, np.int64)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    docs, names = numbered(docs)
    return docs.select(F.col(names[id_col]).alias("doc_id"), F.coalesce(F.col(names[text_col]).cast("string"), F.lit("")).alias("text"))


def linked_pairs(docs: DataFrame, byte_file: str, piece_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``bucket``, ``node``, ``keys`` and ``counts``: for each task the pairs it saw, ascending, and in
    how many of its documents each is linked."""

    def run(batches):
        aligner = kept("aligner", (byte_file, piece_file), lambda: Aligner(byte_file, piece_file))
        known = kept("aligned", (byte_file, piece_file), lambda: Remembered(aligner.links, 2 * REMEMBERED_BYTES, 240))
        node = TaskContext.get().partitionId()
        sums: list[tuple[np.ndarray, np.ndarray]] = []
        fresh: list[np.ndarray] = []

        def count():
            keys = np.concatenate(fresh) if fresh else np.zeros(0, np.int64)
            fresh.clear()
            different, counts = np.unique(keys, return_counts=True)
            sums[:] = [_united([k for k, _ in sums] + [different], [c for _, c in sums] + [counts.astype(np.int64)])]

        def send():
            keys, counts = sums.pop()
            buckets = _bucket(keys)
            order = np.argsort(buckets, kind="stable")
            edges = np.searchsorted(buckets[order], np.arange(BUCKETS + 1))
            spans = [order[edges[b] : edges[b + 1]] for b in range(BUCKETS)]
            full = [b for b in range(BUCKETS) if len(spans[b])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()), pa.array([node] * len(full), pa.int64()),
                 pa.array([keys[spans[b]].tobytes() for b in full], pa.binary()),
                 pa.array([counts[spans[b]].tobytes() for b in full], pa.binary())],
                ["bucket", "node", "keys", "counts"],
            )

        waiting = 0
        for batch in slices(batches, 128):
            parts = aligner.parts(batch.column(0).to_pylist())
            for of in known.values(parts):
                links = set(of)
                if links and None not in links:
                    fresh.append(np.unique(_read(b"".join(links))))
                    waiting += len(fresh[-1])
            if waiting > HELD_PAIRS:
                count()
                waiting = 0
                if len(sums[0][0]) > SENT_PAIRS:
                    yield from send()
        count()
        yield from send()

    texts = _texts(docs, id_col, text_col).select("text")
    return texts.mapInArrow(run, "bucket int, node long, keys binary, counts binary")


def _tree(tables: DataFrame, nodes: int, merge: Callable[[pa.Table], list], schema: str) -> DataFrame:
    """Merges the rows of each bucket, ``FAN_IN`` nodes at once, until one is left."""

    def step(key, table):
        values = merge(table)
        names = [f.split()[0] for f in schema.split(", ")]
        columns = [pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int64())]
        return pa.table([*columns, *[pa.array([v], pa.binary()) for v in values]], names)

    while True:
        nodes = -(-nodes // FAN_IN)
        grouped = tables.withColumn("node", F.floor(F.col("node") / FAN_IN).cast("long")).groupBy("bucket", "node")
        tables = grouped.applyInArrow(step, schema)
        if nodes <= 1:
            return tables


def pair_counts(pairs: DataFrame) -> DataFrame:
    """One row per bucket of ``pairs``: ``bucket``, ``n``, the hash (``sizes``, ``words``) and, at each
    pair's number, ``keys``, ``counts`` and ``best``, whether the count is its first id's highest."""
    nodes = (pairs.agg(F.max("node")).first()[0] or 0) + 1

    def unite(table):
        keys = [_read(k) for k in table["keys"].to_pylist()]
        return [_united(keys, keys)[0].tobytes()]

    def number(batches):
        for batch in batches:
            for bucket, data in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                keys = _read(data)
                hash_ = PerfectHash.of(keys)
                placed = np.empty_like(keys)
                placed[hash_.index(keys)] = keys
                values = [hash_.sizes.tobytes(), hash_.words.tobytes(), placed.tobytes()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket], pa.int32()), *[pa.array([v], pa.binary()) for v in values]], ["bucket", "sizes", "words", "keys"]
                )

    united = _tree(pairs.select("bucket", "node", "keys"), nodes, unite, "bucket int, node long, keys binary")
    hashes = stored(united.mapInArrow(number, "bucket int, sizes binary, words binary, keys binary"), "hashes")

    def fill(key, left, right):
        names = ["bucket", "node", "vector"]
        if not left.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int32(), pa.int64(), pa.binary())], names)
        hash_ = PerfectHash(_read(right["sizes"][0].as_py()), _read(right["words"][0].as_py(), "<u8"))
        placed = _read(right["keys"][0].as_py())
        vector = np.zeros(len(placed), np.int64)
        for keys, counts in zip(left["keys"].to_pylist(), left["counts"].to_pylist()):
            at = hash_.index(_read(keys))
            assert (placed[at] == _read(keys)).all()
            vector[at] += _read(counts)
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int64()), pa.array([vector.tobytes()], pa.binary())], names)

    # Each bucket's hash meets the tables of FAN_IN nodes at a time.
    groups = -(-nodes // FAN_IN)
    spread = hashes.select("*", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<bigint>")).alias("node"))
    dealt = pairs.withColumn("node", F.floor(F.col("node") / FAN_IN).cast("long"))
    vectors = dealt.groupBy("bucket", "node").cogroup(spread.groupBy("bucket", "node")).applyInArrow(fill, "bucket int, node long, vector binary")

    def add(table):
        return [np.sum([_read(v) for v in table["vector"].to_pylist()], axis=0).tobytes()]

    sums = _tree(vectors, groups, add, "bucket int, node long, vector binary") if groups > 1 else vectors

    def judge(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = _read(row["keys"]), _read(row["vector"])
                firsts, of = np.unique(keys // SECOND, return_inverse=True)
                highest = np.zeros(len(firsts), np.int64)
                np.maximum.at(highest, of, counts)
                small = counts.astype("<u4") if counts.max() < 1 << 32 else counts
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["bucket"]], pa.int32()), pa.array([len(keys)], pa.int64()),
                     *[pa.array([v.tobytes()], pa.binary()) for v in (_read(row["sizes"]), _read(row["words"]), _packed(keys), small, np.packbits(counts == highest[of]))]],
                    ["bucket", "n", "sizes", "words", "keys", "counts", "best"],
                )

    joined = hashes.join(sums.select("bucket", "vector"), "bucket")
    return stored(joined.mapInArrow(judge, "bucket int, n long, sizes binary, words binary, keys binary, counts binary, best binary"), "pair-counts")


def _packed(keys: np.ndarray) -> np.ndarray:
    """Five bytes for each pair number."""
    return keys.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :5].copy()


def _unpacked(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return wide.view("<i8").ravel()


class Counts:
    """Counts of pairs, of those buckets that ``rows`` hold."""

    def __init__(self, rows: list[tuple]):
        self.tables = {}
        for bucket, n, sizes, words, keys, counts, best in rows:
            counts = np.frombuffer(counts, "<u4" if len(counts) == 4 * n else "<i8")
            best = np.unpackbits(np.frombuffer(best, np.uint8), count=n)
            self.tables[bucket] = PerfectHash(_read(sizes), _read(words, "<u8")), _unpacked(keys), counts, best

    def of(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The count of each pair and whether it is its first id's highest; zeros for pairs of other buckets."""
        counts, best = np.zeros((2, len(pairs)), np.int64)
        buckets = _bucket(pairs)
        order = np.argsort(buckets, kind="stable")
        edges = np.searchsorted(buckets[order], np.arange(BUCKETS + 1))
        for bucket, (hash_, keys, held, highest) in self.tables.items():
            rows = order[edges[bucket] : edges[bucket + 1]]
            if len(rows):
                at = hash_.index(pairs[rows])
                known = keys[at] == pairs[rows]
                counts[rows[known]] = held[at[known]]
                best[rows[known]] = highest[at[known]]
        return counts, best


def alignments(docs: DataFrame, byte_file: str, piece_file: str, id_col: str = "doc_id", text_col: str = "text", round_pairs: int = ROUND_PAIRS) -> DataFrame:
    """One row per document: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``,
    ``count_sum`` and ``groups``, the ids of each group as ``a,a|b,b`` with ``;`` between groups."""
    pairs = stored(linked_pairs(docs, byte_file, piece_file, id_col, text_col), "pairs")
    tables = pair_counts(pairs)
    rounds: list[list[int]] = [[]]
    held = 0
    for bucket, n in sorted((r["bucket"], r["n"]) for r in tables.select("bucket", "n").collect()):
        if rounds[-1] and held + n > round_pairs:
            rounds.append([])
            held = 0
        rounds[-1].append(bucket)
        held += n
    texts = _texts(docs, id_col, text_col)
    schema = T.StructType([texts.schema["doc_id"]])
    for name in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"):
        schema = schema.add(name, "long")
    done = None
    for k, buckets in enumerate(rounds):
        table = tables.filter(F.col("bucket").isin(buckets)).select("bucket", "n", "sizes", "words", "keys", "counts", "best")
        rows = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in table.collect()])
        last = k == len(rounds) - 1
        done = _looked_up(texts if done is None else stored(done, "round"), rows, byte_file, piece_file, schema, done is None, last)
    return done


def _lanes(*numbers: int) -> int:
    """Six numbers side by side in one, so that one addition adds them all; the last may be of any size."""
    return sum(n << LANE * k for k, n in enumerate(numbers))


def _numbers(lanes: int) -> tuple[int, ...]:
    return (*(lanes >> LANE * k & (1 << LANE) - 1 for k in range(5)), lanes >> LANE * 5)


def _summed(aligner: Aligner, counts: Counts, units: list[str]) -> list[tuple[int, str] | None]:
    """The numbers of each unit, side by side, and its groups; None where the tokens do not give its bytes."""
    aligned = aligner.align(units)
    good = [a for a in aligned if a is not None]
    if not good:
        return aligned
    edges = np.cumsum([0, *[len(a.links) // 8 for a in good]])[:-1]
    held, best = counts.of(_read(b"".join([a.links for a in good])))
    sums = zip(np.add.reduceat(best, edges).tolist(), np.add.reduceat(held, edges).tolist())
    return [a and (_lanes(a.n_a, a.n_b, a.n_groups, len(a.links) // 8, *next(sums)), a.groups) for a in aligned]


def _looked_up(texts: DataFrame, rows, byte_file: str, piece_file: str, schema: T.StructType, first: bool, last: bool) -> DataFrame:
    """Aligns once more; adds the counts of this round to those of the rounds before."""

    # A worker keeps what it looked up in this round for its next tasks; it gives way to other rounds and passes.
    this = uuid.uuid4().hex

    def run(batches):
        aligner = kept("aligner", (byte_file, piece_file), lambda: Aligner(byte_file, piece_file))
        known = kept("aligned", (byte_file, piece_file, this), lambda: Remembered(partial(_summed, aligner, Counts(rows.value)), 2 * REMEMBERED_BYTES, 400))
        for batch in slices(batches, 128):
            plain = batch.column(1).to_pylist()
            parts = aligner.parts(plain)
            numbers, groups = [], []
            for of in known.values(parts):
                if not of or None in of:
                    numbers.append((0,) * 6)
                    groups.append(None)
                else:
                    packed, said = zip(*of)
                    numbers.append(_numbers(sum(packed)))
                    groups.append(";".join(said) if last else None)
            out = np.array(numbers, np.int64).reshape(-1, 6)
            if not first:
                out[:, 4:] += np.column_stack([np.asarray(batch.column(k)) for k in (2, 3)])
            columns = [pa.array(out[:, k]) for k in range(6)]
            if last:
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(groups, pa.string())], [*schema.names, "groups"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns[4:]], ["doc_id", "text", "n_best", "count_sum"])

    if last:
        return texts.mapInArrow(run, T.StructType(list(schema.fields)).add("groups", "string"))
    return texts.mapInArrow(run, T.StructType([schema["doc_id"]]).add("text", "string").add("n_best", "long").add("count_sum", "long"))
