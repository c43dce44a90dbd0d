"""SimHash near-dedup with a Gray-order hierarchical index.

A fingerprint has a bit set where more than half of the hashes of a text's shingles have
it set. Fingerprints that differ in at most ``DISTANCE`` bits are linked, and linked
documents form components.

Of the 64 bits, ``DISTANCE + 1`` segments are made: two linked fingerprints agree on one
segment at least. For each segment, the fingerprints that share its bits are a top node of
the index. Below it they are sorted by the Gray rank of the remaining bits, which puts
codes with shared bit patterns side by side, and groups of neighbours become nodes with the
bits that all of the group share (a mask and their values), level upon level. A search for
pairs goes down from pairs of upper nodes: the shared bits that differ add up, and a pair
of nodes is dropped as a whole once they exceed the distance; a pair whose other bits are
too few to exceed it is linked as a whole.

Copies fall together before the index is built, so it holds different fingerprints only. A
top node with more than ``NODE_CODES`` codes is split once more in the same way by its
remaining bits, again and again, so none grows with the data. What a node finds leaves it
as a forest, with fewer links than codes, not as pairs.

A null text counts as empty; texts without words have the fingerprint zero and link like
any other. A null id is never smaller than others and is the component of rows whose ids
are all null. Rows repeated are documents of one component. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drayage.llm.components import components
from drayage.llm.frames import numbered, pieces
from drayage.session import materialized

#: Most differing bits of linked fingerprints.
DISTANCE = 4
SHINGLE_WORDS = 4
SEED = 42
#: Codes below a top node of the index before it is split, and children of an inner node.
NODE_CODES = 50_000
FANOUT = 8

_SHIFTS = np.arange(63, -1, -1, dtype=np.uint64)


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """The SimHash of the word shingles of a UTF-8 text, as an unsigned number."""
    found = text.lower().split()  # bytes: A-Z and the six white space characters only
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    if len(found) <= words:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        digest = xxhash.xxh64_intdigest
        starts = [0, *(ends[: len(found) - words] + 1).tolist()]
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[words - 1 :].tolist())]
    codes = np.array(hashes, np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(codes), 65_536):
        part = codes[at : at + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(codes)).view(">u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``code``, the fingerprint as a signed 64-bit number, for each row."""
    docs, names = numbered(docs)

    def run(batches):
        for piece in pieces(batches):
            texts = piece.column(1).cast(pa.binary()).to_pylist()
            codes = np.array([fingerprint(t or b"") for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(codes)], ["doc_id", "code"])

    texts = docs.select(F.col(names[id_col]).alias("doc_id"), F.col(names[text_col]).cast("string").alias("text"))
    return texts.mapInArrow(run, T.StructType([texts.schema["doc_id"]]).add("code", "long"))


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``code`` and ``component_id``, the smallest
    id among all documents that a chain of links reaches."""
    coded = materialized(fingerprints(docs, id_col, text_col), "fingerprints")
    firsts = materialized(coded.groupBy("code").agg(F.min("doc_id").alias("first")), "codes")
    roots = components(links(firsts.select("code")))
    # The smallest id of each component: codes with their root, then one row for each root.
    rooted = firsts.join(roots, F.col("code") == F.col("node"), "left").select(
        "code", "first", F.coalesce("root", "code").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(smallest, "root").select(F.col("code").alias("of"), "component_id")
    return coded.join(named, F.col("code") == F.col("of")).select("doc_id", "code", "component_id")


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all columns: of each component the row with its
    smallest id, the one with the smallest text hash where that id is repeated."""
    found = near_components(docs, id_col, text_col)
    heads = found.filter("doc_id <=> component_id").select("doc_id").distinct()
    plain, names = numbered(docs)
    kept = plain.join(heads, plain[names[id_col]].eqNullSafe(heads["doc_id"]), "left_semi")
    one = Window.partitionBy(names[id_col]).orderBy(F.xxhash64(names[text_col]), *sorted(names.values()))
    return (
        kept.withColumn("place", F.row_number().over(one)).filter("place = 1").drop("place").toDF(*docs.columns)
    )


def links(codes: DataFrame, distance: int = DISTANCE, node_codes: int = NODE_CODES) -> DataFrame:
    """Links ``a``, ``b`` between the different ``code`` values within ``distance`` bits; not every
    pair, but each such pair lies in one connected part."""
    split = _segments(list(range(63, -1, -1)), distance + 1)
    keyed = codes.select("code", F.explode(F.array(*[
        F.struct(F.lit(str(n)).alias("path"), _bits("code", bits).alias("value")) for n, bits in enumerate(split)
    ])).alias("key")).select("code", "key.*")
    free = {str(n): [b for b in range(63, -1, -1) if b not in bits] for n, bits in enumerate(split)}
    found, names = None, ["path", "value"]
    while True:
        # Top nodes that are too large go on to the next split, all others are searched.
        sizes = keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
        large = materialized(sizes.filter(F.col("n") > node_codes).drop("n"), "large")
        here = _search(keyed.join(large, names, "left_anti"), names, distance)
        found = here if found is None else found.union(here)
        if large.isEmpty():
            return found
        keyed = keyed.join(large, names)
        longer, options = {}, []
        for path, bits in free.items():
            for n, part in enumerate(_segments(bits, distance + 1)):
                longer[f"{path}.{n}"] = [b for b in bits if b not in part]
                options.append(
                    F.when(F.col("path") == path, F.struct(
                        F.lit(f"{path}.{n}").alias("path"), _bits("code", part).alias("value")
                    ))
                )
        level = f"value{len(names)}"
        keyed = keyed.select(
            "code", *[F.col(c).alias(f"v_{c}") if c == "path" else F.col(c) for c in names],
            F.explode(F.array_compact(F.array(*options))).alias("key"),
        ).select("code", F.col("key.path").alias("path"), *names[1:], F.col("key.value").alias(level))
        names, free = [*names, level], longer


def _segments(bits: list[int], parts: int) -> list[list[int]]:
    size = math.ceil(len(bits) / parts)
    return [bits[i : i + size] for i in range(0, len(bits), size)]


def _bits(column: str, bits: list[int]):
    """The given bits of a number, all others zero."""
    mask = sum(1 << b for b in bits)
    return F.col(column).bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


def _search(keyed: DataFrame, names: list[str], distance: int) -> DataFrame:
    """Sorts the codes of each top node by Gray rank and links what lies near each other."""

    def run(batches):
        key, held = None, []
        for batch in batches:
            codes = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(codes):
                continue
            group = batch.column(1).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            for s, e in zip(starts, np.r_[starts[1:], len(group)]):
                if group[s] != key and held:
                    yield from found(np.concatenate(held))
                    held = []
                key = group[s]
                held.append(codes[s:e])
        if held:
            yield from found(np.concatenate(held))

    def found(codes):
        if len(codes) > 1:
            a, b = forest(codes, distance)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    partitions = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Two top nodes that share a hash are searched as one, which adds comparisons and no links.
    hashed = keyed.select("code", F.xxhash64(*names).alias("node"))
    dealt = hashed.repartition(partitions, "node").sortWithinPartitions("node")
    return dealt.mapInArrow(run, "a long, b long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the order of the reflected binary Gray code."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _count(bits: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits).astype(np.int64)


def levels(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The index over codes in Gray order: for each level, leaves first, the masks of the bits
    that the codes below a node share and the values of those bits."""
    full = np.uint64(0xFFFF_FFFF_FFFF_FFFF)
    out = [(np.full(len(codes), full), codes)]
    while len(out[-1][0]) > 1:
        masks, values = out[-1]
        starts = np.arange(0, len(masks), FANOUT)
        ones = np.bitwise_and.reduceat(values | ~masks, starts)
        zeros = np.bitwise_and.reduceat(~values | ~masks, starts)
        shared = np.bitwise_and.reduceat(masks, starts) & (ones | zeros)
        out.append((shared, ones & shared))
    return out


def forest(codes: np.ndarray, distance: int, at_once: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all codes that chains of differences up to ``distance`` join."""
    codes = codes[np.argsort(gray_rank(codes), kind="stable")]
    index = levels(codes)
    parent = np.arange(len(codes))
    todo = [(len(index) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while todo:
        level, left, right = todo.pop()
        if len(left) > at_once:
            half = len(left) // 2
            todo += [(level, left[:half], right[:half]), (level, left[half:], right[half:])]
            continue
        masks, values = index[level]
        both = masks[left] & masks[right]
        differ = _count((values[left] ^ values[right]) & both)
        near = differ <= distance
        left, right, both, differ = left[near], right[near], both[near], differ[near]
        # Bits that are not shared are too few to part any two codes of such nodes.
        sure = differ + _count(~both) <= distance
        _join(parent, *_leaves(left[sure], right[sure], level, len(codes)))
        left, right = left[~sure], right[~sure]
        if level and len(left):
            todo.append((level - 1, *_children(left, right, len(index[level - 1][0]))))
    roots = _roots(parent)
    moved = np.flatnonzero(roots != np.arange(len(codes)))
    return codes[moved], codes[roots[moved]]


def _children(left: np.ndarray, right: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of children of pairs of nodes, each once."""
    a, b = (x.ravel() for x in np.meshgrid(np.arange(FANOUT), np.arange(FANOUT), indexing="ij"))
    left = (left[:, None] * FANOUT + a).ravel()
    right = (right[:, None] * FANOUT + b).ravel()
    due = (left <= right) & (right < nodes)
    return left[due], right[due]


def _leaves(left: np.ndarray, right: np.ndarray, level: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links from the first code of ``left`` to every code below both nodes."""
    if not len(left):
        return left, right
    width = FANOUT**level
    steps = np.arange(width)
    first = np.repeat(left * width, 2 * width)
    others = np.concatenate([left[:, None] * width + steps, right[:, None] * width + steps], axis=1).ravel()
    due = others < n
    return first[due], others[due]


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent[:] = up


def _join(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the sets of each ``a`` and ``b``; a root is the first code of its set."""
    while len(a):
        roots = _roots(parent)
        ra, rb = roots[a], roots[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        due = low != high
        if not due.any():
            return
        a, b = low[due], high[due]
        np.minimum.at(parent, b, a)
