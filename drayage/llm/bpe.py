"""Byte-level BPE encoding and decoding with a finite-state transducer.

The rank file is compiled into a nondeterministic transducer over bytes. Its
configurations are starts of a possible next token: a node of the trie of tokens, the
last token before the start, and the tokens up to it. Below nodes with few tokens, those of
them that may follow the last token stand for it, so starts that go on alike are one, and a
start that none may end is dropped at once. At each byte, at most one token
that ends there goes with the token before its start: two tokens may stand side by
side only if undoing their merges shows no merge across their border that comes
earlier. So each prefix has exactly one encoding, and its end becomes a start too.

The transducer is determinised while it runs: a state is the set of its
configurations, with the tokens that all of them share emitted and the rest kept as
residues. A residue is no longer than the tokens that can still change, so tokens come
out after a bounded look ahead. States and steps are remembered as they are met.

Decoding looks the bytes of each id up and feeds them to an incremental UTF-8 state
machine, which holds back an incomplete character until its last byte comes.

Both run inside Arrow batches, one text at a time, in tasks of their own; nothing is
shuffled. A null text counts as empty, an empty text has no ids, an empty table no
rows, and repeated rows or ids are encoded row by row. Other columns are not read.
"""

from __future__ import annotations

import base64
import codecs
import gc
import struct
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drayage.llm.frames import numbered, pieces

#: The words that a task remembers in each of two generations, of which the older one goes
#: when the younger one is full, its transitions, after which it starts anew, and what it
#: needs to make more transitions: moves of configurations, and pairs of tokens.
REMEMBERED_WORDS = 120_000
REMEMBERED_STEPS = 400_000
REMEMBERED_MOVES = 40_000
#: The tokens below a node of the trie, at most, that are tried at once with the token before.
FEW_TOKENS = 16


def read_ranks(lines: Iterator[bytes]) -> dict[bytes, int]:
    """The ranks of a file of lines ``base64 rank``."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """Tokens, how each is put together, and which pairs of them may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.trie: list[dict[int, int]] = [{}]
        self.token_at: list[int | None] = [None]
        self._goes: dict[tuple[int, int], bool] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1:
                parts = _merge(token, ranks, rank)
                if len(parts) != 2:
                    continue  # no merge ever makes this token
                self.halves[rank] = (ranks[parts[0]], ranks[parts[1]])
            self._insert(token, rank)
        for rank, token in self.bytes_of.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.merged[left, right] = rank
        # The tokens behind each node where they are few; a node has a higher number than those before it.
        self.below: list[tuple[int, ...] | None] = [()] * len(self.trie)
        for node in range(len(self.trie) - 1, -1, -1):
            behind: tuple[int, ...] | None = ()
            for child in self.trie[node].values():
                own = () if self.token_at[child] is None else (self.token_at[child],)
                if self.below[child] is None or len(behind + own + self.below[child]) > FEW_TOKENS:
                    behind = None
                    break
                behind += own + self.below[child]
            self.below[node] = behind

    def _insert(self, token: bytes, rank: int) -> None:
        node = 0
        for byte in token:
            nxt = self.trie[node].get(byte)
            if nxt is None:
                nxt = self.trie[node][byte] = len(self.trie)
                self.trie.append({})
                self.token_at.append(None)
            node = nxt
        self.token_at[node] = rank

    def side_by_side(self, left: int, right: int) -> bool:
        """Whether the encoding of the two tokens' bytes is just these two."""
        known = self._goes.get((left, right))
        if known is None:
            if len(self._goes) >= REMEMBERED_MOVES:
                self._goes.clear()
            known = self._goes[left, right] = self._no_merge_across(left, right)
        return known

    def _no_merge_across(self, left: int, right: int) -> bool:
        # Undo the later of the two tokens' last merges, again and again. A merge of the
        # pieces beside the border is due at its rank, while both pieces are there: until
        # the merge that takes the left piece in (``left_until``), or the right one.
        left_until = right_until = float("inf")
        while True:
            across = self.merged.get((left, right))
            # The left piece comes first in the text: at equal ranks the leftmost goes first.
            if across is not None and across < left_until and across <= right_until:
                return False
            l_halves, r_halves = self.halves.get(left), self.halves.get(right)
            if l_halves is None and r_halves is None:
                return True
            if r_halves is None or (l_halves is not None and left >= right):
                left_until, left = left, l_halves[1]
            else:
                right_until, right = right, r_halves[0]


def _merge(token: bytes, ranks: dict[bytes, int], below: int) -> list[bytes]:
    """Merge by rank, leftmost first, with the ranks before ``below`` only."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank >= below:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Transducer:
    """The transducer of a vocabulary, determinised as far as its input has led.

    A configuration is a trie node and what may end there: any token (None), those that go with
    the last token before the start (its number), or one of a few (a tuple). It has a number.
    A state maps each byte met to the tokens emitted and the next state; under ``_INSIDE`` it has
    its configurations and the residue of each, oldest start first. The last one is the start at
    the place reached.
    """

    def __init__(self, vocabulary: Vocabulary, remembered: int | None = None):
        self.vocabulary = vocabulary
        self.most = remembered or REMEMBERED_STEPS
        self.first: dict = {}
        self._forget()

    def _forget(self) -> None:
        if self.first:
            # States lead back to each other: without references they go, with the collector's help or not.
            for state in self.states.values():
                state.clear()
        self.configurations: list[tuple[int, int | tuple[int, ...] | None]] = [(0, None)]
        self.configuration_of: dict[tuple[int, int | tuple[int, ...] | None], int] = {(0, None): 0}
        self.starts: dict[int, int] = {}
        self.moves: dict[int, tuple[int, int]] = {}  # these can go while the states stay
        inside = ((0,), ((),))
        self.first = {_INSIDE: inside}
        self.states = {inside: self.first}
        self.steps = 0

    def encode(self, word: bytes) -> list[int]:
        """The ids of one match of the pattern."""
        if self.steps > self.most or len(self.configurations) > self.most:
            self._forget()
        state, out = self.first, []
        for byte in word:
            step = state.get(byte)
            if step is None:
                step = state[byte] = self._step(state[_INSIDE], byte)
            emitted, state = step
            if emitted:
                out += emitted
        out += state[_INSIDE][1][-1]
        return out

    def _step(self, inside: tuple, byte: int) -> tuple[tuple[int, ...], dict]:
        moves, alive, rests, token = self.moves, [], [], -1
        for configuration, rest in zip(*inside):
            move = moves.get(configuration << 8 | byte)
            if move is None:
                if len(moves) >= REMEMBERED_MOVES:
                    moves.clear()
                move = moves[configuration << 8 | byte] = self._move(configuration, byte)
            goes_on, ends = move
            if ends >= 0 and token < 0:
                ended, token = (*rest, ends), ends
            if goes_on >= 0:
                alive.append(goes_on)
                rests.append(rest)
        if token < 0:
            raise ValueError("the ranks lack a single byte")
        start = self.starts.get(token)
        if start is None:
            start = self.starts[token] = self._number(0, token)
        alive.append(start)
        rests.append(ended)
        # The residue of the oldest start is the shortest.
        emitted = rests[0]
        for rest in rests:
            if not emitted:
                break
            while rest[: len(emitted)] != emitted:
                emitted = emitted[:-1]
        if emitted:
            rests = [rest[len(emitted) :] for rest in rests]
        reached = (tuple(alive), tuple(rests))
        state = self.states.get(reached)
        if state is None:
            state = self.states[reached] = {_INSIDE: reached}
        self.steps += 1
        return emitted, state

    def _move(self, configuration: int, byte: int) -> tuple[int, int]:
        """The configuration after ``byte`` and the token that ends there, -1 for none."""
        v = self.vocabulary
        node, may = self.configurations[configuration]
        node = v.trie[node].get(byte)
        if node is None:
            return -1, -1
        token = v.token_at[node]
        if token is None or not (may is None or (token in may if isinstance(may, tuple) else v.side_by_side(may, token))):
            token = -1
        return self._number(node, may) if v.trie[node] else -1, token

    def _number(self, node: int, may: int | tuple[int, ...] | None) -> int:
        """The number of a configuration, -1 if no token can end behind ``node``."""
        below = self.vocabulary.below[node]
        if may is not None and below is not None:
            if isinstance(may, tuple):
                left = tuple([token for token in below if token in may])
            else:
                left = tuple([token for token in below if self.vocabulary.side_by_side(may, token)])
            if not left:
                return -1
            may = left if len(left) < len(below) else None
        number = self.configuration_of.get((node, may))
        if number is None:
            number = self.configuration_of[node, may] = len(self.configurations)
            self.configurations.append((node, may))
        return number


#: Where a state has its configurations; no byte.
_INSIDE = -1

_MARKS = ".,;:!?"


class Encoder:
    """Encodes texts, each match of the pattern separately, without special tokens.

    The pattern takes a single space to the word behind it, so the ids of what lies between two
    spaces are remembered, with the space before it.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, remembered: int | None = None):
        self.transducer = Transducer(Vocabulary(ranks), remembered and 2 * remembered)
        self.most = remembered or REMEMBERED_WORDS
        self.matches = regex.compile(pattern).findall
        self.spaced: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.marks = {mark: self._encode("", mark) for mark in _MARKS}

    def ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        first, *parts = text.split(" ")
        # Beside white space a match of the pattern may go across a space.
        if not _plain(first):
            return self._encode("", text)
        found = list(map(self.spaced.get, parts))
        if None in found:
            at = -1
            for _ in range(found.count(None)):
                at = found.index(None, at + 1)
                part = parts[at]
                if not _plain(part):
                    return self._encode("", text)
                # A mark behind letters is a match of its own.
                if part[-1] in _MARKS and part[:-1].isalpha():
                    found[at] = (self.spaced.get(part[:-1]) or self._spaced(part[:-1])) + self.marks[part[-1]]
                else:
                    found[at] = self._spaced(part)
        return self._encode("", first) + b"".join(found)

    def _spaced(self, part: str) -> bytes:
        ids = self.spaced.get(part)
        if ids is None:
            ids = self.older.get(part)
            if ids is None:
                ids = self._encode(" ", part)
            if len(part) <= 64:
                if len(self.spaced) >= self.most:
                    self.older, self.spaced = self.spaced, {}
                self.spaced[part] = ids
        return ids

    def _encode(self, space: str, part: str) -> bytes:
        # Of letters only, it is clear how the pattern matches.
        if part.isalpha():
            found = self.transducer.encode((space + part).encode())
        else:
            found = [i for match in self.matches(space + part) for i in self.transducer.encode(match.encode())]
        return struct.pack(f"<{len(found)}I", *found)


def _plain(part: str) -> bool:
    """Whether what lies between two spaces neither begins nor ends with white space, and is something."""
    return part != "" and not part[0].isspace() and not part[-1].isspace()


class Decoder:
    """Turns ids back into text as they come."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of

    def stream(self, ids: bytes, tokens: int = 256) -> Iterator[str]:
        """The text of ``ids`` in parts; a character cut by the end of a part comes in the next.
        Bytes that are no UTF-8 become U+FFFD."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        numbers = np.frombuffer(ids, "<u4").tolist()
        for at in range(0, len(numbers), tokens):
            yield machine.decode(b"".join([self.bytes_of[i] for i in numbers[at : at + tokens]]))
        yield machine.decode(b"", final=True)


def _worker_encoder(ranks_file: str, pattern: str, remembered: int | None = None) -> Encoder:
    """The encoder that this Python worker keeps between tasks, with what it remembers.

    It hangs on a module of its own, since this package's modules come to a worker by value,
    anew with each task.
    """
    kept = sys.modules.setdefault("drayage_llm_kept", types.ModuleType("drayage_llm_kept"))
    if getattr(kept, "encoder_of", None) != (ranks_file, pattern, remembered):
        with open(ranks_file, "rb") as lines:
            kept.encoder = Encoder(read_ranks(lines), pattern, remembered)
        # The small objects that are remembered are no garbage, and a collection looks at all of them.
        gc.set_threshold(100_000, 50, 50)
        kept.encoder_of = (ranks_file, pattern, remembered)
    return kept.encoder


def encode(docs: DataFrame, ranks_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and its token ids: ``ids`` as little-endian unsigned 32-bit integers, ``n_tokens``.

    ``ranks_file`` is installed wherever tasks run; it holds lines of a base64 token and its rank.
    """
    docs, names = numbered(docs)

    def run(batches):
        encoder = _worker_encoder(ranks_file, pattern)
        for piece in pieces(batches):
            ids = [encoder.ids(text or "") for text in piece.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64())],
                ["doc_id", "ids", "n_tokens"],
            )

    texts = docs.select(F.col(names[id_col]).alias("doc_id"), F.col(names[text_col]).cast("string").alias("text"))
    schema = T.StructType([texts.schema["doc_id"]]).add("ids", "binary").add("n_tokens", "long")
    return texts.mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks_file: str) -> DataFrame:
    """``encoded`` with the ``text`` of its ``ids`` in place of other columns but ``doc_id``."""

    def run(batches):
        with open(ranks_file, "rb") as lines:
            decoder = Decoder({rank: token for token, rank in read_ranks(lines).items()})
        for piece in pieces(batches):
            texts = ["".join(decoder.stream(ids or b"")) for ids in piece.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    ids = encoded.select("doc_id", "ids")
    return ids.mapInArrow(run, T.StructType([ids.schema["doc_id"]]).add("text", "string"))


def with_ids(docs: DataFrame, ranks_file: str, pattern: str, text_col: str = "text", remembered: int = 60_000) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids`` and ``intact``, whether decoding the ids gives the text,
    in place of the text. Columns of these names must not be there before. A task remembers twice
    ``remembered`` words and as many transitions, in about 100 MB; fewer cost time only."""
    others = [c for c in docs.columns if c != text_col]
    texts = docs.select(*others, F.col(text_col).cast("string").alias(text_col))

    def run(batches):
        encoder = _worker_encoder(ranks_file, pattern, remembered)
        decoder = Decoder(encoder.transducer.vocabulary.bytes_of)
        for piece in pieces(batches, 128):
            plain = [t or "" for t in piece.column(piece.num_columns - 1).to_pylist()]
            ids = [encoder.ids(t) for t in plain]
            intact = ["".join(decoder.stream(i)) == t for i, t in zip(ids, plain)]
            yield pa.RecordBatch.from_arrays(
                [*piece.columns[:-1], pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(intact)],
                [*others, "n_tokens", "ids", "intact"],
            )

    schema = T.StructType([texts.schema[c] for c in others])
    return texts.mapInArrow(run, schema.add("n_tokens", "long").add("ids", "binary").add("intact", "boolean"))


def round_trip(docs: DataFrame, ranks_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_tokens``, ``ids`` and ``decoded``, the UTF-8 bytes
    of the text decoded from the ids, in one pass over the text."""
    docs, names = numbered(docs)

    def run(batches):
        encoder = _worker_encoder(ranks_file, pattern)
        decoder = Decoder(encoder.transducer.vocabulary.bytes_of)
        for piece in pieces(batches, 128):
            ids = [encoder.ids(text or "") for text in piece.column(1).to_pylist()]
            decoded = ["".join(decoder.stream(i)).encode() for i in ids]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()),
                 pa.array(decoded, pa.binary())],
                ["doc_id", "n_tokens", "ids", "decoded"],
            )

    texts = docs.select(F.col(names[id_col]).alias("doc_id"), F.col(names[text_col]).cast("string").alias("text"))
    schema = T.StructType([texts.schema["doc_id"]]).add("n_tokens", "long").add("ids", "binary").add("decoded", "binary")
    return texts.mapInArrow(run, schema)
