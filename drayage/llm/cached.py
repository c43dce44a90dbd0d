"""Encoding of texts in chunks that no token crosses, remembered per task within a memory bound.

A chunk ends where a character that is no white space is followed by a blank or a line feed. A
byte-level BPE pattern never matches across such a place, and no piece of a vocabulary with word
starts does, so chunks are encoded apart and words met before are looked up.
"""

from __future__ import annotations

import gc
import re
import struct
import sys
import types
from collections.abc import Callable, Iterable

import numpy as np

CHUNK = re.compile(r"\s*\S+(?:[^\S \n]\s*\S*)*|\s+")

LETTER = "[A-Za-zÀ-ÖØ-öø-ÿ]"
#: Smaller units for a byte-level pattern alone: it also parts letters from a stop or comma at a
#: chunk's end, and a single line feed from the letters behind it.
UNIT = re.compile(rf" ?{LETTER}+(?=[.,]?(?:[ \n]|\Z))|[.,](?=[ \n]|\Z)|\n(?={LETTER})|" + CHUNK.pattern)

#: A unit that keeps its tokens between line feeds.
_PLAIN = re.compile(r" ?\S(?:[^\n]*\S)?")

#: A unit whose only white space is the blank that it begins with.
_SPACED = re.compile(r" \S+")

#: What chunks hold in memory, as estimated, before the older half is forgotten.
REMEMBERED_BYTES = 64 << 20


class Remembered:
    """Values of chunks, made by ``make(chunks)`` for those not known yet.

    Chunks asked for recently are kept in two generations of ``most`` estimated bytes each;
    forgetting costs time only.
    """

    def __init__(self, make: Callable[[list[str]], Iterable], most: int = REMEMBERED_BYTES, each: int = 160):
        self.make, self.most, self.each = make, most, each
        self.known: dict[str, object] = {}
        self.older: dict[str, object] = {}
        self.held = 0

    def _age(self) -> None:
        self.older, self.known, self.held = self.known, {}, 0

    def of(self, parts: list[list[str]]) -> dict[str, object]:
        """A map that holds the value of every chunk of ``parts``, until the next call."""
        if self.held > self.most:
            self._age()
        known = self.known
        wanted = set().union(*parts).difference(known)
        fresh = []
        for chunk in wanted:
            value = self.older.get(chunk)
            if value is None:
                fresh.append(chunk)
            else:
                known[chunk] = value
        known.update(zip(fresh, self.make(fresh)))
        self.held += sum(map(len, wanted)) * 4 + self.each * len(wanted)
        return known

    def values(self, parts: list[list[str]]) -> list[list]:
        """The values of the chunks of each of ``parts``; chunks known are asked for only once."""
        if self.held > self.most:
            self._age()
        get = self.known.get
        found = [list(map(get, chunks)) for chunks in parts]
        missing = []
        for values in found:
            at, places = -1, []
            for _ in range(values.count(None)):
                at = values.index(None, at + 1)
                places.append(at)
            missing.append(places)
        known = self.of([[chunks[k] for k in places] for chunks, places in zip(parts, missing)])
        for chunks, values, places in zip(parts, found, missing):
            for k in places:
                values[k] = known[chunks[k]]
        return found


def kept(name: str, key: tuple, make: Callable[[], object]):
    """What ``make`` gave for ``key`` in an earlier task of this Python worker, or now.

    It hangs on a module of its own, since this package's modules come to a worker by value,
    anew with each task.
    """
    held = sys.modules.setdefault("drayage_llm_kept", types.ModuleType("drayage_llm_kept"))
    if getattr(held, name, (None,))[0] != key:
        # What was held goes first, or both would take their memory at once.
        setattr(held, name, (None,))
        setattr(held, name, (key, make()))
        # The small objects that are remembered are no garbage, and a collection looks at all of them.
        gc.set_threshold(100_000, 50, 50)
    return getattr(held, name)[1]


def byte_tokenizer(path: str):
    """The byte-level BPE of a ``tokenizers`` file; strings of its special tokens are plain text."""
    import os

    # Tasks already take all cores.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def byte_encoder(path: str, most: int = REMEMBERED_BYTES) -> Remembered:
    """Ids of units, as little-endian unsigned 32-bit integers, by the tokenizer of ``path``."""
    tokenizer = byte_tokenizer(path)
    line_feed = tokenizer.encode("\n", add_special_tokens=False).ids

    # A byte-level entry has a character for each byte.
    lengths = np.zeros(tokenizer.get_vocab_size(), np.int64)
    for token, i in tokenizer.get_vocab().items():
        lengths[i] = len(token)

    def encode(units: list[str]) -> list[bytes]:
        # Many units go in one call. Where each begins with its only white space, a blank, one ends where
        # the next blank is.
        found = {}
        spaced = [u for u in units if _SPACED.fullmatch(u)]
        given = [spaced[at : at + 256] for at in range(0, len(spaced), 256)]
        lists = ["".join(some) for some in given]
        for some, text, of in zip(given, lists, tokenizer.encode_batch_fast(lists, add_special_tokens=False)):
            ids = np.array(of.ids, "<u4")
            ends = np.cumsum(lengths[ids])
            blanks = np.flatnonzero(np.frombuffer(text.encode(), np.uint8) == 32)[1:]
            cuts = np.searchsorted(ends, blanks)
            if not (ends[cuts] == blanks).all():
                raise ValueError("a token lies across a blank behind a character")
            data, cuts = ids.tobytes(), (4 * cuts + 4).tolist()
            found.update(zip(some, [data[at:end] for at, end in zip([0, *cuts], [*cuts, len(data)])], strict=True))
        if len(found) == len(units):
            return list(found.values())
        # A single line feed between two of the others is a token of its own, unless white space touches
        # it that the unit has not got in that place by itself.
        plain = [u for u in units if u not in found and _PLAIN.fullmatch(u)] if len(line_feed) == 1 else []
        given = [plain[at : at + 256] for at in range(0, len(plain), 256)]
        for some, of in zip(given, tokenizer.encode_batch_fast(["\n".join(some) for some in given], add_special_tokens=False)):
            ids = np.array(of.ids, "<u4")
            data, ends = ids.tobytes(), (4 * np.flatnonzero(ids == line_feed[0])).tolist()
            found.update(zip(some, [data[at:end] for at, end in zip([0, *[end + 4 for end in ends]], [*ends, len(data)])], strict=True))
        rest = [u for u in units if u not in found]
        for unit, of in zip(rest, tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            found[unit] = struct.pack(f"<{len(of.ids)}I", *of.ids)
        return [found[u] for u in units]

    return Remembered(encode, most)
