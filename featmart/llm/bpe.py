"""Byte-level BPE by prefix dynamic programming.

A sequence of tokens is what the merges produce exactly if every two neighbours are what the merges
produce from their joined bytes. So each prefix of a byte string has one valid last token: the token
ending there that is compatible with the valid last token of the prefix before it. Storing that token
for every prefix gives the encoding of every prefix at once; bytes can be appended without touching
what is there, and after an edit only the prefixes near it are computed anew. The tokens that end at a
place are those of one state of an automaton over the bytes (Aho-Corasick), whose steps are worked out
when they are first taken.

The vocabulary is a rank file (base64 token and rank on each line) at a path that every machine can
read. Text is split by a pattern first; pieces are encoded separately and a task keeps the encodings
of up to twice ``CACHE`` distinct words (results do not depend on it).

Defined edge cases: a null text is empty and has no tokens; repeated rows are encoded each; ids that
the vocabulary does not have raise an error when decoded; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import struct
from array import array
from bisect import bisect_left
from collections.abc import Iterable
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featmart.llm.common import held

CACHE = 150_000  # distinct words remembered
PIECES_KEPT, STEMS, PAIRS = 50_000, 50_000, 200_000  # other pieces, beginnings of pieces and pairs of tokens remembered
STEPS = 200_000  # steps of the automaton remembered
LATIN_END = "\u0250"  # all letters below are letters to the pattern as well
STEM = 6  # bytes of a piece whose prefix table is shared with other pieces
LONG_TEXT = 1 << 20  # characters; longer texts are split piece by piece
PIECES = 1 << 16
#: The pattern that splits text before the merges (fixed value, public).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Vocabulary:
    """Byte tokens and their ranks, with the memo of which token pairs are compatible."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(t): int(r) for t, r in map(bytes.split, filter(None, f))}
        self.token = {r: t for t, r in self.rank.items()}
        self.longest = max(map(len, self.rank))
        self._ordered = sorted(self.rank)
        # states are beginnings of tokens: the longest one that the bytes so far end in
        self._begun, self._state_of = [b""], {b"": ROOT}
        self.ending: list[tuple[tuple[int, int], ...]] = [()]  # by state: length and rank of the tokens it ends in, longest first
        self.steps: dict[int, int] = {}  # by ``state << 8 | byte``
        self.pairs: dict[int, bool] = {}  # by ``left << 32 | right``
        self._pairs_before: dict[int, bool] = {}
        self._parts: dict[int, tuple[int, int] | None] = {}

    def _begins(self, data: bytes) -> bool:
        """Does a token begin with ``data``?"""
        i = bisect_left(self._ordered, data)
        return i < len(self._ordered) and self._ordered[i].startswith(data)

    def step(self, state: int, byte: int) -> int:
        """The state after one more byte."""
        key = state << 8 | byte
        known = self.steps.get(key)
        if known is None:
            if len(self.steps) >= STEPS:
                self.steps.clear()
            end = self._begun[state] + bytes((byte,))
            while end and end not in self._state_of and not self._begins(end):
                end = end[1:]
            known = self._state_of.get(end)
            if known is None:
                known = self._state_of[end] = len(self._begun)
                self._begun.append(end)
                suffixes = ((n, self.rank.get(end[-n:])) for n in range(len(end), 0, -1))
                self.ending.append(tuple((n, t) for n, t in suffixes if t is not None))
            self.steps[key] = known
        return known

    def state(self, data: bytes) -> int:
        """The state that ``data`` ends in."""
        state = ROOT
        for byte in data[-self.longest:]:
            state = self.step(state, byte)
        return state

    def merge(self, data: bytes, stop: int = 1) -> list[int]:
        """The definition: merge the neighbours of least rank, leftmost first, until none can be
        (or until ``stop`` tokens are left)."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > stop:
            ranked = [(self.rank.get(a + b), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            ranked = [x for x in ranked if x[0] is not None]
            if not ranked:
                break
            i = min(ranked)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.rank[p] for p in parts]

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the last merge of a token joins; None for a single byte."""
        if token not in self._parts:
            data = self.token[token]
            self._parts[token] = None if len(data) == 1 else tuple(self.merge(data, 2))
        return self._parts[token]

    def compatible(self, left: int, right: int) -> bool:
        """Do the merges turn the joined bytes of the two tokens into just these two?

        They do unless, at some moment, the two tokens at the border would have merged before the
        next of their own merges. The border is followed back in time: the later of the two tokens
        is taken apart, and ``limit`` is the rank up to which a merge over the border came first.
        """
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:  # ``pairs`` itself stays the same object
                self._pairs_before = self.pairs.copy()
                self.pairs.clear()
            known = self._pairs_before.get(key)
            if known is None:
                known = self._stay_apart(left, right)
            self.pairs[key] = known
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        token, rank, parts, limit = self.token, self.rank.get, self._parts, float("inf")
        while True:
            over = rank(token[left] + token[right])
            if over is not None and over < limit:
                return False
            a = parts[left] if left in parts else self.parts(left)
            b = parts[right] if right in parts else self.parts(right)
            if a is not None and (b is None or left > right):
                left, limit = a[1], left
            elif b is not None:
                right, limit = b[0], right + 1  # of equal ranks the one to the left merges first
            else:
                return True


START = -1  # stands for the empty prefix
ROOT = 0  # the state of no bytes


def _extend(vocab: Vocabulary, data: bytes, last: list[int], until: int, state: int) -> int:
    """Add the valid last tokens of the prefixes of ``data`` that end at ``len(last)`` to ``until``. ``state`` is that of
    the bytes before; returns that of the bytes up to ``until``."""
    step, known, ending = vocab.steps.get, vocab.pairs.get, vocab.ending
    for i in range(len(last), until + 1):
        before_byte = state << 8 | data[i - 1]
        state = step(before_byte)
        if state is None:
            state = vocab.step(before_byte >> 8, data[i - 1])
        for n, t in ending[state]:
            before = last[i - n]
            fits = before == START or known(before << 32 | t)
            if fits is None:
                fits = vocab.compatible(before, t)
            if fits:
                last.append(t)
                break
        else:
            raise ValueError(f"byte {data[i - 1]} is not in the vocabulary")
    return state


class PrefixTable:
    """The valid last token of every prefix of one byte string."""

    def __init__(self, vocab: Vocabulary, data: bytes = b""):
        self.vocab, self.data, self.last, self.state = vocab, b"", [START], ROOT
        self.append(data)

    def append(self, data: bytes) -> None:
        """Add bytes at the end; nothing before them changes."""
        self.data += data
        self.state = _extend(self.vocab, self.data, self.last, len(self.data), self.state)

    @classmethod
    def of(cls, vocab: Vocabulary, data: bytes, last: Iterable[int]) -> "PrefixTable":
        """The table of ``data`` whose last tokens are already known."""
        table = cls.__new__(cls)
        table.vocab, table.data, table.last, table.state = vocab, data, list(last), vocab.state(data)
        return table

    def replace(self, start: int, end: int, data: bytes) -> int:
        """Put ``data`` in place of ``[start, end)``; returns how many prefixes were computed anew.

        Prefixes up to ``start`` stay. Behind the new bytes the work stops as soon as as many
        prefixes in a row as the longest token has bytes end in the same token as before.
        """
        new = self.data[:start] + data + self.data[end:]
        shift, reach = len(data) - (end - start), self.vocab.longest
        last, same, i = self.last[:start + 1], 0, start + 1
        state = self.vocab.state(new[max(0, start - reach):start])
        while i <= len(new) and same < reach:
            state = _extend(self.vocab, new, last, i, state)
            behind = i >= start + len(data) + reach and i - shift >= end + reach
            same = same + 1 if behind and last[i] == self.last[i - shift] else 0
            i += 1
        last.extend(self.last[i - shift:])
        self.data, self.last, self.state = new, last, self.vocab.state(new)
        return i - start - 1

    def tokens(self, end: int | None = None) -> list[int]:
        """Encoding of the prefix that ends at ``end`` (default: of everything)."""
        i, out = len(self.data) if end is None else end, []
        while i:
            out.append(self.last[i])
            i -= len(self.vocab.token[self.last[i]])
        return out[::-1]


class _Memo(dict):
    """A bounded memo of a function of one short key. When it is full, the keys not used since it was
    last full are forgotten."""

    def __init__(self, make, size: int = CACHE):
        super().__init__()
        self.make, self.size, self.before = make, size, {}

    def __missing__(self, key):
        if len(self) >= self.size:
            self.before = dict(self)
            self.clear()
        out = self.before.pop(key, None)
        if out is None:
            out = self.make(key)
        if len(key) <= 64:
            self[key] = out
        return out


class _Words(_Memo):
    """Encodings of a space and what follows up to the next. A word of Latin letters, or one with a mark behind it, is
    told without the pattern and remembered; anything else is split by the pattern."""

    def __init__(self, encoder: "Encoder"):
        super().__init__(encoder._piece)
        self.encoder = encoder
        self.marks = {m: encoder._piece(m) for m in ".,;:!?" if m.encode() in encoder.vocab.rank}

    def __missing__(self, chunk: str) -> bytes:
        out = self.before.pop(chunk, None)
        if out is None:
            mark = self.marks.get(chunk[-1:])
            word = chunk if mark is None else chunk[:-1]
            if not word.isalpha() or not (word.isascii() or max(word) < LATIN_END):
                return self.encoder._split(" " + chunk)
            out = self.make(" " + chunk) if mark is None else self[word] + mark
        if len(chunk) <= 64:
            if len(self) >= self.size:
                self.before = dict(self)
                self.clear()
            self[chunk] = out
        return out


class Encoder:
    """Text to the bytes of its ids (little-endian unsigned 32-bit) and back."""

    def __init__(self, vocab: Vocabulary, pattern: str = PATTERN):
        self.vocab, self.pattern = vocab, regex.compile(pattern)
        self.stem = _Memo(self._stem, STEMS)
        self.piece = _Memo(self._piece, PIECES_KEPT)
        # a space followed by a non-space begins a piece of the public pattern, whatever went before
        self.by_space = pattern == PATTERN
        self.words = _Words(self)

    def _piece(self, piece: str) -> bytes:
        data = piece.encode()
        whole = self.vocab.rank.get(data)
        if whole is not None:
            return whole.to_bytes(4, "little")
        *last, state = self.stem[data[:STEM]]  # many pieces begin alike
        _extend(self.vocab, data, last, len(data), state)
        token, i, ids = self.vocab.token, len(data), []
        while i:
            ids.append(t := last[i])
            i -= len(token[t])
        ids.reverse()
        return struct.pack(f"<{len(ids)}I", *ids)

    def _stem(self, data: bytes) -> array:
        """Last tokens of all prefixes of ``data``, and the state it ends in."""
        table = PrefixTable(self.vocab, data)
        return array("i", [*table.last, table.state])

    def _split(self, text: str) -> bytes:
        if len(text) <= LONG_TEXT:
            return b"".join(map(self.piece.__getitem__, self.pattern.findall(text)))
        pieces, out = (m.group() for m in self.pattern.finditer(text)), []
        while part := list(islice(pieces, PIECES)):
            out.append(b"".join(map(self.piece.__getitem__, part)))
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        blank = WHITE[:6] if text.isascii() else WHITE
        if not self.by_space or any(w + " " in text for w in blank):
            return self._split(text)
        first, *chunks = text.split(" ")
        return self._split(first) + b"".join(map(self.words.__getitem__, chunks))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocab.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


#: Characters that the pattern counts as white space (fixed values), ASCII ones first.
WHITE = tuple(map(chr, (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
                        0x202F, 0x205F, 0x3000)))


class EditableText:
    """An encoded text that is appended to and edited; only pieces near a change are split anew."""

    LOOKBACK = 3  # pieces before a change whose match can have looked at it

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder, self.pieces, self.text = encoder, encoder.pattern.findall(text), text

    def append(self, text: str) -> None:
        self.replace(len(self.text), len(self.text), text)

    def replace(self, start: int, end: int, text: str) -> None:
        ends = np.cumsum([0, *map(len, self.pieces)])
        keep = max(0, int(np.searchsorted(ends, start, side="left")) - self.LOOKBACK)
        new = self.text[:start] + text + self.text[end:]
        shift, old = len(text) - (end - start), {int(e): k for k, e in enumerate(ends) if e >= end}
        pieces, at = self.pieces[:keep], int(ends[keep])
        for m in self.encoder.pattern.finditer(new, at):
            pieces.append(m.group())
            at = m.end()
            if at - shift in old and at >= start + len(text):
                pieces += self.pieces[old[at - shift]:]
                break
        self.pieces, self.text = pieces, new

    def tokens(self) -> list[int]:
        return np.frombuffer(b"".join(map(self.encoder.piece.__getitem__, self.pieces)), "<u4").tolist()


def encoder(path: str, pattern: str = PATTERN) -> Encoder:
    """The encoder for a rank file, loaded once in a process that does nothing else meanwhile."""
    return held(("bytes", path, pattern), lambda: Encoder(Vocabulary(path), pattern))


def _passed(docs: DataFrame, drop: str) -> tuple[list[str], str]:
    fields = [f for f in docs.schema if f.name != drop]
    return [f.name for f in fields], ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def encode(docs: DataFrame, path: str, text_col: str = "text", pattern: str = PATTERN,
           keep: tuple[str, ...] = ("doc_id",), round_trip: bool = False) -> DataFrame:
    """Columns of ``keep``, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit) of every row, and with
    ``round_trip`` also ``decoded``, the bytes that the ids stand for, from the same Python worker."""
    rows = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text_col}`").cast("string").alias("__text"))
    names, schema = _passed(rows, "__text")

    def run(batches):
        enc = encoder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [enc.encode(t or "") for t in part.column(len(names)).to_pylist()]
                out = [pa.array([enc.decode(x) for x in ids], pa.binary())] if round_trip else []
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), *out],
                    [*names, "n_tokens", "ids", *(["decoded"] if round_trip else [])])

    return rows.mapInArrow(run, f"{schema}, n_tokens long, ids binary" + (", decoded binary" if round_trip else ""))


def decode(encoded: DataFrame, path: str, pattern: str = PATTERN) -> DataFrame:
    """``encoded`` with a column ``decoded``: the bytes that the ``ids`` stand for."""
    names, schema = _passed(encoded, "decoded")
    where = names.index("ids")

    def run(batches):
        enc = encoder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = [None if x is None else enc.decode(x) for x in part.column(where).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], [*names, "decoded"])

    return encoded.select(*(F.col(f"`{c}`") for c in names)).mapInArrow(run, f"{schema}, decoded binary")
