"""Spelling variants: words one edit apart, found by Bloom-guided neighbourhoods.

The vocabulary is counted over all texts. Every word generates its deletions, and the replacements by a greater
letter (so that a pair is generated once); each is tried against the blocked Bloom filter of the vocabulary of its
length, which is broadcast within a fixed bound (:mod:`featmart.llm.blooms`). Only what the filters let through is
shuffled, to an exact join with the vocabulary that removes the false positives. An edit costs a few operations
whatever the word's length: the hash is a polynomial in the letters, of which the edit changes one term or shifts
the tail.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featmart.llm import blooms
from featmart.llm.common import LOWER, Block, blocks, byte_set, id_text, mix64, stored

#: Code points and occurrences that make a run a word.
MIN_LETTERS, MIN_COUNT = 5, 3
#: A word is a variant of a near word that is at least this many times as frequent.
TIMES = 2
#: One in so many occurrences loses a letter.
THINNED = 97
#: Words probed by one task, and the shard of all words of that length or more.
WORDS_A_TASK, LONGEST = 20_000, 64

_LEAD = 0xC3  # first byte of U+00C0 to U+00FF
_LETTER = byte_set((0x41, 0x5A), (0x61, 0x7A), (_LEAD, _LEAD))
_VECTOR = 64  # bytes of a word whose crc is computed beside others

_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1).astype(np.uint32)

_B = 0x9E3779B97F4A7C15
_B_INV = np.uint64(pow(_B, -1, 1 << 64))
_T = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))


def _crc(data: np.ndarray, start: np.ndarray, size: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """crc32 of each byte range, continued from ``seed``."""
    order = np.argsort(-size, kind="stable")
    at, left, state = start[order], size[order], seed[order] ^ np.uint32(0xFFFFFFFF)
    short = int(np.searchsorted(-left, -_VECTOR))  # the first ranges are longer
    for k in range(short):
        state[k] = zlib.crc32(data[at[k]:at[k] + left[k]].tobytes(), int(state[k]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    sizes = -left[short:]
    for j in range(min(_VECTOR, int(left[short]) if short < len(left) else 0)):
        m = short + int(np.searchsorted(sizes, -j))
        now = state[short:m]
        state[short:m] = _CRC[(now ^ data[at[short:m] + j]) & np.uint32(0xFF)] ^ (now >> np.uint32(8))
    out = np.empty_like(state)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def _block_words(block: Block) -> pa.Array:
    """The words of a block's texts, one letter deleted from those occurrences that the crc chooses."""
    data = block.data
    letter = _LETTER[data]
    tail = np.zeros(len(data), dtype=bool)
    tail[1:] = data[:-1] == _LEAD
    letter |= tail
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[block.offsets] = True
    first = letter.copy()
    first[1:] &= ~letter[:-1] | edge[1:-1]
    last = letter.copy()
    last[:-1] &= ~letter[1:] | edge[1:-1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    points = np.zeros(len(data) + 1, dtype=np.int64)  # code points before each byte, counted by their first bytes
    np.cumsum(letter & ~tail, out=points[1:])
    letters = points[end] - points[start]
    long = letters >= MIN_LETTERS
    start, end, letters = start[long], end[long], letters[long]
    low = LOWER[data]
    ids = block.rows.column(block.rows.schema.get_field_index("doc_id")).to_pylist()
    seeds = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], dtype=np.uint32)
    h = _crc(low, start, end - start, seeds[np.searchsorted(block.offsets, start, side="right") - 1])
    chosen = h % np.uint32(THINNED) == 0
    where = np.flatnonzero(letter & ~tail)
    cut = where[points[start[chosen]] + (h[chosen] % letters[chosen]).astype(np.int64)]
    keep = np.zeros(len(data) + 1, dtype=np.int32)
    enough = ~chosen | (letters > MIN_LETTERS)
    np.add.at(keep, start[enough], 1)
    np.add.at(keep, end[enough], -1)
    inside = np.cumsum(keep[:-1], dtype=np.int32).astype(bool)
    inside[cut] = False
    two = cut[data[cut] == _LEAD] + 1
    inside[two] = False
    size = (end - start).astype(np.int64)
    size[chosen] -= 1 + (data[cut] == _LEAD)
    offsets = np.zeros(int(enough.sum()) + 1, dtype=np.int64)
    np.cumsum(size[enough], out=offsets[1:])
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(low[inside]))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, limit=2 << 20):
        found = _block_words(block)
        if len(found):
            counted = pc.value_counts(found)
            yield pa.record_batch([counted.field("values").cast(pa.string()), counted.field("counts")], names=["word", "n"])


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n, letters`` of all words of at least ``MIN_LETTERS`` code points and ``MIN_COUNT`` occurrences, stored."""
    found = id_text(docs, id_col, text_col).where("text is not null").mapInArrow(_count, "word string, n long")
    counted = found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)
    return stored(counted.select("word", "n", F.char_length("word").alias("letters")), "vocabulary")


def _shard(letters: int) -> int:
    return min(letters, LONGEST)


def _by_length(col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(rows, letters)`` of the words of each length: which they are, and their code points as a matrix."""
    col = col.cast(pa.large_binary())
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(col.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    lead = raw == _LEAD
    kept = np.concatenate(([0], np.cumsum(~lead)))
    codes = raw[~lead]
    codes = np.where(codes >= 0x80, codes + 0x40, codes).astype(np.uint8)
    first = kept[offsets - offsets[0]]
    sizes = np.diff(first)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, codes[first[at][:, None] + np.arange(size)]


def _powers(n: int) -> np.ndarray:
    p = np.full(n, np.uint64(_B), dtype=np.uint64)
    p[:1] = 1
    return np.cumprod(p, dtype=np.uint64)


def _strings(codes: np.ndarray) -> pa.Array:
    """Rows of code points below 256 as strings."""
    flat = codes.ravel()
    wide = flat >= 0x80
    at = np.concatenate(([0], np.cumsum(1 + wide)))
    out = np.empty(at[-1], np.uint8)
    out[at[:-1]] = np.where(wide, _LEAD, flat)
    out[at[:-1][wide] + 1] = flat[wide] - 0x40
    return pa.LargeStringArray.from_buffers(len(codes), pa.py_buffer(at[::codes.shape[1]].astype(np.int64)), pa.py_buffer(out)).cast(pa.string())


def _deletions(codes: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words less one letter, and which are new: of equal neighbours only the last is deleted."""
    before = np.cumsum(terms, axis=1, dtype=np.uint64)
    h = (before - terms) + (before[:, -1:] - before) * _B_INV
    new = np.ones(codes.shape, dtype=bool)
    new[:, :-1] = codes[:, :-1] != codes[:, 1:]
    return h, new


def _probe(filters: dict, alphabet: list[int]):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = {}

        def maybe(size: int, h: np.ndarray) -> np.ndarray:
            shard = _shard(size)
            if shard not in filters:
                return np.zeros(h.shape, dtype=bool)
            if shard not in bits:
                bits[shard] = filters[shard].value
            return blooms.hit(bits[shard], mix64(h))

        for batch in batches:
            words, counts = batch.column(0), batch.column(1)
            for at, all_codes in _by_length(words):
                size = all_codes.shape[1]
                power = _powers(size)
                step = max(1, (1 << 16) // size)
                for a in range(0, len(at), step):
                    codes, mine = all_codes[a:a + step], at[a:a + step]
                    terms = _T[codes] * power
                    whole = terms.sum(axis=1, dtype=np.uint64)
                    found = []
                    if size > MIN_LETTERS:
                        h, new = _deletions(codes, terms)
                        row, pos = np.nonzero(maybe(size - 1, h) & new)
                        if len(row):
                            left = np.ones((len(row), size), dtype=bool)
                            left[np.arange(len(row)), pos] = False
                            found.append((row, codes[row][left].reshape(len(row), size - 1)))
                    for c in alphabet:
                        row, pos = np.nonzero(codes < c)
                        h = whole[row] + (_T[c] - _T[codes[row, pos]]) * power[pos]
                        good = maybe(size, h)
                        row, pos = row[good], pos[good]
                        if len(row):
                            other = codes[row]
                            other[np.arange(len(row)), pos] = c
                            found.append((row, other))
                    for row, other in found:
                        take = pa.array(mine[row])
                        yield pa.record_batch([words.take(take), counts.take(take), _strings(other)], names=["word", "n", "near"])

    return probe


def _filters(words: DataFrame) -> dict:
    sizes = {r["s"]: r["n"] for r in words.groupBy(F.least("letters", F.lit(LONGEST)).alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()}
    per = blooms.blocks_for(sizes)  # one entry a length, LONGEST at most

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, codes in _by_length(batch.column(0)):
                size = codes.shape[1]
                whole = (_T[codes] * _powers(size)).sum(axis=1, dtype=np.uint64)
                yield blooms.rows(_shard(size), mix64(whole), per[_shard(size)])

    return blooms.build(words.select("word").mapInArrow(add, blooms.ROWS), per)


def near_pairs(words: DataFrame) -> DataFrame:
    """``word, n, near, m``: each pair of a :func:`vocabulary` that differs by exactly one inserted, deleted or replaced
    code point, once, with both counts."""
    n = words.count()
    alphabet = sorted(ord(r["c"]) for r in words.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").distinct().collect())
    filters = _filters(words)
    parts = max(1, math.ceil(n / WORDS_A_TASK))
    # tasks get words of about one length, so they load the filters of two
    asked = words.repartitionByRange(parts, "letters", "word").select("word", "n").mapInArrow(
        _probe(filters, alphabet), "word string, n long, near string")
    return asked.join(words.select(F.col("word").alias("near"), F.col("n").alias("m")), "near").select("word", "n", "near", "m")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words that have a form: forms are followed in doubling steps, until none goes on.
    A form is at least twice as frequent as its word, so paths are short and have no circle."""
    links = stored(forms.where("form is not null").select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "links")
    while links.where("moved").limit(1).count():
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        links = stored(links.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"),
                                                               F.col("ahead").isNotNull().alias("moved")), "links")
    return links.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the texts (see :func:`vocabulary`).

    ``form`` is the most frequent near word (ties: the first in code-point order) if it is at least ``TIMES`` times as
    frequent, else null; ``root`` follows forms to the last (the word itself if it has none).

    A null or empty text has no words; a null id counts as an empty one; repeated rows count as often as they occur.
    Words may be of any length. Other columns are not read. An empty table gives an empty result.
    """
    words = vocabulary(docs, id_col, text_col)
    pairs = near_pairs(words)
    both = pairs.select(F.explode(F.array(F.struct("word", F.struct((-F.col("m")).alias("m"), F.col("near").alias("w")).alias("best")),
                                          F.struct(F.col("near").alias("word"), F.struct((-F.col("n")).alias("m"), F.col("word").alias("w")).alias("best"))))
                        .alias("p")).select("p.*")
    stats = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min("best").alias("best"))
    far = -F.col("best.m") >= TIMES * F.col("n")
    forms = stored(words.join(stats, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(far, F.col("best.w")).alias("form"),
        F.when(far, -F.col("best.m")).alias("form_n")), "forms")
    out = forms.join(_roots(forms), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
