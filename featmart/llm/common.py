"""Helpers shared by the corpus operators: bounded text blocks, byte hashing, stored intermediates."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Hashable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featmart.session import checkpoint_dir

#: Bytes of text handled at once inside a task; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only id and text, under fixed names: other columns of the caller cannot clash."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """64-bit hash of id and text, for rows that an id does not tell apart: only rows that repeat both
    share it. A null text counts as empty."""
    return F.xxhash64(F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage: later passes, and tasks re-run after a lost executor, start from the files.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file; the same on every machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


_held: dict[Hashable, object] = {}


def held(key: Hashable, make: Callable[[], object]):
    """``make()``, held by this process for the next tasks that ask for ``key``; only the last one is. Python workers
    serve the tasks of one operator after another, and what one remembers is of no use to the next."""
    if key not in _held:
        let_go()
        _held[key] = make()
    return _held[key]


def let_go() -> None:
    """Free what earlier tasks of other operators made this process hold, and give it back to the system: a worker
    lives on beside the next ones of its executor."""
    if _held:
        _held.clear()
        gc.collect()  # memos and their owners refer to each other
    pa.default_memory_pool().release_unused()


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_INV = pow(_BASE, -1, 1 << 64)
_powers = {"n": 0}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] < n:
        size = max(n, BLOCK_BYTES + 1)
        for key, base in (("up", _BASE), ("down", _INV)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _powers[key] = np.cumprod(p, dtype=np.uint64)
        _powers["n"] = size
    return _powers["up"], _powers["down"]


def prefix_hash(data: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
    """Running polynomial hash (mod 2^64) of bytes; ``fold`` maps bytes before hashing."""
    up, _ = _power_tables(len(data) + 1)
    table = _BYTE if fold is None else _BYTE[fold]
    out = np.empty(len(data) + 1, dtype=np.uint64)
    out[0] = 0
    np.cumsum(table[data] * up[:len(data)], dtype=np.uint64, out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range; equal ranges have equal hashes wherever they stand."""
    _, down = _power_tables(len(prefix))
    h = (prefix[end] - prefix[start]) * down[start]
    return mix64(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Block:
    """Some whole texts of one Arrow batch as one byte array.

    ``data`` uint8 bytes, ``offsets`` of the texts in it, ``rows`` the batch slice they come from.
    A null text counts as empty.
    """

    def __init__(self, rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray):
        self.rows, self.data, self.offsets = rows, data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def sums(self, per_byte: np.ndarray) -> np.ndarray:
        """Per text, the sum of an integer (or boolean) value given for every byte."""
        c = np.zeros(len(per_byte) + 1, dtype=np.int64)
        np.cumsum(per_byte, dtype=np.int64, out=c[1:])
        return c[self.offsets[1:]] - c[self.offsets[:-1]]

    def words(self, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of every maximal run of non-separator bytes inside one text."""
        is_word = ~separator[self.data]
        if not len(is_word):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        edge = np.zeros(len(is_word) + 1, dtype=bool)
        edge[self.offsets] = True
        starts = is_word.copy()
        starts[1:] &= ~is_word[:-1] | edge[1:-1]
        ends = is_word.copy()
        ends[:-1] &= ~is_word[1:] | edge[1:-1]
        return np.flatnonzero(starts), np.flatnonzero(ends) + 1

    def counts(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of items given by ascending start: how many each text has, and each text's first item."""
        first = np.searchsorted(starts, self.offsets)
        return np.diff(first), first


def _binary(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if col.null_count:
        col = pc.fill_null(col, "")
    col = col.cast(pa.large_binary())
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)), offsets


def blocks(batches: Iterator[pa.RecordBatch], text_col: str = "text",
           limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut Arrow batches into blocks of whole texts of at most ``limit`` bytes (or one text)."""
    for batch in batches:
        data, offsets = _binary(batch.column(batch.schema.get_field_index(text_col)))
        i, n = 0, len(offsets) - 1
        while i < n:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
            yield Block(batch.slice(i, j - i), data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            i = j


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Boolean table over the 256 byte values, true inside the given inclusive ranges."""
    t = np.zeros(256, dtype=bool)
    for a, b in ranges:
        t[a:b + 1] = True
    return t


#: ASCII white space: the separators of plain words.
SPACE = byte_set((0x20, 0x20), (0x09, 0x0D))
#: Everything in ASCII but letters and digits: the separators of lower-cased words.
NON_WORD = byte_set((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
#: Byte map that lower-cases A-Z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def gram_hash(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes (length ``len(words) - n + 1``)."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64)
    m = len(words) - n + 1
    h = np.zeros(m, dtype=np.uint64)
    for k in range(n):
        h = (h + words[k:k + m]) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(2 * k + 1)
        h ^= h >> np.uint64(29)
    return mix64(h)


def inside(per_text: np.ndarray, first: np.ndarray, n: int, total: int) -> np.ndarray:
    """For runs of ``n`` items by start: does the run stay inside its text?

    ``per_text``/``first`` as from :meth:`Block.counts`, ``total`` the number of items.
    """
    m = max(0, total - n + 1)
    end = np.repeat(first[1:], per_text)[:m]
    return np.arange(m) + n <= end


def repeated(values: np.ndarray) -> np.ndarray:
    """True where a value occurs at least twice in ``values``."""
    s = np.sort(values)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(twice, values), len(twice) - 1)
    return twice[at] == values
