"""Token ids as Huffman-coded binary blocks, written in document order and read back.

Ids are counted over all documents; the counts give a canonical Huffman code whose words have at most
``MAX_BITS`` bits (package-merge), so that the code is described by the length of each id's word and a
decoder is one table look-up for each id. A data set is a folder with

* ``code``: one row for each id in use, its code length;
* ``blocks``: rows of ``part``, ``block``, ``part_start`` (ids before the block in its part),
  ``doc_ids``, ``lengths`` (ids of each document), ``n_ids``, ``checkpoints`` (the bit offset of every
  ``STRIDE``-th id) and ``payload`` (the code words, most significant bit first).

Blocks follow each other by ``part`` and ``block`` in ascending document order. Each is decoded by
itself, all stretches between its checkpoints side by side.

Bounds: the driver holds one count for each id of the vocabulary, and one total for each part. A block
has about ``BLOCK_IDS`` ids, or those of one longer document. Documents are spread over the parts by
ranges of (id, hash of the content), so rows of one id need not meet in one task.

Defined edge cases: a null or empty text has no ids but the end id; null ids come first; rows that share
an id are ordered by their content; an empty table makes an empty data set.
"""

from __future__ import annotations

import string
import struct
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featmart.llm.common import blocks, held, id_text, stored
from featmart.session import checkpoint_dir

END = 1
MAX_BITS = 16
STRIDE = 256
BLOCK_IDS = 1 << 18
CACHE = 300_000  # words remembered, twice
TEXT_AT_ONCE = 8 << 20  # bytes of text whose words are told apart at once
ROWS_AT_ONCE = 128


def _byte_letters() -> dict[int, int]:
    """How byte-level tokenizers write bytes as characters: printable Latin-1 as it is, the others, in
    order, from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 0x100 + k for k, b in enumerate(hidden)}


class WordEncoder:
    """Ids of texts whose tokenizer drops white space: the distinct words of many texts are encoded once and the texts'
    ids put together from them by Arrow.

    A word of Latin letters goes straight to the tokenizer's merges, lower-cased and as byte letters, which
    is what its normalizer and splitter make of it; ASCII marks at its end are a piece of their own.
    All other words go through the whole tokenizer.
    """

    _ODD = "[\x1c-\x1f]"  # Arrow splits at these as well, the tokenizer does not
    _LATIN = "\u0130"  # letters below lower-case alike everywhere and have no other normal form
    _LETTERS = "".join(c for c in map(chr, range(ord(_LATIN))) if c.isalpha())

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.merges, self.letters = self.tokenizer.model.tokenize, _byte_letters()
        self.cache, self.before = {}, {}

    def _split(self, texts: pa.Array) -> pa.Array:
        """The words of each text; there are empty ones beside white space at an end."""
        if pc.any(pc.match_substring_regex(texts, self._ODD)).as_py():
            return pa.array([regex.split(r"\s+", t) for t in texts.to_pylist()], pa.list_(pa.large_string()))
        return pc.utf8_split_whitespace(texts)

    _FORMATS = [f"<{n}I" for n in range(64)]

    def _pack(self, ids: list[int]) -> bytes:
        n = len(ids)
        return struct.pack(self._FORMATS[n] if n < 64 else f"<{n}I", *ids)

    def _known(self, words: pa.Array) -> pa.Array:
        """Ids of some words, each told apart once: lower-cased ones of Latin letters, and any others."""
        if len(self.cache) > CACHE:  # words not met since the last time are forgotten
            self.before, self.cache = self.cache, {}
        cache, before, rest = self.cache, self.before, []
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        out = list(map(cache.get, distinct))
        for i, w in enumerate(distinct):
            if out[i] is not None:
                continue
            known = before.get(w)
            if known is None:
                if not w.isalpha() or not (w.isascii() or max(w) < self._LATIN):
                    rest.append(i)
                    continue
                letters = w if w.isascii() else w.encode().decode("latin-1").translate(self.letters)
                known = self._pack([t.id for t in self.merges(letters)])
            out[i] = cache[w] = known
        for at in range(0, len(rest), 1 << 14):
            part = rest[at:at + (1 << 14)]
            for i, e in zip(part, self.tokenizer.encode_batch_fast([distinct[i] for i in part], add_special_tokens=False)):
                out[i] = cache[distinct[i]] = self._pack(e.ids)
        return pa.array(out, pa.large_binary()).take(coded.indices)

    def _ids(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words."""
        body, marks = pc.utf8_rtrim(words, string.punctuation), pc.utf8_ltrim(words, self._LETTERS)
        latin = pc.and_(pc.equal(pc.utf8_ltrim(body, self._LETTERS), ""), pc.not_equal(body, ""))
        first = self._known(pc.if_else(latin, pc.utf8_lower(body), words))
        return pc.binary_join_element_wise(first, self._known(pc.if_else(latin, marks, "")), pa.scalar(b"", pa.large_binary()))

    def encode(self, texts: list[str] | pa.Array, end: int | None) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, then ``end``."""
        words = self._split(pc.cast(texts, pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()))
        coded = words.flatten().dictionary_encode()
        ids = self._ids(coded.dictionary).take(coded.indices)
        ends = np.zeros(len(ids) + 1, dtype=np.int64)
        np.cumsum(pc.binary_length(ids).to_numpy(zero_copy_only=False), out=ends[1:])
        first = words.offsets.to_numpy()
        data = memoryview(ids.buffers()[2] or b"")
        tail = b"" if end is None else self._pack([end])
        cuts = ends[first - first[0]].tolist()
        return [bytes(data[a:b]) + tail for a, b in zip(cuts, cuts[1:])]


def word_encoder(path: str) -> WordEncoder:
    """The encoder of a tokenizer file, loaded once in a process that does nothing else meanwhile."""
    return held(("words", path), lambda: WordEncoder(path))


def encode(docs: DataFrame, path: str, end: int | None = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored ``(doc_id, n, ids)``: ids of each row, two bytes each where all fit, else four."""

    def run(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        enc = word_encoder(path)
        for block in blocks(batches, limit=TEXT_AT_ONCE):
            ids = enc.encode(pc.fill_null(block.rows.column(1), ""), end)
            n = [len(x) // 4 for x in ids]
            yield pa.RecordBatch.from_arrays([block.rows.column(0), pa.array(n, pa.int64()), pa.array(map(_narrow, ids), pa.binary())],
                                             ["doc_id", "n", "ids"])

    return stored(id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n long, ids binary"), "ids")


def _narrow(ids: bytes) -> bytes:
    a = np.frombuffer(ids, "<u4")
    return a.astype("<u2").tobytes() if a.max(initial=0) < 1 << 16 else ids


def _wide(ids: bytes, n: int) -> np.ndarray:
    return np.frombuffer(ids, "<u4" if len(ids) == 4 * n else "<u2").astype(np.int64)


def id_counts(encoded: DataFrame) -> DataFrame:
    """``(id, count)`` over all rows; a task sends each id at most once."""

    def run(batches):
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                ids = [_wide(x, n) for n, x in zip(part.column(0).to_pylist(), part.column(1).to_pylist())]
                c = np.bincount(np.concatenate(ids), minlength=len(total))
                c[:len(total)] += total
                total = c
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["id", "count"])

    return encoded.select("n", "ids").mapInArrow(run, "id long, count long").groupBy("id").agg(F.sum("count").alias("count"))


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Lengths of an optimal prefix code with words of at most ``max_bits`` bits (package-merge).

    ``counts`` are positive. One symbol gets one bit. More symbols than ``2**max_bits`` are an error.
    """
    n = len(counts)
    if n <= 1:
        return np.ones(n, dtype=np.int64)
    if n > 1 << max_bits:
        raise ValueError(f"{n} symbols do not fit codes of {max_bits} bits")
    order = np.argsort(counts, kind="stable")
    leaf = np.asarray(counts, dtype=np.int64)[order]
    levels, items = [], leaf
    is_leaf = np.ones(n, dtype=bool)
    levels.append(is_leaf)
    for _ in range(max_bits - 1):
        pairs = items[:len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaf, pairs])
        place = np.argsort(both, kind="stable")
        items, is_leaf = both[place], place < n
        levels.append(is_leaf)
    lengths, take = np.zeros(n, dtype=np.int64), 2 * n - 2
    for is_leaf in reversed(levels):
        leaves = int(is_leaf[:take].sum())
        lengths[:leaves] += 1  # leaves come in ascending order, so these are the least
        take = 2 * (take - leaves)
    out = np.empty(n, dtype=np.int64)
    out[order] = lengths
    return out


class Code:
    """A canonical code: words of equal length ascend with the id, longer words come after shorter."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        self.ids, self.lengths = ids[order], lengths[order]
        self.bits = int(self.lengths.max(initial=1))
        size = np.int64(1) << (self.bits - self.lengths)
        first = np.cumsum(size) - size  # word, left-aligned to ``bits``
        top = int(ids.max(initial=0)) + 1
        self.word, self.length = np.zeros(top, np.int64), np.zeros(top, np.int64)
        self.word[self.ids], self.length[self.ids] = first >> (self.bits - self.lengths), self.lengths
        self.look_id = np.zeros(1 << self.bits, np.int64)
        self.look_length = np.ones(1 << self.bits, np.int64)
        end = int(size.sum())
        self.look_id[:end], self.look_length[:end] = np.repeat(self.ids, size), np.repeat(self.lengths, size)

    def pack(self, ids: np.ndarray, stride: int = STRIDE) -> tuple[bytes, np.ndarray]:
        """Bit string of the ids, and the bit offset of every ``stride``-th of them."""
        length = self.length[ids]
        end = np.cumsum(length)
        at = end - length
        total = int(end[-1]) if len(ids) else 0
        # a word of up to 24 bits touches at most four bytes
        shifted = self.word[ids] << (32 - length - (at & 7))
        out = np.zeros((total >> 3) + 5, dtype=np.int64)
        for k in range(4):
            part = (shifted >> (24 - 8 * k)) & 0xFF
            got = np.bincount((at >> 3) + k, weights=part, minlength=len(out))
            out += got[:len(out)].astype(np.int64)
        return out[:(total + 7) >> 3].astype(np.uint8).tobytes(), at[::stride]

    def unpack(self, payload: bytes, checkpoints: np.ndarray, n: int, stride: int = STRIDE) -> np.ndarray:
        """The ``n`` ids; every stretch between checkpoints advances one id at a time, all at once."""
        out = np.zeros((len(checkpoints), stride), dtype=np.int64)
        data = np.concatenate([np.frombuffer(payload, np.uint8), np.zeros(8, np.uint8)]).astype(np.int64)
        word = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
        at, left = checkpoints.astype(np.int64), n - stride * (len(checkpoints) - 1)
        mask = (1 << self.bits) - 1
        for k in range(stride):
            rows = slice(None) if k < left else slice(0, -1)
            place = at[rows]
            look = (word[place >> 3] >> (32 - self.bits - (place & 7))) & mask
            out[rows, k] = self.look_id[look]
            at[rows] = place + self.look_length[look]
        return out.ravel()[:n]


def write(encoded: DataFrame, path: str, max_bits: int = MAX_BITS) -> None:
    """Write rows ``(doc_id, n, ids)`` as a data set at ``path``."""
    spark = encoded.sparkSession
    rows = sorted((r.id, r["count"]) for r in id_counts(encoded).collect())  # one row for each id of the vocabulary
    ids, counts = (np.array([r[k] for r in rows], dtype=np.int64) for k in (0, 1))
    lengths = code_lengths(counts, max(max_bits, int(len(ids) - 1).bit_length() if len(ids) else 1))
    spark.createDataFrame([(int(i), int(n)) for i, n in zip(ids, lengths)], "id long, bits int").coalesce(1).write.parquet(f"{path}/code")
    code = Code(ids, lengths)
    if code.bits > 24:
        raise ValueError("code words of more than 24 bits")
    place = F.xxhash64("ids")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (encoded.withColumn("__hash", place).repartitionByRange(parts, "doc_id", "__hash")
               .sortWithinPartitions("doc_id", "__hash", "ids").select("doc_id", "n", "ids"))

    def run(batches):
        part, block, before = TaskContext.get().partitionId(), 0, 0
        held: list[tuple] = []
        size = 0

        def flush():
            all_ids = np.concatenate([_wide(i, n) for _, n, i in held])
            payload, marks = code.pack(all_ids)
            return pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "block": pa.array([block], pa.int32()), "part_start": pa.array([before], pa.int64()),
                 "doc_ids": pa.array([[h[0] for h in held]], pa.list_(pa.int64())),
                 "lengths": pa.array([np.array([h[1] for h in held], "<i8").tobytes()]), "n_ids": pa.array([len(all_ids)], pa.int64()),
                 "checkpoints": pa.array([marks.astype("<u8").tobytes()]), "payload": pa.array([payload])})

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and size + row[1] > BLOCK_IDS:
                    yield flush()
                    block, before, held, size = block + 1, before + size, [], 0
                held.append(row)
                size += row[1]
        if held:
            yield flush()

    (ordered.mapInArrow(run, "part int, block int, part_start long, doc_ids array<long>, lengths binary, n_ids long, "
                             "checkpoints binary, payload binary")
     .write.option("compression", "none").parquet(f"{path}/blocks"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of a data set: ``start`` counts the ids of all documents before,
    ``ids`` are little-endian unsigned 32-bit."""
    code_rows = sorted((r.id, r.bits) for r in spark.read.schema("id long, bits int").parquet(f"{path}/code").collect())
    code = Code(np.array([r[0] for r in code_rows], np.int64), np.array([r[1] for r in code_rows], np.int64))
    table = spark.read.schema("part int, block int, part_start long, doc_ids array<long>, lengths binary, n_ids long, "
                              "checkpoints binary, payload binary").parquet(f"{path}/blocks")
    totals = sorted((r.part, r.n) for r in table.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())  # one row a part
    offset, at = {}, 0
    for part, n in totals:
        offset[part], at = at, at + n

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids = code.unpack(r["payload"], np.frombuffer(r["checkpoints"], "<u8"), r["n_ids"]).astype("<u4")
                n = np.frombuffer(r["lengths"], "<i8")
                end = np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array(end - n + (offset[r["part"]] + r["part_start"])), pa.array(n),
                     pa.array([ids[e - m:e].tobytes() for e, m in zip(end, n)], pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return table.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def round_trip(docs: DataFrame, tokenizer: str, end: int | None = END, path: str | None = None,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode ``docs``, write the data set (by default into the shared checkpoint folder), read it back."""
    spark = docs.sparkSession
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    write(encode(docs, tokenizer, end, id_col, text_col), path)
    return read(spark, path)
