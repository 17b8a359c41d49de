"""Collocations: phrases of two to five words scored against their parts, counted by direct-address tiling.

Texts are cut into segments of one language. Words are counted over all segments and the frequent ones numbered by
falling frequency; a segment becomes a row of numbers with breaks where a piece ends or a word is rare. Pairs of
neighbouring numbers fall into square tiles: near the origin, where frequent numbers meet, a task counts them in
dense arrays (``bincount`` on the address inside the tile); the other tiles are counted from sorted coordinates.
Tasks send their sums, which Spark adds up. The frequent pairs are numbered by frequency again and replace the row's
numbers, so that the neighbours of the next level are phrases that overlap in all but one word: a phrase of k words
can be frequent only if its first and last k - 1 are.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featmart.llm import blooms
from featmart.llm.common import LOWER, byte_set, mix64, prefix_hash, range_hash, stored
from featmart.llm.packed import squeeze, unsqueeze

#: Words of a phrase at most, and occurrences of a candidate at least.
MAX_WORDS, MIN_COUNT = 5, 100
#: Phrases returned for each language.
TOP = 2000
#: Bytes of text in a segment, and in all open segments of a task.
SEGMENT, OPEN = 2 << 20, 8 << 20
#: Side of a tile; tiles whose place from the origin (row + 1) * (column + 1) is at most DENSE are counted in arrays.
SIDE, DENSE = 1024, 4
#: Dense tiles and coordinates a task holds before it sends its sums.
TILES, COORDINATES = 24, 2 << 20
#: Words or pairs whose numbers are broadcast (the most frequent of all languages), and the bytes of such a word at most.
HOT, HOT_BYTES = 1 << 18, 64
#: Phrases of equal frequency are numbered by this many tasks.
SPREAD = 64

_BREAK = byte_set((0x0A, 0x0D), *[(ord(c), ord(c)) for c in ".,;:!?"])
_GAP = _BREAK | byte_set((0x20, 0x20), (0x09, 0x09))

_SEGMENT_SCHEMA = "segment long, lang string, length long, codes binary, words array<string>, counts array<long>"
_ROW_SCHEMA = "segment long, lang string, length long, row binary"


# ---- segments -----------------------------------------------------------------------------------
def _cut(text: bytes) -> Iterator[bytes]:
    """A text in stretches of about a segment, cut at the end of a piece."""
    while len(text) > SEGMENT:
        ends = np.flatnonzero(_BREAK[np.frombuffer(text, np.uint8)[SEGMENT:]])
        if not len(ends):
            break
        yield text[:SEGMENT + ends[0]]
        text = text[SEGMENT + ends[0] + 1:]
    yield text


def _row_of_words(data: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of some bytes, and whether a word stands beside the one before it in the same piece."""
    word = ~_GAP[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    breaks = np.zeros(len(data) + 1, dtype=np.int32)
    np.cumsum(_BREAK[data], out=breaks[1:])
    beside = np.zeros(len(start), dtype=bool)
    beside[1:] = breaks[start[1:]] == breaks[end[:-1]]
    offsets = np.zeros(len(start) + 1, dtype=np.int64)
    np.cumsum(end - start, out=offsets[1:])
    words = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(LOWER[data[word]]))
    return words.dictionary_encode(), beside


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    open_texts: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    numbers = itertools.count(TaskContext.get().partitionId() << 32)

    def close(lang: str) -> pa.RecordBatch:
        sizes.pop(lang)
        words, beside = _row_of_words(np.frombuffer(b"\n".join(open_texts.pop(lang)), np.uint8))
        codes = words.indices.to_numpy().astype(np.int32)
        n = np.bincount(codes, minlength=len(words.dictionary)).astype(np.int64)
        # a break before every word that is not beside the last
        at = np.arange(len(codes)) + np.cumsum(~beside)
        row = np.full(len(codes) + int((~beside).sum()), -1, dtype="<i4")
        row[at] = codes
        listed = words.dictionary.cast(pa.string())
        ends = pa.array([0, len(listed)], pa.int32())
        return pa.record_batch([[next(numbers)], [lang], [len(row)], [squeeze(row)], pa.ListArray.from_arrays(ends, listed),
                                pa.ListArray.from_arrays(ends, pa.array(n))], names=["segment", "lang", "length", "codes", "words", "counts"])

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            for part in _cut(text):
                if part:
                    open_texts.setdefault(lang, []).append(part)
                    sizes[lang] = sizes.get(lang, 0) + len(part) + 1
                    if sizes[lang] >= SEGMENT:
                        yield close(lang)
            while sum(sizes.values()) > OPEN:
                yield close(max(sizes, key=sizes.get))
    for lang in list(sizes):
        yield close(lang)


def segments(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Stored segments: the distinct words with counts, and the texts as numbers of these words (-1: a break)."""
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                        F.col(f"`{text_col}`").cast("string").alias("text")).where("text is not null")
    return stored(texts.mapInArrow(_segments, _SEGMENT_SCHEMA), "segments")


# ---- counting -----------------------------------------------------------------------------------
def frequency_ids(counted: DataFrame, name: str = "id") -> DataFrame:
    """``counted`` (``lang, n`` and a key) with dense numbers per language, the most frequent first.

    Rows of one frequency are numbered in ``SPREAD`` parts; how many come before a part is known from a table of the
    distinct frequencies and parts, so no task sorts a whole language."""
    key = [c for c in counted.columns if c not in ("lang", "n")]
    parts = counted.withColumn("part", F.pmod(F.xxhash64(*key), F.lit(SPREAD)).cast("int"))
    sizes = parts.groupBy("lang", "n", "part").agg(F.count(F.lit(1)).alias("size"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("lang", "n", "part", F.coalesce(F.sum("size").over(order), F.lit(0)).alias("before"))
    inner = F.row_number().over(Window.partitionBy("lang", "n", "part").orderBy(*key)) - 1
    return parts.withColumn("inner", inner).join(before, ["lang", "n", "part"]) \
        .select("lang", *key, "n", (F.col("before") + F.col("inner")).cast("int").alias(name))


class _Tiles:
    """Counts of pairs of numbers, by language and tile."""

    def __init__(self):
        self.dense: dict[tuple, np.ndarray] = {}
        self.sparse: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.held = 0

    def add(self, lang: str, left: np.ndarray, right: np.ndarray) -> None:
        tile = (left // SIDE + 1).astype(np.int64) * (right // SIDE + 1)
        near = tile <= DENSE
        a, b = left[near], right[near]
        place = (a // SIDE) * DENSE + b // SIDE
        for p in np.unique(place):
            mine = place == p
            if (lang, int(p)) not in self.dense:
                self.dense[lang, int(p)] = np.zeros(SIDE * SIDE, np.int32)
            self.dense[lang, int(p)] += np.bincount((a[mine] % SIDE) * SIDE + b[mine] % SIDE, minlength=SIDE * SIDE).astype(np.int32)
        keys, n = np.unique((left[~near].astype(np.int64) << 32) | right[~near], return_counts=True)
        self.sparse.setdefault(lang, []).append((keys, n))
        self.held += len(keys)

    def full(self) -> bool:
        return len(self.dense) > TILES or self.held > COORDINATES

    def flush(self) -> Iterator[pa.RecordBatch]:
        for (lang, p), counts in self.dense.items():
            at = np.flatnonzero(counts)
            yield self._batch(lang, at // SIDE + p // DENSE * SIDE, at % SIDE + p % DENSE * SIDE, counts[at])
        for lang, found in self.sparse.items():
            keys, place = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
            n = np.bincount(place, weights=np.concatenate([c for _, c in found]), minlength=len(keys)).astype(np.int64)
            yield self._batch(lang, keys >> 32, keys & 0xFFFFFFFF, n)
        self.__init__()

    @staticmethod
    def _batch(lang, left, right, n) -> pa.RecordBatch:
        return pa.record_batch([pa.array([lang] * len(n), pa.string()), left.astype(np.int32), right.astype(np.int32), n.astype(np.int64)],
                               names=["lang", "left", "right", "n"])


def _neighbours(row: np.ndarray) -> np.ndarray:
    """Where a number stands beside another."""
    return np.flatnonzero((row[:-1] >= 0) & (row[1:] >= 0))


def _rows(batch: pa.RecordBatch, name: str, dtype: str = "<i4") -> Iterator[tuple[int, np.ndarray]]:
    column = batch.column(batch.schema.get_field_index(name))
    lengths = batch.column(batch.schema.get_field_index("length")).to_pylist()
    for i, n in enumerate(lengths):
        yield i, unsqueeze(column[i].as_py(), n, dtype)


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tiles = _Tiles()
    for batch in batches:
        langs = batch.column(batch.schema.get_field_index("lang"))
        for i, row in _rows(batch, "row"):
            at = _neighbours(row)
            if len(at):
                tiles.add(langs[i].as_py(), row[at], row[at + 1])
            if tiles.full():
                yield from tiles.flush()
    yield from tiles.flush()


def _word_counts(made: DataFrame) -> DataFrame:
    counted = made.select("lang", F.explode(F.arrays_zip(F.col("words").alias("word"), F.col("counts").alias("n"))).alias("w"))
    return counted.groupBy("lang", F.col("w.word").alias("word")).agg(F.sum("w.n").alias("n"))


# ---- numbering again ----------------------------------------------------------------------------
def _packed(row: np.ndarray) -> np.ndarray:
    """The row without numbers that stand alone, and with one break where there were several."""
    gap = row < 0
    lone = ~gap
    lone[1:] &= gap[:-1]
    lone[:-1] &= gap[1:]
    row = np.where(lone, -1, row)
    again = np.zeros(len(row), dtype=bool)
    again[1:] = (row[1:] < 0) & (row[:-1] < 0)
    return row[~again].astype("<i4")


def _row_batch(batch: pa.RecordBatch, rows: list[np.ndarray]) -> pa.RecordBatch:
    column = {c: batch.column(batch.schema.get_field_index(c)) for c in ("segment", "lang")}
    return pa.record_batch([column["segment"], column["lang"], pa.array([len(r) for r in rows], pa.int64()),
                            pa.array([squeeze(r) for r in rows], pa.binary())], names=["segment", "lang", "length", "row"])


def _lang_salt(lang: str) -> np.uint64:
    data = lang.encode() + b"\x01"
    return mix64(np.frombuffer(data.ljust(-(-len(data) // 8) * 8, b"\0"), "<u8")).sum(dtype=np.uint64)


def _pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left.astype(np.int64) << 32) | right


def _pair_hashes(lang: str, keys: np.ndarray) -> np.ndarray:
    return mix64(mix64(keys.view(np.uint64)) + _lang_salt(lang))


def _word_hashes(lang: str, words: pa.Array) -> np.ndarray:
    words = words.cast(pa.large_binary())
    if not len(words):
        return np.zeros(0, np.uint64)
    at = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
    return mix64(range_hash(prefix_hash(data), at[:-1] - at[0], at[1:] - at[0]) + _lang_salt(lang))


class _Numbers:
    """Numbers of frequent items (words or pairs), for the rows of all segments.

    The most frequent ``HOT`` items, which most segments hold, are broadcast. What is left goes the exact way round:
    a segment asks for those of its other items that a filter of bounded size lets through, and a join answers."""

    def __init__(self, items: DataFrame, langs: int, keys, hashes):
        """``items``: ``lang``, the item's columns, ``n``, ``id``; ``keys(columns)`` makes an array to look items up in,
        ``hashes(lang, keys)`` their hashes. ``id`` follows frequency, so a bound on it takes the most frequent."""
        limit = max(1, HOT // max(1, langs))
        self.names = [c for c in items.columns if c not in ("lang", "n", "id")]
        size = sum((F.octet_length(c) for c in self.names if items.schema[c].dataType.simpleString() == "string"), F.lit(0))
        hot = (F.col("id") < limit) & (size <= HOT_BYTES)
        table = items.where(hot).select("lang", *self.names, "id").toArrow()  # at most HOT rows of HOT_BYTES
        tables = {}
        for lang in table["lang"].unique().to_pylist():
            mine = table.filter(pc.equal(table["lang"], lang)).combine_chunks()
            tables[lang] = (keys(*(mine[c].combine_chunks() for c in self.names)), mine["id"].to_numpy())
        self.hot = items.sparkSession.sparkContext.broadcast(tables)
        self.cold = items.where(~hot).select("lang", *self.names, "id")
        names, count = self.names, self.cold.count()
        per = blooms.blocks_for({0: max(1, count)})

        def add(batches):
            for batch in batches:
                column = pa.table(batch)
                for lang in column["lang"].unique().to_pylist():
                    mine = column.filter(pc.equal(column["lang"], lang)).combine_chunks()
                    yield blooms.rows(0, hashes(lang, keys(*(mine[c].combine_chunks() for c in names))), per[0])

        self.bits = blooms.build(self.cold.drop("id").mapInArrow(add, blooms.ROWS), per)[0]


def _asked(rows: DataFrame, numbers: _Numbers, items, look_up, hashes, answer, schema: str) -> DataFrame:
    """Per segment the numbers of those items that are not broadcast: ``segment`` and two arrays, in one order, of
    what ``answer`` makes of an item and of its number. ``items(batch)`` lists ``(position, lang, keys, columns)``."""
    hot, bits, names = numbers.hot, numbers.bits, numbers.names

    def ask(batches):
        for batch in batches:
            segments = batch.column(batch.schema.get_field_index("segment"))
            for i, lang, keys, columns in items(batch):
                other = np.flatnonzero(look_up(hot.value.get(lang), keys) < 0)
                rest = keys.take(pa.array(other)) if isinstance(keys, pa.Array) else keys[other]
                other = other[blooms.hit(bits.value, hashes(lang, rest))]
                if len(other):
                    at = pa.array(other)
                    m = len(other)
                    yield pa.record_batch([pa.array([segments[i].as_py()] * m), pa.array([lang] * m), *(c.take(at) for c in columns)],
                                          names=["segment", "lang", *[f.split()[0] for f in schema.split(", ")]])

    asked = rows.mapInArrow(ask, f"segment long, lang string, {schema}")
    return asked.join(numbers.cold, ["lang", *names]).groupBy("segment").agg(
        F.collect_list(answer).alias("items"), F.collect_list("id").alias("ids"))  # at most a segment's distinct items


def _find_words(table: tuple | None, words: pa.Array) -> np.ndarray:
    if table is None or not len(table[0]):
        return np.full(len(words), -1, np.int64)
    at = pc.index_in(words, value_set=table[0])
    found = pc.fill_null(at, 0).to_numpy()
    return np.where(pc.is_valid(at).to_numpy(zero_copy_only=False), table[1][found], -1)


def _find_pairs(table: tuple | None, keys: np.ndarray) -> np.ndarray:
    if table is None or not len(table[0]) or not len(keys):
        return np.full(len(keys), -1, np.int64)
    known, ids = table
    place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[place] == keys, ids[place], -1)


def _sorted_pairs(table: tuple) -> tuple:
    order = np.argsort(table[0])
    return table[0][order], table[1][order]


def _answers(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
    items, ids = (batch.column(batch.schema.get_field_index(c))[i].values for c in ("items", "ids"))
    if items is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return items.to_numpy(), ids.to_numpy()


def _number_words(made: DataFrame, words: DataFrame, langs: int) -> DataFrame:
    """Segments as rows of the numbers of frequent words."""
    numbers = _Numbers(words, langs, lambda w: w, _word_hashes)

    def items(batch):
        listed = batch.column(batch.schema.get_field_index("words"))
        names = batch.column(batch.schema.get_field_index("lang"))
        for i in range(len(batch)):
            own = listed[i].values
            yield i, names[i].as_py(), own, [pa.array(np.arange(len(own), dtype=np.int32)), own]

    known = _asked(made.select("segment", "lang", "words"), numbers, items, _find_words, _word_hashes, "local", "local int, word string")
    hot = numbers.hot

    def recode(batches):
        for batch in batches:
            out, names = [], batch.column(batch.schema.get_field_index("lang"))
            listed = batch.column(batch.schema.get_field_index("words"))
            for i, codes in _rows(batch, "codes"):
                own = listed[i].values
                table = np.full(len(own) + 1, -1, dtype="<i4")  # the last entry answers -1
                table[:-1] = _find_words(hot.value.get(names[i].as_py()), own)
                local, ids = _answers(batch, i)
                table[local] = ids
                out.append(_packed(table[codes]))
            yield _row_batch(batch, out)

    asked = made.select("segment", "lang", "length", "codes", "words").join(known, "segment", "left")
    return stored(asked.mapInArrow(recode, _ROW_SCHEMA), "rows")


def _number_pairs(rows: DataFrame, pairs: DataFrame, langs: int) -> DataFrame:
    """Rows whose numbers are those of the frequent pairs that begin there."""
    numbers = _Numbers(pairs, langs, lambda a, b: _pair_keys(a.to_numpy(), b.to_numpy()), _pair_hashes)
    hot = numbers.hot = rows.sparkSession.sparkContext.broadcast({lang: _sorted_pairs(t) for lang, t in numbers.hot.value.items()})

    def items(batch):
        names = batch.column(batch.schema.get_field_index("lang"))
        for i, row in _rows(batch, "row"):
            at = _neighbours(row)
            keys = np.unique(_pair_keys(row[at], row[at + 1]))
            yield i, names[i].as_py(), keys, [pa.array((keys >> 32).astype(np.int32)), pa.array((keys & 0xFFFFFFFF).astype(np.int32))]

    answer = F.shiftleft(F.col("left").cast("long"), 32).bitwiseOR(F.col("right").cast("long"))
    known = _asked(rows, numbers, items, _find_pairs, _pair_hashes, answer, "left int, right int")

    def recode(batches):
        for batch in batches:
            out, names = [], batch.column(batch.schema.get_field_index("lang"))
            for i, row in _rows(batch, "row"):
                at = _neighbours(row)
                mine = _pair_keys(row[at], row[at + 1])
                ids = _find_pairs(hot.value.get(names[i].as_py()), mine)
                new = np.full(len(row), -1, dtype="<i4")
                new[at] = np.maximum(ids, _find_pairs(_sorted_pairs(_answers(batch, i)), mine))
                out.append(_packed(new))
            yield _row_batch(batch, out)

    return stored(rows.join(known, "segment", "left").mapInArrow(recode, _ROW_SCHEMA), "rows")


# ---- phrases ------------------------------------------------------------------------------------
def frequent_phrases(made: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS) -> DataFrame:
    """``lang, words, n`` of all phrases of one to ``max_words`` words that occur ``min_count`` times in :func:`segments`."""
    counted = stored(_word_counts(made).where(F.col("n") >= min_count), "counted")
    words = stored(frequency_ids(counted), "words")
    langs = counted.select("lang").distinct().count()
    grams = words.select("lang", "id", "n", F.array("word").alias("words"))
    out, rows = grams, None
    for k in range(2, max_words + 1):
        rows = _number_words(made, words, langs) if rows is None else _number_pairs(rows, pairs, langs)
        sums = rows.mapInArrow(_count_pairs, "lang string, left int, right int, n long").groupBy("lang", "left", "right").agg(F.sum("n").alias("n"))
        counted = stored(sums.where(F.col("n") >= min_count), "counted")
        pairs = stored(frequency_ids(counted), "pairs")
        if not pairs.limit(1).count():
            break
        first = grams.select("lang", F.col("id").alias("left"), "words")
        last = grams.select("lang", F.col("id").alias("right"), F.element_at("words", -1).alias("last"))
        grams = stored(pairs.join(first, ["lang", "left"]).join(last, ["lang", "right"]).select(
            "lang", "id", "n", F.concat("words", F.array("last")).alias("words")), "grams")
        out = out.unionByName(grams)
    return out.select("lang", "words", "n")


def _joined(words) -> Column:
    return F.array_join(words, " ")


def _scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """``lang, phrase, words, a, l, r, n, score`` of all phrases of two words and more, by their lowest-scoring cut."""
    known = phrases.select("lang", _joined("words").alias("phrase"), F.col("n").alias("f"))
    cuts = phrases.where(F.size("words") > 1).select("lang", "words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select("*", _joined(F.slice("words", F.lit(1), F.col("k"))).alias("left"),
                       _joined(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k"))).alias("right"))
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]) \
        .join(known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]).join(totals, "lang")
    whole = "cast({} as decimal(16,0))"
    score = F.expr(f"(cast(1000 as decimal(4,0)) * {whole.format('a')} * {whole.format('n')}) div ({whole.format('l')} * {whole.format('r')})")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    return cuts.groupBy("lang", "words", "a", "n").agg(best.alias("b")).select(
        "lang", _joined("words").alias("phrase"), "words", "a", "b.l", "b.r", "n", "b.score")


def _inner_phrases(words: str) -> Column:
    """All phrases of two words and more that stand inside a longer one."""
    size = F.size(words)
    starts = lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda s: _joined(F.slice(words, s, m)))
    return F.flatten(F.transform(F.sequence(F.lit(2), size - 1), starts))


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, lang_col: str = "lang",
                 text_col: str = "text") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language.

    ``n`` counts a language's words, ``a`` a phrase's occurrences inside pieces, ``l`` and ``r`` those of the two parts at
    the cut with the lowest ``score = floor(1000 * a * n / (l * r))`` (exact; ties: the earliest cut). A phrase that stands
    inside a longer candidate at least as frequent is left out. Order: score, a (both falling), phrase.

    A null language is ``und``; a null or empty text has no words; repeated rows count as often as they occur; texts
    may be of any length (they are cut between pieces). Other columns are not read. An empty table gives an empty result.
    """
    made = segments(docs, lang_col, text_col)
    totals = made.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda x, c: x + c)).alias("n"))
    scored = stored(_scored(frequent_phrases(made, min_count, max_words), totals), "scored")
    longer = scored.where(F.size("words") > 2).select("lang", F.col("a").alias("more"), F.explode(_inner_phrases("words")).alias("phrase")) \
        .groupBy("lang", "phrase").agg(F.max("more").alias("more"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(F.col("more").isNull() | (F.col("more") < F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
