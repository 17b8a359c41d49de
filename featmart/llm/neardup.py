"""Near-duplicate classes of documents by weighted Jaccard similarity of word shingles.

A text is the multiset of its runs of five lower-cased words (a text of fewer words is one run); the
similarity of two texts is ``sum(min) / sum(max)`` of the run counts. Signatures come from throwing
darts: every run owns the same random darts in the plane (weight, time) wherever it occurs, a dart is
kept if its weight coordinate lies under the run's weight in the text, every dart belongs to one of
``k`` coordinates, and the earliest kept dart of a coordinate is the signature there. Two texts agree
in a coordinate with probability equal to their similarity. Darts are generated region by region
(doubling weight and time intervals, a Poisson number in each), in order of time, until every
coordinate of a text is filled, which takes about ``k log k`` darts whatever the text's length.

Links: exact copies are first folded into one representative. Texts that agree in all rows of one of
``bands`` bands are candidates; each bucket is joined to its first text, and the components of these
joins are *families*. Inside a family, texts that no link joins yet are compared by the exact
similarity and every new link is kept, so that no link between components is missed and none inside
one is listed: a family of ``n`` texts gives at most ``n - 1`` links from a group.

Bounds: a block of texts at a time inside a task. A family of more than ``FAMILY`` texts is cut into
parts by a hash, and each two parts meet in a group of their own, so no task has more than two parts.
Chance of missing a pair of similarity 0.8 with 36 bands of 6 rows: 2e-5.

Defined edge cases: null, empty and wordless texts are copies of each other; repeated rows are
copies; a null id stays null and never names a class that has another id; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featmart.llm.common import (LOWER, NON_WORD, blocks, gram_hash, id_text, inside, let_go, mix64, prefix_hash,
                                 range_hash, row_key, stored)

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 36
ROWS = 6
FAMILY = 4096  # texts in one part of a family
DENSE = 32  # runs of at least so many texts of a group are compared as bits
FIRST_TIME = 1 / 64  # end of the first time interval; later ones double

_cdf: dict[float, np.ndarray] = {}


def _poisson(mean: float) -> np.ndarray:
    """Cumulative probabilities of a Poisson count."""
    if mean not in _cdf:
        n = np.arange(int(mean + 12 * math.sqrt(mean) + 24))
        log_p = n * math.log(mean) - mean - np.array([math.lgamma(i + 1) for i in n])
        _cdf[mean] = np.cumsum(np.exp(log_p))
    return _cdf[mean]


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


def dart_signatures(keys: np.ndarray, weights: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """``(sets, k)`` signatures of weighted sets; set ``i`` has elements ``first[i]:first[i + 1]``.

    Weights are positive. A set without elements has a row of zeros.
    """
    sets = len(first) - 1
    size = np.diff(first)
    owner = np.repeat(np.arange(sets), size)
    time = np.full(sets * k, np.inf)
    out = np.zeros(sets * k, dtype=np.uint64)
    todo = size > 0
    begin, end, region = 0.0, FIRST_TIME, 0
    while todo.any():
        live = np.flatnonzero(todo[owner])
        low, high, layer = 0.0, 1.0, 0
        while len(live):
            salt = mix64(np.array([(region << 20) + layer + 1], dtype=np.uint64))[0]
            h = mix64(keys[live] ^ salt)
            cdf = _poisson((high - low) * (end - begin))
            u = _unit(h)
            some = np.flatnonzero(u >= cdf[0])
            n = np.searchsorted(cdf, u[some], side="right")
            at, h = np.repeat(live[some], n), np.repeat(h[some], n)
            serial = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
            dart = mix64(h + (serial.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
            under = low + (high - low) * _unit(dart) < weights[at]
            at, dart = at[under], dart[under]
            other = mix64(dart ^ np.uint64(0xA0761D6478BD642F))
            when = begin + (end - begin) * _unit(other)
            slot = owner[at] * k + (dart % np.uint64(k)).astype(np.int64)
            np.minimum.at(time, slot, when)
            won = time[slot] == when
            out[slot[won]] = other[won]
            low, high, layer = high, high * 2, layer + 1
            live = live[weights[live] > low]
        todo &= ~np.isfinite(time.reshape(sets, k)).all(axis=1)
        begin, end, region = end, end * 2, region + 1
    return out.reshape(sets, k)


def _shingles(block, n: int):
    """Run hash and text number of every run, runs of one text together; hash of each word sequence."""
    starts, ends = block.words(NON_WORD)
    words = range_hash(prefix_hash(block.data, LOWER), starts, ends)
    per_text, first = block.counts(starts)
    text_of = np.repeat(np.arange(len(block)), per_text)
    at = np.flatnonzero(inside(per_text, first, n, len(words)))
    grams, owner = gram_hash(words, n)[at], text_of[at]
    short = np.flatnonzero((per_text > 0) & (per_text < n))
    if len(short):
        whole = np.array([gram_hash(words[first[i]:first[i + 1]], int(per_text[i]))[0] for i in short], dtype=np.uint64)
        grams, owner = np.append(grams, whole), np.append(owner, short)
    copies = [hashlib.md5(words[first[i]:first[i + 1]].tobytes()).digest() for i in range(len(block))]
    return grams, owner, copies


def sketches(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, n: int = SHINGLE,
             id_col: str = "doc_id", text_col: str = "text", key: Column | None = None) -> DataFrame:
    """Stored: ``row`` (unique), ``doc_id``, ``copy`` (hash of the word sequence), ``size`` (number of
    runs), ``buckets`` (a hash for each band) and ``runs`` (sorted 32-bit hashes of (run, occurrence),
    whose plain intersection is the weighted one); and ``key``, if given (a long)."""
    k = bands * rows
    read = id_text(docs, id_col, text_col) if key is None else docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), key.alias("key"))
    more = read.columns[2:]

    def run(batches):
        let_go()
        base, number = TaskContext.get().partitionId() << 36, 0
        for b in blocks(batches):
            grams, owner, copies = _shingles(b, n)
            order = np.lexsort((grams, owner))
            grams, owner = grams[order], owner[order]
            new = np.append(True, (np.diff(grams) != 0) | (np.diff(owner) != 0))[:len(grams)]
            begin = np.flatnonzero(new)
            weight = np.diff(np.append(begin, len(grams)))
            occurrence = np.arange(len(grams)) - np.repeat(begin, weight)
            runs = (mix64(grams + occurrence.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(32)).astype("<u4")
            sig = dart_signatures(grams[begin], weight.astype(np.float64),
                                  np.searchsorted(owner[begin], np.arange(len(b) + 1)), k)
            size = np.bincount(owner, minlength=len(b))
            last = np.cumsum(size)
            keys = gram_hash_rows(sig.reshape(len(b) * bands, rows)).reshape(len(b), bands)
            keys = mix64(keys + np.arange(bands, dtype=np.uint64)[None, :]).view(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(base + number + np.arange(len(b))), b.rows.column(0), pa.array(copies, pa.binary()),
                pa.array(size.astype(np.int64)),
                pa.array([x if s else None for x, s in zip(keys, size)], pa.list_(pa.int64())),
                pa.array([np.sort(runs[e - s:e]).tobytes() for s, e in zip(size, last)], pa.binary()),
                *b.rows.columns[2:],
            ], ["row", "doc_id", "copy", "size", "buckets", "runs", *more])
            number += len(b)

    return stored(read.mapInArrow(run, "row long, doc_id long, copy binary, size long, buckets array<long>, runs binary"
                                  + "".join(f", {c} long" for c in more)), "sketches")


def gram_hash_rows(values: np.ndarray) -> np.ndarray:
    """One hash for each row of a matrix of hashes."""
    h = np.zeros(len(values), dtype=np.uint64)
    for column in values.T:
        h = mix64(h + column)
    return h


def _family_links(similarity: float):
    """Links between the texts of one group ``(row, runs)``, as few as join what they join."""

    def run(table: pa.Table) -> pa.Table:
        let_go()
        rows = table.column("row").to_numpy()
        runs = [np.unique(np.frombuffer(x.as_buffer(), "<u4")) for x in table.column("runs")]
        size = np.array([len(x) for x in runs])
        order = np.lexsort((rows, size))
        rows, size, runs = rows[order], size[order], [runs[i] for i in order]
        n = len(rows)
        uniq, place, df = np.unique(np.concatenate(runs), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(n), size)
        # runs of many texts: one bit for each; runs of few: lists of their texts
        column = np.cumsum(df >= DENSE) - 1
        dense = df[place] >= DENSE
        bits = np.zeros((n, int(column[-1]) // 64 + 1 if n else 1), dtype=np.uint64)
        at = column[place[dense]]
        np.bitwise_or.at(bits, (owner[dense], at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
        few = ~dense & (df[place] > 1)
        by_run = np.argsort(place[few], kind="stable")
        listed, run_of = owner[few][by_run], place[few]
        starts = np.searchsorted(run_of[by_run], np.arange(len(uniq) + 1))
        first = np.searchsorted(owner[few], np.arange(n + 1))
        part = np.arange(n)
        out = []
        last = np.searchsorted(size, size / similarity + 1e-9, side="right")  # longer ones are too long
        for i in range(n):
            js = np.arange(i + 1, last[i])
            js = js[part[js] != part[i]]
            if not len(js):
                continue
            common = np.bitwise_count(bits[js] & bits[i]).sum(axis=1, dtype=np.int64)
            mine = run_of[first[i]:first[i + 1]]
            if len(mine):
                length = starts[mine + 1] - starts[mine]
                inner = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
                common += np.bincount(listed[np.repeat(starts[mine], length) + inner], minlength=n)[js]
            for j in js[common >= similarity * (size[i] + size[js] - common) - 1e-9]:
                if part[j] != part[i]:
                    out.append((rows[i], rows[j]))
                    part[part == part[j]] = part[i]
        return pa.table({"a": pa.array([x[0] for x in out], pa.int64()), "b": pa.array([x[1] for x in out], pa.int64())})

    return run


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of an edge list ``(a, b)``: the label is the least node of its
    component. Each round hooks every node to its least neighbour, flattens the trees by pointer
    jumping and contracts the edges; each table is stored in the shared folder."""
    edges = stored(edges.where("a <> b").select("a", "b").distinct(), "edges")
    label = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = stored(both.groupBy("a").agg(F.min("b").alias("b"))
                        .select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "parents")
        while True:
            up = parent.select(F.col("node").alias("label"), F.col("label").alias("upper"))
            nxt = stored(parent.join(up, "label").select("node", F.col("upper").alias("label"),
                                                         (F.col("upper") != F.col("label")).alias("moved")), "parents")
            parent = nxt.select("node", "label")
            if not nxt.agg(F.max("moved")).first()[0]:
                break
        up = parent.select(F.col("node").alias("label"), F.col("label").alias("upper"))
        label = parent if label is None else stored(label.join(up, "label", "left").select(
            "node", F.coalesce("upper", "label").alias("label")), "labels")
        edges = stored(edges.join(parent.select(F.col("node").alias("a"), F.col("label").alias("x")), "a")
                       .join(parent.select(F.col("node").alias("b"), F.col("label").alias("y")), "b")
                       .where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")) if label is None else label


def links(sketch: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """``(texts, label)``: the representatives ``(row, copy)`` of exact copies, and ``(node, label)``
    for the representatives that have a link."""
    texts = stored(sketch.groupBy("copy").agg(F.min("row").alias("row"), F.first("buckets").alias("buckets")), "texts")
    member = texts.select("row", F.explode("buckets").alias("bucket"))
    heads = member.groupBy("bucket").agg(F.count("*").alias("n"), F.min("row").alias("head")).where("n > 1")
    family = components(member.join(heads, "bucket").select(F.col("head").alias("a"), F.col("row").alias("b")))
    parts = family.groupBy("label").agg(F.ceil(F.count("*") / FAMILY).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    other = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda i: i != own))
    spread = (family.join(parts, "label").select(F.col("node").alias("row"), "label", own.alias("own"), F.explode(other).alias("other"))
              .select("row", "label", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y")))
    # one plan at every size: the families grow with the corpus, so they are never the side to broadcast
    runs = sketch.select("row", "runs").join(spread.hint("merge"), "row")
    found = runs.groupBy("label", "x", "y").applyInArrow(_family_links(similarity), "a long, b long")
    return texts.select("row", "copy"), components(found)


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS,
                    id_col: str = "doc_id", text_col: str = "text", key: Column | None = None) -> DataFrame:
    """One row per input row: ``doc_id``, ``class_id`` (least id of its class), ``copy_id`` (least id
    of its exact copies) and ``first`` (true for one row of each class); with a ``key`` of the rows,
    also ``key`` and ``label`` (a number for each class)."""
    sketch = sketches(docs, bands, rows, id_col=id_col, text_col=text_col, key=key)
    keys = [] if key is None else ["key"]
    texts, label = links(sketch, similarity)
    ids = sketch.groupBy("copy").agg(F.min("doc_id").alias("copy_id"))
    classes = (texts.select("copy", "row").join(label.withColumnRenamed("node", "row"), "row", "left")
               .select("copy", F.coalesce("label", "row").alias("label")).join(ids, "copy"))
    classes = stored(classes, "classes")
    heads = classes.groupBy("label").agg(F.min("copy_id").alias("class_id"))
    named = classes.join(heads, "label").select("copy", "label", "copy_id", "class_id")
    chosen = sketch.select("copy", "doc_id", "row", *keys).join(named, "copy")
    first = stored(chosen, "members")
    head = first.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"].alias("row")).select("row", F.lit(True).alias("first"))
    return first.join(head, "row", "left").select("doc_id", "class_id", "copy_id", F.coalesce("first", F.lit(False)).alias("first"),
                                                 *keys, *(["label"] if keys else []))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without all but one row of each class, that of the least id. Rows are told apart by id and
    text: of rows that share an id each is judged by its own text. Rows without an id are compared with all
    others, and one of those in a class stays, beside the one with an id."""
    key = row_key(id_col, text_col)
    out = near_duplicates(docs, id_col=id_col, text_col=text_col, key=key, **options)
    best = out.groupBy("label", F.col("doc_id").isNull()).agg(F.min(F.struct("doc_id", "key"))["key"].alias("__kept"))
    kept = stored(best.select("__kept"), "kept")
    # the kept rows grow with the corpus: one plan at every size
    rows = docs.withColumn("__row_key", key)
    stay = rows.join(kept.hint("merge"), rows["__row_key"] == kept["__kept"], "left_semi")
    if not out.groupBy("key").count().where("count > 1").isEmpty():
        stay = stay.dropDuplicates(["__row_key"])
    return stay.drop("__row_key")
