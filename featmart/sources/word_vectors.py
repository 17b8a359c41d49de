"""Word-vector files (SRC-13) as a Spark data source: text (a word and its numbers a line, with or without a heading
line) and binary (heading line, then each word, a blank and its 32-bit numbers), one file or a folder of files.

A file is planned as byte ranges, so one large file is read by many tasks. A text range begins after the line break at
or before its start. Binary records do not show where they begin, so the planner walks from word to word, skipping the
numbers, and notes where every ``rows`` records start.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "word string, vector array<float>"
_ARROW = pa.schema([("word", pa.string()), ("vector", pa.list_(pa.float32()))])
_BATCH = 2048
_LONGEST_WORD = 4096


@dataclass
class _Range(InputPartition):
    path: str
    start: int
    end: int  # of text: first byte not to begin a line at; of binary: number of records
    dim: int


def _files(path: str) -> tuple[fs.FileSystem, list[fs.FileInfo]]:
    system, inner = fs.FileSystem.from_uri(path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.is_file else [f for f in system.get_file_info(fs.FileSelector(inner)) if f.is_file and not f.base_name.startswith(("_", "."))]
    return system, sorted((f for f in found if f.size), key=lambda f: f.path)


def _heading(line: bytes) -> tuple[int, int] | None:
    """``(words, dim)`` if a line is a heading: two whole numbers."""
    parts = line.split()
    return (int(parts[0]), int(parts[1])) if len(parts) == 2 and parts[0].isdigit() and parts[1].isdigit() else None


def _batches(rows: Iterator[tuple[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    words, vectors = [], []

    def made() -> pa.RecordBatch:
        offsets = np.concatenate([[0], np.cumsum([len(v) for v in vectors])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(vectors).astype(np.float32)))
        return pa.record_batch([pa.array(words, pa.string()), lists], schema=_ARROW)

    for word, vector in rows:
        words.append(word)
        vectors.append(vector)
        if len(words) == _BATCH:
            yield made()
            words, vectors = [], []
    if words:
        yield made()


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.binary = options["path"], options.get("form", "text") == "binary"
        self.range_bytes, self.range_rows = int(options.get("rangebytes", 64 << 20)), int(options.get("rangerows", 50_000))

    def partitions(self) -> list[_Range]:
        system, files = _files(self.path)
        out = []
        for f in files:
            with system.open_input_file(f.path) as file:
                out += self._binary_ranges(file, f) if self.binary else [
                    _Range(f.path, a, min(a + self.range_bytes, f.size), 0) for a in range(0, f.size, self.range_bytes)]
        return out or [_Range("", 0, 0, 0)]

    def _binary_ranges(self, file, info) -> Iterator[_Range]:
        file.seek(0)
        line = bytes(file.read(64)).split(b"\n", 1)[0]
        heading = _heading(line)
        if heading is None:
            raise ValueError(f"no heading line: {info.path}")
        n, dim = heading
        at, start = len(line) + 1, len(line) + 1
        for i in range(n):
            if i and i % self.range_rows == 0:
                yield _Range(info.path, start, self.range_rows, dim)
                start = at
            file.seek(at)
            word, size = b"", 64
            while b" " not in word:
                word = bytes(file.read_at(size, at))
                if len(word) < size and b" " not in word or size > _LONGEST_WORD:
                    raise ValueError(f"record {i} is cut off: {info.path}")
                size *= 4
            at += word.index(b" ") + 1 + 4 * dim
            if bytes(file.read_at(1, at)) == b"\n":
                at += 1
        if n:
            yield _Range(info.path, start, n - (n - 1) // self.range_rows * self.range_rows, dim)

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return iter(())
        system, _ = fs.FileSystem.from_uri(self.path)
        return _batches((self._records if self.binary else self._lines)(system, partition))

    def _lines(self, system, part: _Range) -> Iterator[tuple[str, np.ndarray]]:
        with system.open_input_file(part.path) as file:
            # a later range begins one byte early: the rest of a line that began before is skipped with its break
            first, skip = part.start == 0, part.start > 0
            at, rest = part.start - skip, b""
            file.seek(at)
            while at < part.end:
                block = bytes(file.read(1 << 20))
                if not block:
                    break
                rest += block
                lines = rest.split(b"\n")
                rest = lines.pop()
                for line in lines:
                    begin, at = at, at + len(line) + 1
                    if skip:
                        skip = False
                        continue
                    if begin >= part.end:
                        return
                    if first and _heading(line):
                        first = False
                        continue
                    first = False
                    if line.strip():
                        yield self._parsed(line)
            if rest.strip() and not skip and at < part.end and not (first and _heading(rest)):
                yield self._parsed(rest)

    @staticmethod
    def _parsed(line: bytes) -> tuple[str, np.ndarray]:
        word, *numbers = line.rstrip(b" \r").split(b" ")
        return word.decode("utf-8", "replace"), np.array(numbers, dtype=np.float32)

    @staticmethod
    def _records(system, part: _Range) -> Iterator[tuple[str, np.ndarray]]:
        with system.open_input_file(part.path) as file:
            file.seek(part.start)
            held = b""
            for _ in range(part.end):
                while (space := held.find(b" ")) < 0 or len(held) < space + 2 + 4 * part.dim:
                    block = bytes(file.read(1 << 20))
                    if not block:
                        break
                    held += block
                word, body = held[:space], held[space + 1:space + 1 + 4 * part.dim]
                yield word.lstrip(b"\n").decode("utf-8", "replace"), np.frombuffer(body, "<f4")
                held = held[space + 1 + 4 * part.dim:]
                if held[:1] == b"\n":
                    held = held[1:]


class WordVectors(DataSource):
    """``spark.read.format("wordvectors").option("form", "text" or "binary").load(path)``."""

    @classmethod
    def name(cls) -> str:
        return "wordvectors"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


def read_word_vectors(spark: SparkSession, path: str, form: str = "text", **options) -> DataFrame:
    """``word, vector`` of a word-vector file or folder. ``rangebytes`` (text) and ``rangerows`` (binary) are a task's share.
    Blank lines are skipped; an empty file has no words; bytes that are no UTF-8 are replaced."""
    spark.dataSource.register(WordVectors)
    return spark.read.format("wordvectors").option("form", form).options(**options).load(path)


def write_word_vectors(df: DataFrame, path: str, word: str = "word", vector: str = "vector") -> None:
    """The text form, a folder with a file for each task."""
    from pyspark.sql import functions as F
    numbers = F.array_join(F.transform(vector, lambda x: x.cast("string")), " ")
    df.select(F.concat_ws(" ", word, numbers)).write.text(path)
