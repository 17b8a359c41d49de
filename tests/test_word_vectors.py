"""Word-vector files against a plain parser."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from featmart.sources.word_vectors import read_word_vectors, write_word_vectors


def made(n, dim, seed=1):
    rng = np.random.default_rng(seed)
    words = [f"wört{i}" if i % 3 else f"w{i}-{'x' * (i % 50)}" for i in range(n)]
    return words, rng.normal(size=(n, dim)).astype(np.float32)


def text_file(path, words, vectors, heading):
    lines = [f"{len(words)} {vectors.shape[1]}"] if heading else []
    lines += [w + " " + " ".join(repr(float(x)) for x in v) for w, v in zip(words, vectors)]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def binary_file(path, words, vectors, breaks):
    with open(path, "wb") as f:
        f.write(f"{len(words)} {vectors.shape[1]}\n".encode())
        for w, v in zip(words, vectors):
            f.write(w.encode() + b" " + v.tobytes() + (b"\n" if breaks else b""))


def check(df, words, vectors):
    got = {r.word: r.vector for r in df.collect()}
    assert len(got) == len(words)
    assert all(np.array_equal(np.array(got[w], dtype=np.float32), v) for w, v in zip(words, vectors))


@pytest.mark.parametrize("heading", [True, False])
@pytest.mark.parametrize("size", [37, 1000, 1 << 20])
def test_text_in_byte_ranges(spark, tmp_path, heading, size):
    words, vectors = made(300, 4)
    text_file(tmp_path / "v.txt", words, vectors, heading)
    df = read_word_vectors(spark, str(tmp_path / "v.txt"), rangebytes=size)
    check(df, words, vectors)
    assert (df.rdd.getNumPartitions() > 1) == (size < 1 << 20)


@pytest.mark.parametrize("breaks", [True, False])
def test_binary_in_ranges(spark, tmp_path, breaks):
    words, vectors = made(500, 7)
    binary_file(tmp_path / "v.bin", words, vectors, breaks)
    df = read_word_vectors(spark, str(tmp_path / "v.bin"), "binary", rangerows=60)
    assert df.rdd.getNumPartitions() == 9
    check(df, words, vectors)


def test_hundred_thousand_words_by_several_tasks(spark, tmp_path):
    words, vectors = made(100_000, 8)
    binary_file(tmp_path / "v.bin", words, vectors, False)
    df = read_word_vectors(spark, str(tmp_path / "v.bin"), "binary", rangerows=20_000)
    assert df.rdd.getNumPartitions() == 5
    total = df.select(F.explode("vector").alias("x")).agg(F.sum("x"), F.count("x")).first()
    assert total[1] == 800_000 and total[0] == pytest.approx(float(vectors.astype(np.float64).sum()), abs=1e-3)
    assert df.select("word").distinct().count() == len(set(words))


def test_written_and_read_back(spark, tmp_path):
    words, vectors = made(50, 3)
    df = spark.createDataFrame([(w, [float(x) for x in v]) for w, v in zip(words, vectors)], "word string, vector array<float>").repartition(3)
    write_word_vectors(df, str(tmp_path / "out"))
    check(read_word_vectors(spark, str(tmp_path / "out")), words, vectors)


def test_empty_and_broken_files(spark, tmp_path):
    (tmp_path / "empty.txt").write_bytes(b"")
    assert read_word_vectors(spark, str(tmp_path / "empty.txt")).collect() == []
    (tmp_path / "cut.bin").write_bytes(b"3 4\nabc ")
    with pytest.raises(Exception, match="cut off"):
        read_word_vectors(spark, str(tmp_path / "cut.bin"), "binary").collect()
