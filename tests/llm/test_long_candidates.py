"""Candidates of any length: entropy spans across pieces, and time in proportion to the length."""

import random
import time

from pyspark.sql import functions as F

from featmart.llm import secret_scan
from tests.llm.test_rowwise import _entropy


def test_spans_across_pieces(spark, monkeypatch):
    monkeypatch.setattr(secret_scan, "PIECE", 7)
    rng = random.Random(11)
    values = ["".join(rng.choice(rng.choice(["ab1", "0123456789abcdef", secret_scan.ALPHABET])) for _ in range(rng.choice((1, 19, 20, 21, 60, 300))))
              for _ in range(60)]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for r in df.select("v", secret_scan.entropy_spans(F.col("v"), F.lit(3.2)).alias("s")).collect():
        flags = [False] * len(r.v)
        for i in range(len(r.v) - secret_scan.WINDOW + 1):
            if _entropy(r.v[i:i + secret_scan.WINDOW]) >= 3.2 - 1e-6:
                flags[i:i + secret_scan.WINDOW] = [True] * secret_scan.WINDOW
        got = [False] * len(r.v)
        for s in r.s:
            got[s.start:s.end] = [True] * (s.end - s.start)
        assert got == flags
        assert all(a.end < b.start for a, b in zip(r.s, r.s[1:]))


def test_a_candidate_of_a_megabyte(spark):
    rng = random.Random(12)
    text = "image " + "".join(rng.choice(secret_scan.ALPHABET[:62]) for _ in range(1 << 20)) + " end"
    begin = time.perf_counter()
    row = secret_scan.secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert time.perf_counter() - begin < 60
    assert row.spans and row.spans[0].start >= 6 and row.spans[-1].end <= len(text) - 4
    assert sum(s.end - s.start for s in row.spans) > 1 << 19
