"""Collocations against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from featmart.llm import phrases
from featmart.llm.queries import op13_collocations

SCHEMA = "lang string, text string"


def brute(rows, min_count, top=2000, max_words=5):
    total, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, max_words + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    f = {key: n for key, n in f.items() if n >= min_count}
    best, covered = {}, Counter()
    for (lang, words), a in f.items():
        if len(words) < 2:
            continue
        n = total[lang]
        cuts = [(1000 * a * n // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        best[lang, words] = (a, f[lang, words[:k]], f[lang, words[k:]], n, score)
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                covered[lang, words[i:i + m]] = max(covered[lang, words[i:i + m]], a)
    out = set()
    for lang in total:
        mine = [(-v[4], -v[0], " ".join(w).encode(), v) for (x, w), v in best.items() if x == lang and covered[x, w] < v[0]]
        out |= {(lang, rank, p.decode(), *v) for rank, (_, _, p, v) in enumerate(sorted(mine)[:top], 1)}
    return out


def found(df):
    rows = [tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def make(seed, n=400):
    """Phrases that repeat, overlap themselves and cross languages; every separator; a null language beside ``und``."""
    rng = random.Random(seed)
    words = ["a", "b", "A", "é", "É", "to", "be", "or", "not", "x-y", " z", "🙂"] + [f"w{i}" for i in range(30)]
    fixed = ["to be or not to be", "a a a a a a", "New York City Hall", "b é 🙂 x-y  z b"]
    rows = []
    for i in range(n):
        text = "".join(rng.choice([rng.choice(fixed), rng.choice(words), rng.choice(words)]) + rng.choice(["  ", " ", "\t", " ", ", ", ".", "\n", "\x0b", "!?"])
                       for _ in range(rng.randint(0, 40)))
        rows.append((rng.choice(["en", "en", "en", "fr", None, "und"]), text if i % 50 else None))
    return rows


@pytest.mark.parametrize("seed,min_count,top", [(1, 100, 2000), (2, 10, 2000), (3, 4, 25)])
def test_equals_brute_force(spark, seed, min_count, top):
    rows = make(seed)
    want = brute(rows, min_count, top)
    assert any(len(w[2].split(" ")) == 5 for w in want) and {w[0] for w in want} == {"en", "fr", "und"}
    assert found(phrases.collocations(spark.createDataFrame(rows, SCHEMA).repartition(7), min_count, top=top)) == want


@pytest.mark.parametrize("hot", [1 << 18, 9])
def test_small_tiles_and_segments(spark, monkeypatch, hot):
    """Every tile path: dense, sparse, sums sent early; texts cut into many segments; numbers broadcast or joined."""
    rows = make(4) + [("en", "\n".join(t or "" for _, t in make(5, 300)))]
    for name, value in (("SIDE", 4), ("TILES", 3), ("COORDINATES", 20), ("SEGMENT", 500), ("OPEN", 900), ("HOT", hot)):
        monkeypatch.setattr(phrases, name, value)
    assert found(phrases.collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), 6)) == brute(rows, 6)


def test_tiles_count_every_pair(monkeypatch):
    monkeypatch.setattr(phrases, "SIDE", 8)
    rng = np.random.default_rng(1)
    left, right = (rng.geometric(0.02, 5000).astype(np.int32) for _ in range(2))
    tiles = phrases._Tiles()
    tiles.add("en", left[:2500], right[:2500])
    tiles.add("en", left[2500:], right[2500:])
    got = {(a, b): n for batch in tiles.flush() for _, a, b, n in zip(*(c.to_pylist() for c in batch.columns))}
    assert got == Counter(zip(left.tolist(), right.tolist()))
    assert not list(tiles.flush())


def test_ids_follow_frequency(spark):
    rows = [("en" if i % 3 else None, f"w{i}", 1 + i % 17) for i in range(500)]
    got = phrases.frequency_ids(spark.createDataFrame(rows, "lang string, word string, n long").na.fill("und")).collect()
    for lang in ("en", "und"):
        mine = sorted((r.id, r.n) for r in got if r.lang == lang)
        assert [i for i, _ in mine] == list(range(len(mine)))
        assert [n for _, n in mine] == sorted((n for _, n in mine), reverse=True)


def test_scores_beyond_64_bits(spark):
    big = 3 * 10**12
    known = spark.createDataFrame([("en", ["a"], big), ("en", ["b"], big), ("en", ["a", "b"], big - 1)], "lang string, words array<string>, n long")
    totals = spark.createDataFrame([("en", 10**13)], "lang string, n long")
    row = phrases._scored(known, totals).first()
    assert row.score == 1000 * (big - 1) * 10**13 // (big * big)


def test_odd_rows(odd, none, tmp_path):
    rows = [(r.lang, r.text) for r in odd.collect()]
    assert found(phrases.collocations(odd, 3)) == brute(rows, 3)
    assert phrases.collocations(none).collect() == []


def test_query_runs_on_rows_without_candidates(spark, none, tmp_path):
    none.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    assert op13_collocations(spark, str(tmp_path)).collect() == []
