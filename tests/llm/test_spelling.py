"""Spelling variants against a plain comparison of all words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from featmart.llm import blooms, spelling
from featmart.llm.common import mix64
from featmart.llm.queries import op12_spelling_variants
from tests.conftest import SMALL


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words_of(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3}


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    k = next((i for i, c in enumerate(a) if c != b[i]), len(a))
    return a[k:] == b[k + 1:]


def brute(rows):
    words = words_of(rows)
    # words that are near share all letters but one of one of them: compare inside groups of equal rests only
    rests = {}
    for w in words:
        for k in range(len(w)):
            rests.setdefault((w[:k], w[k + 1:]), set()).add(w)
        for k in range(len(w) + 1):
            rests.setdefault((w[:k], w[k:]), set()).add(w)
    near = {w: set() for w in words}
    for group in rests.values():
        for a in group:
            near[a] |= {b for b in group if one_apart(a, b)}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), None if form[w] is None else words[form[w]]) for w, n in words.items()}


def found(df):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_equals_brute_force(spark, texts):
    want = brute(texts.items())
    assert len(want) > 500 and any(w[1] for w in want)
    assert found(op12_spelling_variants(spark, SMALL)) == want


def make(seed):
    """Few letters, so that neighbours, chains of forms and ties abound; accents, capitals and long words."""
    rng = random.Random(seed)
    letters = "abcdeéÿÀZ"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 8))) for _ in range(60)] + ["x" * 70 + "é" * 5, "ab" * 300]
    rows = []
    for i in range(300):
        out = []
        for _ in range(rng.randint(0, 60)):
            w = list(rng.choice(base[-2:] if rng.random() < 0.05 else base[:1 + i % len(base)]))
            for _ in range(rng.choice((0, 0, 1, 2))):
                k = rng.randrange(len(w) + 1)
                w[k:k + rng.choice((0, 1))] = rng.choice((rng.choice(letters), ""))
            out.append("".join(w))
        rows.append((rng.choice((i, None)), rng.choice((" ", "-", "×", "\n", "ŀ")).join(out)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = make(seed)
    want = brute(rows)
    assert max(len(w[0]) for w in want) > 64
    assert found(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))) == want


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    """Beyond its bound a filter lets more through; the exact join removes it."""
    rows = make(3)
    monkeypatch.setattr(blooms.blocks_for, "__defaults__", (64,))
    assert found(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_chain_of_forms(spark):
    rows = [(1, "abcdef " * 200 + "abcdeg " * 90 + "abcdhg " * 40 + "abcihg " * 15 + "zzzzz zzzzz zzzzz yyyyy yyyyy")]
    got = {r.word: (r.form, r.root, r.n_near) for r in spelling.variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {w: (f, r, k) for w, f, r, _, k, _ in brute(rows)}
    assert got == want
    assert got["abcihg"][1] == "abcdef" and got["zzzzz"] == (None, "zzzzz", 0)


def test_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(spelling.variants(odd)) == brute(rows)
    assert spelling.variants(none).collect() == []


def test_filter_holds_every_key():
    keys = mix64(np.arange(5000, dtype=np.uint64))
    blocks = blooms.blocks_for({7: 5000})[7]
    bits = np.zeros(blocks, np.uint64)
    batch = blooms.rows(7, keys, blocks)
    np.bitwise_or.at(bits, batch["block"].to_numpy(), batch["mask"].to_numpy().view(np.uint64))
    assert blooms.hit(bits, keys).all()
    assert blooms.hit(bits, mix64(np.arange(10**6, 2 * 10**6, dtype=np.uint64))).mean() < 0.02
    assert sum(blooms.blocks_for({k: 10**10 for k in range(60)}).values()) * 8 <= blooms.MAX_BYTES
