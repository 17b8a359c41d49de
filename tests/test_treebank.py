"""Treebank tokens: the published examples, and the rules one after another in plain Python."""

import random
import re

import pytest

from featmart.operators import treebank as tb

EXAMPLES = [
    ("They'll save and invest more.", "They 'll save and invest more ."),
    ("hi, my name can't hello,", "hi , my name ca n't hello ,"),
    ("Good muffins cost $3.88\nin New York. Please buy me\ntwo of them.\nThanks.",
     "Good muffins cost $ 3.88 in New York . Please buy me two of them . Thanks ."),
    ('"We beat them," he said. "Well done!"', "`` We beat them , '' he said . `` Well done ! ''"),
    ("The U.S. economy (1,000 people) grew 3:1; right?", "The U.S. economy ( 1,000 people ) grew 3:1 ; right ?"),
    ("I cannot gonna wanna lemme -- it's the dogs' bone...", "I can not gon na wan na lem me -- it 's the dogs ' bone ..."),
    ("'Tis I'd we've YOU'RE DON'T [a] {b} <c>", "'T is I 'd we 've YOU 'RE DO N'T [ a ] { b } < c >"),
    ("", ""), (None, ""), (" \n\t ", ""), ("a@b 50% #1 x&y", "a @ b 50 % # 1 x & y"),
]


def plain(text):
    out = "\n" + (text or "") + "\n"
    for pattern, replacement in tb.RULES:
        out = re.sub(pattern, replacement, out)
    return [t for t in re.split("[ \n\t\r\x0b\x0c]+", out) if t]


@pytest.mark.parametrize("text,want", EXAMPLES)
def test_published_examples(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(tb.treebank_tokens("t").alias("x")).first().x == want.split()


def test_equals_the_rules_one_after_another(spark):
    rng = random.Random(3)
    parts = ["can't", "cannot", "\"", "'", "''", "...", ".", "U.S.", "a", "B", "é", " ", " ", "\n", "\t", ",", ":", "1,5", "3", "--", "-", "?", "!", "(", ")", "[",
             "it's", "gonna", "dogs'", "$5", "\\", "$1", "🙂", "<", "}", "'ll", "n't", "d'ye", "more'n", "'tis"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.x for r in df.select("i", tb.treebank_tokens("t").alias("x")).collect()}
    assert all(got[i] == plain(t) for i, t in enumerate(texts))


def test_protected_spans_stay_whole(spark):
    address = r"[A-Za-z0-9.]+@[A-Za-z0-9.]+[A-Za-z]|https?://[^ ]+"
    df = spark.createDataFrame([("Mail me@x.org, or see https://a.b/c?d=1&e! It's \"ok\".",), ("none",), ("a@b.c",), (None,)], "t string")
    got = [r.x for r in df.select(tb.treebank_tokens("t", address).alias("x")).collect()]
    assert got[0] == ["Mail", "me@x.org", ",", "or", "see", "https://a.b/c?d=1&e!", "It", "'s", "``", "ok", "''", "."]
    assert got[1] == ["none"] and got[2] == ["a@b.c"] and got[3] == []


def test_rules_are_skipped_only_where_they_change_nothing(spark):
    """Texts that hold what a rule needs, or all but hold it, in any case."""
    rng = random.Random(11)
    parts = [" cannot ", "Cannot", " GONNA ", " 'tis ", " more'n", " d'ye ", "...", "..", "--", "-", '"', "\n\"", "' ", "'", "n't ", "N'T", "?", "!", " ", "\n", "a", "é"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(400)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", tb.treebank_tokens("t").alias("x")).collect()
    assert {r.i: r.x for r in rows} == {i: plain(t) for i, t in enumerate(texts)}
    assert all(re.search(tb.TWO_WORDS, t) for t in (" cannot ", " Gonna ", " 'TWAS ")) and not re.search(tb.TWO_WORDS, "cannot")
    assert set(tb.HOLDS) < {p for p, _ in tb.RULES}
