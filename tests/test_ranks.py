"""Exact order statistics against numpy."""

import math
import random

import numpy as np
import pytest

from featmart.operators import ranks
from featmart.operators.layout import split_points, with_bucket

PROBS = [0, 0.1, 0.25, 1 / 3, 0.5, 0.9, 0.999, 1.0]


def table(spark, n, seed=1):
    rng = random.Random(seed)
    rows = [(rng.gauss(0, 1), float(rng.choice([1, 1, 1, 2, 5])), rng.choice([None, float("nan"), 3.0, -1e300, 1e12]), None, rng.randrange(7),
             rng.choice([math.inf, -math.inf, 0.0])) for _ in range(n)]
    return spark.createDataFrame(rows, "x double, few double, holes double, none double, whole int, ends double").repartition(5), rows


@pytest.mark.parametrize("n,accuracy", [(1, 10_000), (2, 10_000), (301, 10_000), (5000, 20)])
def test_quantiles_equal_numpy(spark, monkeypatch, n, accuracy):
    df, rows = table(spark, n)
    monkeypatch.setattr(ranks.values_at, "__defaults__", (accuracy,))
    got = ranks.quantiles(df, ["x", "few", "holes", "none", "whole", "ends"], PROBS)
    for i, c in enumerate(["x", "few", "holes", "none", "whole"]):
        values = [r[i] for r in rows if r[i] is not None and not math.isnan(r[i])]
        assert got[c] == (pytest.approx(list(np.quantile(values, PROBS)), rel=1e-12) if values else [None] * len(PROBS)), c
    ends = sorted(r[5] for r in rows)
    assert got["ends"][0] == ends[0] and got["ends"][-1] == ends[-1]


def test_equal_count_cuts_and_bins(spark):
    df, rows = table(spark, 997)
    cuts = ranks.equal_count_cuts(df, ["x", "few", "holes", "none"], 8)
    xs = sorted(r[0] for r in rows)
    assert cuts["x"] == [xs[-(-j * 997 // 8) - 1] for j in range(1, 8)]
    assert cuts["few"] == [1.0, 2.0] and cuts["none"] == [] and cuts["holes"] == [-1e300, 3.0]
    binned = ranks.equal_count_bins(df, cuts, lambda c: f"{c}_bin").collect()
    for r in binned:
        assert r.x_bin == sum(v < r.x for v in cuts["x"])
        assert r.few_bin == sum(v < r.few for v in cuts["few"])
        assert r.holes_bin == (None if r.holes is None or math.isnan(r.holes) else sum(v < r.holes for v in cuts["holes"]))
        assert r.none_bin is None
    sizes = np.bincount([r.x_bin for r in binned])
    assert sizes.max() - sizes.min() <= 1


def test_few_values_need_no_second_look(spark):
    """Eleven values: the answers come from the counts of single values; nothing is windowed."""
    df = spark.range(20_000).selectExpr("double(id % 11) AS v")
    plans = []
    original = ranks.Window.partitionBy
    try:
        ranks.Window.partitionBy = staticmethod(lambda *a: plans.append(a) or original(*a))
        assert ranks.quantiles(df, ["v"], [0.25, 0.5])["v"] == [2.0, 5.0]
    finally:
        ranks.Window.partitionBy = original
    assert not plans


def test_buckets_over_few_values_stay_even(spark):
    """Rows are sampled: eleven values give eleven buckets at most, none of them with most rows."""
    df = spark.range(50_000).selectExpr("id % 11 AS v").repartition(4)
    assert len(split_points(df, ["v"], 24)) >= 9
    sizes = [r["count"] for r in with_bucket(df, ["v"], buckets=24).groupBy("__b").count().collect()]
    assert len(sizes) >= 9 and max(sizes) < 50_000 / 4


def test_many_buckets_keep_the_order(spark):
    df = spark.range(30_000).selectExpr("IF(id % 50 = 0, NULL, id * 7 % 30011) AS v", "id AS t").repartition(4)
    rows = with_bucket(df, ["v", "t"], buckets=300).collect()
    rows.sort(key=lambda r: (r.v is not None, r.v or 0, r.t))
    got = [r["__b"] for r in rows]
    assert got == sorted(got) and len(set(got)) > 200
