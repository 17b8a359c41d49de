"""Per-feature trees and boosted stumps against row-by-row versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from featmart.operators import bin_models as bm
from featmart.operators.split import kfold
from tests.test_boosting import cuts_of


def bins_of(values, bins):
    cuts = cuts_of(values, bins)
    return np.array([-1 if math.isnan(v) else sum(c < v for c in cuts) for v in values])


def split(b, r, mine, l2, min_rows, scale):
    """``(worth, cut, missing_left, mask)`` by trying every cut on the rows themselves."""
    found = []
    part = lambda m: r[m].sum() ** 2 / (m.sum() + l2)
    for cut in sorted(set(b[mine]) - {-1}):
        for missing_left in (False, True):
            if missing_left and not (b[mine] == -1).any():
                continue
            side = ((b >= 0) & (b <= cut)) | ((b == -1) & missing_left)
            left, right = mine & side, mine & ~side
            if left.sum() < min_rows or right.sum() < min_rows:
                continue
            worth = round((part(left) + part(right) - part(mine)) / scale, 12)
            if worth > 0:
                found.append((-worth, int(cut), missing_left, side))
    return min(found, key=lambda f: f[:3]) if found else None


def auc(score, y):
    p, q = score[y == 1], score[y == 0]
    return float(((p[:, None] > q[None, :]).sum() + 0.5 * (p[:, None] == q[None, :]).sum()) / (len(p) * len(q)))


def test_drift_trees_equal_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for i in range(900):
        test = i % 3 == 0
        rows.append((i, test, rng.gauss(0.7 if test else 0, 1), rng.choice([None, 1.0, 2.0]) if test else rng.choice([1.0, 2.0, 2.0]), 4.0,
                     rng.uniform(0.4, 0.5) if test else rng.random()))
    df = spark.createDataFrame(rows, "id int, test boolean, shift double, holes double, flat double, middle double").repartition(4)
    got = {r.feature: r.drift_score for r in bm.drift_report(df.where("NOT test"), df.where("test"), ["shift", "holes", "flat", "middle"], "id",
                                                              bins=16, depth=3, min_rows=5, seed=1).collect()}
    fold = {r.id: r.f for r in df.select("id", kfold("id", 4, 1).alias("f")).collect()}
    f, y = np.array([fold[r[0]] for r in rows]), np.array([float(r[1]) for r in rows])
    for c, name in enumerate(["shift", "holes", "flat", "middle"], 2):
        b, found = bins_of([math.nan if r[c] is None else r[c] for r in rows], 16), []
        for k in range(4):
            train = f != k
            score, groups = np.full(len(rows), y[train].mean()), [np.ones(len(rows), bool)]
            scale = y[train].sum() * (1 - y[train].mean())
            for _ in range(3):
                nxt = []
                for g in groups:
                    s = split(b, y, train & g, 0.0, 5, scale)
                    if s:
                        for m in (g & s[3], g & ~s[3]):
                            score[m] = y[m & train].mean()
                            nxt.append(m)
                groups = nxt
            found.append(auc(score[~train], y[~train]))
        assert got[name] == pytest.approx(np.mean(found), abs=1e-12), name
    assert got["middle"] > 0.9 and got["flat"] == 0.5


def test_an_outlier_hides_no_drift(spark):
    """A value of 1e12 would put all other rows into one bin of equal width."""
    df = spark.range(4000).selectExpr("id", "id % 2 = 0 AS test", "CASE WHEN id = 7 THEN 1e12 WHEN id % 2 = 0 THEN id % 50 + 30 ELSE id % 50 END AS x")
    row = bm.drift_report(df.where("NOT test"), df.where("test"), ["x"], "id").first()
    assert row.drifted and row.drift_score > 0.8


def test_one_origin_alone_has_no_score(spark):
    df = spark.range(100).selectExpr("id", "double(id) AS x")
    assert bm.drift_report(df, df.where("false"), ["x"], "id").first().drift_score is None


@pytest.mark.parametrize("patience", [1, 50])
def test_boosted_stumps_equal_brute_force(spark, patience):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        base, x = rng.choice([None, rng.random(), rng.random()]), rng.choice([None, 1.0, 2.0, 3.0, rng.random()])
        y = 3 * (base or 0.1) + (2.0 if x is None else math.sin(x)) + rng.gauss(0, 0.3)
        rows.append((i, y, base, i % 3, x, rng.random()))
    df = spark.createDataFrame(rows, "id int, y double, base double, f int, x double, noise double").repartition(4)
    params = {"rounds": 12, "rate": 0.6, "l2": 0.5, "patience": patience, "bins": 8}
    got = {r.feature: r for r in bm.boosted_feature_report(df, "y", "base", "f", ["x", "noise"], **params).collect()}
    y, f = np.array([r[1] for r in rows]), np.array([r[3] for r in rows])
    nan = lambda v: math.nan if v is None else v
    bb = bins_of([nan(r[2]) for r in rows], 8)
    for c, name in ((4, "x"), (5, "noise")):
        bx, found = bins_of([nan(r[c]) for r in rows], 8), []
        for k in range(3):
            train = f != k
            pred = np.full(len(rows), y[train].mean())
            losses = [((y - pred)[~train] ** 2).mean()]
            for _ in range(12):
                tried = [(s[:3], axis, s) for axis, b in ((0, bb), (1, bx)) if (s := split(b, np.where(train, y - pred, 0), train, 0.5, 1, y[train].var() * train.sum()))]
                (_, _, s) = min(tried, key=lambda t: (t[0][0], t[1]))
                for m in (s[3], ~s[3]):
                    pred = pred + np.where(m, 0.6 * (y - pred)[m & train].sum() / ((m & train).sum() + 0.5), 0)
                losses.append(((y - pred)[~train] ** 2).mean())
                if len(losses) - 1 - int(np.argmin(losses)) >= patience:
                    break
            found.append((math.sqrt(min(losses)), int(np.argmin(losses))))
        assert got[name].cv_rmse == pytest.approx(np.mean([a for a, _ in found]), abs=1e-9)
        assert got[name].rounds == pytest.approx(np.mean([b for _, b in found]))
    assert got["x"].cv_rmse < got["noise"].cv_rmse
    assert got["x"].n_distinct == len({r[4] for r in rows}) and got["noise"].n_zero == 0


def test_rows_without_a_target_or_base(spark):
    df = spark.createDataFrame([(None, 1.0, 0, 1.0), (2.0, None, 0, None), (4.0, None, 1, None)], "y double, base double, f int, x double")
    row = bm.boosted_feature_report(df, "y", "base", "f", ["x"]).first()
    assert row.cv_rmse == pytest.approx(2.0) and row.rounds == 0 and row.n_distinct == 1
    assert bm.boosted_feature_report(df.where(F.lit(False)), "y", "base", "f", ["x"]).collect() == []
