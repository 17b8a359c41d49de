"""Boosted trees against a plain single-process version."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from featmart.operators import boosting


def cuts_of(values, bins):
    v = sorted(x for x in values if not math.isnan(x))
    return sorted({v[-(-j * len(v) // bins) - 1] for j in range(1, bins)} - {v[-1]}) if v else []


def brute(x, y, held, objective, rounds, depth, rate, l2, min_rows, bins, patience):
    """Predictions of all rows; ``x`` has NaN for missing values."""
    train = ~held
    cuts = [cuts_of(x[train, f], bins) for f in range(x.shape[1])]
    b = np.array([[-1 if math.isnan(v) else sum(c < v for c in cuts[f]) for f, v in enumerate(row)] for row in x])
    mean = y[train].mean()
    score = np.full(len(y), mean if objective == "squared" else math.log(mean / (1 - mean)))
    scale = y[train].var() * train.sum()
    scores, losses = [score.copy()], []
    for _ in range(rounds):
        if objective == "squared":
            g, h = score - y, np.ones(len(y))
        else:
            p = 1 / (1 + np.exp(-score))
            g, h = p - y, p * (1 - p)
        node, add, split_any = np.ones(len(y), int), {}, False
        active = [1]
        for _level in range(depth):
            nxt = []
            for k in active:
                mine = train & (node == k)
                found = []
                for f in range(x.shape[1]):
                    for cut in sorted(set(b[mine, f]) - {-1}):
                        for missing_left in (False, True):
                            if missing_left and not (b[mine, f] == -1).any():
                                continue
                            left = mine & (((b[:, f] >= 0) & (b[:, f] <= cut)) | ((b[:, f] == -1) & missing_left))
                            right = mine & ~left
                            if left.sum() < min_rows or right.sum() < min_rows:
                                continue
                            part = lambda m: g[m].sum() ** 2 / (h[m].sum() + l2)  # noqa: E731, B023
                            worth = round((part(left) + part(right) - part(mine)) / scale, 12)
                            if worth > 0:
                                found.append((-worth, f, cut, missing_left))
                if not found:
                    continue
                split_any = True
                _, f, cut, missing_left = min(found)
                goes = ((b[:, f] >= 0) & (b[:, f] <= cut)) | ((b[:, f] == -1) & missing_left)
                at = node == k
                for child, side in ((2 * k, goes), (2 * k + 1, ~goes)):
                    inside = train & at & side
                    add[child] = -rate * g[inside].sum() / (h[inside].sum() + l2)
                    nxt.append(child)
                node = np.where(at, np.where(goes, 2 * k, 2 * k + 1), node)
            active = nxt
        if not split_any:
            break
        score = score + np.array([add[k] for k in node])
        scores.append(score.copy())
        if patience:
            s, t = score[held], y[held]
            losses.append(((s - t) ** 2).mean() if objective == "squared" else (np.log1p(np.exp(-abs(s))) + np.maximum(s, 0) - t * s).mean())
            if len(losses) - 1 - int(np.argmin(np.round(losses, 12))) >= patience:
                break
    if losses:
        score = scores[1 + int(np.argmin(np.round(losses, 12)))]
    return (score if objective == "squared" else 1 / (1 + np.exp(-score))), len(scores) - 1


def data(n, seed, objective):
    rng = random.Random(seed)
    x = np.array([[rng.gauss(0, 1), rng.choice([math.nan, 1.0, 2.0, 3.0]), rng.random() if rng.random() > 0.4 else math.nan, 5.0, math.nan]
                  for _ in range(n)])
    signal = x[:, 0] + np.where(np.isnan(x[:, 1]), 2.0, x[:, 1]) + np.where(np.isnan(x[:, 2]), -1.5, x[:, 2] * 3) ** 2
    y = signal + np.array([rng.gauss(0, 0.5) for _ in range(n)])
    return x, (y if objective == "squared" else (y > np.median(y)).astype(float)), np.array([rng.random() < 0.25 for _ in range(n)])


@pytest.mark.parametrize("objective,rounds,depth,rate,l2,min_rows,bins,patience", [
    ("squared", 6, 3, 0.3, 1.0, 1, 16, None), ("logistic", 6, 3, 0.5, 0.5, 5, 16, None), ("squared", 60, 2, 0.9, 0.0, 1, 64, 2)])
def test_predictions_equal_brute_force(spark, objective, rounds, depth, rate, l2, min_rows, bins, patience):
    x, y, held = data(500, 3, objective)
    if not patience:
        held[:] = False
    rows = [(i, *[None if math.isnan(v) and (i + j) % 2 else float(v) for j, v in enumerate(r)], float(t), bool(e)) for i, (r, t, e) in enumerate(zip(x, y, held))]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, d double, e double, y double, held boolean").repartition(5)
    model = boosting.fit(df, ["a", "b", "c", "d", "e"], "y", objective, rounds, depth, rate, l2, min_rows, bins, "held" if patience else None, patience)
    want, grown = brute(x, y, held, objective, rounds, depth, rate, l2, min_rows, bins, patience)
    got = {r.id: r.prediction for r in model.predict(df).collect()}
    assert [got[i] for i in range(len(y))] == pytest.approx(list(want), abs=1e-9)
    if patience:
        assert len(model.trees) < len(model.losses) == grown < rounds
    assert any(s.missing_left for t in model.trees for s in t.splits.values())
    assert model.importance()["d"] == model.importance()["e"] == 0 < model.importance()["a"]


def test_missing_rows_learn_their_side(spark):
    """Missing values of an informative feature are told apart, whichever side they belong to."""
    rows = [(float(i % 10) if i % 3 else None, 10.0 if i % 3 == 0 or i % 10 > 6 else 0.0) for i in range(600)]
    df = spark.createDataFrame(rows, "x double, y double")
    model = boosting.fit(df, ["x"], "y", rounds=30, depth=2, rate=0.5)
    worst = model.predict(df).agg(F.max(F.abs(F.col("prediction") - F.col("y")))).first()[0]
    assert worst < 0.1


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (None, None)], "x double, y double")
    assert boosting.fit(df, ["x"], "y").predict(df).select("prediction").distinct().collect()[0][0] == 1.0
    assert boosting.fit(df.where("false"), ["x"], "y").trees == []
    sure = boosting.fit(df, ["x"], "y", "logistic").predict(df).first()
    assert sure.prediction == pytest.approx(1.0)
