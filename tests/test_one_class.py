"""The one-class boundary against a plain version, and on shapes that a distance from the mean cannot tell."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from featmart.operators import one_class


def ring(n, radius, seed):
    rng = random.Random(seed)
    return [(*(radius * f(a) + rng.gauss(0, 0.1) for f in (math.cos, math.sin)),) for a in (rng.uniform(0, 2 * math.pi) for _ in range(n))]


def test_rings_are_told_apart(spark):
    """Normal rows lie on a ring; the middle is as far from them as the outside, though next to their mean."""
    frame = lambda rows: spark.createDataFrame(rows, "x double, y double")
    normal = frame(ring(1500, 2.0, 1)).repartition(4)
    model = one_class.fit(normal, ["x", "y"], nu=0.1, gamma=1.0, components=256)
    share = lambda df: model.predict(df).agg(F.avg("flagged")).first()[0]
    assert abs(share(normal) - 0.1) <= 0.02
    assert share(frame(ring(300, 0.1, 2))) > 0.95
    assert share(frame(ring(300, 4.0, 3))) > 0.95
    assert share(frame(ring(300, 2.0, 4))) < 0.25


def test_equals_plain_steps(spark):
    rng = random.Random(5)
    rows = [(rng.gauss(0, 1), rng.choice([None, float("nan"), rng.gauss(3, 2)])) for _ in range(300)]
    df = spark.createDataFrame(rows, "x double, y double").repartition(3)
    model = one_class.fit(df, ["x", "y"], nu=0.2, components=16, steps=8, seed=3)
    data = np.array([[x, math.nan if y is None else y] for x, y in rows])
    z = np.nan_to_num((data - np.nanmean(data, 0)) / np.nanstd(data, 0), nan=0.0)
    phi = math.sqrt(2 / 16) * np.cos(z @ model.directions.T + model.phases)
    w = phi.mean(0)
    for _ in range(8):
        s = phi @ w
        low = phi[s <= np.sort(s)[math.ceil(0.2 * 300) - 1]].mean(0)
        gap = w - low
        if w @ gap <= 1e-9:
            break
        w = w - min(1.0, (w @ gap) / (gap @ gap)) * gap
    assert model.weights == pytest.approx(w, abs=1e-9)
    assert model.offset == pytest.approx(np.sort(phi @ w)[60], abs=1e-9)
    assert model.predict(df).agg(F.sum("flagged")).first()[0] == 60


def test_one_row_and_none(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    assert one_class.fit(df, ["x"], components=8).predict(df).first().flagged == 0
    with pytest.raises(ValueError):
        one_class.fit(df.where("false"), ["x"])
