"""Lag keys by prefix hashes against slices of the rows."""

import math
import random
import time

import numpy as np
import pyarrow as pa

from featmart.operators import leak as lk


def brute(rows, n):
    key = lambda v: tuple("nan" if isinstance(x, float) and math.isnan(x) else x for x in v)
    out = []
    for lag in range(n - 2):
        sources = {}
        for _, a in rows:
            sources.setdefault(key(a[lag + 2:]), []).append(a[lag])
        out += [(i, lag, sources[k][0]) for i, a in rows if len(sources.get(k := key(a[:n - lag - 2]), [])) == 1]
    return out


def test_equals_slices_with_odd_values(spark):
    """Shifted copies of one series, with NULL, NaN and both zeros inside the keys."""
    rng, n = random.Random(5), 9
    series = [rng.choice([None, float("nan"), 0.0, -0.0, 1.5, 1.5, 2.0, -3.0, 1e300]) for _ in range(400)]
    rows = [(i, series[k:k + n]) for i, k in enumerate(rng.sample(range(390), 200))] + [(1000 + i, [0.0] * n) for i in range(3)]
    cols = [f"c{i}" for i in range(n)]
    df = spark.createDataFrame([(i, *a) for i, a in rows], "id int, " + ", ".join(f"{c} double" for c in cols)).repartition(5)
    norm = lambda x: (x[0], x[1], repr(x[2] + 0.0 if x[2] is not None else None))
    want = sorted(map(norm, brute(rows, n)))
    assert len(want) > 100
    assert sorted(norm(tuple(r)) for r in lk.lag_matches(df, "id", cols).collect()) == want


def test_too_few_columns_and_no_rows(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0)], "id string, a double, b double")
    assert lk.lag_matches(df, "id", ["a", "b"]).collect() == []
    assert lk.lag_matches(df.where("false").selectExpr("*", "a AS c"), "id", ["a", "b", "c"]).collect() == []


def test_work_is_linear_in_the_columns():
    """Ten times the columns, ten times the time (with room for noise), where slices would take a hundred times."""
    def seconds(n):
        batch = pa.record_batch([pa.array(range(40)), pa.array(np.random.rand(40, n).tolist())], names=["id", "a"])
        run = lk._lag_keys(n, ["__id", "lag", "t1", "t2", "s1", "s2", "pred"])
        best = math.inf
        for _ in range(3):
            t = time.perf_counter()
            assert sum(len(b) for b in run([batch])) == 40 * (n - 2)
            best = min(best, time.perf_counter() - t)
        return best
    seconds(100)
    assert seconds(10_000) < 40 * max(seconds(1_000), 0.002)
