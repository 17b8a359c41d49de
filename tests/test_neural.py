"""The network's training against plain row-by-row steps."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from featmart.operators import neural


def data(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x, y = rng.uniform(-1, 1), rng.uniform(-1, 1)
        rows.append((i * 7 - 50, x, None if rng.random() < 0.1 else y, int(x * y > 0)))
    return rows


def plain(rows, hidden, epochs, batches, rate, momentum, dropout, l2, seed):
    """The same run, one row and one unit at a time."""
    data = np.array([[x, math.nan if y is None else y] for _, x, y, _ in rows])
    z = np.nan_to_num((data - np.nanmean(data, 0)) / np.nanstd(data, 0), nan=0.0)
    rng = np.random.default_rng(seed)
    sizes = [2, *hidden, 1]
    ws = [rng.normal(0, math.sqrt(2 / a), (a, b)) for a, b in zip(sizes, sizes[1:])]
    bs = [np.zeros(b) for b in sizes[1:]]
    vw, vb = [w * 0 for w in ws], [b * 0 for b in bs]
    for step in range(epochs * batches):
        epoch, batch = divmod(step, batches)
        gw, gb, n = [w * 0 for w in ws], [b * 0 for b in bs], 0
        for (i, _, _, y), x in zip(rows, z):
            one = np.array([i])
            if int(neural.hashed_unit(one, seed, epoch, -1)[0] * batches) != batch:
                continue
            n += 1
            acts, on = [list(x)], []
            for k, (w, b) in enumerate(zip(ws, bs)):
                out, flags = [], []
                for u in range(w.shape[1]):
                    s = b[u] + sum(a * w[j, u] for j, a in enumerate(acts[-1]))
                    if k < len(ws) - 1:
                        alive = s > 0 and (not dropout or neural.hashed_unit(one, seed, step, k, u)[0] >= dropout)
                        flags.append(alive)
                        s = s / (1 - dropout) if alive else 0.0
                    out.append(s)
                acts.append(out)
                on.append(flags)
            delta = [1 / (1 + math.exp(-acts[-1][0])) - y]
            for k in range(len(ws) - 1, -1, -1):
                for u, d in enumerate(delta):
                    gb[k][u] += d
                    for j, a in enumerate(acts[k]):
                        gw[k][j, u] += a * d
                if k:
                    delta = [sum(ws[k][j, u] * d for u, d in enumerate(delta)) / (1 - dropout) if on[k - 1][j] else 0.0 for j in range(ws[k].shape[0])]
        for k in range(len(ws)):
            vw[k] = momentum * vw[k] - rate * (gw[k] / n + l2 * ws[k])
            vb[k] = momentum * vb[k] - rate * gb[k] / n
            ws[k], bs[k] = ws[k] + vw[k], bs[k] + vb[k]
    out = []
    for x in z:
        for k, (w, b) in enumerate(zip(ws, bs)):
            x = x @ w + b
            x = np.maximum(x, 0) if k < len(ws) - 1 else x
        out.append(1 / (1 + math.exp(-x[0])))
    return out


@pytest.mark.parametrize("hidden,dropout", [((4, 3), 0.0), ((6,), 0.4)])
def test_equals_plain_steps(spark, hidden, dropout):
    rows = data(60)
    df = spark.createDataFrame(rows, "id long, x double, y double, label int").repartition(3)
    net = neural.fit(df, ["x", "y"], "label", "id", hidden, 2, 3, 0.3, 0.9, dropout, 0.01, seed=5)
    want = plain(rows, hidden, 2, 3, 0.3, 0.9, dropout, 0.01, 5)
    got = {r.id: r.p1 for r in net.predict(df).collect()}
    assert [got[r[0]] for r in rows] == pytest.approx(want, abs=1e-9)


def test_learns_what_a_line_cannot(spark):
    df = spark.createDataFrame([r for r in data(1200, 2) if r[2] is not None], "id long, x double, y double, label int").repartition(4)
    net = neural.fit(df.where("id % 4 <> 0"), ["x", "y"], "label", "id", (12,), epochs=25, batches=2, rate=0.5, seed=3)
    right = net.predict(df.where("id % 4 = 0")).agg(F.avg(((F.col("p1") > 0.5) == (F.col("label") == 1)).cast("int"))).first()[0]
    assert right > 0.85


def test_empty_and_unlabelled_rows(spark):
    df = spark.createDataFrame([(1, 1.0, None), (None, 2.0, 1)], "id long, x double, label int")
    net = neural.fit(df, ["x"], "label", "id", (2,), epochs=1, batches=1)
    assert all(0 < r.p1 < 1 for r in net.predict(df).collect())
