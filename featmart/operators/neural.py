"""MDL-6: a feed-forward classifier with ReLU layers and dropout, trained by mini-batches.

One step is one aggregate: every task works out the gradient of its part of the batch in numpy and sends one row for
each parameter, Spark adds them up, and the driver (which holds the parameters, and nothing that grows with the rows)
takes the step. Which batch a row belongs to in an epoch, and which of its units drop out in a step, are hashes of its
id: a task that runs again, or a table dealt to other tasks, gives the same run.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featmart.session import materialize

_SUMS = pa.schema([("i", pa.int32()), ("g", pa.float64())])


@dataclass
class Network:
    features: list[str]
    centre: list[float]
    spread: list[float]
    layers: list[tuple[np.ndarray, np.ndarray]]  # weights (in x out) and biases

    def inputs(self) -> Column:
        """Standardised features as one array; a NULL or NaN value counts as the training mean."""
        out = []
        for f, m, s in zip(self.features, self.centre, self.spread):
            x = F.col(f"`{f}`").cast("double")
            out.append(F.coalesce(F.when(~F.isnan(x), (x - m) / s), F.lit(0.0)))
        return F.array(*out)

    def predict(self, df: DataFrame, out: str = "p1") -> DataFrame:
        """``df`` with the probability of class 1 (no units drop out)."""
        x = self.inputs()
        for k, (w, b) in enumerate(self.layers):
            columns = F.array(*[F.struct(F.lit(float(c)).alias("b"), F.array(*[F.lit(float(v)) for v in col]).alias("w")) for col, c in zip(w.T, b)])
            last = k == len(self.layers) - 1
            # the layer below is worked out once, not for every unit
            x = F.get(F.transform(F.array(x), lambda below: F.transform(columns, _unit(below, last))), F.lit(0))  # noqa: B023
        return df.withColumn(out, F.lit(1.0) / (F.exp(-F.get(x, F.lit(0))) + 1.0))


def _unit(below: Column, last: bool):
    """A unit's output from the layer below; ReLU but for the last layer."""
    def out(u: Column) -> Column:
        z = F.aggregate(F.zip_with(below, u["w"], lambda a, v: a * v), u["b"], lambda s, v: s + v)
        return z if last else F.greatest(z, F.lit(0.0))
    return out


def hashed_unit(ids: np.ndarray, *salts: int) -> np.ndarray:
    """Numbers in [0, 1) that depend on ids and salts only."""
    x = ids.astype(np.int64).view(np.uint64).copy()
    for s in salts:
        x = (x ^ np.uint64((s * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        x = x * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(32)
    return (x >> np.uint64(11)).astype(np.float64) / (1 << 53)


def gradient(layers, ids: np.ndarray, x: np.ndarray, y: np.ndarray, dropout: float, seed: int, step: int) -> list[np.ndarray]:
    """Sums over rows of the gradient of the log loss, layer by layer (weights, biases)."""
    seen, masks = [x], []
    for k, (w, b) in enumerate(layers):
        z = seen[-1] @ w + b
        if k < len(layers) - 1:
            mask = z > 0
            if dropout:
                keep = np.stack([hashed_unit(ids, seed, step, k, u) >= dropout for u in range(z.shape[1])], axis=1)
                mask = mask & keep
            z = np.where(mask, z, 0.0) / (1 - dropout if dropout else 1.0)
            masks.append(mask)
        seen.append(z)
    delta = 1 / (1 + np.exp(-seen[-1])) - y[:, None]
    out = []
    for k in range(len(layers) - 1, -1, -1):
        out += [delta.sum(axis=0), seen[k].T @ delta]
        if k:
            delta = np.where(masks[k - 1], delta @ layers[k][0].T, 0.0) / (1 - dropout if dropout else 1.0)
    return out[::-1]


def fit(df: DataFrame, features: Sequence[str], label: str, id_col: str, hidden: Sequence[int] = (16,), epochs: int = 5, batches: int = 4,
        rate: float = 0.1, momentum: float = 0.9, dropout: float = 0.0, l2: float = 0.0, seed: int = 0) -> Network:
    """Train on the rows of ``df`` with a label (0 or 1) and an integer id. Each epoch deals the rows anew to ``batches``
    batches; a step uses the mean gradient of one batch, momentum and an ``l2`` penalty on weights."""
    features = list(features)
    number = {f: F.when(~F.isnan(F.col(f"`{f}`").cast("double")), F.col(f"`{f}`").cast("double")) for f in features}
    row = df.agg(*[F.struct(F.avg(x).alias("m"), F.stddev_pop(x).alias("s")).alias(f"c{i}") for i, x in enumerate(number.values())]).first()
    rng = np.random.default_rng(seed)
    sizes = [len(features), *hidden, 1]
    layers = [(rng.normal(0, math.sqrt(2 / a), (a, b)), np.zeros(b)) for a, b in zip(sizes, sizes[1:])]
    net = Network(features, [row[f"c{i}"]["m"] or 0.0 for i in range(len(features))], [row[f"c{i}"]["s"] or 1.0 for i in range(len(features))], layers)
    rows = materialize(df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label}`").cast("double").alias("y"),
                                 net.inputs().alias("x")).where("id IS NOT NULL AND y IS NOT NULL"))
    speed = [np.zeros_like(p) for layer in layers for p in layer]
    for step in range(epochs * batches):
        epoch, batch = divmod(step, batches)
        sums = _summed(rows, net.layers, dropout, seed, step, epoch, batch, batches)
        if not sums[-1]:
            continue
        at, flat = 0, [p for layer in net.layers for p in layer]
        for i, p in enumerate(flat):
            g = sums[at:at + p.size].reshape(p.shape) / sums[-1] + (l2 * p if p.ndim == 2 else 0.0)
            at += p.size
            speed[i] = momentum * speed[i] - rate * g
            flat[i] = p + speed[i]
        net.layers = list(zip(flat[::2], flat[1::2]))
    return net


def _summed(rows: DataFrame, layers, dropout: float, seed: int, step: int, epoch: int, batch: int, batches: int) -> np.ndarray:
    """Sums of the batch's gradients, all parameters in one array, and the number of rows at its end."""
    size = sum(p.size for layer in layers for p in layer)
    width = layers[0][0].shape[0]

    def run(parts):
        total = np.zeros(size + 1)
        for part in parts:
            ids = part.column(0).to_numpy()
            mine = np.floor(hashed_unit(ids, seed, epoch, -1) * batches) == batch
            if mine.any():
                x = part.column(2).flatten().to_numpy().reshape(-1, width)[mine]
                grads = gradient(layers, ids[mine], x, part.column(1).to_numpy()[mine], dropout, seed, step)
                total += np.concatenate([*(g.ravel() for g in grads), [mine.sum()]])
        if total[-1]:
            yield pa.record_batch([pa.array(np.arange(size + 1, dtype=np.int32)), pa.array(total)], schema=_SUMS)

    out = np.zeros(size + 1)
    for r in rows.mapInArrow(run, "i int, g double").groupBy("i").agg(F.sum("g").alias("g")).collect():  # a row a parameter
        out[r["i"]] = r["g"]
    return out
