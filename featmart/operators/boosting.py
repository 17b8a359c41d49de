"""Gradient-boosted trees from histograms, with missing values (MDL-1, MDL-2, MDL-9, MDL-13).

Features are cut into equal-count bins once; NULL (and NaN) is a bin of its own. A tree grows level by level: one
aggregate by ``(node, feature, bin)`` gives the sums of gradients and curvatures, running sums over a node's bins
give the gain of every split, each tried with the missing rows on either side, and the best split of each node
(one row a node) comes to the driver. So a level costs one pass and a shuffle of partial sums, whatever the rows;
leaves need no pass, their sums are known from the splits above them. A validation flag stops the rounds when its
loss has not fallen for ``patience`` rounds; the trees up to the best round are kept.

Gains are compared after rounding to 12 digits of the loss at the start (ties: first feature, lowest bin, missing
rows to the right), so the order in which sums are added does not decide.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featmart.operators.ranks import equal_count_bins, equal_count_cuts
from featmart.session import materialize

#: Trees whose scores are computed anew in each pass before they are written down.
PENDING = 4


@dataclass(frozen=True)
class Split:
    """Rows with ``x <= cut`` go to ``2 * node``, others to ``2 * node + 1``; missing ones as ``missing_left`` says."""

    feature: int
    bin: int
    cut: float
    missing_left: bool
    gain: float


@dataclass
class Tree:
    splits: dict[int, Split] = field(default_factory=dict)
    leaves: dict[int, float] = field(default_factory=dict)

    def _follow(self, goes_left, leaf, node: int = 1):
        s = self.splits.get(node)
        if s is None:
            return leaf(node)
        return F.when(goes_left(s), self._follow(goes_left, leaf, 2 * node)).otherwise(self._follow(goes_left, leaf, 2 * node + 1))

    def binned(self, bins: str, leaf=None) -> Column:
        """The leaf's value (or ``leaf(node)``) of a row of bin numbers, -1 for missing."""
        def left(s: Split) -> Column:
            b = F.get(bins, F.lit(s.feature))
            return (b <= s.bin) if s.missing_left else b.between(0, s.bin)
        return self._follow(left, leaf or (lambda n: F.lit(self.leaves[n])))

    def raw(self, columns: Sequence[Column]) -> Column:
        def left(s: Split) -> Column:
            x = columns[s.feature]
            return F.coalesce(x <= s.cut, F.lit(s.missing_left))
        return self._follow(left, lambda n: F.lit(self.leaves[n]))


@dataclass
class Boosted:
    features: list[str]
    objective: str
    base: float
    trees: list[Tree]
    losses: list[float]  # of the validation rows after each round, with a validation flag

    def score(self, columns: Sequence[Column]) -> Column:
        out = F.lit(self.base)
        for t in self.trees:
            out = out + t.raw(columns)
        return out

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with the predicted value, or the probability of class 1 under ``logistic``."""
        numbers = [F.col(f"`{f}`").cast("double") for f in self.features]
        numbers = [F.when(~F.isnan(x), x) for x in numbers]
        s = self.score(numbers)
        return df.withColumn(out, _probability(s) if self.objective == "logistic" else s)

    def importance(self) -> dict[str, float]:
        """Gain of every feature (MDL-13)."""
        out = dict.fromkeys(self.features, 0.0)
        for t in self.trees:
            for s in t.splits.values():
                out[self.features[s.feature]] += s.gain
        return out


def out_of_fold(df: DataFrame, features: Sequence[str], label: str, fold: str, k: int, out: str = "prediction",
                test: str | None = None, threads: int = 4, **params) -> DataFrame:
    """MDL-10: ``df`` with each row's prediction by the model of the folds without it; rows where the flag ``test`` is
    true train no model and get the mean of all. The models of the folds are fitted side by side; their
    predictions are one expression, so the table is read once."""
    is_test = F.coalesce(F.col(f"`{test}`"), F.lit(False)) if test else F.lit(False)

    def one(f: int) -> Boosted:
        return fit(df.where((F.col(f"`{fold}`") != f) & ~is_test), features, label, **params)

    with ThreadPoolExecutor(min(threads, k)) as pool:
        models = list(pool.map(inheritable_thread_target(df.sparkSession)(one), range(k)))
    parts = [f"__p{f}" for f in range(k)]
    scored = df
    for name, m in zip(parts, models):
        scored = m.predict(scored, name)
    own = F.lit(None).cast("double")
    for f, name in enumerate(parts):
        own = F.when(F.col(f"`{fold}`") == f, F.col(name)).otherwise(own)
    mean = sum((F.col(p) for p in parts[1:]), F.col(parts[0])) / k
    return scored.withColumn(out, F.when(is_test, mean).otherwise(own)).drop(*parts)


def _probability(score: Column) -> Column:
    return F.lit(1.0) / (F.exp(-score) + 1.0)


def _gradients(objective: str, y: Column, score: Column) -> tuple[Column, Column]:
    if objective == "logistic":
        p = _probability(score)
        return p - y, p * (F.lit(1.0) - p)
    return score - y, F.lit(1.0)


def _loss(objective: str, y: Column, score: Column) -> Column:
    if objective == "logistic":
        return F.log1p(F.exp(-F.abs(score))) + F.greatest(score, F.lit(0.0)) - y * score
    return (score - y) * (score - y)


def _best_splits(hist: DataFrame, l2: float, min_rows: int, scale: float) -> list:
    """Best split of every node of ``node, f, b, g, h, n``, with the sums of both sides: one row a node at most."""
    part = Window.partitionBy("node", "f")
    sums = {c: F.sum(c).over(part) for c in "ghn"}
    missing = {c: F.coalesce(F.sum(F.when(F.col("b") < 0, F.col(c))).over(part), F.lit(0)) for c in "ghn"}
    upto = {c: F.sum(F.when(F.col("b") >= 0, F.col(c)).otherwise(0)).over(part.orderBy("b")) for c in "ghn"}
    wide = hist.select("node", "f", "b", *[x.alias(f"all_{c}") for c, x in sums.items()], *[x.alias(f"miss_{c}") for c, x in missing.items()],
                       *[x.alias(f"upto_{c}") for c, x in upto.items()]).where("b >= 0")
    both = wide.withColumn("missing_left", F.explode(F.array(F.lit(False), F.lit(True)))).where("NOT missing_left OR miss_n > 0")
    left = {c: F.col(f"upto_{c}") + F.when(F.col("missing_left"), F.col(f"miss_{c}")).otherwise(0) for c in "ghn"}
    both = both.select("*", *[x.alias(f"l_{c}") for c, x in left.items()])
    both = both.select("*", *[(F.col(f"all_{c}") - F.col(f"l_{c}")).alias(f"r_{c}") for c in "ghn"]).where((F.col("l_n") >= min_rows) & (F.col("r_n") >= min_rows))

    def part_of(side):
        return F.col(f"{side}_g") * F.col(f"{side}_g") / (F.col(f"{side}_h") + l2)

    gain = part_of("l") + part_of("r") - part_of("all")
    both = both.withColumn("gain", gain).withColumn("worth", F.round(F.col("gain") / scale, 12)).where("worth > 0")
    best = F.min(F.struct((-F.col("worth")).alias("worth"), "f", "b", "missing_left", "gain", "l_g", "l_h", "r_g", "r_h"))
    return both.groupBy("node").agg(best.alias("s")).select("node", "s.*").collect()


def fit(df: DataFrame, features: Sequence[str], label: str, objective: str = "squared", rounds: int = 20, depth: int = 3, rate: float = 0.1,
        l2: float = 1.0, min_rows: int = 1, bins: int = 64, valid: str | None = None, patience: int | None = None) -> Boosted:
    """Boost ``rounds`` trees of at most ``depth`` levels on the rows with a label (and, with ``valid``, where that
    flag is not true). ``objective``: ``squared`` or ``logistic`` (label 0 or 1).

    With ``valid`` and ``patience`` the rounds end when the flagged rows' loss has not fallen for ``patience`` rounds,
    and the trees up to its minimum are kept. Without rows or with one class nothing is split."""
    features = list(features)
    held = F.coalesce(F.col(f"`{valid}`").cast("boolean"), F.lit(False)) if valid else F.lit(False)
    rows = df.select(F.col(f"`{label}`").cast("double").alias("y"), held.alias("held"),
                     *[F.col(f"`{f}`").alias(f"x{i}") for i, f in enumerate(features)]).where("y IS NOT NULL")
    names = [f"x{i}" for i in range(len(features))]
    cuts = equal_count_cuts(rows.where("NOT held"), names, bins)
    work = equal_count_bins(rows, cuts, lambda c: f"{c}_bin")
    work = work.select("y", "held", F.array(*[F.coalesce(f"{c}_bin", F.lit(-1)).cast("tinyint" if bins <= 127 else "int") for c in names]).alias("bins"))
    start = rows.where("NOT held").agg(F.avg("y").alias("m"), F.var_pop("y").alias("v"), F.count(F.lit(1)).alias("n")).first()
    mean, scale = start["m"] or 0.0, (start["v"] or 0.0) * start["n"]
    base = mean
    if objective == "logistic":
        base = math.log(mean / (1 - mean)) if 0 < mean < 1 else (50.0 if mean >= 1 else -50.0 if start["n"] else 0.0)
    model = Boosted(features, objective, base, [], [])
    if not scale:
        return model
    work = materialize(work.withColumn("score", F.lit(base)))
    pending: list[Tree] = []
    best = (math.inf, 0)
    for _ in range(rounds):
        now = F.col("score")
        for t in pending:
            now = now + t.binned("bins")
        g, h = _gradients(objective, F.col("y"), now)
        graded = work.where("NOT held").select("bins", g.alias("g"), h.alias("h"))
        tree, alive = Tree(), [1]
        for _level in range(depth):
            node = tree.binned("bins", lambda n: F.lit(n if n in alive else None).cast("int"))  # noqa: B023
            cells = graded.select(node.alias("node"), "g", "h", F.posexplode("bins").alias("f", "b")).where("node IS NOT NULL")
            hist = cells.groupBy("node", "f", "b").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count(F.lit(1)).alias("n"))
            alive = []
            for s in _best_splits(hist, l2, min_rows, scale):
                at = cuts[names[s["f"]]]
                tree.splits[s["node"]] = Split(s["f"], s["b"], at[s["b"]] if s["b"] < len(at) else math.inf, s["missing_left"], s["gain"])
                for child, side in ((2 * s["node"], "l"), (2 * s["node"] + 1, "r")):
                    tree.leaves[child] = -rate * s[f"{side}_g"] / (s[f"{side}_h"] + l2)
                    alive.append(child)
            if not alive:
                break
        if not tree.splits:
            break
        model.trees.append(tree)
        pending.append(tree)
        if len(pending) == PENDING:
            total = F.col("score")
            for t in pending:
                total = total + t.binned("bins")
            work, pending = materialize(work.withColumn("score", total)), []
        if valid and patience:
            now = F.col("score")
            for t in pending:
                now = now + t.binned("bins")
            loss = work.where("held").agg(F.avg(_loss(objective, F.col("y"), now))).first()[0]
            if loss is None:
                continue
            model.losses.append(loss)
            if round(loss, 12) < round(best[0], 12):
                best = (loss, len(model.trees))
            elif len(model.trees) - best[1] >= patience:
                break
    if model.losses:
        model.trees = model.trees[:best[1]]
    return model
