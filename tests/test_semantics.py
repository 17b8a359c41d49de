"""Edge semantics on small literals."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from featmart.functions import keywords as kw
from featmart.functions.rows import nonzero_row_mean, row_stats
from featmart.functions.scalar import cross, hours_between, lower_or_nan, safe_div
from featmart.operators import encode as enc
from featmart.operators import evaluate as ev
from featmart.operators import leak as lk
from featmart.operators import relational as rel
from featmart.operators import split as spl
from featmart.operators import text as tx
from featmart.operators import windows as win
from featmart.operators.ordered import exact_quantiles, prefix_sums


def test_one_row_variance_is_null_and_missing_pivot_is_null(spark):
    df = spark.createDataFrame([(1, 5.0, "A"), (2, 1.0, "A"), (2, 3.0, "B")], "k int, x double, s string")
    out = {r["k"]: r for r in rel.agg_spec(df, "k", {"x": ["var", "std", "size", "sum"]},
                                           extra=rel.pivot_count_exprs("s", ["A", "B"])).collect()}
    assert out[1]["x_var"] is None and out[1]["x_std"] is None
    assert out[1]["s_B"] is None and out[2]["s_B"] == 1
    assert out[2]["x_var"] == pytest.approx(2.0)


def test_null_group_key_dropped(spark):
    df = spark.createDataFrame([(None, 1.0), (1, 2.0)], "k int, x double")
    assert rel.agg_spec(df, "k", {"x": ["mean"]}).count() == 1


def test_safe_div_and_cross(spark):
    r = spark.range(1).select(safe_div(F.lit(1.0), F.lit(0.0)).alias("a"),
                              cross(F.lit("x"), F.lit(None).cast("string")).alias("b"),
                              lower_or_nan(F.lit(None).cast("string")).alias("c")).first()
    assert r["a"] is None and r["b"] is None and r["c"] == "nan"


def test_negative_hour_gap_floors(spark):
    r = spark.range(1).select(hours_between(F.lit("2024-01-01 00:00:00").cast("timestamp"),
                                            F.lit("2024-01-01 01:30:00").cast("timestamp")).alias("h")).first()
    assert r["h"] == -2


def test_keyword_rules_first_match(spark):
    df = spark.createDataFrame([("MySearch engine",), ("lunametrics",), ("Chrome",), ("samsung browser",),
                                (None,), ("(not set)",), ("baidu",)], "x string")
    got = [r[0] for r in df.select(kw.source_group("x")).collect()]
    assert got == ["mysearch", "lunametrics", "others", "others", "nan", "(not set)", "baidu"]
    got = [r[0] for r in df.select(kw.browser_family("x")).collect()]
    assert got[2] == "chrome" and got[3] == "mobile browser" and got[4] == "others"


def test_row_stats_match_pandas(spark):
    vals = [0.0, 3.0, 1.0, 7.0, 0.0, 2.0, 11.0]
    df = spark.createDataFrame([(vals,)], "a array<double>")
    st = row_stats(F.col("a"))
    r = df.select(*[c.alias(n) for n, c in st.items()], nonzero_row_mean(F.col("a")).alias("nzm")).first()
    s = pd.Series(vals).replace(0, float("nan"))
    assert r["the_kur"] == pytest.approx(s.kurtosis())
    assert r["the_std"] == pytest.approx(s.std())
    assert r["log_of_median"] == pytest.approx(math.log1p(s.median()))
    assert r["nb_nans"] == 2
    assert r["nzm"] == pytest.approx(math.expm1(pd.Series([math.log1p(v) for v in vals if v]).mean()))


def test_global_row_number_independent_of_partitions(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    a = rel.with_global_row_number(df, ["k"], "rn", num_buckets=1).orderBy("k").collect()
    b = rel.with_global_row_number(df.repartition(7), ["k"], "rn", num_buckets=5).orderBy("k").collect()
    assert [r["rn"] for r in a] == list(range(1, 1001)) == [r["rn"] for r in b]


def test_global_forward_fill_matches_pandas(spark):
    rows = [(i, None if i % 3 == 0 or i in (5, 6, 7) else float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "k int, x double")
    got = [r["x"] for r in win.global_forward_fill(df, ["x"], ["k"], num_buckets=6).orderBy("k").collect()]
    exp = pd.Series([x for _, x in rows], dtype="float64").ffill().tolist()
    assert [None if (v is None or (isinstance(v, float) and math.isnan(v))) else v for v in exp] == got


def test_prefix_sums_grouped(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 1, 5), ("b", 3, 1), ("a", 3, 4)], "g string, o int, v int")
    got = {(r["g"], r["o"]): r["cum_v"] for r in prefix_sums(df, ["o"], ["v"], ["g"], num_buckets=3).collect()}
    assert got == {("a", 1): 1, ("a", 2): 3, ("a", 3): 7, ("b", 1): 5, ("b", 3): 6}


def test_exact_quantiles_match_pandas(spark):
    vals = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0, 5.0, 3.0, 5.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0, .1, .25, .5, .9, 1.0]
    assert exact_quantiles(df, "x", probs) == pytest.approx(pd.Series(vals).quantile(probs).tolist())


def test_qcut_bins_and_outside_null(spark):
    vals = list(range(100))
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    edges = enc.quantile_edges(df, "x", [.1, .2, .3, .4, .5, .6, .7, .8, .9, .10])
    got = [r[0] for r in df.select(enc.bin_index("x", edges)).collect()]
    exp = pd.qcut(pd.Series(vals, dtype=float), q=[.1, .2, .3, .4, .5, .6, .7, .8, .9, .10], duplicates="drop",
                  labels=False)
    assert [None if pd.isna(e) else int(e) for e in exp] == got
    assert sum(g is None for g in got) == 20


def test_auc_ties_brute_force(spark):
    rows = [(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1), (0, 0.9), (1, 0.3), (0, 0.3)]
    df = spark.createDataFrame(rows, "y int, s double")
    got = ev.auc(df, "y", "s").first()["auc"]
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    exp = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert got == pytest.approx(exp)


def test_oof_target_encoding_brute_force(spark):
    rows = [(i, "ab"[i % 2] if i % 5 else "c", (float(i) if i % 3 else None), i % 3) for i in range(30)]
    df = spark.createDataFrame(rows, "id int, c string, y double, fold int")
    got = {r["id"]: r["e"] for r in enc.target_mean_oof(df, "c", "y", "fold", 5.0, name="e").collect()}
    g = pd.Series([y for *_, y, _ in rows], dtype=float).mean()
    for i, c, _, f in rows:
        others = [y for j, cc, y, ff in rows if cc == c and ff != f and y is not None]
        exp = (sum(others) + g * 5) / (len(others) + 5) if others else g
        assert got[i] == pytest.approx(exp)


def test_factorize_unseen_and_null(spark):
    tr = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, None)], "k int, v string")
    te = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "k int, v string")
    d = enc.factorize_dictionary(tr, "v", ["k"])
    got = {r["k"]: r["code"] for r in enc.apply_dictionary(te, "v", d, "code", null_text=None, unseen=-1).collect()}
    assert got == {1: 1, 2: -1, 3: -1}


def test_padding_and_drop_position(spark):
    r = spark.createDataFrame([([1, 2, 3, 4],)], "a array<int>").select(
        tx.pad_post("a", 6).alias("p"), tx.pad_pre("a", 6).alias("q"), tx.pad_pre("a", 2).alias("t"),
        tx.drop_position("a", 1).alias("d"), tx.drop_position("a", 3).alias("e")).first()
    assert r["p"] == [1, 2, 3, 4, 0, 0] and r["q"] == [0, 0, 1, 2, 3, 4] and r["t"] == [3, 4]
    assert r["d"] == [1, 3, 4] and r["e"] == [1, 2, 3]


def test_token_ids_keep_empty_documents(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, ""), (3, None)], "k int, t string").withColumn("toks", tx.tokens("t"))
    voc = tx.sorted_vocabulary(df, "toks")
    got = {r["k"]: r["ids"] for r in tx.to_ids(df, "k", "toks", voc).collect()}
    assert got == {1: [1, 2, 1], 2: [], 3: []}


def test_hash_split_is_deterministic(spark):
    df = spark.range(0, 2000)
    a = df.where(spl.split_flag("id", 0.25, 9)).count()
    b = df.repartition(13).where(spl.split_flag("id", 0.25, 9)).count()
    assert a == b and 400 < a < 600


def test_contiguous_folds_like_kfold(spark):
    df = spark.range(0, 23).withColumnRenamed("id", "k")
    got = [r["fold"] for r in spl.contiguous_folds(df, ["k"], 5).orderBy("k").collect()]
    assert got == [0] * 5 + [1] * 5 + [2] * 5 + [3] * 4 + [4] * 4


def test_leak_matches_brute_force(spark):
    rows = [(0, [5.0, 1.0, 2.0, 3.0, 4.0]), (1, [7.0, 9.0, 1.0, 2.0, 3.0]), (2, [6.0, 8.0, 9.0, 1.0, 2.0]),
            (3, [1.0, 1.0, 1.0, 1.0, 1.0]), (4, [2.0, 1.0, 1.0, 1.0, 1.0])]
    cols = [f"c{i}" for i in range(5)]
    df = spark.createDataFrame([(i, *v) for i, v in rows], "id int, " + ", ".join(f"{c} double" for c in cols))
    got = sorted((r["id"], r["lag"], r["pred"]) for r in lk.lag_matches(df, "id", cols).collect())
    exp = []
    n = len(cols)
    for lag in range(n - 2):
        right = {}
        for _, v in rows:
            right.setdefault(tuple(v[lag + 2:]), []).append(v[lag])
        for i, v in rows:
            hit = right.get(tuple(v[:n - lag - 2]))
            if hit is not None and len(hit) == 1:
                exp.append((i, lag, hit[0]))
    assert got == sorted(exp)


def test_ordered_primitives_with_ties_and_nulls(spark):
    rows = [(i % 7 if i % 11 else None, i, i % 3) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, t int, v int").repartition(5)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for n in (1, 8, 50):
        got = rel.with_global_row_number(df, ["k", "t"], "rn", num_buckets=n).collect()
        assert {r["rn"]: (r["k"], r["t"]) for r in got} == {i + 1: w[:2] for i, w in enumerate(want)}
        sums = {(r["k"], r["t"]): r["cum_v"] for r in prefix_sums(df, ["k", "t"], ["v"], num_buckets=n).collect()}
        total = 0
        for w in want:
            total += w[2]
            assert sums[w[:2]] == total
    x = [r[1] for r in rows]
    assert exact_quantiles(df, "t", [0.0, 0.25, 0.9, 1.0]) == pytest.approx(list(pd.Series(x).quantile([0.0, 0.25, 0.9, 1.0])))
    assert exact_quantiles(df.where("false"), "t", [0.5]) == [None]


def test_small_group_after_large_keeps_its_digits(spark):
    df = spark.createDataFrame([("a", 1, 1e17), ("a", 2, 1e17), ("b", 1, 0.25), ("b", 2, 0.5)], "g string, o int, v double")
    got = {(r["g"], r["o"]): r["cum_v"] for r in prefix_sums(df, ["o"], ["v"], ["g"], num_buckets=3).collect()}
    assert got["b", 1] == 0.25 and got["b", 2] == 0.75


def test_integer_mean_imputation(spark):
    from featmart.operators.profile import impute_mean_mode
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert sorted(r["x"] for r in impute_mean_mode(df).collect()) == [1.0, 1.5, 2.0]


def test_drift_in_the_middle_of_the_range(spark):
    train = spark.createDataFrame([(i, float(i % 100)) for i in range(2000)], "id int, x double")
    test = spark.createDataFrame([(5000 + i, 50.0 + i % 3) for i in range(600)], "id int, x double")
    assert ev.drift_report(train, test, ["x"], "id").first()["drift_score"] > 0.9
    assert ev.drift_report(train, train.withColumn("id", F.col("id") + 9000), ["x"], "id").first()["drift_score"] < 0.6


def test_feature_report_with_large_values(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    x, b = 1.6e9 + rng.integers(0, 50, 400), rng.random(400)
    y = 0.01 * (x - 1.6e9) + b + rng.random(400)
    rows = [(float(y[i]), float(b[i]), float(x[i]), i % 4) for i in range(400)]
    df = spark.createDataFrame(rows, "y double, b double, x double, fold int")
    got = ev.single_feature_report(df, "y", "b", "fold", ["x"]).first()["cv_rmse"]
    want = []
    for f in range(4):
        tr, va = np.arange(400) % 4 != f, np.arange(400) % 4 == f
        a = np.stack([np.ones(400), b, x - 1.6e9], axis=1)
        k = np.linalg.lstsq(a[tr], y[tr], rcond=None)[0]
        want.append(np.sqrt(np.mean((y[va] - a[va] @ k) ** 2)))
    assert got == pytest.approx(np.mean(want), rel=1e-9)


def test_category_with_a_third_of_the_rows(spark):
    df = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 50).cast("string"))).alias("c"))
    out = enc.frequency_encode(df, "c")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and out.where("c = 'hot'").first()["c_frequency"] == pytest.approx(1 / 3)


def test_left_mart_names_clashing_columns(spark):
    base = spark.createDataFrame([(1, 5)], "k int, x int")
    parts = {"a": spark.createDataFrame([(1, 6, 7)], "k int, x int, y int"), "b": spark.createDataFrame([(1, 8)], "k int, y int")}
    out = rel.left_mart(base, parts, "k")
    assert out.columns == ["k", "x", "a_x", "a_y", "b_y"] and tuple(out.first()) == (1, 5, 6, 7, 8)


def test_lag_search_regroups_colliding_hashes(spark, monkeypatch):
    """With hashes that always collide, keys are told apart by the third hash and compared themselves."""
    cols = ["d4", "d3", "d2", "d1"]
    df = spark.createDataFrame([(1, 9.0, 1.0, 2.0, 3.0), (2, 7.0, 8.0, 9.0, 1.0), (3, 5.0, 5.0, 5.0, 5.0)], "id int, d4 double, d3 double, d2 double, d1 double")
    want = sorted(map(tuple, lk.lag_matches(df, "id", cols).collect()))
    assert want
    monkeypatch.setattr(lk.F, "xxhash64", lambda *c: F.lit(0).cast("long"))
    assert sorted(map(tuple, lk.lag_matches(df, "id", cols).collect())) == want


def test_group_median_and_mode(spark):
    from featmart.operators.profile import group_median, group_modes
    rows = [("a", 1.0, "x"), ("a", 5.0, "x"), ("a", 2.0, "y"), ("a", 2.0, None), ("b", 7.0, "q"), ("b", 8.0, "p"), ("c", None, None)]
    df = spark.createDataFrame(rows, "k string, v double, s string")
    assert {r["k"]: r["m"] for r in group_median(df, ["k"], F.col("v"), "m").collect()} == {"a": 2.0, "b": 7.5}
    assert {r["k"]: r["s_mode"] for r in group_modes(df, ["k"], ["s"]).collect()} == {"a": "x", "b": "p", "c": None}


def test_null_targets_ignored_or_zero(spark):
    df = spark.createDataFrame([("a", 4.0), ("a", None), ("b", 2.0)], "c string, y double")
    ignore = {r["c"]: r["enc"] for r in enc.target_mean_fit(df, "c", "y", alpha=0.0)[0].collect()}
    zero = {r["c"]: r["enc"] for r in enc.target_mean_fit(df, "c", "y", alpha=0.0, null_target="zero")[0].collect()}
    assert ignore == {"a": 4.0, "b": 2.0} and zero == {"a": 2.0, "b": 2.0}
