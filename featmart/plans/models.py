"""Model queries over MLlib (MDL-*, CLU-1, DEC-1). What a model predicts depends on seeds and solver
details, so the queries return what can be stated exactly: which rows are scored (the held-out ones, or
every row once over the folds), their labels and folds, and whether the result holds up: probabilities
inside their range, both classes predicted, errors below those of the trivial model on held-out rows."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import MinMaxScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featmart.operators import encode as enc
from featmart.operators import models as md
from featmart.operators import neural as nn
from featmart.operators import one_class as oc
from featmart.operators.split import BUCKETS, kfold, split_flag
from featmart.plans.registry import query
from featmart.session import materialize
from featmart.sources import tables

_NUMERIC = ["n_chars", "upper_share", "digit_share", "n_lines"]


def _doc_features(spark, base):
    """labels x documents: length, share of upper-case and digits, lines, and an indicator per language (the
    languages come from the data). Returns the table and the feature names."""
    t = tables(spark, base)
    d = t.documents.select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"),
        (F.length(F.regexp_replace("text", r"[^A-Z]", "")) / F.greatest(F.length("text"), F.lit(1))).alias("upper_share"),
        (F.length(F.regexp_replace("text", r"[^0-9]", "")) / F.greatest(F.length("text"), F.lit(1))).alias("digit_share"),
        F.size(F.split("text", "\n")).cast("double").alias("n_lines"), "lang")
    langs = enc.distinct_values(d, "lang")["lang"]
    d = d.select("*", *enc.one_hot_exprs("lang", langs)).drop("lang")
    return t.labels.join(d, "doc_id"), _NUMERIC + [f"lang_{x}" for x in langs]


def _checked(pred: DataFrame, ok: Column, *cols) -> DataFrame:
    """``pred`` with ``holds_up``: one verdict over all of its rows (an aggregate of one row)."""
    verdict = pred.agg(ok.alias("holds_up"))
    return pred.select(*cols).join(F.broadcast(verdict))


def _classifies(label: str, pred: str = "prediction") -> Column:
    """At least as accurate as the more frequent class, and both classes predicted."""
    right, share = F.avg((F.col(label) == F.col(pred)).cast("double")), F.avg(F.col(label).cast("double"))
    return (right >= F.greatest(share, 1 - share)) & (F.count_distinct(pred) > 1)


def _regresses(label: str, pred: str = "prediction") -> Column:
    """Smaller squared error than the mean of the scored rows."""
    return F.sum((F.col(label) - F.col(pred)) ** 2) < F.count(label) * F.var_pop(label)


_VALID_SQL = "('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '|{seed}'), 1, 8))::BIGINT % " + str(BUCKETS) + " < {share} * " + str(BUCKETS)
_LABELLED = "labels JOIN documents USING (doc_id)"


def _held_out(seed, share=0.25):
    return f"SELECT doc_id, quality, TRUE AS holds_up FROM {_LABELLED} WHERE {_VALID_SQL.format(seed=seed, share=share)}"


def _split_docs(spark, base, seed, features=None):
    df, names = _doc_features(spark, base)
    names = features(names) if features else names
    df = md.assemble(df, names, null_indicators=False).withColumn("is_valid", split_flag("doc_id", 0.25, seed))
    return df.where(~F.col("is_valid")), df.where("is_valid"), names


def _length_docs(spark, base, seed):
    """The text's length as the target, with features that do not contain it."""
    df, names = _doc_features(spark, base)
    names = [n for n in names if n != "n_chars"]
    df = md.assemble(df, names, null_indicators=False).withColumn("y", F.log1p("n_chars"))
    return df.withColumn("is_valid", split_flag("doc_id", 0.25, seed))


@query("mdl09_early_stopping", f"SELECT doc_id, TRUE AS holds_up FROM {_LABELLED} WHERE {_VALID_SQL.format(seed=12, share=0.25)}",
       ("MDL-9", "MDL-2", "SPL-2"))
def mdl09_early_stopping(spark, base):
    """A third split stops the boosting: rows for training, for stopping and, never seen, for scoring."""
    df = _length_docs(spark, base, 12).withColumn("is_es", split_flag("doc_id", 0.2, 112))
    model = md.fit_early_stopping(df.where(~F.col("is_valid")), "gbt_regressor", "is_es", label="y", maxIter=20, maxDepth=3, seed=1)
    return _checked(model.transform(df.where("is_valid")), _regresses("y"), "doc_id")


@query("mdl03_rf_importance", _held_out(13), ("MDL-3", "MDL-13", "SRT-3"))
def mdl03_rf_importance(spark, base):
    """A forest, its 20 most important features (or all, if fewer), and a second forest on these alone."""
    df, names = _doc_features(spark, base)
    valid = split_flag("doc_id", 0.25, 13)
    first = md.fit(md.assemble(df.where(~valid), names, null_indicators=False), "rf_classifier", label="quality", numTrees=20, maxDepth=4, seed=3)
    top = [n for n, _ in md.feature_importance(first, names)[:20]]  # one value per feature
    second = md.fit(md.assemble(df.where(~valid), top, null_indicators=False), "rf_classifier", label="quality", numTrees=20, maxDepth=4, seed=4)
    return _checked(second.transform(md.assemble(df.where(valid), top, null_indicators=False)), _classifies("quality"), "doc_id", "quality")


@query("mdl04_tree_regressor", f"SELECT doc_id, TRUE AS holds_up FROM {_LABELLED} WHERE {_VALID_SQL.format(seed=14, share=0.25)}",
       ("MDL-4", "EVL-6", "ENC-4"))
def mdl04_tree_regressor(spark, base):
    df = _length_docs(spark, base, 14)
    model = md.fit(df.where(~F.col("is_valid")), "tree_regressor", label="y", maxDepth=4)
    return _checked(model.transform(df.where("is_valid")), _regresses("y"), "doc_id")


def _scaled(train: DataFrame, valid: DataFrame):
    """Both parts scaled to [0, 1] by the ranges of train."""
    model = MinMaxScaler(inputCol="features", outputCol="scaled").fit(train)
    return model.transform(train), model.transform(valid)


@query("mdl05_linear_svc", None, ("MDL-5",))
def mdl05_linear_svc(spark, base):
    """The class of held-out documents and their distance from the plane; no SQL, the solver decides the last digits."""
    train, valid, _ = _split_docs(spark, base, 15)
    train, valid = _scaled(train, valid)
    model = md.fit(train, "linear_svc", label="quality", features="scaled", maxIter=50, regParam=0.001)
    margin = vector_to_array("rawPrediction")[1]
    return model.transform(valid).select("doc_id", "quality", F.col("prediction").cast("int").alias("prediction"), F.round(margin, 6).alias("margin"))


@query("mdl06_mlp", _held_out(16), ("MDL-6", "SCA-1"))
def mdl06_mlp(spark, base):
    train, valid, names = _split_docs(spark, base, 16)
    train, valid = _scaled(train, valid)
    model = md.fit(train, "mlp", label="quality", features="scaled", layers=[len(names), 8, 2], maxIter=300, seed=1, solver="l-bfgs", tol=1e-9)
    return _checked(model.transform(valid), _classifies("quality"), "doc_id", "quality")


@query("mdl06_relu_dropout", None, ("MDL-6",))
def mdl06_relu_dropout(spark, base):
    """The probability of good quality for held-out documents, by a network with a ReLU layer and dropout."""
    df, names = _doc_features(spark, base)
    rows = materialize(df.select("doc_id", "quality", *names).withColumn("is_valid", split_flag("doc_id", 0.25, 16)))
    net = nn.fit(rows.where(~F.col("is_valid")), names, "quality", "doc_id", (16,), epochs=4, batches=4, rate=0.2, dropout=0.2, seed=1)
    out = net.predict(rows.where("is_valid"))
    return out.select("doc_id", "quality", F.round("p1", 6).alias("p1"), (F.col("p1") > 0.5).cast("int").alias("prediction"))


@query("mdl07_one_class", None, ("MDL-7", "SPL-8"))
def mdl07_one_class(spark, base):
    """A boundary around the documents that are not toxic, a tenth of them outside; all documents with their distance."""
    df, names = _doc_features(spark, base)
    rows = materialize(df.select("doc_id", "toxic", *names))
    model = oc.fit(rows.where("toxic = 0"), names, nu=0.1)
    return model.predict(rows).select("doc_id", "toxic", "flagged", F.round("margin", 6).alias("margin"))


_GRID = {"numTrees": [3, 6], "maxDepth": [2, 4], "minInstancesPerNode": [1, 5], "featureSubsetStrategy": ["sqrt", "onethird", "all"],
         "maxBins": [32], "subsamplingRate": [0.9], "minInfoGain": [0.0], "impurity": ["gini"]}


@query("mdl08_grid_search", None, ("MDL-8",))
def mdl08_grid_search(spark, base):
    """24 combinations over eight keys, 4 folds: one row each with the mean area under the curve and its rank."""
    train, _, _ = _split_docs(spark, base, 17)
    ev = BinaryClassificationEvaluator(labelCol="quality", metricName="areaUnderROC")
    cv = md.grid_search(materialize(train), "rf_classifier", _GRID, ev, folds=4, label="quality", parallelism=4, seed=5)
    rows = [(*(m[getattr(cv.getEstimator(), k)] for k in _GRID), float(a)) for m, a in zip(cv.getEstimatorParamMaps(), cv.avgMetrics)]
    types = {int: "int", float: "double", str: "string"}
    out = spark.createDataFrame(rows, ", ".join(f"{k} {types[type(v[0])]}" for k, v in _GRID.items()) + ", auc double")  # one row a combination
    return out.withColumn("place", F.rank().over(Window.orderBy(F.desc("auc"))))


@query("clu01_kmeans_cluster", "SELECT c_custkey, TRUE AS in_range, TRUE AS holds_up FROM customer", ("CLU-1",))
def clu01_kmeans_cluster(spark, base):
    t = tables(spark, base)
    n = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).cast("double").alias("n_orders"))
    c = t.customer.join(n, "c_custkey", "left")
    out = md.cluster_feature(c, c, ["c_acctbal", "c_nationkey", "n_orders"], k=8, seed=1)
    return _checked(out, F.count_distinct("cluster") > 1, "c_custkey", F.col("cluster").between(0, 7).alias("in_range"))


@query("dec01_pca_whitened", "SELECT vec_id, 36 AS n_components, TRUE AS holds_up FROM embeddings", ("DEC-1",))
def dec01_pca_whitened(spark, base):
    """36 components, each of unit variance."""
    from pyspark.ml.functions import array_to_vector
    e = tables(spark, base).embeddings.select("vec_id", array_to_vector("embedding").alias("v"))
    out = md.whitened_pca(e, "v", 36).select("vec_id", vector_to_array("pca").alias("pca"))
    unit = F.abs(F.stddev_samp(F.element_at("pca", 1)) - 1) + F.abs(F.stddev_samp(F.element_at("pca", 36)) - 1) < 1e-3
    return _checked(out, unit, "vec_id", F.size("pca").alias("n_components"))


@query("mdl13_importance_mean", """
WITH f AS (SELECT unnest(range(3)) AS fold),
n AS (SELECT unnest(['n_chars', 'upper_share', 'digit_share', 'n_lines']) AS feature
      UNION ALL SELECT DISTINCT 'lang_' || lang FROM documents WHERE lang IS NOT NULL)
SELECT CAST(fold AS INTEGER) AS fold, feature, CAST(3 AS BIGINT) AS n_folds, TRUE AS holds_up FROM f, n
""", ("AGG-24", "MDL-13", "MDL-10"))
def mdl13_importance_mean(spark, base):
    """Importance of each feature in each fold's forest, with the mean over the folds joined back to the rows."""
    df, names = _doc_features(spark, base)
    df = md.assemble(df, names, null_indicators=False).withColumn("fold", kfold("doc_id", 3, 8))
    rows = []
    for f in range(3):
        m = md.fit(df.where(F.col("fold") != f), "rf_classifier", label="quality", numTrees=5, maxDepth=3, seed=f)
        rows += [(f, name, imp) for name, imp in md.feature_importance(m, names)]  # one value per feature
    imp = spark.createDataFrame(rows, "fold int, feature string, importance double")
    mean = imp.groupBy("feature").agg(F.avg("importance").alias("importance_mean"), F.count(F.lit(1)).alias("n_folds"))
    out = imp.join(mean, "feature")
    return _checked(out, F.abs(F.sum("importance") - 3) < 1e-6, "fold", "feature", "n_folds")
