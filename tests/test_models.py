"""Invariants of the model queries beyond their SQL oracles."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from featmart.operators import models as md
from tests.conftest import SMALL

Q = E.queries()


def test_every_row_predicted_once(spark):
    users = spark.read.parquet(f"{SMALL}/events.parquet").select("user_id").distinct().count()
    for name in ("mdl02_gbt_oof", "mdl11_two_level_stack"):
        df = Q[name](spark, SMALL)
        assert df.count() == users == df.select("user_id").distinct().count()


def test_scored_rows_are_held_out(spark):
    labelled = spark.read.parquet(f"{SMALL}/labels.parquet").count()
    n = Q["mdl05_linear_svc"](spark, SMALL).count()
    assert 0 < n < labelled / 2


def test_linear_svc_separates(spark):
    """A plane between two point clouds: all held-out points on their side (tolerance 1 %)."""
    df = spark.range(2000).select("id", F.rand(1).alias("a"), F.rand(2).alias("b")).withColumn("label", (F.col("a") + F.col("b") > 1).cast("double"))
    df = md.assemble(df.where("abs(a + b - 1) > 0.05"), ["a", "b"], null_indicators=False)
    model = md.fit(df.where("id % 4 > 0"), "linear_svc", maxIter=50, regParam=0.0001)
    wrong = model.transform(df.where("id % 4 = 0")).agg(F.avg((F.col("prediction") != F.col("label")).cast("int"))).first()[0]
    assert wrong <= 0.01


def test_grid_search_reports_every_combination(spark):
    rows = Q["mdl08_grid_search"](spark, SMALL).collect()
    assert len(rows) == 24 and len({(r.numTrees, r.maxDepth, r.minInstancesPerNode, r.featureSubsetStrategy) for r in rows}) == 24
    assert all(0 <= r.auc <= 1 for r in rows) and min(r.place for r in rows) == 1


def test_stack_follows_the_target(spark):
    assert Q["mdl11_two_level_stack"](spark, SMALL).agg(F.corr("y", "prediction")).first()[0] > 0
