"""Bucketed feature tables and rows by position."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from featmart.sources import positions as pos
from featmart.sources.bucketed import BucketedCache, bucketed_mart
from tests.conftest import SMALL


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange")


def test_mart_over_buckets_moves_no_rows(spark):
    mart = E.queries()["jn03_bucketed_mart"](spark, SMALL)
    assert mart.count() == spark.read.parquet(f"{SMALL}/customer.parquet").count()
    assert exchanges(mart) == 0
    assert mart._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") == 6
    assert exchanges(E.queries()["customer_full_mart"](spark, SMALL)) > 6


def test_null_and_hot_keys_and_clashing_names(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (2, "d")], "k int, name string")
    part = spark.createDataFrame([(1, 10.0), (3, 30.0), (None, 5.0)], "k int, x double")
    cache = BucketedCache(spark, "k", 4)
    got = bucketed_mart(cache, base, {"p": part, "q": part}).collect()
    assert sorted((r.name, r.p_x, r.q_x) for r in got) == [("a", 10.0, 10.0), ("b", None, None), ("c", None, None), ("d", None, None)]
    assert cache.get("p").count() == 3
    with pytest.raises(ValueError):
        cache.put("p", part)
    cache.drop()


def test_buckets_follow_the_size(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    assert BucketedCache.sized_for(df, "k").buckets == 4
    assert BucketedCache.sized_for(df, "k", rows_a_bucket=50).buckets == 32


def test_parquet_positions_equal_the_files_rows(spark, tmp_path):
    """Many files, split into many tasks, read with a filter: the numbers stay those of the files."""
    spark.range(5000).selectExpr("id", "hash(id) AS h").repartition(7).write.option("parquet.block.size", 4096).parquet(str(tmp_path / "t"))
    want = duckdb.sql(f"SELECT id, filename, file_row_number AS n FROM read_parquet('{tmp_path}/t/*.parquet', file_row_number=true, filename=true)").fetchall()
    want = {r[0]: i for i, r in enumerate(sorted(want, key=lambda r: (r[1], r[2])))}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        rows = pos.parquet_positions(spark, str(tmp_path / "t"))
        assert rows.rdd.getNumPartitions() > 1
        assert {r.id: r.position for r in rows.collect()} == want
        assert {r.id: r.position for r in rows.where("h % 3 = 0").collect()} == {r.id: want[r.id] for r in rows.where("h % 3 = 0").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r.position for r in pos.positional_slice(rows, 100, 120).collect()) == list(range(100, 120))


def test_csv_positions_across_splits(spark, tmp_path):
    for k in range(3):
        lines = [f"{k * 1000 + i},{'x' * (i % 40)}" for i in range(1000 if k != 1 else 0)]
        (tmp_path / f"part-{k}.csv").write_text("\n".join(["id,s", *lines]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = {r.id: r.position for r in pos.csv_positions(spark, str(tmp_path), "id long, s string").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {**{i: i for i in range(1000)}, **{2000 + i: 1000 + i for i in range(1000)}}


def test_rows_of_one_split_do_not_meet_to_be_numbered(spark, tmp_path):
    """Splits of several files in one task: rows are numbered where they are read, by no window over a split."""
    for k in range(5):
        (tmp_path / f"part-{k}.csv").write_text("\n".join(["id", *(str(k * 400 + i) for i in range(400))]) + "\n")
    spark.conf.set("spark.sql.files.minPartitionNum", "2")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = pos.csv_positions(spark, str(tmp_path), "id long")
        assert rows.rdd.getNumPartitions() < 5
        assert {r.id: r.position for r in rows.collect()} == {i: i for i in range(2000)}
        assert {r.id: r.position for r in rows.where("id % 7 = 0").collect()} == {i: i for i in range(0, 2000, 7)}
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and "row_number" not in plan  # that of the splits' sizes


def test_positional_join_of_unequal_lengths(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "a"))
    spark.range(100, 107).coalesce(1).withColumnRenamed("id", "other").write.parquet(str(tmp_path / "b"))
    a, b = (pos.parquet_positions(spark, str(tmp_path / n)) for n in "ab")
    assert sorted((r.id, r.other) for r in pos.positional_join(a, b).collect()) == [(i, 100 + i) for i in range(7)]
    assert pos.positional_join(a, b, how="left").where(F.col("other").isNull()).count() == 3
    assert pos.parquet_positions(spark, str(tmp_path / "a")).where("false").count() == 0


def _joins(df):
    """The kinds of joins in the plan, where Spark itself would broadcast nothing."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {kind: plan.count(kind) for kind in ("SortMergeJoin", "ShuffledHashJoin", "BroadcastHashJoin")}


def test_rows_of_one_file_do_not_meet_to_be_numbered(spark, tmp_path):
    spark.range(3000).coalesce(1).write.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = pos.parquet_positions(spark, str(tmp_path / "t"))
        assert _joins(rows) == {"SortMergeJoin": 0, "ShuffledHashJoin": 0, "BroadcastHashJoin": 1}
        assert sorted(r.position for r in rows.collect()) == list(range(3000))
        assert _joins(E.queries()["prj11_positional_slice"](spark, SMALL))["SortMergeJoin"] == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fill_by_position_numbers_both_files_in_place(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joins = _joins(E.queries()["snk04_fill_by_position"](spark, SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert joins["SortMergeJoin"] == 1  # of the two tables, by position


def test_positional_join_moves_rows_by_position_only(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joins = _joins(E.queries()["jn10_positional_join"](spark, SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert joins["SortMergeJoin"] == 1


def test_positional_join_deals_out_small_tables_too(spark):
    for name in ("jn10_positional_join", "snk04_fill_by_position"):
        joins = _joins(E.queries()[name](spark, SMALL))
        assert joins == {"SortMergeJoin": 1, "ShuffledHashJoin": 0, "BroadcastHashJoin": 2}  # two of the files' starts
