"""Typed readers and sinks on files written to a scratch folder."""

import os
import tempfile

from pyspark.sql import functions as F

from featmart.sources import files as io


def _scratch():
    return tempfile.mkdtemp(prefix="featmart-test-")


def test_csv_schema_malformed_and_sentinel(spark):
    d = _scratch()
    p = os.path.join(d, "a.csv")
    with open(p, "w") as f:
        f.write("id,days,amount\n007,365243,1.5\n008,12,2.5\nbad,row\n009,x,3.0\n")
    df = io.read_csv(spark, p, "id STRING, days INT, amount DOUBLE", drop_malformed=True)
    df = io.null_sentinels(df, [365243])
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [("007", None, 1.5), ("008", 12, 2.5)]


def test_tsv_and_snake_case(spark):
    d = _scratch()
    p = os.path.join(d, "a.tsv")
    with open(p, "w") as f:
        f.write("PhraseId\ttotals.hits\n1\t3\n")
    df = io.snake_case_columns(io.read_tsv(spark, p, "PhraseId LONG, `totals.hits` INT"))
    assert df.columns == ["phrase_id", "totals_hits"] and df.first()["totals_hits"] == 3


def test_labelled_files(spark):
    d = _scratch()
    for lab in ("bart", "lisa"):
        os.makedirs(os.path.join(d, lab))
        for i in range(2):
            with open(os.path.join(d, lab, f"{i}.bin"), "wb") as f:
                f.write(b"\x00" * (i + 1))
    df = io.read_labelled_files(spark, d)
    got = sorted((r["label"], r["length"]) for r in df.collect())
    assert got == [("bart", 1), ("bart", 2), ("lisa", 1), ("lisa", 2)]


def test_fill_template_and_fixed(spark):
    t = spark.createDataFrame([(1, None), (2, None)], "id int, target double")
    p = spark.createDataFrame([(2, 0.125)], "id int, target double")
    out = io.fill_template(t, p, "id", "target")
    assert out.columns == ["id", "target"]
    got = sorted((r["id"], r["target"]) for r in out.collect())
    assert got == [(1, None), (2, 0.125)]
    assert out.select(io.format_fixed("target", 2).alias("s")).where("id = 2").first()["s"] == "0.13"


def test_quotes_and_line_breaks(spark):
    p = os.path.join(_scratch(), "q.csv")
    with open(p, "w") as f:
        f.write('id,text,author\n1,"He said ""hi, you"" now",A\n2,"two\nlines",B\n')
    rows = io.read_csv(spark, p, "id INT, text STRING, author STRING", multi_line=True).collect()
    assert [tuple(r) for r in rows] == [(1, 'He said "hi, you" now', "A"), (2, "two\nlines", "B")]
    out = _scratch()
    io.write_csv(spark.createDataFrame([(1, 'He said "hi", ok')], "id int, t string").coalesce(1), out)
    part = [x for x in os.listdir(out) if x.endswith(".csv")][0]
    assert '"He said ""hi"", ok"' in open(os.path.join(out, part)).read()


def test_malformed_rows_do_not_depend_on_columns_read(spark):
    p = os.path.join(_scratch(), "a.csv")
    with open(p, "w") as f:
        f.write('id,days,amount\n007,1,1.5\n008,12,2.5\nbad,row\n009,x,3.0\n')
    df = io.read_csv(spark, p, "id STRING, days INT, amount DOUBLE", drop_malformed=True)
    assert df.count() == len(df.collect()) == df.select("id").count() == len(df.select("id").collect()) == 2


def test_label_without_folder(spark):
    df = spark.createDataFrame([("file",), ("a/b/file",)], "p string")
    assert [r[0] for r in df.select(io.label_from_path(F.col("p"))).collect()] == [None, "b"]
