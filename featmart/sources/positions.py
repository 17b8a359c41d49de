"""Rows by their place in a file (JN-10, PRJ-11, SNK-4, SRT-8): slices and joins of tables that share no key.

A row's number is its place in its file plus the rows of the files before it (by path): one count per file, which is
sent to the rows, so that the rows of one file never meet in one task. The Parquet reader knows the place of its rows;
rows of text files are counted inside the split they were read from, by the task that reads it. Nothing is sorted and no
row is moved to be numbered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_PLACE = ("__file", "__block", "__place")


def _numbered(rows: DataFrame, first: Column, name: str) -> DataFrame:
    """``rows`` with ``__file``, ``__block`` and a ``__place`` that rises by one inside them, numbered from 0 through all
    files. ``first`` is the place of the first row of a file and block, an aggregate."""
    sizes = rows.groupBy("__file", "__block").agg(F.count(F.lit(1)).alias("__n"), first.alias("__first"))  # a row a file or split
    before = F.sum("__n").over(Window.orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("__file", "__block", (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__start"))
    out = rows.join(F.broadcast(starts), ["__file", "__block"])
    return out.withColumn(name, (F.col("__start") + F.col("__place")).cast("long")).drop(*_PLACE, "__start")


def parquet_positions(spark: SparkSession, path: str | list[str], name: str = "position") -> DataFrame:
    """The Parquet files at ``path`` with each row's number in file order, from 0. The place in the file comes from the
    reader, so filters on other columns may follow and files may be split."""
    paths = [path] if isinstance(path, str) else path
    rows = spark.read.parquet(*paths)
    rows = rows.select("*", F.col("_metadata.file_path").alias("__file"), F.lit(0).cast("long").alias("__block"), F.col("_metadata.row_index").alias("__place"))
    return _numbered(rows, F.first(F.lit(0)), name)


def csv_positions(spark: SparkSession, path: str | list[str], schema: str, name: str = "position", **options) -> DataFrame:
    """The CSV files at ``path`` with each row's number in file order, from 0. Text files do not know their rows: a row's
    place is counted inside the split it was read from, and splits follow each other by their offset. Lines may not
    hold line breaks; malformed rows count like the reader keeps them."""
    rows = spark.read.schema(schema).options(**{"header": True, **options}).csv(path)
    # a split is read from front to back by one task, so inside it these numbers rise by one from row to row
    rows = rows.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"),
                       F.monotonically_increasing_id().alias("__place"))
    return _numbered(rows, F.min("__place"), name)


def positional_join(left: DataFrame, right: DataFrame, name: str = "position", how: str = "inner") -> DataFrame:
    """JN-10: row i beside row i, by their numbers. Both sides are dealt out by position at every size: a broadcast side
    would not shrink with more machines, and what a task reads would leap where the side gets too large for it."""
    return left.join(right.hint("merge"), name, how)


def positional_slice(df: DataFrame, start: int, end: int, name: str = "position") -> DataFrame:
    """PRJ-11: the rows from ``start`` up to but not with ``end``."""
    return df.where((F.col(name) >= start) & (F.col(name) < end))
