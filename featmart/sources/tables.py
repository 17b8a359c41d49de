"""Parquet tables of a dataset folder (``<dir>/<name>.parquet``).

Parquet carries its schema, so no inference happens; Catalyst prunes columns and pushes filters into
the scan (``ReadSchema`` / ``PushedFilters`` in ``explain``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")


class tables:
    """Attribute access to the tables of one folder: ``t = tables(spark, d); t.orders``."""

    def __init__(self, spark: SparkSession, base_dir: str):
        self._spark, self._dir = spark, base_dir
        # D5: calendar features and epoch conversions of the timezone-less timestamps are UTC,
        # whatever session the caller passes in
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_table(self._spark, self._dir, name)
