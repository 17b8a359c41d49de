"""Session construction and lineage cutting."""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

# Settings every featmart job relies on. They are defaults: a key that the launcher or a configuration
# file sets keeps its value, and ``getOrCreate`` reuses a running session.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",  # D5: calendar features are computed in UTC
    "spark.sql.adaptive.enabled": "true",  # runtime re-plan: broadcast conversion, coalescing
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",  # split hot join partitions
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # checkpoints go with their DataFrames
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "featmart", extra: dict | None = None) -> SparkSession:
    """Return (or create) the session with featmart's defaults.

    ``master`` is only set when given (tests pass ``local[*]``); on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    given = SparkConf()
    conf = {k: v for k, v in _DEFAULTS.items() if not given.contains(k)}
    if master and master.startswith("local"):
        conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be a shared file system (HDFS, object store) and is read from the
    session. Only a local-mode session without the setting (tests) gets a private scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder")
    path = tempfile.mkdtemp(prefix="featmart-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` by a reliable checkpoint in the shared checkpoint folder.

    Used where a plan is reused by several later jobs (fold loops, multi-pass operators): after
    an executor loss the re-run starts from the checkpoint files instead of the whole lineage.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
