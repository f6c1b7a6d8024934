"""Session helpers.

The library never creates its own cluster settings in production code: it
reads what the session has. ``get_session`` is for tests, benchmarks and the
CLI, and only fills in settings that are unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC for the record-time constants, AQE for
# skew splitting and partition coalescing at run time.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "corpusforge") -> SparkSession:
    """Return the active session, creating a local one for tests if needed."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    given = SparkConf()  # what the submit command and its files say
    for key, value in _DEFAULTS.items():
        if not given.contains(key):
            builder = builder.config(key, value)
    if shuffle_partitions and not given.contains("spark.sql.shuffle.partitions"):
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if "CF_DRIVER_MEMORY" in os.environ:
        builder = builder.config("spark.driver.memory", os.environ["CF_DRIVER_MEMORY"])
    elif (master or "").startswith("local") and not given.contains("spark.driver.memory"):
        builder = builder.config("spark.driver.memory", "8g")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage.

    On a cluster this is ``spark.checkpoint.dir`` as configured by the
    operator (a shared file system path). Only when it is unset (local tests)
    do we pick a scratch folder of our own.
    """
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(conf)
        return conf
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing
    if spark.sparkContext.master.startswith("local"):
        # Local runs only (tests, the driver's smoke check): a scratch folder.
        path = tempfile.mkdtemp(prefix="corpusforge-ckpt-")
        spark.sparkContext.setCheckpointDir(path)
        return path
    raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back (reliable, survives lost executors)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()
