"""Session defaults and the shared staging folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution sizes the shuffles and splits skewed join partitions at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "quotebook", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a fresh local one only for a local session."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    path = tempfile.mkdtemp(prefix="quotebook-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    return os.path.join(shared_dir(spark), "quotebook", f"{label}-{uuid.uuid4().hex}")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result as parquet to the shared folder and go on from there.

    Used where a result feeds several branches of a plan: it is computed once, survives the
    loss of executors and gives the optimizer real sizes.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
