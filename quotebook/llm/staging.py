"""Intermediate tables in the shared folder, compressed well since they count as disk; and how joins take them.

Spark estimates a table's size from that of its files, which are compressed, and does not count the rows that an
explode makes. Where a side is estimated far too low it is collected and broadcast by the driver, up to sizes that do
not fit there. So joins of tables that grow with the input go by counted rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotebook.session import scratch_path

#: A join is left to the planner, which may broadcast, up to so many rows of the side in question.
PLANNED_ROWS = 100_000


def exchanged(df: DataFrame) -> DataFrame:
    """`df` for a join by exchange, whatever size Spark estimates for either side."""
    return df.hint("merge")


def planned(df: DataFrame, rows: int) -> DataFrame:
    """`df`, of at most so many rows, for a join that the planner may decide on only if they are few."""
    return df if rows <= PLANNED_ROWS else exchanged(df)


def sized(df: DataFrame, most: int) -> DataFrame:
    """`df` for a join: broadcast up to so many rows, else by exchange."""
    return F.broadcast(df) if df.count() <= most else exchanged(df)


def keep(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write `df` to the folder of spark.checkpoint.dir and read it back: cuts lineage, outlives executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path, partitionBy=list(partition_by) or None)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep_bucketed(df: DataFrame, label: str, column: str, buckets: int) -> tuple[DataFrame, str]:
    """The same as a table in hash buckets of a column, so that a join on it need not exchange this side; and the name
    of the table, to be dropped from the session's catalog when it is done with."""
    name = f"{label.replace('-', '_')}_{uuid.uuid4().hex}"
    write = df.write.format("parquet").option("compression", "zstd").option("path", scratch_path(df.sparkSession, label))
    write.bucketBy(buckets, column).saveAsTable(name)
    return df.sparkSession.table(name), name
