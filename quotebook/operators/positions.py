"""Global row numbers without one task seeing all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotebook.session import stage


def numbered(rows: DataFrame, *order: str, into: str = "Position") -> DataFrame:
    """The rows with their place, from 0, in the given order.

    The rows are sorted over range partitions and written with the number of their partition and their place in it; a
    place is that plus the sizes of the partitions before. Only these sizes, one row per partition, meet in one task.
    Rows that are equal in all of ``order`` come in any order among themselves, the same one for all later reads.
    """
    placed = rows.orderBy(*order).withColumns(
        {"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}
    )
    placed = stage(placed, "numbered")
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    return placed.join(F.broadcast(starts), "_part").withColumn(into, F.col("_start") + F.col("_at")).drop("_part", "_at", "_start")
