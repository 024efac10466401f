"""Priority list: ``{"high_priority_stocks": [url or slug, ...]}``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCHEMA = "struct<high_priority_stocks:array<string>>"


def parse_priority_list(texts: DataFrame, column: str = "value") -> DataFrame:
    """Rows of JSON text to one row per entry. Broken text gives no entries."""
    parsed = F.from_json(F.col(column), _SCHEMA)["high_priority_stocks"]
    return texts.select(F.explode(parsed).alias("entry"))


def read_priority_list(spark: SparkSession, inline: str | None = None, path: str | None = None) -> DataFrame:
    """Entries of the inline JSON if it is valid JSON, else of the file, else none."""
    if inline:
        given = spark.createDataFrame([(inline,)], "value string")
        if not given.filter(F.try_parse_json("value").isNotNull()).isEmpty():
            return parse_priority_list(given)
    if path:
        return parse_priority_list(spark.read.text(path, wholetext=True))
    return spark.createDataFrame([], "entry string")
