"""The live feed: tagged JSON lines among other log lines. Works on batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quotebook.operators.publish import live_columns
from quotebook.sources.book import versions

TAG = "LIVE_DATA:"
_EVENT = "company string, price string, source string"


def live_feed(lines: DataFrame) -> DataFrame:
    """Well-formed tagged lines as (company, price, source); malformed ones are ignored."""
    text = F.replace(F.col("line"), F.lit(TAG), F.lit(""))
    tagged = lines.filter(F.col("line").startswith(TAG)).withColumn("text", text)
    parsed = tagged.filter(F.try_parse_json("text").isNotNull()).select(F.from_json("text", _EVENT).alias("event"))
    return live_columns(parsed.select("event.*"))


def feed_lines(listings: DataFrame) -> DataFrame:
    """The feed's lines for raw listings, one for each row before any is dropped as a duplicate."""
    event = F.struct("company", F.col("price").cast("string").alias("price"), "source")
    return listings.select(F.concat(F.lit(TAG), F.to_json(event)).alias("line"))


def feed_other_lines(lines: DataFrame) -> DataFrame:
    return lines.filter(~F.col("line").startswith(TAG))


def live_source_counts(feed: DataFrame) -> DataFrame:
    """Running rows per source. The state has one entry per source."""
    return feed.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"))


def read_lines(spark: SparkSession, path: str, **options) -> DataFrame:
    """A stream of log lines from a folder of text files."""
    reader = spark.readStream
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.text(path).withColumnRenamed("value", "line")


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a parquet folder until the available input is used up."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def snapshot_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Rewrite a small running result per micro-batch, each under its own batch number."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/version={batch_id}")

    return (
        stream.writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_snapshot(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The running result as of the newest micro-batch."""
    done = versions(spark, path)
    if not done:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/version={done[-1]}")
