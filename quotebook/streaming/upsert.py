"""The repeated batch run as a stream: every micro-batch of raw listings goes into the book."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from quotebook.operators.listings import normalize_listings
from quotebook.plans.buckets import merge_batch
from quotebook.sources.versions import written_by


def stream_upsert(
    listings: DataFrame,
    root: str,
    checkpoint: str,
    batch_ts: Column,
    aliases: DataFrame | None = None,
    keep_short_name: bool = False,
) -> StreamingQuery:
    """Merge a stream of raw listings into the versioned book at ``root``.

    A micro-batch makes the next version, whoever wrote those before it, and marks it with the stream's id
    and its own number. If it is replayed after a failure, a version with that mark is not made again.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # The id lives with the checkpoint: a stream that lost its state is another writer.
        stream = json.loads(spark.read.text(f"{checkpoint}/metadata").first().value)["id"]
        writer = f"{stream}-{batch_id}"
        if written_by(spark, root, writer):
            return
        merge_batch(spark, root, normalize_listings(batch, keep_short_name), batch_ts, aliases, writer=writer)

    return (
        listings.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
