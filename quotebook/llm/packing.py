"""Concatenate and cut: all documents as one stream of token ids, cut into windows of equal length.

Pass one tokenizes each document once, ends it with the terminator id, and writes the ids with their place
in their partition. The totals of the partitions, summed up in partition order, give every partition its
offset in the stream. Pass two cuts at the multiples of the window; a document on a boundary gives a piece
on either side. Only the last window is padded. The order of the stream is the order of the scan, fixed by
the table written in pass one, so lost executors change nothing.

Nulls: a null text is an empty document (its terminator alone); null ids are carried along. Repeated rows are
packed each. Empty tables give no piece. Other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotebook.llm import bpe
from quotebook.llm.staging import keep, sized

WINDOW = 1024
#: The partition offsets (16 bytes each) are broadcast up to so many partitions, else joined by exchange.
BROADCAST_PARTITIONS = 1_000_000
_BATCH_BYTES = 8_000_000


def encoded(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, terminator: int) -> DataFrame:
    """part, at (tokens before it in its part), id, n and the ids (little-endian, 4 bytes each)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = bpe.worker_cache(tokenizer, True)
        width, part, at = cache.dtype.itemsize, TaskContext.get().partitionId(), 0
        end = np.array([terminator], dtype=cache.dtype).tobytes()

        def rows(first: int, last: int, ids: pa.Array, blobs: list[bytes], start: int) -> pa.RecordBatch:
            n = np.array([len(b) // width for b in blobs], dtype=np.int64)
            begin = start + np.cumsum(n) - n
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(n), part, np.int32)), pa.array(begin), ids.slice(first, last - first),
                    pa.array(n), pa.array(blobs, pa.binary()),
                ],
                names=["part", "at", "id", "n", "ids"],
            )

        for batch in batches:
            ids, texts = batch.columns
            blobs: list[bytes] = []
            size, first = 0, 0
            for i, blob in enumerate(cache.values(bpe.texts_of(texts))):
                blobs.append(blob + end)
                size += len(blob) + width
                if size >= _BATCH_BYTES or i == len(texts) - 1:
                    yield rows(first, i + 1, ids, blobs, at)
                    at, first, size, blobs = at + size // width, i + 1, 0, []

    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()), T.StructField("at", T.LongType()),
            T.StructField("id", docs.schema[id_col].dataType), T.StructField("n", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    return docs.select(id_col, text_col).mapInArrow(encode, schema)


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    window: int = WINDOW,
    terminator: int = 0,
) -> DataFrame:
    """One row per piece: id, start, length, doc_tokens, sequence_id, offset, ids (binary, uint32 each)."""
    path = tokenizer or bpe.default_tokenizer()
    narrow = bpe.Vocabulary(path).size <= 1 << 16
    tokens = keep(encoded(docs, id_col, text_col, path, terminator), "packing")
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = keep(totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")), "packing-bases")
    bases = sized(bases, BROADCAST_PARTITIONS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at, blobs = batch.columns
            source: list[int] = []
            starts, lengths, totals_, offsets, data = [], [], [], [], []
            size = 0
            for i, (place, blob) in enumerate(zip(at.to_numpy(), blobs, strict=True)):
                stream = np.frombuffer(blob.as_buffer(), dtype="<u2" if narrow else "<u4").astype("<u4")
                n = len(stream)
                edges = [place, *range((place // window + 1) * window, place + n, window), place + n]
                for a, b in zip(edges, edges[1:]):
                    source.append(i)
                    starts.append(a - place)
                    lengths.append(b - a)
                    totals_.append(n)
                    offsets.append(a)
                    data.append(stream[a - place : b - place].tobytes())
                size += 4 * n
                if size >= _BATCH_BYTES or i == len(ids) - 1:
                    where = np.array(offsets, dtype=np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array(source)), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                            pa.array(totals_, pa.int64()), pa.array(where // window), pa.array(where % window),
                            pa.array(data, pa.binary()),
                        ],
                        names=[id_col, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
                    )
                    source, starts, lengths, totals_, offsets, data, size = [], [], [], [], [], [], 0

    long = [T.StructField(c, T.LongType()) for c in ("start", "length", "doc_tokens", "sequence_id", "offset")]
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *long, T.StructField("ids", T.BinaryType())])
    placed = tokens.join(bases, "part").select("id", (F.col("base") + F.col("at")).alias("at"), "ids")
    return placed.mapInArrow(cut, schema)
