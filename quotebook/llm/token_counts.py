"""Token counts of whole texts by a map-side two-tier lookup.

First tier: a table of the lengths (in tokens) of the corpus's frequent pre-tokens, broadcast to the workers.
Second tier: what the table lacks is encoded and kept in a cache of the worker process. Pre-tokens are never
shuffled; the only exchange is the small count of the sample from which the table is made. The table decides
speed alone: a count is the same whether its pre-tokens are in the table or not.

Nulls: a null text counts as empty (0 tokens, 0 bytes); null ids are carried along. Repeated rows each give a
row. Empty tables give an empty result. Other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotebook.llm import bpe

#: Rows sampled (about) to find frequent pre-tokens, entries of the table, and the longest entry: at most
#: 65,536 entries of 32 characters, so the broadcast stays below 10 MB whatever the size of the corpus.
SAMPLE_ROWS = 10_000
TABLE_ENTRIES = 65_536
ENTRY_CHARS = 32


def frequent_lengths(docs: DataFrame, text_col: str, tokenizer: str, sample_rows: int, entries: int) -> bytes:
    """A compact table of the most frequent space-led pre-tokens: their texts, and one byte of length each."""
    rows = docs.select(F.col(text_col).alias("text"))
    total = rows.count()
    if not total:
        return b""
    found = (
        rows.sample(min(1.0, sample_rows / total), seed=7)
        .select(F.explode(F.slice(F.split("text", " "), 2, 1 << 30)).alias("piece"))
        .where(F.length("piece") <= ENTRY_CHARS)
        .groupBy("piece")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .orderBy(F.desc("n"), "piece")
        .limit(entries)
        .collect()
    )
    pieces = [r.piece for r in found]
    vocabulary = bpe.Vocabulary(tokenizer)
    if not vocabulary.by_piece:
        return b""
    lengths = bytes(map(len, vocabulary.encode([" " + p for p in pieces])))
    head = len(pieces).to_bytes(4, "little")
    return zlib.compress(head + lengths + " ".join(pieces).encode()) if pieces else b""


def unpack(table: bytes) -> dict[str, int]:
    """The table as a dictionary; 33 characters are at most 132 bytes, so a byte holds each length."""
    if not table:
        return {}
    raw = zlib.decompress(table)
    n = int.from_bytes(raw[:4], "little")
    return dict(zip(raw[4 + n :].decode().split(" "), raw[4 : 4 + n], strict=True))


def count_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    limit: int = 1024,
    sample_rows: int = SAMPLE_ROWS,
    entries: int = TABLE_ENTRIES,
) -> DataFrame:
    """id, n_bytes, n_tokens and over_limit (more than `limit` tokens) of every row."""
    path = tokenizer or bpe.default_tokenizer()
    table = frequent_lengths(docs, text_col, path, sample_rows, entries)
    shared = docs.sparkSession.sparkContext.broadcast(table)
    key = zlib.crc32(table)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = bpe.worker_cache(path, False, key, lambda: unpack(shared.value))
        for batch in batches:
            ids, texts = batch.columns
            n = np.fromiter(cache.values(bpe.texts_of(texts)), np.int64, len(texts))
            size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids, size, pa.array(n), pa.array(n > limit)], names=[id_col, "n_bytes", "n_tokens", "over_limit"]
            )

    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )
    return docs.select(id_col, text_col).mapInArrow(count, schema)
