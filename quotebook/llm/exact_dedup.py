"""Exact deduplication by Grace hashing with complete comparison of contents.

1. Each task reads its rows in chunks of bounded size and enters the normalized texts into an open-addressing
   table; a chunk passes on one content per distinct text, with its count and first row. However many copies a
   text has, a chunk forwards one of them. This is the first generation of spill files (a shared table).
2. Contents go to buckets by hash. A bucket whose distinct contents exceed the bound is split by further hash
   bits, again and again, until each fits the table.
3. One task at a time fills an open-addressing table per bucket, comparing complete contents, and gives the
   count and the first row of every text that occurs more than once.
4. The (small) rows of the documents meet these groups by digest; adaptive execution splits a hot group.

Texts are equal when they are identical after every run of blanks (space, tab to carriage return) has become
one space. Nulls: a null text is an empty text; a null id orders after all others. Of repeated rows (same id,
same text) one stays, any of them since they are alike. Empty tables give an empty result. Other columns of
the input, whatever their names, are not read; `drop_copies` returns them untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotebook.llm.staging import keep, planned

CHUNK_BYTES = 16 << 20
#: A bucket aims at TARGET_BYTES of distinct contents and is split beyond BUCKET_BYTES.
TARGET_BYTES = 16 << 20
BUCKET_BYTES = 64 << 20


def normalized(text: str | Column) -> Column:
    """Fixed rule: runs of space and \\t..\\r become one space; null is empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(column, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


class ContentTable:
    """Open addressing with linear probing: a slot holds the number of an entry, an entry its content."""

    def __init__(self) -> None:
        self.contents: list[str] = []
        self._hashes: list[int] = []
        self._mask = 1023
        self._slots = [-1] * 1024

    def _grow(self) -> None:
        self._mask = self._mask * 2 + 1
        self._slots = [-1] * (self._mask + 1)
        for entry, h in enumerate(self._hashes):
            at = h & self._mask
            while self._slots[at] >= 0:
                at = (at + 1) & self._mask
            self._slots[at] = entry

    def entry(self, h: int, content: str) -> tuple[int, bool]:
        """The entry of this content, and whether it is new."""
        at = h & self._mask
        while (found := self._slots[at]) >= 0:
            if self._hashes[found] == h and self.contents[found] == content:
                return found, False
            at = (at + 1) & self._mask
        self._slots[at] = new = len(self.contents)
        self.contents.append(content)
        self._hashes.append(h)
        if 2 * new > self._mask:
            self._grow()
        return new, True


def _first(a: tuple, b: tuple) -> tuple:
    """The smaller (id, row); a null id comes last."""
    return min(a, b, key=lambda x: (x[0] is None, x[0] if x[0] is not None else 0, x[1]))


def _fold(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A chunk (id, row, sha, h, content): contents, counts and first rows only at the first copy of a text."""
    ids, rows, _, hashes, contents = batch.columns
    table, count, first, at = ContentTable(), [], [], []
    keys = zip(ids.to_pylist(), rows.to_pylist(), hashes.to_pylist(), strict=True)
    for i, (key, row, h) in enumerate(keys):
        entry, new = table.entry(h, contents[i].as_py())
        if new:
            count.append(1)
            first.append((key, row))
            at.append(i)
        else:
            count[entry] += 1
            first[entry] = _first(first[entry], (key, row))
    n, first_id, first_row, content = ([None] * len(ids) for _ in range(4))
    for entry, i in enumerate(at):
        n[i], (first_id[i], first_row[i]), content[i] = count[entry], first[entry], table.contents[entry]
    return pa.RecordBatch.from_arrays(
        [*batch.columns[:4], pa.array(content, pa.string()), pa.array(n, pa.int64()),
         pa.array(first_id, ids.type), pa.array(first_row, pa.int64())],
        names=["id", "row", "sha", "h", "content", "n", "first_id", "first_row"],
    )


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, at, held, size = TaskContext.get().partitionId(), 0, [], 0
    for batch in batches:
        for start in range(0, len(batch), 512):
            piece = batch.slice(start, 512)
            rows = pa.array(range((part << 33) + at, (part << 33) + at + len(piece)), pa.int64())
            at += len(piece)
            held.append(pa.RecordBatch.from_arrays(
                [piece.column(0), rows, *piece.columns[1:]], names=["id", "row", "sha", "h", "content"]))
            size += piece.nbytes
            if size >= CHUNK_BYTES:
                yield _fold(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                held, size = [], 0
    if held:
        yield from map(_fold, pa.Table.from_batches(held).combine_chunks().to_batches())


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, h, sha, content, n, first_id, first_row) in order of their bucket: texts with copies."""
    bucket, table, held = None, ContentTable(), []
    schema: pa.Schema | None = None

    def out() -> Iterator[pa.RecordBatch]:
        found = [x for x in held if x[1] > 1]
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.int64()),
                 pa.array([x[2][0] for x in found], schema.field("first_id").type),
                 pa.array([x[2][1] for x in found], pa.int64())],
                names=["sha", "group_size", "keep_id", "keep_row"],
            )

    for batch in batches:
        schema = batch.schema
        contents = batch.column(3)
        small = [c.to_pylist() for i, c in enumerate(batch.columns) if i != 3]
        for i, (b, h, sha, n, first_id, first_row) in enumerate(zip(*small, strict=True)):
            if b != bucket:
                yield from out()
                bucket, table, held = b, ContentTable(), []
            entry, new = table.entry(h, contents[i].as_py())
            if new:
                held.append((sha, n, (first_id, first_row)))
            else:
                old = held[entry]
                held[entry] = (sha, old[1] + n, _first(old[2], (first_id, first_row)))
    yield from out()


def bucketed(contents: DataFrame, target: int = TARGET_BYTES, bound: int = BUCKET_BYTES) -> tuple[DataFrame, int]:
    """`contents` (h, content, ...) with a column `bucket`, each of at most `bound` bytes of distinct contents
    (or a single content), and about how many buckets there are."""
    sizes = keep(contents.groupBy("h").agg(F.max(F.octet_length("content")).alias("size")), "dedup-sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    fan_out = max(1, -(-total // target))
    bucket = F.pmod(F.col("h"), F.lit(fan_out))
    sizes, contents, buckets = sizes.withColumn("bucket", bucket), contents.withColumn("bucket", bucket), fan_out
    for level in range(1, 9):
        heavy = sizes.groupBy("bucket").agg(F.sum("size").alias("size"), F.count("*").alias("texts"))
        heavy = heavy.where((F.col("size") > bound) & (F.col("texts") > 1))
        heavy = keep(heavy.select("bucket", F.ceil(F.col("size") / target).alias("parts")), "dedup-heavy")
        more = heavy.agg(F.sum("parts")).first()[0]
        if not more:
            break
        digit = F.pmod(F.xxhash64("h", F.lit(level)), F.col("parts"))
        split = F.when(F.col("parts").isNull(), F.col("bucket")).otherwise(F.xxhash64("bucket", digit, F.lit(level)))
        sizes, contents = (
            df.join(heavy, "bucket", "left").withColumn("bucket", split).drop("parts") for df in (sizes, contents)
        )
        buckets += more
    return contents, buckets


def find_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, keep_id, group_size, kept and text_sha256 of every row."""
    kind = docs.schema[id_col].dataType
    read = docs.select(F.col(id_col).alias("id"), normalized(text_col).alias("content"))
    read = read.select("id", F.sha2("content", 256).alias("sha"), F.xxhash64("content").alias("h"), "content")
    schema = T.StructType(
        [T.StructField("id", kind), T.StructField("row", T.LongType()), T.StructField("sha", T.StringType()),
         T.StructField("h", T.LongType()), T.StructField("content", T.StringType()), T.StructField("n", T.LongType()),
         T.StructField("first_id", kind), T.StructField("first_row", T.LongType())]
    )
    folded = keep(read.mapInArrow(_chunks, schema), "dedup-spill")
    contents = folded.where("n is not null").select("h", "sha", "content", "n", "first_id", "first_row")
    contents, buckets = bucketed(contents)
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(buckets, 20_000))
    groups = (
        contents.select("bucket", "h", "sha", "content", "n", "first_id", "first_row")
        .repartition(tasks, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(
            _groups,
            T.StructType([T.StructField("sha", T.StringType()), T.StructField("group_size", T.LongType()),
                          T.StructField("keep_id", kind), T.StructField("keep_row", T.LongType())]),
        )
    )
    alone = F.col("group_size").isNull()
    return folded.select("id", "row", "sha").join(groups, "sha", "left").select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns, of which one stays for each text."""
    kept = find_copies(docs, id_col, text_col).where("kept").select(F.col(id_col).alias("_id"), F.col("text_sha256").alias("_sha"))
    kept = keep(kept, "dedup-kept")
    n = kept.count()
    # Repeated rows have the same id and text; where there are any, one of them is taken.
    numbered = docs.withColumn("_key", F.sha2(normalized(text_col), 256))
    rows = numbered.join(planned(kept, n), F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_sha")), "left_semi")
    if rows.count() > n:
        rows = rows.dropDuplicates([id_col, "_key"])
    return rows.drop("_key")
