"""The book: versions of hash buckets (see ``versions``), and readers of its JSON forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotebook.functions.names import name_tokens
from quotebook.functions.text import nonempty
from quotebook.schemas import BOOK_FIELDS, BOOK_SCHEMA, POSITION, PUBLISHED_SCHEMA
from quotebook.session import stage
from quotebook.sources.versions import (  # noqa: F401  (written_by and retire belong to the book's interface)
    PREFIX,
    Part,
    VersionTaken,
    commit,
    describe,
    fs_of,
    read_part,
    retire,
    versions,
    written_by,
)

#: Records per bucket aimed at when a whole book is written.
ROWS_PER_BUCKET = 500_000
MIN_BUCKETS = 16

#: What matching needs to know of every record; kept beside the records, so that these need not be read for it.
NAMES_SCHEMA = T.StructType([BOOK_SCHEMA[c] for c in ("slug", "source", "company", "short_name", "ord")])
#: One row per token of a primary record's name.
POSTINGS_SCHEMA = T.StructType(
    [T.StructField("token", T.StringType()), T.StructField("canon", T.StringType()), BOOK_SCHEMA["slug"], BOOK_SCHEMA["ord"]]
)


def parts_for(n_buckets: int) -> dict[str, Part]:
    return {
        "records": Part(BOOK_SCHEMA, "slug", n_buckets),
        "names": Part(NAMES_SCHEMA, "slug", n_buckets),
        "postings": Part(POSTINGS_SCHEMA, "token", n_buckets),
    }


def empty_book(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], BOOK_SCHEMA)


def newest(spark: SparkSession, root: str, before: int | None = None) -> int | None:
    """Number of the newest committed version (older than ``before``)."""
    usable = [v for v in versions(spark, root) if before is None or v < before]
    return usable[-1] if usable else None


def read_version(spark: SparkSession, root: str, number: int) -> DataFrame:
    version = describe(spark, root, number)
    if version is None:
        # Written as one folder of files, without buckets.
        return spark.read.schema(BOOK_SCHEMA).parquet(f"{root}/{PREFIX}{number}")
    return read_part(spark, root, version, "records", BOOK_SCHEMA)


def read_book(spark: SparkSession, root: str, before: int | None = None) -> DataFrame:
    """The newest committed snapshot (older than ``before``); empty if there is none."""
    number = newest(spark, root, before)
    return empty_book(spark) if number is None else read_version(spark, root, number)


def names_of(records: DataFrame) -> DataFrame:
    return records.select(*NAMES_SCHEMA.names)


def postings_of(names: DataFrame, primary: str = "primary") -> DataFrame:
    """(token, canon, slug, ord) of primary records."""
    known = names.filter((F.col("source") == primary) & (F.col("company") != ""))
    return known.select(
        F.explode(F.expr(name_tokens("company"))).alias("token"), F.col("company").alias("canon"), "slug", "ord"
    )


def write_book(
    book: DataFrame,
    root: str,
    version: int | None = None,
    writer: str | None = None,
    n_buckets: int | None = None,
    primary: str = "primary",
) -> int:
    """Write a whole snapshot as a new version. An already committed ``version`` is left alone, so repeating a batch
    changes nothing. Without ``version`` the next free number is taken, also if others write at the same time.

    With ``writer`` the version is marked with that name. ``n_buckets`` follows from the number of records unless given.
    """
    spark = book.sparkSession
    if version is not None and version in versions(spark, root):
        return version
    book = stage(book.select(*BOOK_FIELDS), "book")
    if n_buckets is None:
        n_buckets = MIN_BUCKETS
        while n_buckets * ROWS_PER_BUCKET < book.count():
            n_buckets *= 2
    names = names_of(book)
    parts = {
        name: (part, rows, None)
        for (name, part), rows in zip(parts_for(n_buckets).items(), (book, names, postings_of(names, primary)))
    }
    number = version
    while True:
        done = versions(spark, root)
        if version is None:
            number = done[-1] + 1 if done else 0
        try:
            return commit(spark, root, None, parts, writer=writer, number=number)
        except VersionTaken:
            if version is not None and version in versions(spark, root):
                return version


def book_from_json(texts: DataFrame) -> DataFrame:
    """JSON snapshots (column ``value``: slug -> record) as a book; broken text gives no rows.

    Record order within a document becomes ``ord``.
    """
    record = ", ".join(
        f"{f.name}: {'string' if f.name == 'updated_at' else f.dataType.simpleString()}"
        for f in BOOK_SCHEMA
        if f.name != "ord"
    )
    entries = F.map_entries(F.from_json("value", f"map<string,struct<{record}>>"))
    rows = texts.select(F.posexplode(entries).alias("ord", "entry"))
    flat = rows.select(F.col("ord").cast("bigint"), F.col("entry.key").alias("key"), "entry.value.*")
    return flat.withColumns(
        {
            "slug": F.coalesce(nonempty(F.col("slug")), F.col("key")),
            "updated_at": F.col("updated_at").try_cast("timestamp"),
        }
    ).select(*BOOK_FIELDS)


def import_book_json(spark: SparkSession, path: str) -> DataFrame:
    """A snapshot kept as one JSON file. Only for moving it over once: a single document is
    parsed in one task."""
    return book_from_json(spark.read.text(path, wholetext=True))


def read_published(spark: SparkSession, path: str, positions: bool = False) -> DataFrame:
    """Published price rows: a JSON array file or a folder of JSON lines.

    With ``positions`` also their place by insertion: as written, and in an array file that of the element. Lines without
    one have null.
    """
    fs, hpath = fs_of(spark, path)
    if fs.exists(hpath) and fs.getFileStatus(hpath).isFile():
        # One document is parsed in one task, in its order.
        rows = spark.read.schema(PUBLISHED_SCHEMA).option("multiLine", True).json(path)
        return rows.withColumn(POSITION, F.monotonically_increasing_id()) if positions else rows
    schema = T.StructType(list(PUBLISHED_SCHEMA))
    return spark.read.schema(schema.add(POSITION, T.LongType()) if positions else schema).json(path)
