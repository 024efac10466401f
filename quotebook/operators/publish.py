"""Publishing and reporting on the book."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotebook.functions.text import display_price, display_timestamp, nonempty
from quotebook.operators.positions import numbered
from quotebook.schemas import POSITION
from quotebook.sources.versions import replace_folder


def _published_columns() -> list[Column]:
    aliases = F.coalesce(F.col("aliases"), F.array().cast("array<string>"))
    return [
        F.col("url").alias("URL"),
        F.col("company").alias("Name"),
        F.coalesce(nonempty(F.col("short_name")), F.get(aliases, 0), F.lit("")).alias("Short Name"),
        aliases.alias("Aliases"),
        F.col("isin").alias("ISIN"),
        display_price(F.col("price"), F.col("backup_price")).alias("Latest Price"),
        F.col("backup_price").alias("Backup Price"),
        F.coalesce("change_abs", F.lit("0.00")).alias("Change Abs"),
        F.coalesce("change_pct", F.lit("0.00")).alias("Change Pct"),
        F.coalesce(display_timestamp(F.col("updated_at")), F.lit("")).alias("Last Updated"),
        F.coalesce("error", F.lit("")).alias("Error"),
    ]


def publish_prices(book: DataFrame) -> DataFrame:
    """The flat price table: one row per record, defaults filled in, ``ord`` not included."""
    return book.select(*_published_columns())


def published_in_order(book: DataFrame) -> DataFrame:
    """The flat price table with ``Position``: the place of a record by insertion, from 0 and without gaps."""
    rows = book.select(*_published_columns(), F.col("ord").alias("_ord"), F.col("slug").alias("_slug"))
    return numbered(rows, "_ord", "_slug", into=POSITION).drop("_ord", "_slug")


def write_published(book: DataFrame, path: str) -> None:
    """Publish as JSON lines in order of insertion (of files, and of lines in them), absent values written out as null.

    Written aside and swapped in at the end: until then, and if the job fails, the former table stays as it is.
    """
    aside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    published_in_order(book).orderBy(POSITION).write.option("ignoreNullFields", False).json(aside)
    replace_folder(book.sparkSession, aside, path)


def flat_text(book: DataFrame) -> DataFrame:
    """Arrays and maps as JSON text, for flat file formats."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return book.select(
        *[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in book.schema]
    )


def export_csv(book: DataFrame, path: str) -> None:
    flat_text(book).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def book_metrics(book: DataFrame) -> DataFrame:
    """Number of records, then the number per source, most frequent first.

    The book is counted once per source, combined on the map side; the total adds up those rows.
    """
    per_source = book.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"))
    total = per_source.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows")).select(
        F.lit("total").alias("metric"), F.lit(None).cast("string").alias("source"), "n_rows"
    )
    known = per_source.filter(F.col("source").isNotNull()).select(F.lit("source").alias("metric"), "source", "n_rows")
    return total.unionByName(known).orderBy(F.desc("metric"), F.desc("n_rows"), "source")


def name_lookup(published: DataFrame, pattern: str, *order: str) -> DataFrame:
    """First row whose name matches the pattern, ignoring case; null names never match.

    Without ``order`` the first one inserted, where the table has positions, else the first by name.
    """
    hits = published.filter(F.coalesce(F.col("Name").rlike(f"(?i){pattern}"), F.lit(False)))
    return first_match(hits, *(order or default_order(published)))


def default_order(published: DataFrame) -> tuple[str, ...]:
    return (POSITION,) if POSITION in published.columns else ("Name",)


def first_match(rows: DataFrame, *order: str) -> DataFrame:
    return rows.orderBy(*order).limit(1)


def last_n_lines(lines: DataFrame, n: int = 15) -> DataFrame:
    """The latest lines of a log."""
    return lines.orderBy(F.desc("ord")).limit(n)


def live_columns(feed: DataFrame) -> DataFrame:
    return feed.select("company", "price", "source")
