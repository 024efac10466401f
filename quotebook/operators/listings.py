"""Cleaning and combining raw listings before matching."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quotebook.functions.text import is_positive_price, nonempty, number, path_slug, slugify_ascii
from quotebook.schemas import DOCUMENTS, EXTRA_DATA, LISTING_FIELDS, NUMERIC_FIELDS, field_type

# ``ord`` holds (batch, source rank, order within the source) in one number.
SOURCE_STRIDE = 1 << 36
BATCH_STRIDE = 1 << 39


def normalize_listings(raw: DataFrame, keep_short_name: bool = False) -> DataFrame:
    """Project raw rows to the 22 listing columns (and ``ord``); rows without a company go."""

    def column(name: str):
        if name not in raw.columns:
            return F.expr(f"cast(null AS {field_type(name).simpleString()})")
        c = F.col(name)
        return number(raw.schema[name].dataType, c) if name in NUMERIC_FIELDS else c

    values = {name: column(name) for name in LISTING_FIELDS}
    values["slug"] = F.coalesce(nonempty(values["slug"]), slugify_ascii(F.col("company")))
    values["documents"] = F.coalesce(values["documents"], F.array().cast(DOCUMENTS))
    values["extra_data"] = F.coalesce(values["extra_data"], F.create_map().cast(EXTRA_DATA))
    if keep_short_name:
        values["short_name"] = column("short_name")
    kept = raw.filter(F.col("company") != "")
    return kept.select(*[c.alias(n) for n, c in values.items()], F.col("ord").cast("bigint"))


def filter_valid_price(listings: DataFrame, price: str = "price") -> DataFrame:
    if isinstance(listings.schema[price].dataType, T.NumericType):
        return listings.filter(F.col(price) > 0)
    return listings.filter(is_positive_price(F.col(price)))


def filter_slug_present(listings: DataFrame) -> DataFrame:
    return listings.filter(F.col("slug") != "")


def filter_source(listings: DataFrame, choice: str = "all", primary: str = "primary", secondary: str = "secondary") -> DataFrame:
    """Rows of the chosen source, "primary" or "secondary"; "all" takes every row, whatever its source."""
    if choice == "all":
        return listings
    return listings.filter(F.col("source") == {"primary": primary, "secondary": secondary}[choice])


def union_sources(*sources: DataFrame) -> DataFrame:
    """Concatenate sources in the given order; ``ord`` becomes (source rank, source order).

    Numeric fields are parsed source by source, so that one may hold text and another numbers. An order
    that does not fit its share of ``ord`` is an error: it would pass for one of the next source.
    """
    if len(sources) > BATCH_STRIDE // SOURCE_STRIDE:
        raise ValueError("too many sources for one batch")

    def ranked_source(rank: int, s: DataFrame) -> DataFrame:
        numbers = {n: number(s.schema[n].dataType, F.col(n)) for n in NUMERIC_FIELDS if n in s.columns}
        own = F.col("ord").cast("bigint")
        fits = F.when(own < SOURCE_STRIDE, own).when(own.isNotNull(), F.raise_error(F.lit("ord out of range")).cast("bigint"))
        return s.withColumns({**numbers, "ord": F.lit(rank * SOURCE_STRIDE) + fits})

    ranked = [ranked_source(rank, s) for rank, s in enumerate(sources)]
    out = ranked[0]
    for other in ranked[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def dedup_first(listings: DataFrame, *order: str, within: tuple[str, ...] = ()) -> DataFrame:
    """The first row of each slug (or company, where there is no slug), within each value of ``within``.

    The rank filter is applied on the map side as well, so the copies of a key are dropped
    before the shuffle.
    """
    keyed = listings.withColumn("_key", F.coalesce(nonempty(F.col("slug")), nonempty(F.col("company"))))
    first = Window.partitionBy(*within, "_key").orderBy(*(order or ("ord",)))
    return (
        keyed.filter(F.col("_key").isNotNull())
        .withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") == 1)
        .drop("_key", "_rank")
    )


def priority_slugs(entries: DataFrame, marker: str = "/shares/") -> DataFrame:
    """URLs of the priority list to slugs; other entries are slugs already."""
    entry = F.col("entry")
    return entries.select(
        F.when(entry.contains(marker), path_slug(entry, marker)).otherwise(entry).alias("slug")
    )


def priority_semi_join(listings: DataFrame, entries: DataFrame, marker: str = "/shares/") -> DataFrame:
    """Listings on the priority list. The planner broadcasts the list if it measures small."""
    return listings.join(priority_slugs(entries, marker), "slug", "left_semi")
