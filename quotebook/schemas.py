"""Schemas of raw listings, normalized listings and the book."""

from __future__ import annotations

from pyspark.sql import types as T

DOCUMENTS = T.ArrayType(
    T.StructType([T.StructField("title", T.StringType()), T.StructField("url", T.StringType())])
)
EXTRA_DATA = T.MapType(T.StringType(), T.StringType())

# Fixed values, here and below: names, order and types of the columns of listings, book and published rows.
NUMERIC_FIELDS = (
    "price", "market_cap", "face_value", "pe", "eps", "book_value", "roe", "roce", "revenue",
    "profit", "enterprise_value",
)

# The 22 normalized columns, in order.
LISTING_FIELDS = (
    "company", "slug", "price", "market_cap", "sector", "industry", "face_value", "isin", "pe",
    "eps", "book_value", "roe", "roce", "revenue", "profit", "enterprise_value", "logo",
    "description", "documents", "extra_data", "source", "url",
)

BOOK_ONLY = (
    ("updated_at", T.TimestampType()),
    ("backup_price", T.DoubleType()),
    ("aliases", T.ArrayType(T.StringType())),
    ("short_name", T.StringType()),
    ("change_abs", T.StringType()),
    ("change_pct", T.StringType()),
    ("error", T.StringType()),
    ("ord", T.LongType()),
)


def field_type(name: str) -> T.DataType:
    if name in NUMERIC_FIELDS:
        return T.DoubleType()
    return {"documents": DOCUMENTS, "extra_data": EXTRA_DATA, **dict(BOOK_ONLY)}.get(name, T.StringType())


LISTING_SCHEMA = T.StructType([T.StructField(f, field_type(f)) for f in LISTING_FIELDS])
BOOK_SCHEMA = T.StructType(
    [T.StructField(f, field_type(f)) for f in LISTING_FIELDS] + [T.StructField(f, t) for f, t in BOOK_ONLY]
)
BOOK_FIELDS = tuple(BOOK_SCHEMA.names)

# A matched secondary listing never fills these columns of the primary record.
KEPT_ON_MERGE = (
    "company", "slug", "source", "url", "updated_at", "price", "backup_price", "aliases", "short_name",
)

#: Place of a published row by insertion; written with the rows, read on demand.
POSITION = "Position"

PUBLISHED_SCHEMA = T.StructType(
    [
        T.StructField("URL", T.StringType()),
        T.StructField("Name", T.StringType()),
        T.StructField("Short Name", T.StringType()),
        T.StructField("Aliases", T.ArrayType(T.StringType())),
        T.StructField("ISIN", T.StringType()),
        T.StructField("Latest Price", T.DoubleType()),
        T.StructField("Backup Price", T.DoubleType()),
        T.StructField("Change Abs", T.StringType()),
        T.StructField("Change Pct", T.StringType()),
        T.StructField("Last Updated", T.StringType()),
        T.StructField("Error", T.StringType()),
    ]
)
