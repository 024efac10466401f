"""Secondary-source API responses: an object with a ``data`` array of items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotebook.functions.text import is_positive_price, nonempty, slugify_unicode, strip
from quotebook.schemas import DOCUMENTS

# The fields of an API item that are read.
_ISIN_FIELDS = ("ISIN", "UL_STOCKS_ISIN", "STOCK_ISIN", "isin")
_EXTRAS = (
    ("Market Cap", "MCAP"),
    ("P/E", "STOCK_PE"),
    ("P/B", "STOCK_PB"),
    ("Lot Size", "UL_STOCKS_LOT_SIZE"),
    ("Short Name", "UL_STOCKS_S_NAME"),
)


# Places that ``ord`` has for the items of one response.
_ITEMS = 1 << 20


def _fitting(pos: Column) -> Column:
    return F.when(pos < _ITEMS, pos).otherwise(F.raise_error(F.lit("too many items in a response")).cast("int"))


def _zero(name: str) -> Column:
    """Whether the raw item holds the number zero there (the text "0" is something else)."""
    return F.col("item").rlike(rf'"{name}"\s*:\s*-?0(?:\.0*)?\s*[,}}]')


def explode_responses(responses: DataFrame, body: str = "body") -> DataFrame:
    """Response bodies to one row (ord, item) per element of ``data``.

    ``responses`` has ``ord`` and a body column; item order within a response is kept. A response with
    more items than ``ord`` has room for is an error.
    """
    return responses.select(
        F.col("ord").alias("response"),
        F.posexplode(F.from_json(F.get_json_object(body, "$.data"), "array<string>")).alias("pos", "item"),
    ).select(
        (F.col("response") * F.lit(_ITEMS) + _fitting(F.col("pos"))).alias("ord"), "item"
    )


def scan_api_items(items: DataFrame, source: str = "secondary") -> DataFrame:
    """API items (ord, item JSON) to raw listings with a company and a positive price.

    The calculated price stands in where the bid price is absent, empty or zero.
    """
    # A string map keeps keys case-sensitive (ISIN and isin are two fields) and is parsed once.
    parsed = items.withColumn("f", F.from_json("item", "map<string,string>"))

    def field(name: str) -> Column:
        return F.col("f")[name]

    bid = F.when(~field("UL_PD_BID_PRICE").isin("", "0") & ~_zero("UL_PD_BID_PRICE"), field("UL_PD_BID_PRICE"))
    extras = []
    for label, name in _EXTRAS:
        extras += [F.lit(label), F.when((field(name) != "") & ~_zero(name), field(name))]
    return (
        parsed.select(
            "ord",
            F.lit(source).alias("source"),
            field("UL_STOCKS_COMPNAME").alias("company"),
            F.coalesce(field("UL_STOCKS_S_NAME"), F.lit("")).alias("short_name"),
            strip(F.coalesce(bid, field("current_price_calculated"))).alias("price"),
            F.map_filter(F.create_map(*extras), lambda k, v: v.isNotNull()).alias("extra_data"),
            F.coalesce(*[nonempty(field(n)) for n in _ISIN_FIELDS]).alias("isin"),
        )
        .filter((F.col("company") != "") & is_positive_price(F.col("price")))
        .withColumn("slug", slugify_unicode(F.col("company")))
        .withColumn("documents", F.array().cast(DOCUMENTS))
    )
