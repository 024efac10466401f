"""Primary-source listing pages: JSON payloads with an HTML-card fallback.

A landed page is one row (source_run, page_num, body). Item order is (page_num, pos).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotebook.functions.text import clean_price, nonempty
from quotebook.operators.listings import dedup_first
from quotebook.sources.cards import scan_html_cards

# Places that ``ord`` has for the rows of one page.
_ITEMS = 1 << 20

_ITEM = "name string, slug string, price string, lot_size string, as_of string, sector string, logo string"


def _elements(key: str) -> Column:
    """The raw elements of the body's array, null without one."""
    needle = f'"{key}":['
    at = F.instr(F.col("body"), needle)
    array_text = F.substring(F.col("body"), at + F.lit(len(needle) - 1), F.length("body"))
    return F.when(at > 0, F.from_json(array_text, "array<string>"))


def scan_json_payload(pages: DataFrame, key: str = "shares", item_schema: str = _ITEM) -> DataFrame:
    """One row per object of the ``"<key>":[...]`` array in a page body.

    The array is split into raw elements first and each object parsed on its own, so one
    element of another type does not void the rest.
    """
    return (
        pages.select("source_run", "page_num", F.posexplode(_elements(key)).alias("pos", "element"))
        .filter(F.col("element").startswith("{"))
        .select("source_run", "page_num", "pos", F.from_json("element", item_schema).alias("item"))
        .select("source_run", "page_num", "pos", "item.*")
    )


def _labelled(**values: Column) -> Column:
    """A string map of the given entries, without the null ones."""
    entries = []
    for label, value in values.items():
        entries += [F.lit(label.replace("_", " ")), value]
    return F.map_filter(F.create_map(*entries), lambda k, v: v.isNotNull())


def project_primary_items(items: DataFrame, base_url: str, source: str = "primary") -> DataFrame:
    """Payload items to raw listings; a name and a price are required."""
    return items.select(
        "source_run",
        "page_num",
        "pos",
        F.col("name").alias("company"),
        clean_price(F.col("price")).alias("price"),
        F.lit(source).alias("source"),
        F.when(nonempty(F.col("slug")).isNotNull(), F.concat(F.lit(f"{base_url}/shares/"), "slug")).alias("url"),
        "slug",
        "sector",
        "logo",
        _labelled(Lot_Size=F.col("lot_size"), As_Of=nonempty(F.col("as_of"))).alias("extra_data"),
    ).filter((F.col("company") != "") & F.col("price").isNotNull())


def page_fallback(pages: DataFrame, base_url: str, source: str = "primary") -> DataFrame:
    """Payload rows of a page if it has any, else its card rows.

    A landed page is one row, so the choice is a filter on that row: nothing is joined or shuffled, and
    only pages without a usable payload item reach the Python stage.
    """
    payload = project_primary_items(scan_json_payload(pages), base_url, source)

    def usable(element: Column) -> Column:
        item = F.from_json(element, "name string, price string")
        found = element.startswith("{") & (item["name"] != "") & clean_price(item["price"]).isNotNull()
        return F.coalesce(found, F.lit(False))

    bare = pages.filter(~F.coalesce(F.exists(_elements("shares"), usable), F.lit(False)))
    return payload.unionByName(scan_html_cards(bare, base_url, source), allowMissingColumns=True)


def page_cutoff(rows: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Rows of the pages read before the second of two consecutive empty pages of a run.

    A page without rows, landed or not, is empty. With ``max_pages`` later pages are left out as well. A run's
    distinct page numbers follow each other until one is missing twice; each page is kept if no such gap
    lies before it.
    """
    numbered = rows.filter(F.col("page_num") >= 1)
    if max_pages is not None:
        numbered = numbered.filter(F.col("page_num") <= max_pages)
    pages = numbered.select("source_run", "page_num").distinct()
    run = Window.partitionBy("source_run").orderBy("page_num")
    last = F.coalesce(F.lag("page_num").over(run), F.lit(0))
    gaps = F.sum(F.when(F.col("page_num") - last > 2, 1).otherwise(0)).over(run)
    read = pages.withColumn("gaps", gaps).filter("gaps = 0").drop("gaps")
    return numbered.join(read, ["source_run", "page_num"], "left_semi")


def read_listing_pages(pages: DataFrame, base_url: str, source: str = "primary") -> DataFrame:
    """All landed pages to raw listings in reading order (column ``ord``), the first row of each slug per run.

    Landed pages are read whole; ``page_cutoff`` is for callers that want a crawl's stop rule.
    """
    pos = F.when(F.col("pos") < _ITEMS, F.col("pos")).otherwise(F.raise_error(F.lit("too many items on a page")).cast("int"))
    rows = page_fallback(pages, base_url, source).withColumn("ord", F.col("page_num") * F.lit(_ITEMS) + pos)
    return dedup_first(rows, "ord", within=("source_run",))
