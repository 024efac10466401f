"""Facts from landed detail pages (page_id, url, html), by built-in regular expressions."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotebook.functions.text import RUPEE, WS, absolutize_url, path_slug, remove, strip

# References that are decoded other than HTML's table says, or that pages use most.
ENTITIES = (
    ("&nbsp;", " "), ("&copy;", "©"), ("&reg;", "®"), ("&middot;", "·"), ("&ndash;", "–"),
    ("&mdash;", "—"), ("&lsquo;", "‘"), ("&rsquo;", "’"), ("&ldquo;", "“"), ("&rdquo;", "”"),
    ("&hellip;", "…"), ("&euro;", "€"), ("&pound;", "£"), ("&deg;", "°"), ("&lt;", "<"),
    ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"),
)
_HIDDEN = r"(?s)<!--.*?-->|<!doctype[^>]*>|(?i:<(script|style|template)\b[^>]*>.*?</\1\s*>)"
_TAG = r"<[/a-zA-Z!][^>]*>"
_KEY_CHARS = rf"[A-Za-z0-9{WS}/()\-]"
# A key run is tried once, from its first character or where the last pair ended, and is never
# split again: the matches are those of the plain pattern, without its quadratic restarts.
_PAIR = rf"(?:\G|(?<!{_KEY_CHARS}))({_KEY_CHARS}++):[{WS}]*([^:\n]+)"
_ANCHOR = r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']*)[\"'][^>]*>(.*?)</a\s*>"
# How a price and an ISIN are written.
_PRICE = rf"{RUPEE}[{WS}]*([0-9,]+(?:\.[0-9]+)?)"
_ISIN = "IN[A-Z0-9]{10}"


_REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
# References to the ampersand come last: what they leave is text, not a reference.
_AMPERSANDS = ("&amp;", "&AMP;", "&#38;", "&#x26;", "&#X26;")


def _named() -> Column:
    """The named character references of HTML as one constant map; a no-break space counts as a space."""
    names = {f"&{name}": char for name, char in html5.items() if name.endswith(";")} | dict(ENTITIES)
    return F.from_json(F.lit(json.dumps(names)), "map<string,string>")


def _decode_entities(c: Column) -> Column:
    """Decimal, hexadecimal and named references to their characters; unknown ones stay as they are."""

    def character(reference: Column) -> Column:
        code = F.substring_index(F.substring(reference, 3, 9), ";", 1)
        hexadecimal = F.lower(F.substring(code, 1, 1)) == "x"
        number = F.when(hexadecimal, F.conv(F.substring(code, 2, 8), 16, 10)).otherwise(code).try_cast("bigint")
        known = (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        utf32 = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        return F.when(reference.startswith("&#"), F.when(known, utf32)).otherwise(F.element_at(_named(), reference))

    found = F.array_distinct(F.regexp_extract_all(c, F.lit(_REFERENCE), F.lit(0)))
    found = F.filter(found, lambda r: ~r.isin(*_AMPERSANDS))
    decoded = F.aggregate(found, c, lambda acc, r: F.replace(acc, r, F.coalesce(character(r), r)))
    for reference in _AMPERSANDS:
        decoded = F.replace(decoded, F.lit(reference), F.lit("&"))
    return F.when(c.contains("&"), decoded).otherwise(c)


def _text_nodes(html: Column) -> Column:
    """Stripped non-empty text pieces between tags; tags within a piece of prose split it too."""
    pieces = F.split(F.regexp_replace(html, _HIDDEN, "<p>"), _TAG, -1)
    return F.filter(F.transform(pieces, lambda p: strip(_decode_entities(p))), lambda p: p != "")


def visible_text(html: Column) -> Column:
    return F.array_join(_text_nodes(html), " ")


def _heading(html: Column) -> Column:
    """Joined text of the first h1, null without one."""
    inner = F.regexp_extract(html, r"(?is)<h1\b[^>]*>(.*?)</h1\s*>", 1)
    return F.when(html.rlike(r"(?i)<h1\b"), F.array_join(_text_nodes(inner), ""))


def extract_page_facts(
    pages: DataFrame, marker: str = "/in/listing/", source: str = "detail", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Company, price, ISIN and slug of each page that has a heading; with the columns of ``keep``."""
    text = pages.withColumn("text", visible_text(F.col("html"))).withColumn("company", _heading(F.col("html")))
    price = remove(F.regexp_extract("text", _PRICE, 1), ",")
    return text.filter(F.col("company").isNotNull()).select(
        "page_id",
        "url",
        F.lit(source).alias("source"),
        path_slug(F.col("url"), marker).alias("slug"),
        "company",
        F.when(F.col("text").rlike(_PRICE), price).alias("price"),
        F.when(F.col("text").rlike(_ISIN), F.regexp_extract("text", _ISIN, 0)).alias("isin"),
        *keep,
    )


def _pairs(text: Column) -> Column:
    """(key, value) pairs of a text in order, of a repeated key only the last."""
    # Neither a key nor a value contains a colon, so one search gives both.
    found = F.transform(
        F.regexp_extract_all(text, F.lit(_PAIR), F.lit(0)),
        lambda p: F.struct(
            strip(F.substring_index(p, ":", 1)).alias("key"), strip(F.substring_index(p, ":", -1)).alias("value")
        ),
    )
    return F.filter(found, lambda p: F.length(p["key"]).between(2, 35) & F.length(p["value"]).between(1, 100))


def _one_of_each(items: Column, name: str, last: bool) -> Column:
    """Of the items with equal ``name`` the last or first one, by that name: sorted once, neighbours compared."""
    placed = F.transform(
        items, lambda x, i: F.struct(x[name].alias("k"), (i if last else -i).alias("i"), x.alias("x"))
    )
    ordered = F.sort_array(placed)
    after = F.concat(F.slice(ordered, F.lit(2), F.size(ordered)), F.array(F.lit(None)))
    kept = F.filter(F.arrays_zip(ordered.alias("a"), after.alias("b")), lambda z: ~z["a"]["k"].eqNullSafe(z["b"]["k"]))
    return F.transform(F.filter(kept, lambda z: z["a"].isNotNull()), lambda z: z["a"]["x"])


def extract_kv_pairs(pages: DataFrame) -> DataFrame:
    """``key: value`` pairs of the page text, the last value of a repeated key winning."""
    found = pages.select("page_id", _pairs(visible_text(F.col("html"))).alias("pairs"))
    return found.select("page_id", F.explode(_one_of_each(F.col("pairs"), "key", True)).alias("p")).select("page_id", "p.key", "p.value")


def _links(pages: DataFrame) -> DataFrame:
    """Every link of a page in order: (page_id, pos, href, title)."""
    markup = F.regexp_replace("html", r"(?s)<!--.*?-->", "")
    found = F.arrays_zip(
        F.regexp_extract_all(markup, F.lit(_ANCHOR), F.lit(1)).alias("href"),
        F.regexp_extract_all(markup, F.lit(_ANCHOR), F.lit(2)).alias("body"),
    )
    return pages.select("page_id", F.posexplode(found).alias("pos", "link")).select(
        "page_id",
        "pos",
        _decode_entities(F.col("link.href")).alias("href"),
        visible_text(F.col("link.body")).alias("title"),
    )


def _documents(html: Column, base_url: str) -> Column:
    """(pos, url, title) of the report links of a page in order."""
    markup = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    found = F.arrays_zip(
        F.regexp_extract_all(markup, F.lit(_ANCHOR), F.lit(1)).alias("href"),
        F.regexp_extract_all(markup, F.lit(_ANCHOR), F.lit(2)).alias("body"),
    )
    read = F.transform(
        found,
        lambda x, i: F.struct(
            i.alias("pos"), _decode_entities(x["href"]).alias("href"), visible_text(x["body"]).alias("title")
        ),
    )

    def wanted(x: Column) -> Column:
        title = F.lower(x["title"])
        named = F.lower(x["href"]).contains("pdf") | title.contains("report") | title.contains("financial")
        return named & F.length(x["title"]).between(1, 99)

    return F.transform(
        F.filter(read, wanted),
        lambda x: F.struct(x["pos"].alias("pos"), absolutize_url(x["href"], base_url).alias("url"), x["title"].alias("title")),
    )


def extract_document_links(pages: DataFrame, base_url: str) -> DataFrame:
    """Report links of each page, the first title of a URL winning."""
    found = pages.select("page_id", _documents(F.col("html"), base_url).alias("found"))
    return found.select("page_id", F.explode(_one_of_each(F.col("found"), "url", False)).alias("d")).select(
        "page_id", "d.url", "d.title", "d.pos"
    )


def harvest_listing_links(pages: DataFrame, base_url: str, prefix: str = "/in/listing/") -> DataFrame:
    """Distinct listing URLs with the first place they occur at."""
    href = F.col("href")
    return (
        _links(pages)
        .filter(href.contains(prefix) & (href != prefix.rstrip("/")))
        .select(
            F.when(href.startswith("/"), F.concat(F.lit(base_url), href)).otherwise(href).alias("url"),
            F.struct("page_id", "pos").alias("at"),
        )
        .groupBy("url")
        .agg(F.min("at").alias("at"))
        .select("url", F.col("at.page_id").alias("page_id"), F.col("at.pos").alias("pos"))
    )


def detail_listings(
    pages: DataFrame, base_url: str, marker: str = "/in/listing/", full: bool = True
) -> DataFrame:
    """Raw listings from detail pages; without ``full`` only company, price and ISIN are read."""
    facts = extract_page_facts(pages, marker, keep=("html", "text") if full else ())
    if not full:
        return facts
    # Everything comes from the page's own row: no join, no shuffle.
    read = facts.withColumns({"pairs": _pairs(F.col("text")), "found": _documents(F.col("html"), base_url)})
    document = lambda d: F.struct(d["title"].alias("title"), d["url"].alias("url"))
    pairs = _one_of_each(F.col("pairs"), "key", True)
    # Documents stand in the order of the page: the position is their first field.
    found = F.transform(F.sort_array(_one_of_each(F.col("found"), "url", False)), document)
    return read.withColumns(
        {
            "extra_data": F.when(F.size(pairs) > 0, F.map_from_entries(pairs)),
            "documents": F.when(F.size(found) > 0, found),
        }
    ).drop("html", "text", "pairs", "found")
