"""Reading landed payloads, and cleaning the listings read."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import duck
from checks.catalog import query
from quotebook.fixtures import duckdb_views, load, view
from quotebook.operators import listings as ops
from quotebook.session import scratch_path
from quotebook.sources import api, book, cards, detail, listings, priority

BASE = "https://primary.example"
DETAIL = "https://detail.example"
_LOT = "extra_data['Lot Size']"

# --- listing pages -----------------------------------------------------------------------------

_ITEMS = f"""{duckdb_views('fx_payload_pages')},
payload AS (
  SELECT source_run, page_num, CAST(i - 1 AS INTEGER) AS pos, item FROM (
    SELECT source_run, page_num, unnest(elements) AS item, generate_subscripts(elements, 1) AS i FROM (
      SELECT source_run, page_num,
             CAST(json_extract(regexp_extract(body, '"shares":(\\[.*\\]),"more"', 1), '$[*]') AS JSON[]) AS elements
      FROM fx_payload_pages WHERE contains(body, '"shares":[')))),
items AS (
  SELECT source_run, page_num, pos, json_extract_string(item, '$.name') AS name, json_extract_string(item, '$.slug') AS slug,
         json_extract_string(item, '$.price') AS price, json_extract_string(item, '$.sector') AS sector,
         json_extract_string(item, '$.lot_size') AS lot_size FROM payload),
primary_rows AS (
  SELECT source_run, page_num, pos, name AS company, {duck.clean_price('price')} AS price, 'primary' AS source,
         '{BASE}/shares/' || slug AS url, slug, sector, lot_size FROM items WHERE name <> '' AND {duck.clean_price('price')} IS NOT NULL)"""


def _cards_sql(table: str) -> str:
    return f"""SELECT source_run, page_num, CAST(i - 1 AS INTEGER) AS pos, name AS company, {duck.clean_price('price_text')} AS price,
  'primary' AS source, '{BASE}' || href AS url, string_split(href, '/')[-1] AS slug FROM (
    SELECT source_run, page_num, i, regexp_extract(card, '<span class="nm">([^<]*)</span>', 1) AS name,
           regexp_extract(card, '<b class="p">([^<]*)</b>', 1) AS price_text, regexp_extract(card, 'href="([^"]*)"', 1) AS href
    FROM (SELECT source_run, page_num, unnest(c) AS card, generate_subscripts(c, 1) AS i FROM (
      SELECT source_run, page_num, string_split(body, '<div class="scard">')[2:] AS c FROM {table}
      WHERE contains(body, '<div class="scard">')))) WHERE {duck.clean_price('price_text')} IS NOT NULL"""


@query(f"WITH {_ITEMS} SELECT * FROM items")
def scan_json_payload(spark, sf):
    return listings.scan_json_payload(view(spark, sf, "fx_payload_pages")).drop("logo", "as_of")


@query(f"WITH {_ITEMS} SELECT * FROM primary_rows")
def project_primary_items(spark, sf):
    items = listings.scan_json_payload(view(spark, sf, "fx_payload_pages"))
    rows = listings.project_primary_items(items, BASE)
    return rows.withColumn("lot_size", F.expr(_LOT)).drop("extra_data", "logo")


@query(f"WITH {duckdb_views('fx_card_html')} {_cards_sql('fx_card_html')}")
def scan_html_cards(spark, sf):
    return cards.scan_html_cards(view(spark, sf, "fx_card_html"), BASE)


_FALLBACK = f"""{_ITEMS},
card_rows AS ({_cards_sql('fx_payload_pages')}),
page_rows AS (
  SELECT source_run, page_num, pos, company, price, source, url, slug, sector, lot_size FROM primary_rows
  UNION ALL SELECT source_run, page_num, pos, company, price, source, url, slug, NULL, NULL FROM card_rows c
  WHERE NOT EXISTS (SELECT 1 FROM primary_rows p WHERE p.source_run = c.source_run AND p.page_num = c.page_num))"""


@query(f"WITH {_FALLBACK} SELECT * FROM page_rows")
def page_fallback(spark, sf):
    rows = listings.page_fallback(view(spark, sf, "fx_payload_pages"), BASE)
    return rows.withColumn("lot_size", F.expr(_LOT)).drop("extra_data", "logo")


_CUTOFF = f"""{_FALLBACK},
sizes AS (
  SELECT r.source_run, p.page_num, count(t.company) AS n
  FROM (SELECT DISTINCT source_run FROM fx_payload_pages) r CROSS JOIN (SELECT CAST(unnest(range(1, 41)) AS BIGINT) AS page_num) p
  LEFT JOIN page_rows t ON t.source_run = r.source_run AND t.page_num = p.page_num GROUP BY ALL),
flagged AS (SELECT *, n = 0 AND lag(n) OVER (PARTITION BY source_run ORDER BY page_num) = 0 AS stop FROM sizes),
limits AS (SELECT source_run, coalesce(min(page_num) FILTER (WHERE stop), 41) AS stop_page FROM flagged GROUP BY source_run),
kept AS (SELECT t.* FROM page_rows t JOIN limits l USING (source_run) WHERE t.page_num < l.stop_page)"""


@query(f"WITH {_CUTOFF} SELECT source_run, page_num, pos, company, price, slug FROM kept")
def page_cutoff(spark, sf):
    rows = listings.page_cutoff(listings.page_fallback(view(spark, sf, "fx_payload_pages"), BASE), 40)
    return rows.select("source_run", "page_num", "pos", "company", "price", "slug")


@query(
    f"""WITH {_CUTOFF} SELECT coalesce(nullif(slug, ''), company) AS listing, page_num, pos, company, price, sector FROM
(SELECT *, row_number() OVER (PARTITION BY coalesce(nullif(slug, ''), company) ORDER BY source_run DESC, page_num, pos) AS r FROM page_rows) WHERE r = 1"""
)
def dedup_first(spark, sf):
    """The two runs list the same companies; the later run counts."""
    rows = listings.page_fallback(view(spark, sf, "fx_payload_pages"), BASE)
    first = ops.dedup_first(rows, F.desc("source_run"), "page_num", "pos")
    return first.select(
        F.coalesce(F.when(F.col("slug") != "", F.col("slug")), F.col("company")).alias("listing"),
        "page_num", "pos", "company", "price", "sector",
    )


# --- API and detail pages ----------------------------------------------------------------------


@query(
    f"""WITH {duckdb_views('fx_api_item')},
f AS (SELECT ord, json_extract_string(item, '$.UL_STOCKS_COMPNAME') AS company, json_extract_string(item, '$.UL_PD_BID_PRICE') AS bid,
             json_extract_string(item, '$.current_price_calculated') AS calc, json_extract_string(item, '$.MCAP') AS mcap FROM fx_api_item),
p AS (SELECT *, CASE WHEN bid IS NULL OR bid IN ('', '0') THEN calc ELSE bid END AS price FROM f)
SELECT ord, 'secondary' AS source, company, price, {duck.slug_unicode('company')} AS slug, nullif(mcap, '') AS market_cap
FROM p WHERE {duck.float_of('price')} > 0"""
)
def scan_api_items(spark, sf):
    rows = api.scan_api_items(view(spark, sf, "fx_api_item"))
    return rows.select("ord", "source", "company", "price", "slug", F.expr("extra_data['Market Cap']").alias("market_cap"))


@query(
    f"""WITH {duckdb_views('fx_api_item')}
SELECT CAST(ord // 10 * 1048576 + row_number() OVER (PARTITION BY ord // 10 ORDER BY ord) - 1 AS BIGINT) AS ord,
       json_extract_string(item, '$.UL_STOCKS_COMPNAME') AS company, json_extract_string(item, '$.MCAP') AS market_cap FROM fx_api_item"""
)
def explode_responses(spark, sf):
    """Items in responses of ten, taken apart again."""
    items = view(spark, sf, "fx_api_item").withColumn("response", F.floor(F.col("ord") / 10))
    gathered = F.transform(F.array_sort(F.collect_list(F.struct("ord", "item"))), lambda x: x["item"])
    body = F.concat(F.lit('{"status": 1, "data": ['), F.array_join(gathered, ", "), F.lit("]}"))
    responses = items.groupBy("response").agg(body.alias("body")).withColumnRenamed("response", "ord")
    field = lambda name: F.get_json_object("item", f"$.{name}")
    return api.explode_responses(responses).select(
        "ord", field("UL_STOCKS_COMPNAME").alias("company"), field("MCAP").alias("market_cap")
    )


_TEXT_STEPS = """regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script\\s*>', '<p>', 'g'),
  '(?is)<style\\b.*?</style\\s*>', '<p>', 'g'), '(?s)<!--.*?-->', '<p>', 'g'), '(?i)<!doctype[^>]*>', '<p>', 'g')"""


def _decoded(e: str) -> str:
    for entity, char in (*detail.ENTITIES, ("&amp;", "&")):
        e = f"replace({e}, '{entity}', '{char.replace(chr(39), chr(39) * 2)}')"
    return e


def _text_sql(html: str) -> str:
    pieces = f"string_split_regex({_TEXT_STEPS.replace('(html,', f'({html},')}, '<[/a-zA-Z!][^>]*>')"
    return f"array_to_string(list_filter(list_transform({pieces}, lambda p: {duck.strip(_decoded('p'))}), lambda p: p <> ''), ' ')"


_PAGE_TEXT = f"""{duckdb_views('fx_detail_html')},
texts AS (SELECT page_id, url, html, {_text_sql('html')} AS text FROM fx_detail_html)"""


@query(
    f"""WITH {_PAGE_TEXT} SELECT page_id, url, 'detail' AS source, rtrim(string_split(url, '/in/listing/')[-1], '/') AS slug,
  replace({_text_sql("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")}, '', '') AS company,
  replace(regexp_extract(text, '₹[{duck.WS}]*([0-9,]+([.][0-9]+)?)', 1), ',', '') AS price,
  regexp_extract(text, 'IN[A-Z0-9]{{10}}') AS isin FROM texts"""
)
def extract_page_facts(spark, sf):
    return detail.extract_page_facts(view(spark, sf, "fx_detail_html"))


_PAIRS = rf"([A-Za-z0-9{duck.WS}/()\-]+):[{duck.WS}]*([^:\n]+)"


@query(
    f"""WITH {_PAGE_TEXT},
pairs AS (SELECT page_id, regexp_extract_all(text, '{_PAIRS}', 1) AS ks, regexp_extract_all(text, '{_PAIRS}', 2) AS vs FROM texts),
flat AS (SELECT page_id, {duck.strip('unnest(ks)')} AS key, {duck.strip('unnest(vs)')} AS value, generate_subscripts(ks, 1) AS pos FROM pairs)
SELECT page_id, key, arg_max(value, pos) AS value FROM flat
WHERE length(key) BETWEEN 2 AND 35 AND length(value) BETWEEN 1 AND 100 GROUP BY page_id, key"""
)
def extract_kv_pairs(spark, sf):
    return detail.extract_kv_pairs(view(spark, sf, "fx_detail_html"))


_LINKS = f"""{duckdb_views('fx_detail_html')},
raw_links AS (SELECT page_id, unnest(hs) AS href, unnest(ts) AS body, CAST(generate_subscripts(hs, 1) - 1 AS INTEGER) AS pos FROM (
  SELECT page_id, regexp_extract_all(html, '(?is)<a[^>]*? href="([^"]*)"[^>]*>(.*?)</a>', 1) AS hs,
         regexp_extract_all(html, '(?is)<a[^>]*? href="([^"]*)"[^>]*>(.*?)</a>', 2) AS ts FROM fx_detail_html)),
links AS (SELECT page_id, pos, {_decoded('href')} AS href, {_text_sql('body')} AS title FROM raw_links)"""


@query(
    f"""WITH {_LINKS} SELECT page_id, url, arg_min(title, pos) AS title, min(pos) AS pos FROM (
SELECT page_id, pos, title, CASE WHEN href LIKE 'http%' THEN href WHEN href LIKE '/%' THEN '{DETAIL}' || href ELSE '{DETAIL}/' || href END AS url
FROM links WHERE (lower(href) LIKE '%pdf%' OR lower(title) LIKE '%report%' OR lower(title) LIKE '%financial%') AND length(title) BETWEEN 1 AND 99)
GROUP BY page_id, url"""
)
def extract_document_links(spark, sf):
    return detail.extract_document_links(view(spark, sf, "fx_detail_html"), DETAIL)


@query(
    f"""WITH {_LINKS} SELECT url, any_value(page_id ORDER BY page_id, pos) AS page_id, any_value(pos ORDER BY page_id, pos) AS pos FROM (
SELECT page_id, pos, CASE WHEN href LIKE '/%' THEN '{DETAIL}' || href ELSE href END AS url FROM links WHERE contains(href, '/in/listing/'))
GROUP BY url"""
)
def harvest_listing_links(spark, sf):
    return detail.harvest_listing_links(view(spark, sf, "fx_detail_html"), DETAIL)


@query(
    f"""WITH {_PAGE_TEXT} SELECT page_id, {_text_sql("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")} AS company,
  regexp_extract(text, 'IN[A-Z0-9]{{10}}') AS isin, CAST(1 AS BIGINT) AS n_documents,
  CAST(length(text) - length(replace(text, ':', '')) > 0 AS BIGINT) AS has_pairs FROM texts"""
)
def mode_projection(spark, sf):
    """The full mode reads pairs and documents on top of the priority mode's columns."""
    pages = view(spark, sf, "fx_detail_html")
    quick = detail.detail_listings(pages, DETAIL, full=False).select("page_id", "company", "isin")
    full = detail.detail_listings(pages, DETAIL).select(
        "page_id",
        F.size("documents").cast("bigint").alias("n_documents"),
        (F.size("extra_data") > 0).cast("bigint").alias("has_pairs"),
    )
    return quick.join(full, "page_id")


# --- lists and cleaning ------------------------------------------------------------------------


@query(f"WITH {duckdb_views('fx_priority')} SELECT entry FROM fx_priority")
def read_priority_list(spark, sf):
    """Entries written as JSON documents, one per hundred keys, and read back."""
    number = F.regexp_extract("entry", "kx([0-9]+)", 1).cast("bigint")
    entries = view(spark, sf, "fx_priority").withColumn("hundred", F.floor(number / 100))
    documents = entries.groupBy("hundred").agg(
        F.to_json(F.struct(F.collect_list("entry").alias("high_priority_stocks"))).alias("value")
    )
    return priority.parse_priority_list(documents)


_PRICED = f"SELECT company, slug, {duck.parse_float('price')} AS price, sector, source FROM fx_primary_raw"


@query(
    f"""WITH {duckdb_views('fx_primary_raw', 'fx_secondary_raw')} SELECT company, slug, price, sector, source, CAST(0 AS BIGINT) AS n_extra FROM (
{_PRICED} UNION ALL SELECT company, {duck.slug_ascii('company')}, {duck.parse_float('price')}, NULL, source FROM fx_secondary_raw)"""
)
def normalize_listings(spark, sf):
    both = ops.union_sources(view(spark, sf, "fx_primary_raw"), view(spark, sf, "fx_secondary_raw"))
    return ops.normalize_listings(both).select(
        "company", "slug", "price", "sector", "source", F.size("extra_data").cast("bigint").alias("n_extra")
    )


@query(
    f"""WITH {duckdb_views('fx_primary_raw', 'fx_secondary_raw')} SELECT source, rank, ord, company FROM (
SELECT source, CAST(0 AS BIGINT) AS rank, ord, company FROM fx_primary_raw UNION ALL SELECT source, 1, ord, company FROM fx_secondary_raw)"""
)
def union_sources(spark, sf):
    both = ops.union_sources(view(spark, sf, "fx_primary_raw"), view(spark, sf, "fx_secondary_raw"))
    stride = F.lit(ops.SOURCE_STRIDE)
    return both.select(
        "source", F.floor(F.col("ord") / stride).alias("rank"), (F.col("ord") % stride).alias("ord"), "company"
    )


@query(f"WITH {duckdb_views('fx_api_item')}, p AS (SELECT ord, json_extract_string(item, '$.UL_PD_BID_PRICE') AS price FROM fx_api_item) SELECT * FROM p WHERE {duck.float_of('price')} > 0")
def filter_valid_price(spark, sf):
    items = view(spark, sf, "fx_api_item").select("ord", F.get_json_object("item", "$.UL_PD_BID_PRICE").alias("price"))
    return ops.filter_valid_price(items)


@query(f"WITH {duckdb_views('fx_primary_raw')} SELECT ord, nullif(CASE WHEN ord % 3 = 0 THEN '' ELSE slug END, '') AS slug FROM fx_primary_raw WHERE ord % 3 <> 0")
def filter_slug_present(spark, sf):
    return ops.filter_slug_present(
        view(spark, sf, "fx_primary_raw").select("ord", F.when(F.col("ord") % 3 == 0, "").otherwise(F.col("slug")).alias("slug"))
    )


@query("SELECT doc_id, source FROM documents WHERE source = 'src1'")
def filter_source(spark, sf):
    return ops.filter_source(load(spark, sf, "documents").select("doc_id", "source"), "secondary", "src0", "src1")


@query("SELECT doc_id, source FROM documents")
def filter_source_all(spark, sf):
    """Every row, those of a third source too."""
    return ops.filter_source(load(spark, sf, "documents").select("doc_id", "source"), "all", "src0", "src1")


_SLUGS = f"""{duckdb_views('fx_primary_raw', 'fx_priority')}, wanted AS (
  SELECT CASE WHEN contains(entry, '/shares/') THEN rtrim(string_split(entry, '/shares/')[-1], '/') ELSE entry END AS slug FROM fx_priority)"""


@query(f"WITH {_SLUGS} SELECT slug, company, price FROM fx_primary_raw WHERE slug IN (SELECT slug FROM wanted)")
def priority_semi_join(spark, sf):
    return ops.priority_semi_join(view(spark, sf, "fx_primary_raw"), view(spark, sf, "fx_priority")).select(
        "slug", "company", "price"
    )


# --- stored forms ------------------------------------------------------------------------------


def _book(spark, sf):
    from quotebook.operators.merge import upsert_primary

    raw = ops.normalize_listings(view(spark, sf, "fx_book_raw"))
    return upsert_primary(book.empty_book(spark), raw, F.lit("2024-01-01 00:00:00").cast("timestamp"))


_BOOK_ROWS = f"SELECT slug, company, {duck.parse_float('price')} AS price, sector, isin, source FROM fx_book_raw"


@query(f"WITH {duckdb_views('fx_book_raw')} {_BOOK_ROWS}", name="write_book")
def write_book(spark, sf):
    """Two committed versions; the newer one is read."""
    root = scratch_path(spark, "book")
    rows = _book(spark, sf)
    book.write_book(rows.limit(1), root)
    book.write_book(rows, root)
    return book.read_book(spark, root).select("slug", "company", "price", "sector", "isin", "source")


@query(f"WITH {duckdb_views('fx_book_raw')} SELECT slug, company, price, source FROM ({_BOOK_ROWS})")
def read_book(spark, sf):
    """A book kept as JSON documents of up to a hundred records, imported."""
    path = scratch_path(spark, "book-json")
    rows = _book(spark, sf).select("slug", "company", "price", "source")
    hundred = F.floor(F.regexp_extract("slug", "kx([0-9]+)", 1).cast("bigint") / 100)
    documents = rows.groupBy(F.col("source").alias("part"), hundred.alias("hundred")).agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("slug", F.struct("company", "price", "source"))))).alias("value")
    )
    documents.select("value").write.text(path)
    texts = spark.read.text(path)
    return book.book_from_json(texts).select("slug", "company", "price", "source")
