"""Column helpers over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import duck
from checks.catalog import query
from quotebook.fixtures import duckdb_views, load, view
from quotebook.functions import names, text
from quotebook.operators.publish import live_columns
from quotebook.schemas import field_type

# Prices as sources write them; the table's own value in most of them.
_PRICE_TEXT = """CASE o_orderkey % 12 WHEN 0 THEN 'N/A' WHEN 1 THEN '-' WHEN 2 THEN '' WHEN 3 THEN '12%' WHEN 4 THEN '1e5'
  WHEN 5 THEN concat('₹ 1,', CAST(o_custkey AS STRING), '.50 ') WHEN 6 THEN concat('₹ ', CAST(o_orderkey AS STRING), ' 200')
  WHEN 7 THEN '1_000' WHEN 8 THEN '12d' WHEN 9 THEN concat('+', CAST(o_custkey AS STRING)) WHEN 10 THEN 'abc'
  ELSE concat('₹ ', CAST(CAST(round(o_totalprice) AS BIGINT) AS STRING), '.25') END"""


def _price_texts(spark, sf):
    return load(spark, sf, "orders").selectExpr("o_orderkey", f"{_PRICE_TEXT} AS raw")


_PRICE_SQL = f"(SELECT o_orderkey, {_PRICE_TEXT} AS raw FROM orders)"


@query(f"SELECT o_orderkey, {duck.parse_float('raw')} AS value FROM {_PRICE_SQL}")
def parse_float(spark, sf):
    return _price_texts(spark, sf).select("o_orderkey", text.parse_float(F.col("raw")).alias("value"))


@query(f"SELECT o_orderkey, {duck.clean_price('raw')} AS value FROM {_PRICE_SQL}")
def clean_price(spark, sf):
    return _price_texts(spark, sf).select("o_orderkey", text.clean_price(F.col("raw")).alias("value"))


@query(f"SELECT o_orderkey, {duck.clean_value('raw')} AS value FROM {_PRICE_SQL}")
def clean_value(spark, sf):
    return _price_texts(spark, sf).select("o_orderkey", text.clean_value(F.col("raw")).alias("value"))


@query(f"SELECT doc_id, {duck.slug_ascii('text')} AS slug FROM documents")
def slugify_ascii(spark, sf):
    return load(spark, sf, "documents").select("doc_id", text.slugify_ascii(F.col("text")).alias("slug"))


@query(f"SELECT doc_id, {duck.slug_unicode('text')} AS slug FROM documents")
def slugify_unicode(spark, sf):
    return load(spark, sf, "documents").select("doc_id", text.slugify_unicode(F.col("text")).alias("slug"))


# Texts with the abbreviations in them.
_ABBREVIATED = "concat('Ent ', text, ' lab')"


@query(f"SELECT doc_id, {duck.canonical(_ABBREVIATED)} AS name FROM documents")
def canonical_match_name(spark, sf):
    return load(spark, sf, "documents").selectExpr("doc_id", f"{names.canonical_match_name(_ABBREVIATED)} AS name")


@query(f"SELECT doc_id, {duck.norm(_ABBREVIATED)} AS match_key FROM documents")
def normalize_for_match(spark, sf):
    return load(spark, sf, "documents").selectExpr("doc_id", f"{names.normalize_for_match(_ABBREVIATED)} AS match_key")


@query(f"SELECT doc_id, {duck.joined(duck.tokens('text'))} AS tokens, CAST(len({duck.tokens('text')}) AS BIGINT) AS n_tokens FROM documents")
def name_tokens(spark, sf):
    return (
        load(spark, sf, "documents")
        .selectExpr("doc_id", f"sort_array({names.name_tokens('text')}) AS t")
        .selectExpr("doc_id", "array_join(t, '|') AS tokens", "cast(size(t) AS bigint) AS n_tokens")
    )


@query(
    f"SELECT {duck.stem('w')} AS stem, count(*) AS n_words FROM "
    "(SELECT unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS w FROM conversations) GROUP BY 1"
)
def stem(spark, sf):
    words = load(spark, sf, "conversations").selectExpr("explode(regexp_extract_all(lower(text), '[a-z0-9]+', 0)) AS w")
    return words.groupBy(F.expr(names.stem("w")).alias("stem")).agg(F.count(F.lit(1)).alias("n_words"))


@query(
    f"WITH {duckdb_views('fx_primary_raw')} SELECT slug, lower(v) AS variant FROM "
    f"(SELECT slug, unnest({duck.variants('company')}) AS v FROM fx_primary_raw) GROUP BY 1, 2"
)
def name_variants(spark, sf):
    return view(spark, sf, "fx_primary_raw").selectExpr("slug", f"explode({names.name_variants('company')}) AS v").select(
        "slug", F.lower("v").alias("variant")
    )


@query(
    f"SELECT doc_id, {duck.joined(duck.significant(_ABBREVIATED))} AS words, "
    f"""{duck.joined(duck.significant("concat(text, ' Pvt Ltd shares')", False))} AS words_with_limited FROM documents"""
)
def significant_words(spark, sf):
    return load(spark, sf, "documents").selectExpr(
        "doc_id",
        f"array_join({names.significant_words(_ABBREVIATED)}, '|') AS words",
        f"""array_join({names.significant_words("concat(text, ' Pvt Ltd shares')", False)}, '|') AS words_with_limited""",
    )


@query(f"WITH {duckdb_views('fx_primary_raw')} SELECT slug, {duck.joined(duck.acronyms('company'))} AS acronyms FROM fx_primary_raw")
def acronyms_of(spark, sf):
    return view(spark, sf, "fx_primary_raw").selectExpr(
        "slug", f"array_join(sort_array({names.acronyms_of('company')}), '|') AS acronyms"
    )


@query(
    f"SELECT doc_id, coalesce(array_to_string(flatten(list_transform({duck.chunks('text')}, lambda c: "
    f"CASE WHEN {duck.norm('c')} = '' THEN [c] ELSE [c, {duck.norm('c')}] END)), '|'), '') AS chunks FROM documents"
)
def paren_chunks(spark, sf):
    return load(spark, sf, "documents").selectExpr("doc_id", f"array_join({names.paren_chunks('text')}, '|') AS chunks")


@query(
    f"""WITH t AS (SELECT conv_id, turn, {duck.tokens('text')} AS toks FROM conversations)
SELECT a.conv_id, a.turn, round(CASE WHEN len(a.toks) = 0 OR len(b.toks) = 0 THEN 0.0
  ELSE len(list_intersect(a.toks, b.toks)) / len(list_distinct(list_concat(a.toks, b.toks))) END, 6) AS jaccard,
  CAST(len(list_intersect(a.toks, b.toks)) AS BIGINT) AS n_common
FROM t a JOIN t b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1"""
)
def token_jaccard(spark, sf):
    """Similarity of each turn with the next one."""
    t = load(spark, sf, "conversations").selectExpr("conv_id", "turn", f"{names.name_tokens('text')} AS toks")
    following = t.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("toks").alias("next_toks"))
    return t.join(following, ["conv_id", "turn"]).selectExpr(
        "conv_id",
        "turn",
        f"round({names.token_jaccard('toks', 'next_toks')}, 6) AS jaccard",
        "cast(size(array_intersect(toks, next_toks)) AS bigint) AS n_common",
    )


@query(
    f"""WITH t AS (SELECT doc_id, {duck.tokens('text')} AS toks, {duck.tokens('source')} AS other FROM documents)
SELECT doc_id, CAST(len(list_intersect(toks, other)) AS BIGINT) AS n_common,
  CAST(len(list_distinct(list_concat(toks, other))) AS BIGINT) AS n_all,
  len(list_intersect(toks, other)) = least(len(toks), len(other)) AS is_subset FROM t"""
)
def token_set_ops(spark, sf):
    """Intersection, union and containment of the tokens of a text and of its source."""
    t = load(spark, sf, "documents").selectExpr(
        "doc_id", f"{names.name_tokens('text')} AS toks", f"{names.name_tokens('source')} AS other"
    )
    return t.selectExpr(
        "doc_id",
        "cast(size(array_intersect(toks, other)) AS bigint) AS n_common",
        "cast(size(array_union(toks, other)) AS bigint) AS n_all",
        "size(array_intersect(toks, other)) = least(size(toks), size(other)) AS is_subset",
    )


@query(
    f"WITH {duckdb_views('fx_book_raw')} SELECT slug, coalesce(sector, '') <> '' AS has_sector, coalesce(isin, '') <> '' AS has_isin, "
    f"{duck.parse_float('price')} IS NOT NULL AS has_price FROM fx_book_raw"
)
def meaningful(spark, sf):
    book = view(spark, sf, "fx_book_raw").withColumn("price", text.parse_float(F.col("price")))
    return book.select(
        "slug", *[text.meaningful(F.col(c), field_type(c)).alias(f"has_{c}") for c in ("sector", "isin", "price")]
    )


_TWO_PRICES = """CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 0D ELSE o_totalprice END AS price,
  CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 0D ELSE o_totalprice + 7 END AS backup"""


@query(
    f"""SELECT o_orderkey, CASE WHEN (price IS NULL OR price = 0) AND backup IS NOT NULL THEN backup ELSE price END AS shown
FROM (SELECT o_orderkey, {_TWO_PRICES.replace('0D', '0.0::DOUBLE')} FROM orders)"""
)
def display_price(spark, sf):
    two = load(spark, sf, "orders").selectExpr("o_orderkey", *_split(_TWO_PRICES))
    return two.select("o_orderkey", text.display_price(F.col("price"), F.col("backup")).alias("shown"))


def _split(columns: str) -> list[str]:
    return [c.strip() for c in columns.split(",\n")]


_HREF = "CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN concat('/p/', CAST(page_id AS STRING), '/') ELSE concat('p/', CAST(page_id AS STRING)) END"


@query(
    f"""SELECT page_id, CASE WHEN href LIKE 'http%' THEN href WHEN href LIKE '/%' THEN 'https://primary.example' || href
  ELSE 'https://primary.example/' || href END AS url FROM (SELECT page_id, {_HREF} AS href FROM pages)"""
)
def absolutize_url(spark, sf):
    hrefs = load(spark, sf, "pages").selectExpr("page_id", f"{_HREF} AS href")
    return hrefs.select("page_id", text.absolutize_url(F.col("href"), "https://primary.example").alias("url"))


@query(f"SELECT page_id, string_split(rtrim(href, '/'), '/')[-1] AS slug FROM (SELECT page_id, {_HREF} AS href FROM pages)")
def url_slug(spark, sf):
    hrefs = load(spark, sf, "pages").selectExpr("page_id", f"{_HREF} AS href")
    return hrefs.select("page_id", text.url_slug(F.col("href")).alias("slug"))


@query(
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS shown, "
    "left(replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), 'T', ' '), 19) AS shown_iso FROM events"
)
def display_timestamp(spark, sf):
    events = load(spark, sf, "events")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return events.select(
        "event_id", text.display_timestamp(F.col("ts")).alias("shown"), text.display_iso(iso).alias("shown_iso")
    )


@query("SELECT CAST(user_id AS VARCHAR) AS company, CAST(event_id AS VARCHAR) AS price, event_type AS source FROM events", name="live_columns")
def live_columns_query(spark, sf):
    return live_columns(
        load(spark, sf, "events").selectExpr(
            "event_type AS source", "cast(event_id AS string) AS price", "cast(user_id AS string) AS company", "value"
        )
    )
