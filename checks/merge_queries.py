"""Merging into the book, publishing, and the streaming forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import duck
from checks.catalog import query
from quotebook.fixtures import VIEWS, duckdb_views, load, view
from quotebook.functions.text import display_timestamp
from quotebook.operators import listings as ops
from quotebook.operators import lookup, merge, publish
from quotebook.plans.upsert import UpsertResult, run_batch
from quotebook.plans.upsert import upsert_stocks as upsert_job
from quotebook.session import scratch_path, stage
from quotebook.sources import book as books
from quotebook.streaming import feed
from quotebook.streaming import upsert as streaming_upsert

_OLD, _NEW = "2024-01-01 00:00:00", "2024-02-01 12:30:00"


def _ts(text: str):
    return F.lit(text).cast("timestamp")


def _old_book(spark, sf) -> DataFrame:
    raw = ops.normalize_listings(view(spark, sf, "fx_book_raw"))
    return merge.upsert_primary(books.empty_book(spark), raw, _ts(_OLD))


def _shown(book: DataFrame) -> DataFrame:
    return book.select(
        "slug",
        "company",
        "source",
        "price",
        "backup_price",
        "sector",
        "isin",
        F.coalesce(F.array_join("aliases", "|"), F.lit("")).alias("aliases"),
        display_timestamp(F.col("updated_at")).alias("updated"),
    )


_B0 = f"""b0 AS (SELECT ord, source, company, slug, {duck.parse_float('price')} AS price, sector, isin, '{_OLD}' AS updated FROM fx_book_raw)"""


def _upserted(name: str, source: str) -> str:
    """CTE: rows of ``source`` folded into b0 by the primary rules."""
    return f"""{name}_f AS (
  SELECT slug, arg_max(company, ord) AS company, arg_max(source, ord) AS source,
         arg_max(p, ord) FILTER (p IS NOT NULL) AS price, arg_max(sector, ord) FILTER (sector <> '') AS sector_full,
         arg_max(sector, ord) FILTER (sector IS NOT NULL) AS sector_any, arg_max(isin, ord) FILTER (isin <> '') AS isin, min(ord) AS ord
  FROM (SELECT *, {duck.parse_float('price')} AS p FROM {source}) GROUP BY slug),
{name} AS (
  SELECT slug, coalesce(f.company, b.company) AS company, coalesce(f.source, b.source) AS source, coalesce(f.price, b.price) AS price,
         coalesce(f.sector_full, nullif(b.sector, ''), f.sector_any, b.sector) AS sector, coalesce(f.isin, b.isin) AS isin,
         CASE WHEN f.slug IS NULL THEN b.updated ELSE '{_NEW}' END AS updated, coalesce(b.ord, 1000000000000 + f.ord) AS ord
  FROM b0 b FULL JOIN {name}_f f USING (slug))"""


_PLAIN = "slug, company, source, price, CAST(NULL AS DOUBLE) AS backup_price, sector, isin, '' AS aliases, updated"


@query(
    f"WITH {duckdb_views('fx_book_raw', 'fx_primary_updates')}, {_B0}, {_upserted('b1', 'fx_primary_updates')} SELECT {_PLAIN} FROM b1"
)
def upsert_primary(spark, sf):
    incoming = ops.normalize_listings(view(spark, sf, "fx_primary_updates"))
    return _shown(merge.upsert_primary(_old_book(spark, sf), incoming, _ts(_NEW), ops.BATCH_STRIDE))


@query(
    f"""WITH {duckdb_views('fx_book_raw', 'fx_secondary_updates')}, {_B0}, f AS (
  SELECT slug, arg_max(company, ord) AS company, arg_max(source, ord) AS source, arg_max(p, ord) FILTER (p IS NOT NULL) AS price,
         arg_max(sector, ord) FILTER (sector IS NOT NULL) AS sector
  FROM (SELECT *, {duck.parse_float('price')} AS p FROM fx_secondary_updates) GROUP BY slug)
SELECT slug, coalesce(f.company, b.company) AS company, coalesce(f.source, b.source) AS source, coalesce(f.price, b.price) AS price,
  CAST(NULL AS DOUBLE) AS backup_price, coalesce(f.sector, b.sector) AS sector, b.isin, '' AS aliases,
  CASE WHEN f.slug IS NULL THEN b.updated ELSE '{_NEW}' END AS updated FROM b0 b FULL JOIN f USING (slug)"""
)
def upsert_secondary_only(spark, sf):
    incoming = ops.normalize_listings(view(spark, sf, "fx_secondary_updates"))
    return _shown(merge.upsert_secondary_only(_old_book(spark, sf), incoming, _ts(_NEW), ops.BATCH_STRIDE))


@query(
    f"""WITH {duckdb_views('fx_book_raw', 'fx_secondary_updates')}, n AS (SELECT slug, count(*) AS n_rows FROM fx_secondary_updates GROUP BY slug)
SELECT slug, CASE WHEN b.company IS NULL THEN 'insert' WHEN n_rows IS NULL THEN 'keep' ELSE 'update' END AS action,
  coalesce(n_rows, 0) AS n_rows FROM fx_book_raw b FULL JOIN n USING (slug)"""
)
def slug_join(spark, sf):
    return merge.slug_join(_old_book(spark, sf), view(spark, sf, "fx_secondary_updates"))


_MATCHED = f"""{duckdb_views('fx_primary_raw', 'fx_matched')},
m AS (SELECT *, {duck.parse_float('price')} AS p FROM fx_matched),
al AS (SELECT matched_slug AS slug, string_agg(DISTINCT n, '|' ORDER BY n) AS aliases FROM (
  SELECT matched_slug, company AS n FROM m UNION SELECT matched_slug, short_name FROM m WHERE short_name <> '') GROUP BY 1),
f AS (SELECT matched_slug AS slug, arg_max(p, ord) FILTER (p IS NOT NULL) AS backup_price,
  arg_min(industry, ord) FILTER (industry <> '') AS industry FROM m GROUP BY 1),
merged AS (SELECT b.slug, b.company, f.backup_price, f.industry, coalesce(al.aliases, '') AS aliases,
  CASE WHEN f.slug IS NULL THEN '{_OLD}' ELSE '{_NEW}' END AS updated FROM fx_primary_raw b LEFT JOIN f USING (slug) LEFT JOIN al USING (slug))"""


def _merged(spark, sf) -> DataFrame:
    primary = ops.normalize_listings(view(spark, sf, "fx_primary_raw"))
    book = merge.upsert_primary(books.empty_book(spark), primary, _ts(_OLD))
    rows = view(spark, sf, "fx_matched")
    keyed = ops.normalize_listings(rows, keep_short_name=True).join(rows.select("ord", "matched_slug"), "ord")
    return merge.merge_backup(book, keyed, _ts(_NEW))


@query(f"WITH {_MATCHED} SELECT * FROM merged")
def merge_backup(spark, sf):
    return _merged(spark, sf).select(
        "slug",
        "company",
        "backup_price",
        "industry",
        F.coalesce(F.array_join("aliases", "|"), F.lit("")).alias("aliases"),
        display_timestamp(F.col("updated_at")).alias("updated"),
    )


@query(f"WITH {_MATCHED} SELECT slug, aliases FROM al WHERE slug IN (SELECT slug FROM fx_primary_raw)")
def alias_sort(spark, sf):
    aliased = _merged(spark, sf).filter(F.size("aliases") > 0)
    return aliased.select("slug", F.array_join("aliases", "|").alias("aliases"))


# --- the whole job -----------------------------------------------------------------------------

_JOB = f"""{duckdb_views('fx_book_raw', 'fx_primary_raw', 'fx_secondary_raw', 'fx_alias')},
incoming AS (SELECT ord, source, company, slug, price, sector, CAST(NULL AS VARCHAR) AS isin FROM fx_primary_raw),
{_B0}, {_upserted('b1', 'incoming')},
prim AS (SELECT ord, company, slug FROM b1 WHERE source = 'primary'),
sec AS (SELECT ord, company, CAST(NULL AS VARCHAR) AS short_name, {duck.parse_float('price')} AS price, {duck.slug_ascii('company')} AS slug FROM fx_secondary_raw),
res AS (WITH {duck.match_ctes('prim', 'sec')} SELECT company, slug AS matched FROM resolved),
rows1 AS (SELECT sec.*, res.matched FROM sec LEFT JOIN res USING (company)),
olds AS (SELECT ord, company, company AS short_name, price, sector, isin, slug FROM b1 WHERE source = 'secondary'
         UNION ALL SELECT 2000000000000 + ord, company, company, price, NULL, NULL, slug FROM rows1 WHERE matched IS NULL),
res2 AS (WITH {duck.match_ctes('prim', 'olds')} SELECT company, slug AS matched FROM resolved),
rows2 AS (SELECT olds.*, res2.matched FROM olds JOIN res2 USING (company) WHERE res2.matched <> olds.slug),
both_rows AS (
  SELECT 1 AS phase, ord, matched, company, price, CAST(NULL AS VARCHAR) AS sector, CAST(NULL AS VARCHAR) AS isin FROM rows1 WHERE matched IS NOT NULL
  UNION ALL SELECT 2, ord, matched, company, price, sector, isin FROM rows2),
merges AS (
  SELECT matched AS slug, arg_max(price, phase * 10000000000000 + ord) FILTER (price IS NOT NULL) AS backup_price,
         arg_min(sector, phase * 10000000000000 + ord) FILTER (sector <> '') AS sector,
         arg_min(isin, phase * 10000000000000 + ord) FILTER (isin <> '') AS isin FROM both_rows GROUP BY matched),
named AS (SELECT r.matched AS slug, string_agg(DISTINCT r.company, '|' ORDER BY r.company) AS aliases
          FROM both_rows r JOIN b1 ON b1.slug = r.matched WHERE r.company <> b1.company GROUP BY r.matched),
final AS (
  SELECT b1.slug, b1.company, b1.source, b1.price, m.backup_price, coalesce(nullif(b1.sector, ''), m.sector, b1.sector) AS sector,
         coalesce(nullif(b1.isin, ''), m.isin, b1.isin) AS isin, coalesce(n.aliases, '') AS aliases, b1.updated
  FROM b1 LEFT JOIN merges m USING (slug) LEFT JOIN named n USING (slug) WHERE b1.slug NOT IN (SELECT slug FROM rows2)
  UNION ALL SELECT slug, company, 'secondary', price, NULL, NULL, NULL, '', '{_NEW}' FROM rows1 WHERE matched IS NULL)"""


def _job(spark, sf) -> UpsertResult:
    both = ops.union_sources(view(spark, sf, "fx_primary_raw"), view(spark, sf, "fx_secondary_raw"))
    return upsert_job(
        stage(_old_book(spark, sf), "old-book"), ops.normalize_listings(both), _ts(_NEW), view(spark, sf, "fx_alias"), batch=1
    )


@query(f"WITH {_JOB} SELECT * FROM final")
def upsert_stocks(spark, sf):
    return _shown(_job(spark, sf).book)


@query(
    f"""WITH {_JOB} SELECT CAST((SELECT count(*) FROM fx_primary_raw) + (SELECT count(*) FROM sec) AS BIGINT) AS scraped,
  CAST((SELECT count(*) FROM final) - (SELECT count(*) FROM b0) + (SELECT count(*) FROM rows2) AS BIGINT) AS inserted,
  CAST((SELECT count(*) FROM fx_primary_raw WHERE slug IN (SELECT slug FROM b0)) + (SELECT count(*) FROM rows1 WHERE matched IS NOT NULL) AS BIGINT) AS updated,
  CAST((SELECT count(*) FROM rows2) AS BIGINT) AS removed"""
)
def run_summary(spark, sf):
    return _job(spark, sf).summary.select(*[F.col(c).cast("bigint").alias(c) for c in ("scraped", "inserted", "updated", "removed")])


_PUBLISHED = """SELECT CAST(NULL AS VARCHAR) AS "URL", company AS "Name", split_part(aliases, '|', 1) AS "Short Name", aliases AS "Aliases",
  isin AS "ISIN", CASE WHEN (price IS NULL OR price = 0) AND backup_price IS NOT NULL THEN backup_price ELSE price END AS "Latest Price",
  backup_price AS "Backup Price", '0.00' AS "Change Abs", '0.00' AS "Change Pct", updated AS "Last Updated", '' AS "Error" FROM {0}"""


def _flat(published: DataFrame) -> DataFrame:
    return published.withColumn("Aliases", F.array_join("Aliases", "|"))


@query(f"WITH {_JOB} {_PUBLISHED.format('final')}")
def publish_prices(spark, sf):
    """Raw listings of both sources to the published table, through the stored book."""
    root = scratch_path(spark, "book")
    books.write_book(_old_book(spark, sf), root, 0)
    run_batch(
        root, view(spark, sf, "fx_primary_raw"), view(spark, sf, "fx_secondary_raw"), _ts(_NEW), view(spark, sf, "fx_alias")
    )
    return _flat(publish.publish_prices(books.read_book(spark, root)))


_LEFT = f"""{duckdb_views('fx_book_raw', 'fx_primary_raw')},
incoming AS (SELECT ord, source, company, slug, price, sector, CAST(NULL AS VARCHAR) AS isin FROM fx_primary_raw),
{_B0}, {_upserted('b1', 'incoming')},
prim AS (SELECT ord, company, slug FROM b1 WHERE source = 'primary'),
olds AS (SELECT ord, company, company AS short_name, price, sector, isin, slug FROM b1 WHERE source = 'secondary'),
fx_alias AS (SELECT 0 AS ord, '' AS secondary_name, '' AS primary_name WHERE false),
res2 AS (WITH {duck.match_ctes('prim', 'olds')} SELECT company, slug AS matched FROM resolved),
rows2 AS (SELECT olds.*, res2.matched FROM olds JOIN res2 USING (company) WHERE res2.matched <> olds.slug),
left_final AS (SELECT b1.slug, b1.company, b1.source, b1.price, r.price AS backup_price, coalesce(nullif(b1.sector, ''), r.sector, b1.sector) AS sector,
  coalesce(nullif(b1.isin, ''), r.isin, b1.isin) AS isin, coalesce(r.company, '') AS aliases, b1.updated
  FROM b1 LEFT JOIN rows2 r ON r.matched = b1.slug WHERE b1.slug NOT IN (SELECT slug FROM rows2))"""


def _reconcile(spark, sf) -> tuple[DataFrame, DataFrame]:
    incoming = ops.normalize_listings(view(spark, sf, "fx_primary_raw"))
    book = stage(merge.upsert_primary(_old_book(spark, sf), incoming, _ts(_NEW), ops.BATCH_STRIDE), "book")
    return book, stage(merge.leftover_matches(book), "leftovers")


@query(f"WITH {_LEFT} SELECT * FROM left_final")
def reconcile_leftovers(spark, sf):
    return _shown(merge.reconcile_leftovers(*_reconcile(spark, sf)))


@query(f"WITH {duckdb_views('fx_book_raw', 'fx_secondary_updates')} SELECT slug, company FROM fx_book_raw WHERE slug NOT IN (SELECT slug FROM fx_secondary_updates)")
def drop_reconciled(spark, sf):
    return merge.drop_reconciled(_old_book(spark, sf), view(spark, sf, "fx_secondary_updates")).select("slug", "company")


# --- publishing and reports --------------------------------------------------------------------

_SMALL = f"{_MATCHED}, shown AS (SELECT m.*, {duck.parse_float('p.price')} AS price, CAST(NULL AS VARCHAR) AS isin FROM merged m JOIN fx_primary_raw p USING (slug))"


@query(f"WITH {_SMALL} {_PUBLISHED.format('shown')}")
def read_published(spark, sf):
    """Published as JSON lines and read back."""
    path = scratch_path(spark, "published")
    publish.write_published(_merged(spark, sf), path)
    return _flat(books.read_published(spark, path))


@query(f"WITH {_SMALL} SELECT slug, company, CAST(price AS VARCHAR) AS price, CAST(backup_price AS VARCHAR) AS backup_price, nullif(aliases, '') AS aliases FROM shown")
def export_csv(spark, sf):
    """Exported as CSV and read back, arrays as JSON text."""
    path = scratch_path(spark, "csv")
    publish.export_csv(_merged(spark, sf), path)
    rows = spark.read.option("header", True).option("escape", '"').csv(path)
    return rows.select(
        "slug", "company", "price", "backup_price", F.array_join(F.from_json("aliases", "array<string>"), "|").alias("aliases")
    )


@query(
    f"""WITH {duckdb_views('fx_book_raw')} SELECT 'total' AS metric, CAST(NULL AS VARCHAR) AS source, count(*) AS n_rows FROM fx_book_raw
UNION ALL SELECT 'source', source, count(*) FROM fx_book_raw WHERE source IS NOT NULL GROUP BY source"""
)
def book_metrics(spark, sf):
    return publish.book_metrics(_old_book(spark, sf))


@query(f"WITH {_SMALL} SELECT company AS \"Name\", CASE WHEN price IS NULL OR price = 0 THEN coalesce(backup_price, price) ELSE price END AS \"Latest Price\" FROM shown WHERE regexp_matches(company, 'GIZMO', 'i') ORDER BY company LIMIT 1")
def name_lookup(spark, sf):
    return publish.name_lookup(publish.publish_prices(_merged(spark, sf)), "GIZMO").select("Name", "Latest Price")


def _published(spark, sf) -> DataFrame:
    path = scratch_path(spark, "published")
    publish.write_published(_merged(spark, sf), path)
    return books.read_published(spark, path, positions=True)


@query(f"WITH {duckdb_views('fx_primary_raw')} SELECT company AS \"Name\", row_number() OVER (ORDER BY ord, slug) - 1 AS \"Position\" FROM fx_primary_raw")
def published_positions(spark, sf):
    """Published in order of insertion and read back with the positions."""
    return _published(spark, sf).select("Name", "Position")


@query(f"WITH {duckdb_views('fx_primary_raw')} SELECT company AS \"Name\" FROM fx_primary_raw WHERE regexp_matches(company, 'GIZMO', 'i') ORDER BY ord, slug LIMIT 1")
def name_lookup_inserted(spark, sf):
    """The first inserted hit in the published table."""
    return publish.name_lookup(_published(spark, sf), "GIZMO").select("Name")


@query("SELECT c_name AS \"Name\", c_custkey AS place FROM customer WHERE regexp_matches(c_name, 'mer#.*77', 'i') ORDER BY c_name, c_custkey LIMIT 1")
def name_lookup_indexed(spark, sf):
    names = load(spark, sf, "customer").selectExpr("c_name AS Name", "c_custkey AS place")
    index = stage(lookup.trigram_index(names), "trigrams")
    return lookup.indexed_lookup(names, index, "MER#.*77", "Name", "place")


@query("SELECT doc_id, lang FROM documents WHERE lang = 'de' ORDER BY doc_id LIMIT 1")
def first_match(spark, sf):
    return publish.first_match(load(spark, sf, "documents").filter("lang = 'de'").select("doc_id", "lang"), "doc_id")


# --- streaming ---------------------------------------------------------------------------------


def _stream(spark, sf, table: str) -> DataFrame:
    schema = load(spark, sf, table).schema
    return spark.readStream.schema(schema).parquet(f"{sf}/{table}*.parquet")


def _feed_lines(spark, sf) -> DataFrame:
    text = VIEWS["fx_feed_lines"]
    columns = text[text.index("SELECT") + 6 : text.rindex("FROM")]
    ord_column, line = columns.split(",", 1)
    return _stream(spark, sf, "events").selectExpr(ord_column, line)


_EVENTS = f"""{duckdb_views('fx_feed_lines')}, live AS (
  SELECT json_extract_string(j, '$.company') AS company, json_extract_string(j, '$.price') AS price, json_extract_string(j, '$.source') AS source
  FROM (SELECT replace(line, 'LIVE_DATA:', '') AS j FROM fx_feed_lines WHERE starts_with(line, 'LIVE_DATA:')) WHERE json_valid(j))"""


@query(f"WITH {_EVENTS} SELECT * FROM live")
def live_feed(spark, sf):
    """The feed as a stream into a parquet folder."""
    path = scratch_path(spark, "feed")
    feed.append_to(feed.live_feed(_feed_lines(spark, sf)), path, scratch_path(spark, "feed-state")).awaitTermination()
    return spark.read.schema("company string, price string, source string").parquet(path)


@query(f"WITH {duckdb_views('fx_primary_raw')} SELECT company, price, 'primary' AS source FROM fx_primary_raw")
def feed_lines(spark, sf):
    """Lines written for raw listings and read back from the feed."""
    rows = view(spark, sf, "fx_primary_raw").withColumn("source", F.lit("primary"))
    return feed.live_feed(feed.feed_lines(rows)).select("company", "price", "source")


@query(f"WITH {duckdb_views('fx_feed_lines')} SELECT ord, line FROM fx_feed_lines WHERE NOT starts_with(line, 'LIVE_DATA:')")
def feed_other_lines(spark, sf):
    path = scratch_path(spark, "log")
    feed.append_to(feed.feed_other_lines(_feed_lines(spark, sf)), path, scratch_path(spark, "log-state")).awaitTermination()
    return spark.read.schema("ord bigint, line string").parquet(path)


@query(f"WITH {duckdb_views('fx_feed_lines')} SELECT ord, line FROM fx_feed_lines WHERE NOT starts_with(line, 'LIVE_DATA:') ORDER BY ord DESC LIMIT 15")
def last_n_lines(spark, sf):
    return publish.last_n_lines(feed.feed_other_lines(view(spark, sf, "fx_feed_lines")))


@query(f"WITH {_EVENTS} SELECT source, count(*) AS n_rows FROM live GROUP BY source")
def live_source_counts(spark, sf):
    path = scratch_path(spark, "counts")
    counts = feed.live_source_counts(feed.live_feed(_feed_lines(spark, sf)))
    feed.snapshot_to(counts, path, scratch_path(spark, "counts-state")).awaitTermination()
    return feed.latest_snapshot(spark, path, "source string, n_rows bigint")


_STREAMED = _JOB.replace(_B0, _B0.replace("FROM fx_book_raw)", "FROM fx_book_raw WHERE false)"))


@query(f"WITH {_STREAMED} SELECT * FROM final")
def stream_upsert(spark, sf):
    """Both sources as one stream of listings, merged into an empty book."""
    parts = _stream(spark, sf, "part")

    def listings(name: str) -> DataFrame:
        return spark.sql(VIEWS[name].replace("{", "{{").replace("}", "}}").replace("FROM part", "FROM {part}"), part=parts)

    root = scratch_path(spark, "book")
    streaming_upsert.stream_upsert(
        ops.union_sources(listings("fx_primary_raw"), listings("fx_secondary_raw")),
        root,
        scratch_path(spark, "upsert-state"),
        _ts(_NEW),
        view(spark, sf, "fx_alias"),
    ).awaitTermination()
    return _shown(books.read_book(spark, root))
