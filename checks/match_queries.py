"""Name matching: tiers, candidates, fallbacks and the resolution as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import duck
from checks.catalog import query
from quotebook.fixtures import duckdb_views, view
from quotebook.functions import vocabulary as v
from quotebook.operators import listings as ops
from quotebook.operators import resolve
from quotebook.operators.candidates import ALL_TIERS, canonical_names
from quotebook.plans.buckets import kept_token_index, merge_batch
from quotebook.session import scratch_path, stage


def _names(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Secondary names with their aliases, and primary names."""
    listings = ops.normalize_listings(view(spark, sf, "fx_secondary_raw"), keep_short_name=True)
    book = ops.normalize_listings(view(spark, sf, "fx_primary_raw"))
    src = resolve.alias_lookup(resolve.source_names(listings), view(spark, sf, "fx_alias"))
    return stage(src, "secondary-names"), stage(canonical_names(book), "primary-names")


def _with_names(rows: DataFrame, src: DataFrame) -> DataFrame:
    return rows.join(src.select("src", "company", "short_name"), "src").drop("src")


@query(
    f"WITH {duck.fixture_match()} SELECT company, short_name, mapped_name FROM s_names"
)
def alias_lookup(spark, sf):
    return _names(spark, sf)[0].select("company", "short_name", "mapped_name")


def _tier_oracle(tier: int) -> str:
    return f"""WITH {duck.fixture_match()}, one_tier AS (SELECT * FROM pair_tiers WHERE tier = {tier}),
{duck.best_cte('tier_best', 'one_tier', 'sid')}
SELECT s.company, s.short_name, CAST(tier AS INTEGER) AS tier, round(jaccard, 6) AS jaccard, ambiguous,
       CASE WHEN NOT ambiguous THEN slug END AS slug FROM tier_best JOIN s_names s USING (sid)"""


def _best_of(spark, sf, tiers: tuple) -> DataFrame:
    src, canon = _names(spark, sf)
    best = resolve.best_candidate(resolve.match_candidates(src, canon, tiers))
    return _with_names(best.withColumn("jaccard", F.round("jaccard", 6)), src)


@query(_tier_oracle(v.TIER_EQUAL))
def join_equal_names(spark, sf):
    """Best candidate of every name among those with an equal normalized form."""
    return _best_of(spark, sf, (v.TIER_EQUAL,))


@query(_tier_oracle(v.TIER_SUBSET))
def join_token_subset(spark, sf):
    return _best_of(spark, sf, (v.TIER_SUBSET,))


@query(_tier_oracle(v.TIER_SHORT))
def join_short_name(spark, sf):
    return _best_of(spark, sf, (v.TIER_SHORT,))


@query(_tier_oracle(v.TIER_OVERLAP))
def join_token_jaccard(spark, sf):
    return _best_of(spark, sf, (v.TIER_OVERLAP,))


@query(
    f"""WITH {duck.fixture_match()} SELECT s.company, s.short_name, CAST(max(tier) AS INTEGER) AS score
FROM scored JOIN s_names s USING (sid) GROUP BY s.company, s.short_name"""
)
def match_score(spark, sf):
    src, canon = _names(spark, sf)
    scores = resolve.match_candidates(src, canon).groupBy("src").agg(F.max("tier").alias("score"))
    return _with_names(scores, src)


@query(
    f"""WITH {duck.fixture_match()} SELECT s.company, s.short_name, CAST(tier AS INTEGER) AS tier, round(jaccard, 6) AS jaccard, ambiguous,
       CASE WHEN NOT ambiguous THEN slug END AS slug FROM best JOIN s_names s USING (sid)"""
)
def best_candidate(spark, sf):
    return _best_of(spark, sf, ALL_TIERS)


@query(
    f"""WITH {duckdb_views('fx_primary_raw')}, i AS (SELECT slug, ord, unnest({duck.tokens('company')}) AS token FROM fx_primary_raw)
SELECT token, count(*) AS n_records, arg_min(slug, ord) AS slug FROM i GROUP BY token"""
)
def token_index(spark, sf):
    canon = canonical_names(ops.normalize_listings(view(spark, sf, "fx_primary_raw")))
    return resolve.token_index(canon).select("token", F.col("n_records").cast("bigint").alias("n_records"), "slug")


@query(
    f"""WITH {duckdb_views('fx_primary_raw')}, i AS (SELECT slug, ord + 1000000000000 * (ord % 3) AS ord, unnest({duck.tokens('company')}) AS token FROM fx_primary_raw)
SELECT token, count(*) AS n_records, arg_min(slug, ord) AS slug FROM i GROUP BY token"""
)
def token_index_kept(spark, sf):
    """The index as the stored book keeps it, after three batches that hold all listings between them."""
    root, listings = scratch_path(spark, "book"), ops.normalize_listings(view(spark, sf, "fx_primary_raw"))
    for batch in range(3):
        merge_batch(spark, root, listings.filter(F.col("ord") % 3 == batch), F.lit("2024-01-01").cast("timestamp"))
    return kept_token_index(spark, root).select("token", F.col("n_records").cast("bigint").alias("n_records"), "slug")


_HINTED = f"""{duckdb_views('fx_primary_raw', 'fx_secondary_raw')},
h AS (SELECT DISTINCT company, {duck.identity(duck.tokens('company'))} AS ids FROM fx_secondary_raw),
ht AS (SELECT company, len(ids) AS n, unnest(ids) AS t FROM h),
pt AS (SELECT slug, company AS canon, unnest({duck.tokens('company')}) AS t FROM fx_primary_raw)"""


def _hints(spark, sf) -> tuple[DataFrame, DataFrame]:
    hints = view(spark, sf, "fx_secondary_raw").select("company").distinct().selectExpr("company AS src", "company AS hint")
    return hints, stage(canonical_names(ops.normalize_listings(view(spark, sf, "fx_primary_raw"))), "primary-names")


@query(
    f"""WITH {_HINTED}, full_hits AS (SELECT company, slug FROM ht JOIN pt USING (t) GROUP BY company, slug, n HAVING count(*) = n)
SELECT company, min(slug) AS slug FROM full_hits GROUP BY company HAVING count(*) = 1"""
)
def unique_token_match(spark, sf):
    """Every secondary name, scored or not."""
    return resolve.unique_token_match(*_hints(spark, sf)).withColumnRenamed("src", "company")


@query(
    f"""WITH {_HINTED}, df AS (SELECT t, count(*) AS n, min(slug) AS slug, min(canon) AS canon FROM pt GROUP BY t),
hit AS (SELECT company, count(*) AS present, max(df.n) AS df, max(slug) AS slug, max(canon) AS canon FROM ht JOIN df USING (t) GROUP BY company)
SELECT company, slug FROM hit WHERE present = 1 AND df = 1 AND length({duck.norm('canon')}) >= 4
  AND (starts_with({duck.norm('company')}, {duck.norm('canon')}) OR starts_with({duck.norm('canon')}, {duck.norm('company')}))"""
)
def unique_prefix_match(spark, sf):
    return resolve.unique_prefix_match(*_hints(spark, sf)).withColumnRenamed("src", "company")


_RESOLVED = """SELECT x.ord, x.company, r.slug AS matched_slug
FROM fx_secondary_raw x LEFT JOIN resolved r ON r.company = x.company AND r.short_name = coalesce({short}, '')"""


@query(f"WITH {duck.fixture_match()} {_RESOLVED.format(short='x.short_name')}")
def resolve_entities(spark, sf):
    listings = ops.normalize_listings(view(spark, sf, "fx_secondary_raw"), keep_short_name=True)
    book = ops.normalize_listings(view(spark, sf, "fx_primary_raw"))
    return resolve.resolve_entities(listings, book, view(spark, sf, "fx_alias")).select("ord", "company", "matched_slug")


@query(f"WITH {duck.fixture_match(keep_short=False)} {_RESOLVED.format(short='NULL')}", name="resolve_entities_by_name")
def resolve_entities_by_name(spark, sf):
    """As the batch job resolves: without short names."""
    listings = ops.normalize_listings(view(spark, sf, "fx_secondary_raw"))
    book = ops.normalize_listings(view(spark, sf, "fx_primary_raw"))
    return resolve.resolve_entities(listings, book, view(spark, sf, "fx_alias")).select("ord", "company", "matched_slug")
