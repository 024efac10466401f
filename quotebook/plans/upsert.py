"""The batch job: merge a batch of listings into a book, in memory or stored, and publish it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotebook.operators.candidates import MatchLimits
from quotebook.operators.listings import (
    BATCH_STRIDE,
    filter_source,
    normalize_listings,
    priority_semi_join,
    union_sources,
)
from quotebook.operators.merge import (
    leftover_matches,
    merge_backup,
    reconcile_leftovers,
    run_summary,
    upsert_primary,
    upsert_secondary_only,
)
from quotebook.operators.publish import write_published
from quotebook.operators.resolve import primary_names, resolve_entities
from quotebook.plans.buckets import merge_batch
from quotebook.session import stage
from quotebook.sources.book import read_book


SUMMARY = ("scraped", "inserted", "updated", "removed")


@dataclass
class UpsertResult:
    book: DataFrame
    summary: DataFrame


def upsert_stocks(
    book: DataFrame,
    incoming: DataFrame,
    batch_ts: Column,
    aliases: DataFrame | None = None,
    batch: int = 0,
    primary: str = "primary",
    secondary: str = "secondary",
    limits: MatchLimits = MatchLimits(),
) -> UpsertResult:
    """Merge one batch of normalized listings (see ``normalize_listings``) into the book.

    Primary rows are upserted first; then all secondary rows are resolved in one pass against
    that snapshot, merged or kept as records of their own, and older secondary records are
    folded away. Each snapshot is written once, since several later steps read it.
    """
    base = batch * BATCH_STRIDE
    scraped = stage(incoming, "incoming")
    rows = scraped.filter(F.col("slug") != "")
    is_secondary = F.col("source").eqNullSafe(secondary)
    ours, theirs = rows.filter(~is_secondary), rows.filter(is_secondary)

    snapshot = stage(upsert_primary(book, ours, batch_ts, base), "book-primary")
    known = primary_names(snapshot, primary)
    resolved = stage(resolve_entities(theirs, snapshot, aliases, primary, limits, known=known), "matched")
    merged = merge_backup(snapshot, resolved, batch_ts)
    unmatched = resolved.filter(F.col("matched_slug").isNull())
    with_secondary = stage(upsert_secondary_only(merged, unmatched, batch_ts, base), "book-secondary")
    # Names just found to match nothing need no second look, as long as no primary record was
    # overwritten in between, which would change what they are compared with. Else the primary names are the same, too.
    overwritten = unmatched.join(snapshot.filter(F.col("source") == primary).select("slug"), "slug", "left_semi")
    settled, known = (unmatched, known) if overwritten.isEmpty() else (None, None)
    gone = stage(
        leftover_matches(with_secondary, aliases, primary, secondary, settled, limits=limits, known=known), "reconciled"
    )
    return UpsertResult(
        book=reconcile_leftovers(with_secondary, gone),
        # Rows without a slug were scraped, too, although they go no further.
        summary=run_summary(book, ours, resolved, gone).withColumn("scraped", F.lit(scraped.count()).cast("bigint")),
    )


def run_batch(
    root: str,
    primary_raw: DataFrame | tuple[DataFrame, ...],
    secondary_raw: DataFrame,
    batch_ts: Column,
    aliases: DataFrame | None = None,
    priority: DataFrame | None = None,
    source: str = "all",
    keep_short_name: bool = False,
    publish_to: str | None = None,
) -> DataFrame:
    """Raw listings of all sources to a new committed version of the book at ``root``.

    ``primary_raw`` may be several sources, in order; none of them is itself a union of ranked sources.

    With ``priority`` only listed slugs are taken; an empty list leaves everything as it is. Returns the
    run summary.
    """
    ours = primary_raw if isinstance(primary_raw, tuple) else (primary_raw,)
    spark = secondary_raw.sparkSession
    if priority is not None and priority.isEmpty():
        return spark.range(1).select(*[F.lit(0).cast("bigint").alias(c) for c in SUMMARY])
    # The caller's source choice is applied before any work on the other source.
    listings = normalize_listings(
        filter_source(union_sources(*ours, secondary_raw), source), keep_short_name
    )
    if priority is not None:
        listings = priority_semi_join(listings, priority)
    result = merge_batch(spark, root, listings, batch_ts, aliases)
    if publish_to:
        write_published(read_book(spark, root, before=result.version + 1), publish_to)
    return result.summary

