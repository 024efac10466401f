"""The batch job on a stored book: a batch reads and rewrites the buckets it touches, and no others.

What a batch needs of the other records is little, and is kept beside them: their names (for matching), and the
postings of the names' tokens (the index that the fallbacks look up). Both are bucketed and rewritten where the
batch changes them, like the records.

Leftovers (secondary records without a match) were looked at by the batches before. Only those that share a match
key with a primary name that came, went or changed its record are resolved again; all of them, if the book was
written as a whole or the alias table is another one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotebook.operators.candidates import MatchLimits
from quotebook.operators.listings import BATCH_STRIDE
from quotebook.operators.merge import (
    affected_leftovers,
    changed_names,
    leftover_matches,
    merge_backup,
    reconcile_leftovers,
    run_summary,
    upsert_primary,
    upsert_secondary_only,
)
from quotebook.operators.resolve import index_of_postings, primary_names, resolve_entities, source_key
from quotebook.schemas import BOOK_SCHEMA
from quotebook.session import stage
from quotebook.sources.book import (
    MIN_BUCKETS,
    NAMES_SCHEMA,
    POSTINGS_SCHEMA,
    names_of,
    newest,
    parts_for,
    postings_of,
    write_book,
)
from quotebook.sources.versions import (
    Part,
    Version,
    VersionTaken,
    buckets_of,
    commit,
    describe,
    read_part,
)

#: The book is dealt over twice as many buckets when they hold more records than this on average.
FULL_BUCKET = 2_000_000


@dataclass(frozen=True)
class Merged:
    version: int
    summary: DataFrame
    #: Buckets of records that were rewritten, of how many.
    touched: int
    n_buckets: int
    #: Leftovers that were resolved again, of how many.
    resolved_again: int
    n_leftovers: int


class _Stored:
    """A version's records, names and postings, read by bucket."""

    def __init__(self, spark: SparkSession, root: str, base: Version | None, parts: dict[str, Part]):
        self.spark, self.root, self.base, self.parts = spark, root, base, parts

    def buckets(self, part: str, keys: DataFrame) -> list[int]:
        return buckets_of(keys, self.parts[part].key, self.parts[part].n_buckets)

    def read(self, part: str, buckets: list[int] | None = None) -> DataFrame:
        return read_part(self.spark, self.root, self.base, part, self.parts[part].schema, buckets)

    def records(self, slugs: DataFrame) -> DataFrame:
        """The records of these slugs (distinct)."""
        return self.read("records", self.buckets("records", slugs)).join(slugs, "slug", "left_semi")

    def replaced(self, part: str, buckets: list[int], gone: DataFrame, new: DataFrame) -> DataFrame:
        """The new rows of these buckets: without the rows of the slugs that are gone or written anew, with the new ones."""
        return self.read(part, buckets).join(gone, "slug", "left_anti").unionByName(new)


def _fingerprint(aliases: DataFrame | None) -> str:
    if aliases is None:
        return ""
    row = aliases.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*sorted(aliases.columns)).cast("decimal(38,0)"))).first()
    return f"{row[0]}:{row[1]}"


def merge_batch(
    spark: SparkSession,
    root: str,
    listings: DataFrame,
    batch_ts: Column,
    aliases: DataFrame | None = None,
    primary: str = "primary",
    secondary: str = "secondary",
    limits: MatchLimits = MatchLimits(),
    writer: str | None = None,
    n_buckets: int = MIN_BUCKETS,
) -> Merged:
    """Merge normalized listings into the book at ``root`` as its next version.

    If another writer's version comes first, the batch is merged again, into that one. ``n_buckets`` counts for a
    new book only.
    """
    scraped = stage(listings, "incoming")
    while True:
        try:
            return _merge_once(spark, root, scraped, batch_ts, aliases, primary, secondary, limits, writer, n_buckets)
        except VersionTaken:
            continue


def _union(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _merge_once(spark, root, scraped, batch_ts, aliases, primary, secondary, limits, writer, n_buckets) -> Merged:
    number = newest(spark, root)
    base = None if number is None else describe(spark, root, number)
    if number is not None and base is None:
        # A book kept as one folder is dealt into buckets first.
        from quotebook.sources.book import read_version

        number = write_book(read_version(spark, root, number), root, primary=primary)
        base = describe(spark, root, number)
    if base is not None:
        n_buckets = base.n_buckets["records"]
    parts = parts_for(n_buckets)
    old = _Stored(spark, root, base, parts)
    ord_base = (0 if base is None else base.number + 1) * BATCH_STRIDE
    rows = scraped.filter(F.col("slug") != "")
    is_secondary = F.col("source").eqNullSafe(secondary)
    ours, theirs = rows.filter(~is_secondary), rows.filter(is_secondary)
    old_names = old.read("names")

    # Primary rows change the records of their slugs.
    own_slugs = stage(ours.select("slug").distinct(), "own-slugs")
    upserted = stage(upsert_primary(old.records(own_slugs), ours, batch_ts, ord_base), "book-primary")
    names = stage(_union(old_names.join(own_slugs, "slug", "left_anti"), names_of(upserted)), "names")
    fresh = stage(postings_of(names_of(upserted), primary), "fresh-postings")
    index = index_of_postings(_union(old.read("postings").join(own_slugs, "slug", "left_anti"), fresh))

    # Secondary rows go into the record they denote, or into one of their own.
    canon = primary_names(names, primary)
    resolved = stage(resolve_entities(theirs, names, aliases, primary, limits, index, canon), "matched")
    unmatched = resolved.filter(F.col("matched_slug").isNull())
    their_slugs = stage(
        resolved.select(F.coalesce("matched_slug", "slug").alias("slug")).distinct().join(own_slugs, "slug", "left_anti"),
        "their-slugs",
    )
    working = stage(_union(upserted, old.records(their_slugs)), "working")
    merged = merge_backup(working, resolved, batch_ts)
    with_secondary = stage(upsert_secondary_only(merged, unmatched, batch_ts, ord_base), "book-secondary")
    slugs = stage(_union(own_slugs, their_slugs), "slugs")
    names = stage(_union(old_names.join(slugs, "slug", "left_anti"), names_of(with_secondary)), "names-merged")

    # Older secondary records that denote a primary one now are folded in.
    leftovers = names.filter(F.col("source") == secondary)
    before = old_names.join(slugs, "slug", "left_semi")
    overwritten = not unmatched.join(
        _union(names_of(upserted), before).filter(F.col("source") == primary), "slug", "left_semi"
    ).isEmpty()
    # Without overwritten records the primary names are those of the first resolution.
    settled, canon = (None, None) if overwritten else (unmatched, canon)
    facts = {"reconciled": "yes", "aliases": _fingerprint(aliases)}
    n_leftovers = leftovers.count()
    if base is not None and base.facts == facts:
        changed = stage(changed_names(before, names_of(with_secondary), primary), "changed-names")
        # A record that this batch wrote is looked at again, too: its name may be another one.
        again = _union(affected_leftovers(leftovers, changed, aliases, limits), leftovers.join(slugs, "slug", "left_semi").select("slug"))
        asked = stage(again.distinct(), "asked")
    else:
        asked = stage(leftovers.select("slug"), "asked")
    if settled is not None:
        known = settled.select(source_key().alias("src")).distinct()
        keyed = leftovers.withColumn("src", source_key()).join(known, "src", "left_anti").select("slug")
        asked = stage(asked.join(keyed, "slug", "left_semi"), "asked-open")
    elsewhere = asked.join(slugs, "slug", "left_anti")
    looked_at = _union(with_secondary.join(asked, "slug", "left_semi"), old.records(stage(elsewhere, "asked-elsewhere")))
    gone = stage(
        leftover_matches(names, aliases, primary, secondary, leftovers=looked_at, limits=limits, known=canon), "reconciled"
    )
    also = stage(
        _union(gone.select("slug"), gone.select(F.col("matched_slug").alias("slug"))).distinct().join(slugs, "slug", "left_anti"),
        "folded-slugs",
    )
    final = stage(
        reconcile_leftovers(_union(with_secondary, old.records(also)), gone).select(*BOOK_SCHEMA.names), "touched"
    )

    # The buckets of what changed are written anew.
    touched_slugs = stage(_union(slugs, also), "touched-slugs")
    buckets = old.buckets("records", touched_slugs)
    # Names that stay as they are keep their postings.
    new_postings = postings_of(names_of(final), primary)
    old_postings = postings_of(old_names.join(touched_slugs, "slug", "left_semi"), primary)
    added, lost = stage(new_postings.exceptAll(old_postings), "added"), stage(old_postings.exceptAll(new_postings), "lost")
    moved = _union(added, lost)
    token_buckets = old.buckets("postings", moved.select("token").distinct())
    kept_postings = old.read("postings", token_buckets).exceptAll(lost).unionByName(added)
    new_parts = {
        "records": (parts["records"], old.replaced("records", buckets, touched_slugs, final), buckets),
        "names": (parts["names"], old.replaced("names", buckets, touched_slugs, names_of(final)), buckets),
        "postings": (parts["postings"], kept_postings, token_buckets),
    }
    summary = run_summary(old_names, ours, resolved, gone).withColumn("scraped", F.lit(scraped.count()).cast("bigint"))
    made = commit(spark, root, base, new_parts, facts, writer)
    result = Merged(made, stage(summary, "summary"), len(buckets), n_buckets, asked.count(), n_leftovers)
    version = describe(spark, root, made)
    held = read_part(spark, root, version, "names", NAMES_SCHEMA).count()
    if held > FULL_BUCKET * n_buckets:
        write_book(read_part(spark, root, version, "records", BOOK_SCHEMA), root, n_buckets=2 * n_buckets, primary=primary)
    return result


def kept_token_index(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """token -> number of primary records with it, and the first of them, from the kept postings."""
    version = describe(spark, root, newest(spark, root) if number is None else number)
    return index_of_postings(read_part(spark, root, version, "postings", POSTINGS_SCHEMA))
