"""Which primary record a secondary listing denotes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotebook.functions.names import (
    identity_tokens,
    name_tokens,
    normalize_for_match,
    token_jaccard,
)
from quotebook.functions.vocabulary import AMBIGUITY_GAP, TIER_EQUAL
from quotebook.operators.candidates import (
    ALL_TIERS,
    MatchLimits,
    subsets,
    canonical_names,
    contained_pairs,
    longest_sets,
    tier_candidates,
    variant_features,
)
from quotebook.session import stage

# Names with at least this many rows are joined by broadcast, the most frequent ones only.
HEAVY_NAME_ROWS = 100_000
HEAVY_NAMES = 1_000


@dataclass(frozen=True)
class PrimaryNames:
    """The primary names of a book and their variants, both written. Resolutions against the same names share them."""

    names: DataFrame
    variants: DataFrame


def primary_names(book: DataFrame, primary: str = "primary") -> PrimaryNames:
    names = stage(canonical_names(book, primary), "primary-names")
    return PrimaryNames(names, stage(variant_features(names, "canon", "canon"), "primary-variants"))


def source_key() -> Column:
    """One text per (company, short name) pair."""
    return F.concat_ws("\x01", F.coalesce("company", F.lit("")), F.coalesce("short_name", F.lit("")))


def source_names(listings: DataFrame) -> DataFrame:
    """Distinct (company, short name) pairs to resolve, with their number of rows and the
    tokens of the company name."""
    short = F.col("short_name") if "short_name" in listings.columns else F.lit("")
    return (
        listings.filter(F.col("company") != "")
        .groupBy("company", F.coalesce(short, F.lit("")).alias("short_name"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(
            source_key().alias("src"),
            "company",
            "short_name",
            "n_rows",
            F.expr(name_tokens("company")).alias("src_tokens"),
        )
    )


def alias_lookup(names: DataFrame, aliases: DataFrame) -> DataFrame:
    """Add ``mapped_name``: the alias entry with exactly this name, else the first entry with
    the same normalized form. ``aliases`` is (ord, secondary_name, primary_name)."""
    # A repeated name keeps its first place and its last value.
    entries = aliases.groupBy("secondary_name").agg(
        F.max_by("primary_name", "ord").alias("primary_name"), F.min("ord").alias("ord")
    )
    exact = entries.select(F.col("secondary_name").alias("company"), F.col("primary_name").alias("exact_name"))
    by_key = (
        entries.withColumn("alias_key", F.expr(normalize_for_match("secondary_name")))
        .filter(F.col("alias_key") != "")
        .groupBy("alias_key")
        .agg(F.min_by("primary_name", "ord").alias("key_name"))
    )
    return (
        names.withColumn("alias_key", F.expr(normalize_for_match("company")))
        .join(exact, "company", "left")
        .join(by_key, "alias_key", "left")
        .withColumn("mapped_name", F.coalesce("exact_name", "key_name"))
        .drop("alias_key", "exact_name", "key_name")
    )


def match_candidates(
    src: DataFrame,
    canon: DataFrame,
    tiers: tuple = ALL_TIERS,
    limits: MatchLimits = MatchLimits(),
    can_features: DataFrame | None = None,
) -> DataFrame:
    """Best tier of each candidate pair with the similarity of the full names.

    ``src`` is the output of ``source_names``, with ``mapped_name`` where aliases apply. ``can_features`` are the
    written variants of ``canon`` if there are any.
    """
    hints = ["mapped_name", "company", "short_name"] if "mapped_name" in src.columns else ["company", "short_name"]
    # Variants feed six branches each, so they are written once.
    src_features = stage(variant_features(src, "src", *hints), "secondary-variants")
    if can_features is None:
        can_features = stage(variant_features(canon, "canon", "canon"), "primary-variants")
    pairs = (
        tier_candidates(src, canon, src_features, can_features, tiers, limits)
        .groupBy("src", "canon")
        .agg(F.max("tier").alias("tier"))
    )
    # The last join leaves the pairs partitioned by name, as the ranking needs them.
    return (
        pairs.join(canon, "canon")
        .join(src.select("src", "src_tokens"), "src")
        .withColumn("jaccard", F.expr(token_jaccard("src_tokens", "canon_tokens")))
        .drop("src_tokens", "canon_tokens")
    )


def best_candidate(candidates: DataFrame) -> DataFrame:
    """The best candidate of each name: highest tier, most similar, first in the book.

    ``slug`` is null where the choice is ambiguous: below the top tier, with a runner-up of the
    same tier that is about as similar. A second record of the same name is such a runner-up.
    """
    order = Window.partitionBy("src").orderBy(F.desc("tier"), F.desc("jaccard"), "ord")
    top = candidates.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= 2)
    first, second = F.col("rank") == 1, F.col("rank") == 2

    def at(which, name: str):
        return F.max(F.when(which, F.col(name)))

    per_name = top.groupBy("src").agg(
        at(first, "tier").cast("int").alias("tier"),
        at(first, "jaccard").alias("jaccard"),
        at(first, "slug").alias("best_slug"),
        at(first, "canon").alias("canon"),
        at(first, "n_records").alias("n_records"),
        at(second, "tier").alias("next_tier"),
        at(second, "jaccard").alias("next_jaccard"),
    )
    close = (F.col("next_tier") == F.col("tier")) & (
        F.abs(F.col("jaccard") - F.col("next_jaccard")) < AMBIGUITY_GAP
    )
    ambiguous = (F.col("tier") < TIER_EQUAL) & (F.coalesce(close, F.lit(False)) | (F.col("n_records") > 1))
    return per_name.select(
        "src",
        "tier",
        "jaccard",
        ambiguous.alias("ambiguous"),
        F.when(~ambiguous, F.col("best_slug")).alias("slug"),
    )


def token_index(canon: DataFrame) -> DataFrame:
    """token -> number of primary records with it, and the first of them."""
    return (
        canon.select("canon", "slug", "ord", "n_records", F.explode("canon_tokens").alias("token"))
        .groupBy("token")
        .agg(
            F.sum("n_records").alias("n_records"),
            F.min_by("slug", "ord").alias("slug"),
            F.min_by("canon", "ord").alias("canon"),
        )
    )


def unique_token_match(hints: DataFrame, canon: DataFrame, limits: MatchLimits = MatchLimits()) -> DataFrame:
    """(src, slug) where the identity tokens of a name occur together in exactly one record.

    ``hints`` is (src, hint). Canonical names list the subsets of those identity tokens that
    any hint has, counted per subset, so a hint is one lookup; longer canonical names are found
    by their rarest token.
    """
    def identity(tokens: str) -> Column:
        return F.expr(f"sort_array({identity_tokens(tokens)})")

    own = hints.select("src", identity(name_tokens("hint")).alias("tokens")).filter(F.size("tokens") > 0)
    own = stage(own, "hints")
    asked = stage(own.select(F.explode("tokens").alias("t")).distinct(), "hint-tokens")
    index = (
        canon.select("canon", F.explode(F.expr(identity_tokens("canon_tokens"))).alias("t"))
        .join(asked, "t", "left_semi")
        .groupBy("canon")
        .agg(F.sort_array(F.collect_list("t")).alias("tokens"))
        .join(canon, "canon")
    )
    index = stage(index.select("canon", "slug", "ord", "n_records", "tokens"), "asked-names")
    n = F.size("tokens")
    sets = (
        index.filter(n <= limits.subset_tokens)
        .select("slug", "ord", "n_records", F.explode(F.expr(subsets("tokens", "size(tokens)"))).alias("s"))
        .filter(F.col("s.n") > 0)
        .groupBy(F.col("s.k").alias("k"))
        .agg(F.sum("n_records").alias("n_records"), F.min_by("slug", "ord").alias("slug"))
    )
    found = (
        own.select("src", F.concat(F.lit("|"), F.array_join("tokens", "|")).alias("k"))
        .join(sets, "k")
        .select("src", "slug", "n_records")
    )
    if longest_sets(index)[0] > limits.subset_tokens:
        long = index.filter(n > limits.subset_tokens)
        found = found.unionByName(
            contained_pairs(own, long.select("canon", "tokens"), "src", "canon")
            .join(index, "canon")
            .select("src", "slug", "n_records")
        )
    return (
        found.groupBy("src")
        .agg(F.sum("n_records").alias("n"), F.min("slug").alias("slug"))
        .filter(F.col("n") == 1)
        .select("src", "slug")
    )


def index_of_postings(postings: DataFrame) -> DataFrame:
    """The token index from kept postings (token, canon, slug, ord), one per record and token."""
    return postings.groupBy("token").agg(
        F.count(F.lit(1)).alias("n_records"), F.min_by("slug", "ord").alias("slug"), F.min_by("canon", "ord").alias("canon")
    )


def unique_prefix_match(hints: DataFrame, canon: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """(src, slug) where one identity token of a name occurs in the index, in a single record,
    and one of the two normalized names starts with the other. ``index`` is the token index of ``canon`` if kept."""
    own = hints.select(
        "src", "hint", F.explode(F.expr(identity_tokens(name_tokens("hint")))).alias("token")
    )
    own = stage(own, "hint-words")
    # Postings of other tokens go before they are gathered.
    asked = stage(own.select("token").distinct(), "hint-tokens")
    index = (token_index(canon) if index is None else index).join(asked, "token", "left_semi")
    present = (
        own.join(index, "token")
        .groupBy("src")
        .agg(
            F.count(F.lit(1)).alias("n_present"),
            F.max("n_records").alias("n_records"),
            F.max("hint").alias("hint"),
            F.max("canon").alias("canon"),
            F.max("slug").alias("slug"),
        )
        .filter((F.col("n_present") == 1) & (F.col("n_records") == 1))
    )
    mine, theirs = F.expr(normalize_for_match("hint")), F.expr(normalize_for_match("canon"))
    prefix = F.startswith(mine, theirs) | F.startswith(theirs, mine)
    return present.filter((mine != "") & (F.length(theirs) >= 4) & prefix).select("src", "slug")


def resolve_names(
    src: DataFrame,
    canon: DataFrame,
    limits: MatchLimits = MatchLimits(),
    index: DataFrame | None = None,
    can_features: DataFrame | None = None,
) -> DataFrame:
    """(src, slug, step) for every name that resolves; step 0 is a scored match, 1-4 the
    fallbacks, which apply only to names without any scored candidate. Both inputs are read
    several times and should be staged."""
    scored = stage(best_candidate(match_candidates(src, canon, limits=limits, can_features=can_features)), "scored")
    found = scored.filter(F.col("slug").isNotNull()).select("src", "slug", F.lit(0).alias("step"))
    rest = stage(src.join(scored, "src", "left_anti"), "unscored")
    if not rest.isEmpty():
        # Both name columns go through each fallback together, told apart by the step.
        def hints(first_step: int) -> DataFrame:
            asked = F.explode(F.array(*[
                F.struct(F.struct("src", F.lit(first_step + i).alias("step")).alias("src"), F.col(c).alias("hint"))
                for i, c in enumerate(("company", "short_name"))
            ]))
            return rest.select(asked.alias("a")).select("a.*").filter(F.col("hint") != "")

        for match in (unique_token_match(hints(1), canon, limits), unique_prefix_match(hints(3), canon, index)):
            found = found.unionByName(match.select("src.src", "slug", "src.step"))
    return found.groupBy("src").agg(F.min_by("slug", "step").alias("slug"), F.min("step").alias("step"))


def split_join(rows: DataFrame, lookup: DataFrame, key: str, heavy: DataFrame) -> DataFrame:
    """Left join to a table with one row per key. Rows of heavy keys stay where they are and
    meet a broadcast copy of their few lookup rows; the others are shuffled.

    ``heavy`` lists at most ``HEAVY_NAMES`` keys, which bounds both broadcasts.
    """
    heavy = F.broadcast(heavy)
    few = F.broadcast(lookup.join(heavy, key, "left_semi"))
    spread = rows.join(heavy, key, "left_anti").join(lookup, key, "left")
    return spread.unionByName(rows.join(heavy, key, "left_semi").join(few, key, "left"))


def resolve_entities(
    listings: DataFrame,
    book: DataFrame,
    aliases: DataFrame | None = None,
    primary: str = "primary",
    limits: MatchLimits = MatchLimits(),
    index: DataFrame | None = None,
    known: PrimaryNames | None = None,
) -> DataFrame:
    """Listings with ``matched_slug``: the primary record of the book each one denotes, or null.

    Of the book only slug, source, company and ord are read. ``index`` is its token index if one is kept, ``known``
    its primary names if they are written already."""
    names = source_names(listings)
    src = stage(names if aliases is None else alias_lookup(names, aliases), "secondary-names")
    known = primary_names(book, primary) if known is None else known
    resolved = stage(
        resolve_names(src, known.names, limits, index, known.variants).select("src", F.col("slug").alias("matched_slug")), "resolved"
    )
    # Written once: its three uses must agree on the names.
    heaviest = src.filter(F.col("n_rows") >= HEAVY_NAME_ROWS).orderBy(F.desc("n_rows"), "src").limit(HEAVY_NAMES)
    heavy = stage(heaviest.select("src"), "heavy-names")
    if "short_name" not in listings.columns:
        listings = listings.withColumn("short_name", F.lit(None).cast("string"))
    keyed = listings.withColumn("src", source_key())
    return split_join(keyed, resolved, "src", heavy).drop("src")
