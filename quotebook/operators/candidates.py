"""Candidate pairs of the name matcher, without pairwise comparison.

Names are compared once per distinct spelling. Each tier is turned into equality of derived
keys, so that sharing a key *is* the match and nothing has to be verified afterwards:

  equal    the normalized forms are equal
  short    a normalized form equals a parenthesised chunk or an acronym
  subset   one side's whole token set equals a subset of the other side's tokens
  overlap  both sides contain the same set that is large enough for the Jaccard threshold

Token subsets are listed for names of up to ``LISTED_TOKENS`` (subset tier) and
``OVERLAP_TOKENS`` (overlap tier) tokens; longer sets are compared once per distinct set, found
through the rarest token and verified, and the sets that match become keys too (``_long_keys``).
A name of n tokens has 2^n subsets, so that a few names of eight would make most of all keys.

A key shared by many canonical names ("(India)") would make quadratically many pairs. Only the
two best candidates of a tier can decide a resolution, best by Jaccard similarity of the full
names and then by book order, so pairs in such a group are reduced to those (``_heavy_pairs``):

  * canonical names sharing a token that is rare in the group are taken one by one;
  * the others share frequent tokens only. For each set I of frequent tokens it is enough to
    keep the two canonical names containing I with the fewest tokens (then earliest): for a name
    s whose common part with the true best name is I, any name with I and no more tokens is at
    least as similar to s. So looking up every frequent subset of s meets the true best two.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotebook.functions.names import NO_TOKENS, identity_tokens, name_tokens, name_variants, normalize_for_match, short_keys
from quotebook.functions.vocabulary import (
    MIN_OVERLAP,
    TIER_EQUAL,
    TIER_OVERLAP,
    TIER_SHORT,
    TIER_SUBSET,
)
from quotebook.session import stage

ALL_TIERS = (TIER_EQUAL, TIER_SUBSET, TIER_SHORT, TIER_OVERLAP)


@dataclass(frozen=True)
class MatchLimits:
    """How the pairs are found; no value here changes the result."""

    subset_tokens: int = 8
    # Of these the subset tier lists so many at most; the keys that tell which names a batch changes list all.
    listed_tokens: int = 5
    overlap_tokens: int = 16
    # Groups of more canonical names than this are heavy, judged on one in ``heavy_sample`` names.
    heavy_group: int = 512
    heavy_sample: int = 16
    heavy_tokens: int = 10

    @property
    def listed(self) -> int:
        return min(self.subset_tokens, self.listed_tokens)


# --- subsets -----------------------------------------------------------------------------------


def subsets(tokens: str, most_dropped: str) -> str:
    """SQL text: the subsets of a sorted token array with at most so many tokens left out.

    array<struct<n: size, dropped, k: joined tokens>>, grown token by token.
    """
    taken = "transform(acc, s -> named_struct('n', s.n + 1, 'dropped', s.dropped, 'k', concat(s.k, '|', t)))"
    left = (
        f"transform(filter(acc, s -> s.dropped < {most_dropped}), "
        "s -> named_struct('n', s.n, 'dropped', s.dropped + 1, 'k', s.k))"
    )
    start = "array(named_struct('n', 0, 'dropped', 0, 'k', ''))"
    return f"aggregate({tokens}, {start}, (acc, t) -> concat({taken}, {left}))"


def _joined(tokens: str) -> str:
    return f"concat('|', array_join({tokens}, '|'))"


def chosen(tokens: str, most: int, bits: str = "i") -> str:
    """SQL text: the tokens of a subset, joined as in ``subsets``. The subset is a number with a bit per place in an
    array of up to ``most`` tokens; exploding numbers and joining afterwards is compiled, a lambda is not."""
    parts = [f"if({bits} & {1 << at} != 0, concat('|', get({tokens}, {at})), '')" for at in range(most)]
    return f"concat({', '.join(parts)})"


def least_overlap(n: str) -> str:
    """Fewest common tokens a set of n needs for the threshold, safe against rounding."""
    return f"cast(ceil(({n}) * {MIN_OVERLAP}D - 1e-9D) AS int)"


# --- names and their variants ------------------------------------------------------------------


def canonical_names(book: DataFrame, primary: str = "primary") -> DataFrame:
    """Distinct company names of primary records: first slug and order, number of records,
    and the tokens of the name."""
    return (
        book.filter((F.col("source") == primary) & (F.col("company") != ""))
        .groupBy(F.col("company").alias("canon"))
        .agg(
            F.min_by("slug", "ord").alias("slug"),
            F.min("ord").alias("ord"),
            F.count(F.lit(1)).alias("n_records"),
        )
        .withColumn("canon_tokens", F.expr(name_tokens("canon")))
    )


def variant_features(names: DataFrame, key: str, *hints: str) -> DataFrame:
    """(key, variant, norm, tokens, shorts) for every variant of the hint columns."""
    variants = f"array_distinct(concat({', '.join(name_variants(h) for h in hints)}))"
    return names.selectExpr(key, f"explode({variants}) AS variant").selectExpr(
        key,
        "variant",
        f"{normalize_for_match('variant')} AS norm",
        f"sort_array({name_tokens('variant')}) AS tokens",
        f"{short_keys('variant')} AS shorts",
    )


# --- match keys --------------------------------------------------------------------------------


def _keys(
    features: DataFrame, key: str, tiers: tuple, limits: MatchLimits, secondary: bool, most: int | None = None
) -> DataFrame:
    """(key, tier, g): rows of the two sides match at ``tier`` exactly when they share (tier, g).

    The subset tier lists names of up to ``most`` tokens (``limits.subset_tokens`` unless given)."""
    most = limits.subset_tokens if most is None else most
    n = "size(tokens)"
    # A row's keys are numbers first, each made into its text after they are exploded: no lambda, so that all is compiled.
    # Positive numbers are sets of tokens, a bit per place in the sorted array.
    none = "cast(array() AS array<int>)"
    numbers, texts = [], []
    common = "cast(null AS array<string>)"

    def add(when: str, items: str, this: str, tier: int, text: str) -> None:
        numbers.append(f"if({when}, {items}, {none})")
        texts.append((this, tier, text))

    def add_all(array: str, first: int, tier: int, text: str) -> None:
        # Places of an array: every second number from the first one down.
        place = f"cast(({first} - i) / 2 AS int)"
        add(f"size({array}) > 0", f"sequence({first}, {first} - 2 * (size({array}) - 1), -2)",
            f"i <= {first} AND i % 2 = {-(-first % 2)}", tier, text.format(f"get({array}, {place})"))

    if TIER_EQUAL in tiers:
        add("norm != ''", "array(-1)", "i = -1", TIER_EQUAL, "concat('=', norm)")
    if TIER_SHORT in tiers:
        if secondary:
            add("length(norm) >= 3", "array(-2)", "i = -2", TIER_SHORT, "concat('s', norm)")
        else:
            add_all("shorts", -10, TIER_SHORT, "concat('s', {})")
    if TIER_SUBSET in tiers:
        # "<": the secondary set lies in the canonical one; ">": strictly the other way round.
        own, other = ("<", ">") if secondary else (">", "<")
        listed = f"{n} BETWEEN 2 AND {most}"
        add(listed, "array(-3)", "i = -3", TIER_SUBSET, f"concat('{own}', {_joined('tokens')})")
        # Sets of two or more; all but the whole one where it has to be smaller.
        last = f"shiftleft(1, {n}) - {2 if secondary else 1}"
        add(f"{listed} AND {last} >= 3", f"sequence(3, {last})", "i > 0", TIER_SUBSET, f"concat('{other}', {chosen('tokens', most)})")
    if TIER_OVERLAP in tiers:
        # A common set of k tokens, properly inside both sides, of sizes n and m: as the other
        # side has more than k tokens, k / (n + 1) must reach the threshold.
        least = least_overlap(f"{n} + 1")
        sets = f"filter({subsets('tokens', f'{n} - {least}')}, s -> s.n >= 2 AND s.n < {n})"
        if secondary:
            sizes = (
                f"filter(sequence(s.n + 1, greatest(s.n + 1, {limits.overlap_tokens})), "
                f"m -> s.n / ({n} + m - s.n) >= {MIN_OVERLAP}D)"
            )
            sized = f"flatten(transform({sets}, s -> transform({sizes}, m -> concat('~', s.k, '#', m))))"
        else:
            sized = f"transform({sets}, s -> concat('~', s.k, '#', {n}))"
        common = f"if({n} BETWEEN 3 AND {limits.overlap_tokens} AND {least} < {n}, {sized}, {NO_TOKENS})"
        add_all("common", -11, TIER_OVERLAP, "{}")
    shown = features.selectExpr(key, "norm", "tokens", "shorts", f"{common} AS common").selectExpr(
        key, "norm", "tokens", "shorts", "common", f"explode(concat({', '.join(numbers)})) AS i"
    )
    whens = [(this, str(tier), text) for this, tier, text in texts]
    return shown.filter("i < 0 OR bit_count(i) >= 2").selectExpr(
        key,
        f"CASE {' '.join(f'WHEN {this} THEN {tier}' for this, tier, _ in whens)} END AS tier",
        f"CASE {' '.join(f'WHEN {this} THEN {text}' for this, _, text in whens)} END AS g",
    )


def change_keys(names: DataFrame, *hints: str, secondary: bool, limits: MatchLimits = MatchLimits()) -> DataFrame:
    """(name, k): a secondary name can match another or fewer primary names than before only if it shares a key with
    a primary name that is new, changed or gone. ``names`` has the hint columns, the first one being the name.

    Keys are the match keys; the tokens, where one of the two sides has more of them than keys are listed for; and
    the identity tokens, which the fallbacks look up.
    """
    features = variant_features(names.withColumn("name", F.col(hints[0])), "name", *hints)
    tiers = _keys(features, "name", ALL_TIERS, limits, secondary).select("name", F.concat(F.col("tier").cast("string"), "g").alias("k"))
    # "c": tokens of canonical names, met by long secondary ones; "C": tokens of long canonical names, met by all.
    every, long_only = ("C", "c") if secondary else ("c", "C")
    long = f"size(tokens) > {limits.subset_tokens}"
    tokens = features.selectExpr(
        "name",
        f"explode(concat(transform(tokens, t -> concat('{every}', t)), "
        f"if({long}, transform(tokens, t -> concat('{long_only}', t)), {NO_TOKENS}))) AS k",
    )
    parts = [identity_tokens(name_tokens(h)) if secondary else name_tokens(h) for h in hints]
    looked_up = f"concat({', '.join(f'coalesce({p}, {NO_TOKENS})' for p in parts)})"
    identity = names.selectExpr(f"{hints[0]} AS name", f"explode(transform({looked_up}, t -> concat('i', t))) AS k")
    return tiers.unionByName(tokens).unionByName(identity).distinct()


# --- groups with many canonical names ----------------------------------------------------------


def _lookup_keys(limits: MatchLimits, canonical: bool) -> str:
    """Sub-keys by which names of one group find each other; see the module text.

    "r": a rare token. "f": a set of frequent tokens. A name with too many frequent tokens to
    list their subsets is "wide" and meets the whole group instead.
    """
    few = f"size(frequent) <= {limits.heavy_tokens}"
    rare = "transform(array_except(name_tokens, frequent), t -> concat('r', t))"
    sets = f"transform({subsets('sort_array(frequent)', 'size(frequent)')}, s -> concat('f', s.k))"
    mine, theirs = ("w", "W") if canonical else ("W", "w")
    wide = f"if({few}, array('{theirs}'), array('{mine}', '{theirs}'))"
    return f"concat({rare}, if({few}, {sets}, {NO_TOKENS}), {wide})"


def _heavy_pairs(src_keys: DataFrame, can_keys: DataFrame, src: DataFrame, canon: DataFrame, limits: MatchLimits) -> DataFrame:
    """Pairs of the groups with many canonical names, reduced to the two best of each group."""
    members = can_keys.join(canon.withColumnRenamed("canon_tokens", "name_tokens"), "canon")
    counts = (
        members.select("canon", F.explode("name_tokens").alias("t")).distinct().groupBy("t").count()
        .filter(F.col("count") > limits.heavy_group).select("t")
    )

    def with_lookup(rows: DataFrame, key: str, canonical: bool) -> DataFrame:
        # The frequent tokens of a name, joined on by token and gathered again per name.
        names = rows.select(key, "name_tokens").distinct()
        frequent = (
            names.select(key, F.explode("name_tokens").alias("t"))
            .join(counts, "t")
            .groupBy(key)
            .agg(F.collect_list("t").alias("frequent"))
        )
        keyed = (
            names.join(frequent, key, "left")
            .selectExpr(key, "name_tokens", f"coalesce(frequent, {NO_TOKENS}) AS frequent")
            .selectExpr(key, "name_tokens", f"explode({_lookup_keys(limits, canonical)}) AS sub")
        )
        return rows.drop("name_tokens").join(keyed, key)

    left = with_lookup(
        src_keys.join(src.select("src", F.col("src_tokens").alias("name_tokens")), "src"),
        "src",
        False,
    )
    right = with_lookup(members, "canon", True)
    # Similarity with an empty common part is 0 whatever the size, so only the order counts there.
    weight = F.when(F.col("sub") == "f", F.lit(0)).otherwise(F.size("name_tokens"))
    best = Window.partitionBy("tier", "g", "sub").orderBy(weight, "ord")
    by_set = (
        right.filter(F.col("sub").startswith("f"))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= 2)
        .drop("rank")
    )
    right = by_set.unionByName(right.filter(~F.col("sub").startswith("f"))).select("tier", "g", "sub", "canon")
    return left.join(right, ["tier", "g", "sub"]).select("src", "canon", "tier").distinct()


# --- long names --------------------------------------------------------------------------------


def contained_pairs(small: DataFrame, large: DataFrame, small_id: str, large_id: str) -> DataFrame:
    """Pairs where every token of the small set is in the large set.

    The large side's vocabulary first removes small sets with any token it lacks; a remaining
    set is then looked up by its rarest token there.
    """
    posted = large.select(large_id, F.col("tokens").alias("large_tokens"), F.explode("tokens").alias("t"))
    # Both are written, so that they are broadcast where they are small; the many small sets stay where they are then.
    postings = stage(posted, "postings")
    vocabulary = stage(postings.groupBy("t").agg(F.count(F.lit(1)).alias("df")), "vocabulary")
    probes = (
        small.select(small_id, F.col("tokens").alias("small_tokens"), F.explode("tokens").alias("t"))
        .join(vocabulary, "t")
        .groupBy(small_id, "small_tokens")
        .agg(F.count(F.lit(1)).alias("present"), F.min(F.struct("df", "t")).alias("rarest"))
        .filter(F.col("present") == F.size("small_tokens"))
        .select(small_id, "small_tokens", F.col("rarest.t").alias("t"))
    )
    return (
        probes.join(postings, "t")
        .filter(F.size(F.array_except("small_tokens", "large_tokens")) == 0)
        .select(small_id, large_id)
        .distinct()
    )


def _overlapping_sets(src_sets: DataFrame, can_sets: DataFrame, limits: MatchLimits) -> DataFrame:
    """(own, g): Jaccard pairs of sets with a long one among them, by prefix filtering on the
    rarest tokens."""
    # A partner of a set with more than m tokens has at least this many itself.
    least = int(limits.overlap_tokens * MIN_OVERLAP)
    postings = [
        d.filter(F.size("tokens") > least).select("g", "tokens", F.explode("tokens").alias("t")) for d in (src_sets, can_sets)
    ]
    df = postings[0].select("t").unionByName(postings[1].select("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))

    def prefixes(rows: DataFrame, name: str, tokens: str) -> DataFrame:
        ordered = (
            rows.join(df, "t")
            .groupBy("g", "tokens")
            .agg(F.sort_array(F.collect_list(F.struct("df", "t"))).alias("by_df"))
        )
        prefix = F.expr(f"slice(by_df, 1, size(tokens) - {least_overlap('size(tokens)')} + 1)")
        return ordered.select(F.col("g").alias(name), F.col("tokens").alias(tokens), F.explode(prefix).alias("p")).select(
            name, tokens, F.col("p.t").alias("t")
        )

    a, b = F.col("own_tokens"), F.col("other_tokens")
    shared = F.size(F.array_intersect(a, b))
    return (
        prefixes(postings[0], "own", "own_tokens")
        .join(prefixes(postings[1], "g", "other_tokens"), "t")
        .filter(F.greatest(F.size(a), F.size(b)) > limits.overlap_tokens)
        .filter((shared >= 2) & (shared < F.least(F.size(a), F.size(b))))
        .filter(shared / (F.size(a) + F.size(b) - shared) >= MIN_OVERLAP)
        .select("own", "g")
        .distinct()
    )


def longest_sets(*sides: DataFrame) -> list[int]:
    """The largest token count of each side, in one small job."""
    sized = [d.select(F.lit(i).alias("side"), F.size("tokens").alias("n")) for i, d in enumerate(sides)]
    union = sized[0]
    for other in sized[1:]:
        union = union.unionByName(other)
    found = dict(union.groupBy("side").agg(F.max("n")).collect())
    return [found.get(i, 0) for i in range(len(sides))]


def _set_key(kind: str, tokens: str = "tokens") -> Column:
    return F.expr(f"concat('{kind}', {_joined(tokens)})").alias("g")


def _long_keys(
    src_features: DataFrame, can_features: DataFrame, tiers: tuple, limits: MatchLimits
) -> list[tuple[DataFrame, DataFrame]]:
    """Keys (src, tier, g) and (canon, tier, g) of pairs with a long name. A branch is planned
    only where such names exist."""
    n = F.size("tokens")
    src, canon = (d.filter(n >= 2).select(k, "tokens") for d, k in ((src_features, "src"), (can_features, "canon")))
    longest_src, longest_canon = longest_sets(src_features, can_features)
    subset, overlap = F.lit(TIER_SUBSET).alias("tier"), F.lit(TIER_OVERLAP).alias("tier")
    is_long = n > limits.listed
    found = []

    def sets(rows: DataFrame, kind: str) -> DataFrame:
        return rows.select("tokens").distinct().select(_set_key(kind), "tokens")

    if TIER_SUBSET in tiers and longest_canon > limits.listed:
        inside = stage(contained_pairs(sets(src, "L<"), canon.filter(is_long), "g", "canon"), "long-primary")
        found.append((src.select("src", subset, _set_key("L<")), inside.select("canon", subset, "g")))
    if TIER_SUBSET in tiers and longest_src > limits.listed:
        inside = stage(contained_pairs(sets(canon, "L>"), src.filter(is_long), "g", "src"), "long-secondary")
        found.append((inside.select("src", subset, "g"), canon.select("canon", subset, _set_key("L>"))))
    if TIER_OVERLAP in tiers and max(longest_src, longest_canon) > limits.overlap_tokens:
        pairs = stage(_overlapping_sets(sets(src, "L~"), sets(canon, "L~"), limits), "long-overlaps")
        partners = src.withColumn("own", _set_key("L~")).join(pairs, "own").select("src", overlap, "g")
        found.append((partners, canon.select("canon", overlap, _set_key("L~"))))
    return found


# --- all together ------------------------------------------------------------------------------


def tier_candidates(
    src: DataFrame,
    canon: DataFrame,
    src_features: DataFrame,
    can_features: DataFrame,
    tiers: tuple = ALL_TIERS,
    limits: MatchLimits = MatchLimits(),
) -> DataFrame:
    """(src, canon, tier): valid pairs, among them the two best of each name and tier.

    The features should be staged: they feed several branches, and which branches are planned
    depends on them.
    """
    src_keys = _keys(src_features, "src", tiers, limits, True, limits.listed)
    can_keys = _keys(can_features, "canon", tiers, limits, False, limits.listed)
    group = ["tier", "g"]
    sampled = can_features.filter(F.pmod(F.xxhash64("canon"), F.lit(limits.heavy_sample)) == 0)
    sized = (
        _keys(sampled, "canon", tiers, limits, False, limits.listed)
        .groupBy(*group)
        .count()
        .filter(F.col("count") * limits.heavy_sample > limits.heavy_group)
    )
    for more_src, more_can in _long_keys(src_features, can_features, tiers, limits):
        src_keys, can_keys = src_keys.unionByName(more_src), can_keys.unionByName(more_can)
        sized = sized.unionByName(
            more_can.groupBy(*group).count().filter(F.col("count") > limits.heavy_group)
        )
    # Written once: few as they are, the groups are broadcast then, and the keys of all names stay where they are.
    sized = stage(sized.select(*group).distinct(), "heavy-groups")
    # Of the heavy groups only those with a secondary name matter; often there are none.
    heavy_src = stage(src_keys.join(sized, group, "left_semi").distinct(), "heavy-secondary")
    if heavy_src.isEmpty():
        return src_keys.join(can_keys, group).select("src", "canon", "tier")
    heavy = heavy_src.select(*group).distinct()
    light = src_keys.join(heavy, group, "left_anti").join(can_keys, group).select("src", "canon", "tier")
    heavy_canon = stage(can_keys.join(heavy, group, "left_semi").distinct(), "heavy-primary")
    return light.unionByName(_heavy_pairs(heavy_src, heavy_canon, src, canon, limits))
