"""The blocked matching plan against all pairs compared by DuckDB."""

import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks import duck
from quotebook.operators import resolve
from quotebook.operators import candidates
from quotebook.operators.candidates import MatchLimits, canonical_names
from quotebook.session import stage

COMMON = ["Green", "Power", "Capital", "Technologies", "Holdings", "Alpha", "Bravo", "Charlie"]
RARE = [f"Kx{i:03d}" for i in range(60)]
ENDS = ["Limited", "Ltd", "Unlisted Shares", "Pvt Ltd", "Company", ""]

DEFAULT = MatchLimits()
# Every branch on tiny inputs: most groups heavy, few frequent tokens allowed, short names long.
STRICT = MatchLimits(subset_tokens=3, overlap_tokens=8, heavy_group=1, heavy_sample=1, heavy_tokens=2)
HEAVY = MatchLimits(subset_tokens=8, overlap_tokens=16, heavy_group=2, heavy_sample=1, heavy_tokens=10)


def random_name(rng, longest=6):
    words = rng.sample(COMMON, rng.randint(0, min(4, longest))) + rng.sample(RARE, rng.randint(0, 2))
    rng.shuffle(words)
    name = " ".join(words + [rng.choice(ENDS)])
    if rng.random() < 0.25:
        name += f" ({rng.choice(['India', 'Green Power', 'Formerly ' + rng.choice(RARE) + ' Alpha', 'GPC'])})"
    if rng.random() < 0.1:
        name = name.replace(" ", "-", 1)
    return name


def long_name(rng):
    letters = [f"{a}{b}word" for a in "pqrst" for b in "uvwxyz"]
    return " ".join(rng.sample(letters[:18], rng.randint(9, 17))) + " Ltd"


def listings(spark, rows, source):
    return spark.createDataFrame(
        [(i, source, c, s, f"{source}-{i}", None) for i, (c, s) in enumerate(rows)],
        "ord bigint, source string, company string, short_name string, slug string, price double",
    )


def spark_result(spark, secondaries, primaries, limits):
    found = resolve.resolve_entities(
        listings(spark, secondaries, "secondary"), listings(spark, primaries, "primary"), limits=limits
    )
    return {r.ord: r.matched_slug for r in found.collect()}


def expected(secondaries, primaries):
    """The pairwise statements of the checks on these names."""
    con = duckdb.connect()
    named = [(i, c) for i, (c, _) in enumerate(primaries) if c]
    text, number = pa.string(), pa.int64()
    con.register("names_p", pa.table({
        "ord": pa.array([i for i, _ in named], number), "company": pa.array([c for _, c in named], text),
        "slug": pa.array([f"primary-{i}" for i, _ in named], text)}))
    con.register("names_s", pa.table({
        "ord": pa.array(range(len(secondaries)), number), "company": pa.array([c for c, _ in secondaries], text),
        "short_name": pa.array([s for _, s in secondaries], text)}))
    none = {"ord": number, "secondary_name": text, "primary_name": text}
    con.register("names_a", pa.table({n: pa.array([], t) for n, t in none.items()}))
    found = con.execute(
        f"""WITH {duck.match_ctes("names_p", "names_s", "names_a")}
        SELECT x.ord, r.slug FROM names_s x
        LEFT JOIN resolved r ON r.company IS NOT DISTINCT FROM x.company AND r.short_name = coalesce(x.short_name, '')"""
    ).fetchall()
    return dict(found)


@pytest.mark.parametrize("limits, seed", [(DEFAULT, 1), (STRICT, 2), (HEAVY, 3)], ids=["default", "strict", "heavy"])
def test_random_names(spark, limits, seed):
    rng = random.Random(seed)
    primaries = [(random_name(rng), None) for _ in range(150)]
    primaries += rng.sample(primaries, 15)
    secondaries = [(random_name(rng), rng.choice([None, "", "GPC", random_name(rng, 2)])) for _ in range(150)]
    secondaries += [(c.replace("Ltd", "Limited"), None) for c, _ in primaries[:40]]
    want = expected(secondaries, primaries)
    assert spark_result(spark, secondaries, primaries, limits) == want
    assert sum(x is not None for x in want.values()) > 30


@pytest.mark.parametrize("limits", [DEFAULT, STRICT], ids=["default", "strict"])
def test_long_and_templated_names(spark, limits):
    rng = random.Random(5)
    primaries = [(long_name(rng), None) for _ in range(40)]
    template = "Alpha Bravo Charlie Delta Echo Foxtrot"
    primaries += [(f"{template} {r}", None) for r in RARE[:30]] + [("Alpha Bravo", None), ("Delta Echo", None)]
    secondaries = [(f"{template} {r} Ltd", None) for r in RARE[20:50]]
    for name, _ in primaries[:40]:
        words = name.split()
        secondaries += [(" ".join(words[:-2] + ["zzword"]), None), (" ".join(words[3:]), None), (name + " extraword", None)]
    assert spark_result(spark, secondaries, primaries, limits) == expected(secondaries, primaries)


def test_one_shared_chunk_in_every_name(spark):
    """All names share a parenthesised part, so all pairs match at the top tier."""
    primaries = [(f"Primary {r} Works (India Group)", None) for r in RARE]
    secondaries = [(f"{r} Works (India Group) Ltd", None) for r in RARE[::2]] + [("Other Thing (India Group)", None)]
    want = expected(secondaries, primaries)
    for limits in (DEFAULT, STRICT):
        assert spark_result(spark, secondaries, primaries, limits) == want
    assert want[0] == "primary-0" and want[30] == "primary-0"


def test_heavy_groups_do_not_make_all_pairs(spark):
    """Candidates per name stay few although every pair of names matches."""
    n = 400
    primaries = listings(spark, [(f"P{i:04d} (India Group)", None) for i in range(n)], "primary")
    secondaries = listings(spark, [(f"S{i:04d} (India Group)", None) for i in range(n)], "secondary")
    src = stage(resolve.source_names(secondaries), "names")
    canon = stage(canonical_names(primaries), "canon")
    limits = MatchLimits(heavy_group=20, heavy_sample=1)
    assert resolve.match_candidates(src, canon, limits=limits).count() <= 6 * n


def test_names_of_eight_tokens_do_not_list_their_subsets(spark, monkeypatch):
    """They match as before, and make about as many keys as names of four tokens."""
    words = ["amber", "birch", "cedar", "delta", "ember", "fjord", "grove", "heath"]
    primaries = [(f"{' '.join(words[:7])} kx{i:04d}", None) for i in range(20)] + [("amber birch", None)]
    secondaries = [(f"kx{i:04d} {' '.join(words[i % 4: i % 4 + 3])}", None) for i in range(0, 20, 2)]
    secondaries += [(f"{' '.join(words)} zz{i:04d}", None) for i in range(10)]
    counts, plain = [], candidates._keys

    def counted(features, *args):
        keys = plain(features, *args)
        counts.append((keys.count(), features.count()))
        return keys

    want = expected(secondaries, primaries)
    monkeypatch.setattr(candidates, "_keys", counted)
    assert spark_result(spark, secondaries, primaries, DEFAULT) == want
    assert counts and all(n <= 60 * names for n, names in counts), counts


def test_only_asked_tokens_are_listed(spark, monkeypatch):
    """Names without a token of any hint never reach the listing of subsets, the others only with such tokens."""
    seen = []

    def spied(tokens, most):
        seen.append(tokens)
        return candidates.subsets(tokens, most)

    staged = {}
    kept = resolve.stage
    monkeypatch.setattr(resolve, "subsets", spied)
    monkeypatch.setattr(resolve, "stage", lambda df, label: staged.setdefault(label, kept(df, label)))
    primaries = listings(spark, [(f"Alphaone Bravotwo kxx{i:03d}", None) for i in range(30)], "primary")
    canon = kept(canonical_names(primaries), "canon")
    hints = spark.createDataFrame([("a", "Kxx007"), ("b", "Bravotwo"), ("c", "Kxx003 Alphaone"), ("d", "Kxx003 Other")], "src string, hint string")
    got = {r.src: r.slug for r in resolve.unique_token_match(hints, canon).collect()}
    by_name = {r.canon: r.slug for r in canon.collect()}
    assert got == {"a": by_name["Alphaone Bravotwo kxx007"], "c": by_name["Alphaone Bravotwo kxx003"]}
    assert seen
    left = {tuple(r.tokens) for r in staged["asked-names"].collect()}
    assert left == {("alphaone", "bravotwo"), ("alphaone", "bravotwo", "kxx003"), ("alphaone", "bravotwo", "kxx007")}


def test_copies_of_a_name_are_resolved_once(spark):
    """A third of the rows are one listing; heavy names take the broadcast branch."""
    rows = [("Acme Rockets Ltd", None)] * 300 + [(f"Acme {r}", None) for r in RARE]
    primaries = [("Acme Rockets Limited Unlisted Shares", None)] + [(f"Acme {r} Limited", None) for r in RARE[:30]]
    before = resolve.HEAVY_NAME_ROWS
    try:
        resolve.HEAVY_NAME_ROWS = 100
        got = spark_result(spark, rows, primaries, DEFAULT)
    finally:
        resolve.HEAVY_NAME_ROWS = before
    assert got == expected(rows, primaries)
    src = resolve.source_names(listings(spark, rows, "secondary"))
    assert src.count() == 61


def test_result_does_not_depend_on_partitioning(spark):
    rng = random.Random(9)
    primaries = [(random_name(rng), None) for _ in range(80)]
    secondaries = [(random_name(rng), None) for _ in range(80)]
    a, b = listings(spark, secondaries, "secondary"), listings(spark, primaries, "primary")
    one = resolve.resolve_entities(a.repartition(1), b.repartition(1))
    many = resolve.resolve_entities(a.repartition(7, F.rand(3)), b.repartition(5, F.rand(4)))
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_empty_sides(spark):
    some = [("Acme Rockets Ltd", "")]
    assert spark_result(spark, [], some, DEFAULT) == {}
    assert spark_result(spark, some, [], DEFAULT) == {0: None}
    assert spark_result(spark, [("", None), (None, None)], some, DEFAULT) == {0: None, 1: None}


def aliases(spark, *pairs):
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "ord int, secondary_name string, primary_name string")


def test_alias_lookup(spark):
    names = resolve.source_names(listings(spark, [("Yy Ltd", None), ("YY Limited", None), ("Zz", None)], "secondary"))
    table = aliases(spark, ("Yy Ltd.", "First"), ("Yy Ltd", "Exact"), ("Yy Ltd.", "Repeated"))
    got = {r.company: r.mapped_name for r in resolve.alias_lookup(names, table).collect()}
    assert got == {"Yy Ltd": "Exact", "YY Limited": "Repeated", "Zz": None}


CASES = [
    # (secondary, short name, primaries, expected index)
    ("Power Exchange India Limited - PXIL", None, ["Power Exchange India Limited (PXIL)"], 0),
    ("Hindustan Power Exchange Limited - HPX", None, ["Hindustan Power Exchange Limited (HPX India)"], 0),
    ("Ecosure Pulpmolding Technologies Limited", None, ["Ecosure Unlisted Shares"], 0),
    ("Ecosure Pulpmolding Technologies Limited", None, ["Ecosure Unlisted Shares", "Other Technologies"], None),
]


@pytest.mark.parametrize("company, short, primaries, index", CASES)
def test_known_cases(spark, company, short, primaries, index):
    got = spark_result(spark, [(company, short)], [(p, None) for p in primaries], DEFAULT)
    assert got == {0: None if index is None else f"primary-{index}"}
    assert got == expected([(company, short)], [(p, None) for p in primaries])


def test_tiers_of_known_cases(spark):
    src = resolve.source_names(listings(spark, [(c[0], c[1]) for c in CASES[:3]], "secondary"))
    canon = canonical_names(listings(spark, [(c[2][0], None) for c in CASES[:3]], "primary"))
    tiers = {(r.src.split("\x01")[0], r.canon): r.tier for r in resolve.match_candidates(stage(src, "s"), stage(canon, "c")).collect()}
    assert tiers[(CASES[0][0], CASES[0][2][0])] == 95
    assert tiers[(CASES[1][0], CASES[1][2][0])] == 88
    assert (CASES[2][0], CASES[2][2][0]) not in tiers


def test_no_nested_loop_joins(spark):
    rng = random.Random(3)
    a = listings(spark, [(random_name(rng), None) for _ in range(50)], "secondary")
    b = listings(spark, [(random_name(rng), None) for _ in range(50)], "primary")
    src, canon = stage(resolve.source_names(a), "s"), stage(canonical_names(b), "c")
    for frame in (
        resolve.match_candidates(src, canon),
        resolve.match_candidates(src, canon, limits=STRICT),
        resolve.resolve_names(src, canon),
        resolve.resolve_entities(a, b),
    ):
        plan = frame._jdf.queryExecution().toString()
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan and "Python" not in plan


def test_job_lists_the_variants_of_primary_names_once(spark, monkeypatch):
    from pyspark.sql import functions as F

    from quotebook.operators import resolve
    from quotebook.operators.listings import normalize_listings
    from quotebook.plans.upsert import upsert_stocks
    from quotebook.sources.book import empty_book

    made, write = [], resolve.stage
    monkeypatch.setattr(resolve, "stage", lambda df, label: made.append(label) or write(df, label))

    def batch(*rows):
        return normalize_listings(spark.createDataFrame(rows, "ord long, source string, company string, slug string"))

    # The old leftover meets a primary name of the second batch, whose own secondary row matches nothing.
    ts = F.lit("2024-01-01").cast("timestamp")
    old = upsert_stocks(empty_book(spark), batch((1, "secondary", "Alpha Bolt Ltd", "old-a")), ts).book
    made.clear()
    new = batch((1, "primary", "Alpha Bolt Limited", "a"), (2, "secondary", "Zulu Pulp", "z"))
    got = upsert_stocks(old, new, ts, batch=1).book.collect()
    assert {(r.slug, tuple(r.aliases or ())) for r in got} == {("a", ("Alpha Bolt Ltd",)), ("z", ())}
    assert made.count("secondary-variants") == 2 and made.count("primary-variants") == 1


def test_token_subsets_are_listed_without_lambdas(spark):
    from quotebook.operators import candidates

    rows = spark.createDataFrame([("n", "abc", ["a", "b", "c"], [])], "canon string, norm string, tokens array<string>, shorts array<string>")
    for secondary, own, other in ((False, ">", {"<|a|b", "<|a|c", "<|b|c", "<|a|b|c"}), (True, "<", {">|a|b", ">|a|c", ">|b|c"})):
        keys = candidates._keys(rows, "canon", (candidates.TIER_SUBSET,), candidates.MatchLimits(), secondary)
        assert {r.g for r in keys.collect()} == other | {f"{own}|a|b|c"}
        assert "lambda" not in keys._jdf.queryExecution().toString()
