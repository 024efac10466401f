"""Lookups through the trigram index against the scan."""

import random
import re

from quotebook.operators import lookup
from quotebook.operators.publish import name_lookup

PATTERNS = [
    "gizmo", "^ALPHA", "pha.*tech", "alphas?$", "al*pha", "(alpha|beta)", "a", "..", "", "zzz", "co\\.", "İst", "ßen", "\U0001f600abc", "a+lp",
    "kelvin", "alp*?ha", "gam+a tech",
]


def rows(spark, names):
    return spark.createDataFrame([(n, i) for i, n in enumerate(names)], "Name string, place int")


def test_literals():
    assert lookup.literals("Alphas?$") == ["alpha"]
    assert lookup.literals("^Ab*c.+de") == ["a", "c", "de"]
    assert lookup.literals("ab|cd") == [] and lookup.literals("") == [] and lookup.literals("a\\.bc") == []
    assert lookup.trigrams("abcd.xy") == ["abc", "bcd"]


def test_lookup_equals_scan(spark, tmp_path):
    rng = random.Random(3)
    words = ["Alpha", "ALPHAS", "beta", "Gamma", "gizmo", "Tech", "Co.", "İstanbul", "Großen", "\U0001f600abc", "Kelvin", "a", ""]
    names = [" ".join(rng.sample(words, rng.randrange(0, 4))) for _ in range(300)] + [None, None, "ab", "Alpha", "Alpha"]
    table = rows(spark, names).repartition(4)
    lookup.write_index(table, str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    random_ones = ["".join(rng.choice("alphteg m.?*+^$") for _ in range(rng.randrange(3, 8))) for _ in range(40)]
    valid = [p for p in random_ones if not re.search(r"[?*+^$]{2}|^[?*+]|\^[?*+]", p)][:8]
    for pattern in PATTERNS + valid:
        scan = name_lookup(table, pattern, "Name", "place").collect()
        assert lookup.indexed_lookup(table, index, pattern, "Name", "place").collect() == scan, pattern


def test_files_are_pruned(spark, tmp_path):
    table = rows(spark, [f"name {i} of many" for i in range(2000)] + ["quirky"])
    lookup.write_index(table, str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    assert [r.Name for r in lookup.matching_names(index, "QUIRK").collect()] == ["quirky"]
    plan = index.filter("trigram IN ('qui')")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(trigram, [qui])]" in plan or "EqualTo(trigram,qui)" in plan


def test_empty_table(spark):
    table = rows(spark, [None])
    assert lookup.indexed_lookup(table, lookup.trigram_index(table), "abc").collect() == []
