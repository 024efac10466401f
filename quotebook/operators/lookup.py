"""Name lookup by pattern through an index of trigrams, instead of a scan of all names.

The index has one row per distinct name and trigram of it (letters A-Z in lower case, as the lookup ignores their
case), sorted by trigram, so that a filter on a few trigrams reads few row groups. A lookup takes the trigrams that
any hit must have from the literal parts of its pattern, keeps the names that have the rarest of them all, and
verifies the pattern on these. Patterns without such a part of three characters are answered by the scan.

Null names are not indexed and never match. Names of fewer than three characters have no trigram; a pattern with a
literal part of three cannot match them. Repeated rows each belong to their name. An empty table gives no hit.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotebook.operators.publish import default_order, first_match, name_lookup

#: Of a pattern's trigrams the rarest so many are intersected; the pattern itself decides in the end.
RAREST = 4
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
# With these a part of a pattern may be an alternative, a class, a group or an escape; no literal is taken from it.
_NOT_PLAIN = frozenset("|()[]{}\\")


def trigram_index(published: DataFrame) -> DataFrame:
    """(trigram, Name): the distinct trigrams of each distinct name."""
    names = published.select("Name").filter("Name IS NOT NULL").distinct()
    lower = f"translate(Name, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    grams = f"array_distinct(transform(sequence(1, length(Name) - 2), i -> substring({lower}, i, 3)))"
    return names.filter("length(Name) >= 3").select(F.explode(F.expr(grams)).alias("trigram"), "Name")


def write_index(published: DataFrame, path: str) -> None:
    """Write the index in ranges of the trigram, sorted within files."""
    index = trigram_index(published)
    # The name is part of the range, so that a trigram of very many names spreads over tasks.
    index.repartitionByRange("trigram", "Name").sortWithinPartitions("trigram", "Name").write.mode("errorifexists").parquet(path)


def literals(pattern: str) -> list[str]:
    """The runs of characters that every hit contains, in lower case; none if the pattern is not plain."""
    if not _NOT_PLAIN.isdisjoint(pattern):
        return []
    runs, run = [], ""
    for c in pattern.translate(_LOWER):
        if c in "*?":
            # The character before may be absent.
            run = run[:-1]
        if c in "^$.*?+":
            runs.append(run)
            run = ""
        else:
            run += c
    return [r for r in [*runs, run] if r]


def trigrams(pattern: str) -> list[str]:
    """The trigrams that every hit contains. Characters beyond the basic plane count once, as in Spark."""
    return sorted({r[i : i + 3] for r in literals(pattern) for i in range(len(r) - 2)})


def matching_names(index: DataFrame, pattern: str) -> DataFrame | None:
    """The distinct names that the pattern matches, from the index; None where only a scan can tell."""
    wanted = trigrams(pattern)
    if not wanted:
        return None
    asked = index.filter(F.col("trigram").isin(wanted))
    # At most one row per trigram of the pattern.
    counts = {r.trigram: r.n for r in asked.groupBy("trigram").agg(F.count(F.lit(1)).alias("n")).collect()}
    rarest = sorted(wanted, key=lambda t: (counts.get(t, 0), t))[:RAREST]
    found = index.filter(F.col("trigram").isin(rarest)).groupBy("Name").agg(F.count(F.lit(1)).alias("n"))
    return found.filter((F.col("n") == len(rarest)) & _matches(pattern)).select("Name")


def _matches(pattern: str) -> Column:
    return F.col("Name").rlike(f"(?i){pattern}")


def indexed_lookup(published: DataFrame, index: DataFrame, pattern: str, *order: str) -> DataFrame:
    """``name_lookup`` through the index: the same row."""
    names = matching_names(index, pattern)
    if names is None:
        return name_lookup(published, pattern, *order)
    return first_match(published.join(names, "Name", "left_semi"), *(order or default_order(published)))
