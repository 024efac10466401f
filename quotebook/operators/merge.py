"""Field-wise merging of listings into the book.

Rows of one record are applied in ``ord`` order. Instead of changing records row by row, each
field is folded per record with ``max_by``/``min_by`` over the rows where it may win; these
aggregates combine on the map side, so a record with very many rows is no bottleneck.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotebook.operators.candidates import MatchLimits, change_keys
from quotebook.operators.resolve import alias_lookup, resolve_entities, source_key
from quotebook.schemas import BOOK_FIELDS, BOOK_SCHEMA, KEPT_ON_MERGE, field_type
from quotebook.session import stage

# Columns an incoming listing may carry.
_INCOMING = tuple(f for f in BOOK_FIELDS if f not in ("slug", "ord"))
_FILLED = tuple(f for f in _INCOMING if f not in KEPT_ON_MERGE)


# The expressions below are SQL text: there are some thirty fields, and one parsed text costs the
# driver far less than a chain of column calls.


def _aligned(rows: DataFrame, batch_ts: Column | None = None, extra: tuple = ()) -> DataFrame:
    """The book columns (absent ones null), stamped with the batch time, and the named extra ones."""
    columns = [
        f"cast({f.name if f.name in rows.columns else 'null'} AS {f.dataType.simpleString()}) AS {f.name}"
        for f in BOOK_SCHEMA
    ]
    aligned = rows.selectExpr(*columns, *extra)
    return aligned if batch_ts is None else aligned.withColumn("updated_at", batch_ts)


def _can_be_empty(name: str) -> bool:
    return field_type(name).typeName() in ("string", "array", "map")


def _full(name: str, e: str | None = None) -> str:
    """Condition: the value of the field is neither null nor empty."""
    e = e or name
    kind = field_type(name).typeName()
    if kind == "string":
        return f"({e} IS NOT NULL AND {e} != '')"
    return f"(size({e}) > 0)" if kind in ("array", "map") else f"({e} IS NOT NULL)"


def _last(name: str, condition: str, alias: str) -> Column:
    return F.expr(f"max_by({name}, ord) FILTER (WHERE {condition}) AS {alias}")


def _first(name: str, condition: str, alias: str) -> Column:
    return F.expr(f"min_by({name}, ord) FILTER (WHERE {condition}) AS {alias}")


def slug_join(book: DataFrame, incoming: DataFrame) -> DataFrame:
    """What happens to each slug: insert, update or keep."""
    return book.select("slug", F.lit(True).alias("_old")).join(
        incoming.groupBy("slug").agg(F.count(F.lit(1)).alias("n_rows")), "slug", "full_outer"
    ).select(
        "slug",
        F.when(F.col("_old").isNull(), "insert").when(F.col("n_rows").isNull(), "keep").otherwise("update").alias("action"),
        F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
    )


def _overlay(book: DataFrame, folded: DataFrame, value, ord_base: int) -> DataFrame:
    """Full outer join of the book (slug unique) with folded rows, ``value(field)`` per field."""
    joined = book.alias("old").join(folded, "slug", "full_outer")
    return joined.selectExpr(
        "slug", *[f"{value(f)} AS {f}" for f in _INCOMING], f"coalesce(old.ord, new_ord + {ord_base}) AS ord"
    ).select(*BOOK_FIELDS)


def upsert_primary(book: DataFrame, incoming: DataFrame, batch_ts: Column, ord_base: int = 0) -> DataFrame:
    """Insert or update by slug: null never overwrites, an empty value never overwrites a
    meaningful one, otherwise the later row wins."""
    folded = (
        _aligned(incoming.filter(F.col("slug") != ""), batch_ts)
        .groupBy("slug")
        .agg(
            *[_last(f, _full(f), f"full_{f}") for f in _INCOMING],
            *[_last(f, f"{f} IS NOT NULL", f"any_{f}") for f in _INCOMING if _can_be_empty(f)],
            F.min("ord").alias("new_ord"),
        )
    )

    def value(f: str) -> str:
        if not _can_be_empty(f):
            return f"coalesce(full_{f}, old.{f})"
        return f"coalesce(full_{f}, CASE WHEN {_full(f, f'old.{f}')} THEN old.{f} END, any_{f}, old.{f})"

    return _overlay(book, folded, value, ord_base)


def upsert_secondary_only(book: DataFrame, incoming: DataFrame, batch_ts: Column, ord_base: int = 0) -> DataFrame:
    """Unmatched secondary rows: insert, or overwrite with every non-null field, empty or not."""
    folded = (
        _aligned(incoming.filter(F.col("slug") != ""), batch_ts)
        .groupBy("slug")
        .agg(*[_last(f, f"{f} IS NOT NULL", f"any_{f}") for f in _INCOMING], F.min("ord").alias("new_ord"))
    )
    return _overlay(book, folded, lambda f: f"coalesce(any_{f}, old.{f})", ord_base)


def _alias_rows(matched: DataFrame, book: DataFrame) -> DataFrame:
    """(slug, alias): distinct spellings per record, without its own company name.

    Copies are dropped before anything is gathered per record, so an array holds one entry per
    spelling however many rows there are.
    """
    names = F.explode(F.array("company", "short_name"))
    incoming = matched.select(F.col("matched_slug").alias("slug"), names.alias("alias")).filter(F.col("alias") != "").distinct()
    own = book.select("slug", F.col("company").alias("own_name"))
    # Names already stored as aliases stay even if one equals the company name.
    stored = book.select("slug", F.explode("aliases").alias("alias"))
    return (
        incoming.join(own, "slug")
        .filter(~F.col("alias").eqNullSafe(F.col("own_name")))
        .select("slug", "alias")
        .unionByName(stored)
        .distinct()
    )


def merge_backup(
    book: DataFrame, matched: DataFrame, batch_ts: Column | None = None, prefer: str = "order"
) -> DataFrame:
    """Merge matched secondary rows (``matched_slug``) into their primary records.

    Names become aliases, the last price the backup price, and other fields fill gaps. With
    ``batch_ts`` the touched records are stamped. ``prefer="latest"`` takes the price of the
    most recently updated row instead of the last in order.
    """
    rows = _aligned(matched, extra=("matched_slug",)).filter(F.col("matched_slug").isNotNull())
    rank = "ord" if prefer == "order" else "struct(updated_at, ord)"
    folded = rows.groupBy(F.col("matched_slug").alias("slug")).agg(
        F.expr(f"max_by(price, {rank}) FILTER (WHERE price IS NOT NULL) AS new_backup"),
        *[_first(f, _full(f), f"fill_{f}") for f in _FILLED],
        F.lit(True).alias("touched"),
    )
    aliases = _alias_rows(rows, book).groupBy("slug").agg(F.sort_array(F.collect_list("alias")).alias("all_aliases"))
    joined = book.alias("old").join(folded, "slug", "left").join(aliases, "slug", "left")

    def value(f: str) -> str:
        if f == "backup_price":
            return "coalesce(new_backup, old.backup_price)"
        if f == "aliases":
            return "coalesce(all_aliases, old.aliases)"
        if f in _FILLED:
            return f"CASE WHEN {_full(f, f'old.{f}')} THEN old.{f} ELSE coalesce(fill_{f}, old.{f}) END"
        return f"old.{f}"

    merged = joined.selectExpr("slug", *[f"{value(f)} AS {f}" for f in _INCOMING], "old.ord AS ord", "touched")
    if batch_ts is not None:
        merged = merged.withColumn("updated_at", F.when(F.col("touched"), batch_ts).otherwise(F.col("updated_at")))
    return merged.select(*BOOK_FIELDS)


def drop_reconciled(book: DataFrame, merged: DataFrame) -> DataFrame:
    return book.join(merged.select("slug"), "slug", "left_anti")


def leftover_matches(
    book: DataFrame,
    aliases: DataFrame | None = None,
    primary: str = "primary",
    secondary: str = "secondary",
    settled: DataFrame | None = None,
    leftovers: DataFrame | None = None,
    **kw,
) -> DataFrame:
    """Secondary records of the book that denote another, primary record now.

    ``leftovers`` are the secondary records to look at (all of the book's unless given); then the book may lack
    what ``resolve_entities`` does not read. ``settled`` lists names (company, short_name) already known to denote none; they are not
    resolved again.
    """
    if leftovers is None:
        leftovers = book.filter(F.col("source") == secondary)
    if settled is not None:
        keys = settled.select(source_key().alias("src")).distinct()
        leftovers = leftovers.withColumn("src", source_key()).join(keys, "src", "left_anti").drop("src")
    leftovers = stage(leftovers, "leftovers")
    if leftovers.isEmpty():
        return leftovers.withColumn("matched_slug", F.lit(None).cast("string"))
    hinted = leftovers.withColumn("stored_short", F.col("short_name")).withColumn(
        "short_name", F.coalesce(F.when(F.col("short_name") != "", F.col("short_name")), F.col("company"))
    )
    resolved = resolve_entities(hinted, book, aliases, primary, **kw)
    return (
        resolved.filter(F.col("matched_slug").isNotNull() & (F.col("matched_slug") != F.col("slug")))
        .withColumn("short_name", F.col("stored_short"))
        .drop("stored_short")
    )


def changed_names(old: DataFrame, new: DataFrame, primary: str = "primary") -> DataFrame:
    """(canon): names of primary records that came, went, or stand for another record or place in the order."""
    def known(names: DataFrame) -> DataFrame:
        return names.filter((F.col("source") == primary) & (F.col("company") != "")).select(
            F.col("company").alias("canon"), "slug", "ord"
        )

    before, after = known(old), known(new)
    return before.exceptAll(after).unionByName(after.exceptAll(before)).select("canon").distinct()


def affected_leftovers(
    leftovers: DataFrame,
    changed: DataFrame,
    aliases: DataFrame | None = None,
    limits: MatchLimits = MatchLimits(),
) -> DataFrame:
    """(slug) of the leftovers (slug, company, short_name) whose match may differ after these primary names changed.

    A leftover that matched nothing before still matches nothing unless it shares a key with a changed name.
    """
    hints = leftovers.filter(F.col("company") != "").select(
        "slug", "company", F.coalesce(F.when(F.col("short_name") != "", F.col("short_name")), F.col("company")).alias("short_name")
    )
    columns = ["company", "short_name"]
    if aliases is not None:
        hints, columns = alias_lookup(hints, aliases), [*columns, "mapped_name"]
    theirs = change_keys(changed, "canon", secondary=False, limits=limits).select("k").distinct()
    keys = change_keys(hints.select(*columns).distinct(), *columns, secondary=True, limits=limits)
    met = keys.join(theirs, "k", "left_semi").select(F.col("name").alias("company")).distinct()
    return hints.join(met, "company", "left_semi").select("slug")


def reconcile_leftovers(book: DataFrame, matches: DataFrame, prefer: str = "order") -> DataFrame:
    """Merge leftover records into their matches and drop them. ``updated_at`` stays."""
    return drop_reconciled(merge_backup(book, matches, prefer=prefer), matches)


def run_summary(book: DataFrame, incoming: DataFrame, resolved: DataFrame, removed: DataFrame) -> DataFrame:
    """Counts of a batch: scraped, inserted, updated, removed.

    Every input row with a slug counts once; the first row of a new slug is the insert, all
    others and every matched row are updates. ``incoming`` are the non-secondary rows,
    ``resolved`` the secondary ones with ``matched_slug``.
    """
    def counts(rows: DataFrame, **values: Column) -> DataFrame:
        names = ("scraped", "inserted", "updated", "removed")
        return rows.agg(*[F.coalesce(F.sum(values.get(n, F.lit(0))), F.lit(0)).alias(n) for n in names])

    one = F.lit(1)
    rows = incoming.select("slug", F.lit(None).cast("string").alias("matched_slug")).unionByName(
        resolved.select("slug", "matched_slug")
    )
    usable = F.coalesce(F.col("slug") != "", F.lit(False))
    merged = usable & F.col("matched_slug").isNotNull()
    known = book.select("slug", F.lit(True).alias("old"))
    placed = (
        rows.filter(usable & ~merged)
        .groupBy("slug")
        .agg(F.count(one).alias("n"))
        .join(known, "slug", "left")
        .withColumn("fresh", F.when(F.col("old").isNull(), 1).otherwise(0))
    )
    parts = (
        counts(rows, scraped=one, updated=F.when(merged, 1).otherwise(0))
        .unionByName(counts(placed, inserted=F.col("fresh"), updated=F.col("n") - F.col("fresh")))
        .unionByName(counts(removed, removed=one))
    )
    return parts.agg(*[F.sum(c).alias(c) for c in parts.columns])
