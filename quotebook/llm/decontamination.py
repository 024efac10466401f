"""Benchmark decontamination by a distributed positional inverted index.

The index holds the postings (row, term, position) of every training token that is a test term, in a shared
table. Test items are cut into windows of ten words. A window can only occur where all its terms do, so the
lists of a window are intersected from its rarest term on: each posting, less the term's offset in the window,
is a place where the window may start; the second rarest term's list thins these out, then all other terms
confirm them. With `slop` 0 the survivors are exact phrases; with more, every term lies within so many words of
its place (a proximity match). Only DataFrame operations are used.

Nulls: a null text has no words; a null item id counts as the empty string. Empty and word-less items give no
window. Repeated rows each give a row, with the same hits. Empty tables: without documents an empty result,
without items no hits. Other columns of the inputs, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotebook.llm.staging import keep, planned, sized

WINDOW = 10
#: Test terms, lists and candidate rows are broadcast up to so many entries, else joined by exchange.
BROADCAST_ROWS = 500_000
# What separates words; upper and lower case.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _pieces(text: str) -> Column:
    """Words in order; the first and the last may be empty, where separators open or close the text."""
    return F.split(F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _UPPER.lower()), _BETWEEN)


def _sized(df: DataFrame) -> DataFrame:
    return sized(df, BROADCAST_ROWS)


def windows_of(items: DataFrame, item_col: str, text_col: str, window: int) -> tuple[DataFrame, DataFrame]:
    """Windows (wid, words) and the items (wid, item) they come from."""
    words = F.filter(_pieces(text_col), lambda w: w != "")
    n = F.size("words")
    last = F.greatest(n - window + 1, F.lit(1))
    cut = (
        items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), words.alias("words"))
        .where(n > 0)
        .select("item", F.explode(F.transform(F.sequence(F.lit(1), last), lambda i: F.slice("words", i, window))).alias("words"))
        .select("item", F.md5(F.concat_ws(" ", "words")).alias("wid"), "words")
    )
    cut = keep(cut.distinct(), "decon-windows")
    return cut.select("wid", "words").dropDuplicates(["wid"]), cut.select("wid", "item")


def build_index(docs: DataFrame, terms: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Postings (id, h, term, pos) of the terms (word, term), and of each row one line with `n_words`."""
    pieces = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("h"), _pieces(text_col).alias("p")
    )
    empty = (F.element_at("p", 1) == "").cast("int") + (F.element_at("p", -1) == "").cast("int")
    pieces = pieces.select("id", "h", "p", F.greatest(F.size("p") - empty, F.lit(0)).alias("n"), (F.size("p") - 1).alias("end"))
    posted = pieces.select("id", "h", "n", "end", F.posexplode("p").alias("pos", "word"))
    posted = posted.join(_sized(terms), "word", "left").where("term is not null or pos = end")
    return keep(posted.select("id", "h", "term", "pos", F.expr("if(pos = end, n, null)").alias("n_words")), "decon-index")


def match(index: DataFrame, windows: DataFrame, terms: DataFrame, slop: int = 0) -> DataFrame:
    """Where windows (wid, words) occur: id, h, wid, start and length in words."""
    postings = index.where("term is not null").select("id", "h", "term", "pos")
    found = postings.groupBy("term").agg(F.count("*").alias("df"))
    parts = windows.select("wid", F.size("words").alias("length"), F.posexplode("words").alias("offset", "word"))
    parts = parts.join(_sized(terms), "word").join(planned(found, terms.count()), "term", "left")
    whole = Window.partitionBy("wid")
    # A window with a term that no document has cannot occur.
    parts = parts.withColumn("least", F.min(F.coalesce("df", F.lit(0))).over(whole)).where("least > 0")
    parts = parts.withColumn("rank", F.row_number().over(whole.orderBy("df", "offset")))
    parts = keep(parts.select("wid", "length", "term", "offset", "rank"), "decon-parts")

    rarest = parts.where("rank = 1").select("wid", "length", "term", "offset")
    starts = postings.join(_sized(rarest), "term").select("id", "h", "wid", "length", (F.col("pos") - F.col("offset")).alias("start"))
    starts = keep(starts.distinct(), "decon-starts")
    # Rows with a place where a window may start; of all others the postings are done with.
    rows = keep(starts.select("id", "h").distinct(), "decon-rows")
    here = _same(postings, _sized(rows), ["h"], "left_semi")
    here = keep(here, "decon-near")
    n_near = here.count()

    def confirm(places: DataFrame, ranks: str, near: DataFrame) -> DataFrame:
        needed = parts.where(ranks).select("wid", "term", "offset")
        # Postings of terms that are not asked for stay where they are.
        near = near.join(_sized(needed.select("term").distinct()), "term", "left_semi")
        asked = places.join(_sized(needed), "wid").select(
            "id", "h", "wid", "length", "start", "offset", "term",
            F.explode(F.sequence(F.col("start") + F.col("offset") - slop, F.col("start") + F.col("offset") + slop)).alias("pos"),
        )
        met = _same(asked, planned(near, n_near), ["h", "term", "pos"], "left_semi")
        n = met.groupBy("id", "h", "wid", "length", "start").agg(F.countDistinct("offset").alias("n"))
        want = parts.where(ranks).groupBy("wid").agg(F.count("*").alias("want"))
        return n.join(_sized(want), "wid").where("n = want").select("id", "h", "wid", "length", "start")

    single = starts.where("length = 1")
    pairs = keep(confirm(starts.where("length > 1"), "rank = 2", here), "decon-pairs")
    left = pairs.where("length > 2").select("id", "h").distinct()
    if left.count() <= BROADCAST_ROWS:
        # The two rarest terms leave few rows; if not, the join below does without this.
        here = _same(here, F.broadcast(left), ["h"], "left_semi")
    more = confirm(pairs.where("length > 2"), "rank > 2", here)
    return single.unionByName(pairs.where("length = 2")).unionByName(more)


def _same(left: DataFrame, right: DataFrame, columns: list[str], how: str) -> DataFrame:
    """Join on the row (its id may be null) and the columns."""
    right = right.select(F.col("id").alias("_id"), *[F.col(c).alias("_" + c) for c in columns])
    on = F.col("id").eqNullSafe(F.col("_id"))
    for c in columns:
        on &= F.col(c) == F.col("_" + c)
    return left.join(right, on, how)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    slop: int = 0,
) -> DataFrame:
    """id, h, n_words, n_hit, n_items, items (sorted, comma-joined), contaminated, for every row."""
    windows, sources = windows_of(items, item_col, item_text_col, window)
    words = windows.select(F.explode("words").alias("word")).distinct()
    terms = keep(words.select("word", F.monotonically_increasing_id().alias("term")), "decon-terms")
    index = build_index(docs, terms, id_col, text_col)
    hits = keep(match(index, windows, terms, slop), "decon-hits")

    # Words inside any window: intervals in order of their start, each counted from where the last ones end.
    earlier = Window.partitionBy("id", "h").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    inside = (
        hits.select("id", "h", "start", "length").distinct()
        .withColumn("reached", F.coalesce(F.max(end).over(earlier), F.lit(0)))
        .groupBy("id", "h")
        .agg(F.sum(F.greatest(F.lit(0), end - F.greatest("start", "reached"))).alias("n_hit"))
    )
    met = hits.select("id", "h", "wid").distinct().join(_sized(sources), "wid")
    met = met.groupBy("id", "h").agg(F.array_sort(F.collect_set("item")).alias("ids"))
    met = met.select(F.col("id").alias("_id"), F.col("h").alias("_h"), "ids")
    row = F.col("id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h"))
    summary = inside.join(planned(met, hits.count()), row).select("_id", "_h", "n_hit", "ids")
    rows = index.where("n_words is not null").select("id", "h", "n_words")
    out = rows.join(planned(summary, index.count()), row, "left")
    return out.select(
        F.col("id").alias(id_col), "h", F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.when(F.col("ids").isNull(), F.lit(0)).otherwise(F.size("ids")).cast("long").alias("n_items"),
        F.coalesce(F.concat_ws(",", "ids"), F.lit("")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns, that hold no window of any item."""
    found = contamination(docs, items, id_col, text_col).where("contaminated")
    found = keep(found.select(F.col(id_col).alias("_id"), F.col("h").alias("_h")).distinct(), "decon-found")
    h = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    return docs.join(_sized(found), F.col(id_col).eqNullSafe(F.col("_id")) & (h == F.col("_h")), "left_anti")
