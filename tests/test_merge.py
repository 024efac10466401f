"""Merging: the folds against tables derived by hand, and repeated runs."""

import json
import shutil

import pytest
from pyspark.sql import functions as F

from quotebook.operators import listings as ops
from quotebook.operators import lookup, merge, publish
from quotebook.plans.upsert import run_batch, upsert_stocks
from quotebook.sources import api, detail, listings
from quotebook.sources import book as books
from quotebook.streaming import feed
from quotebook.streaming.upsert import stream_upsert

FIELDS = ("company", "slug", "source", "price", "sector", "industry", "isin", "short_name")
SCHEMA = "ord bigint, company string, slug string, source string, price double, sector string, industry string, isin string, short_name string"


def ts(day):
    return F.lit(f"2024-01-0{day} 00:00:00").cast("timestamp")


def frame(spark, rows, start=0):
    return spark.createDataFrame([(start + i, *[r.get(f) for f in FIELDS]) for i, r in enumerate(rows)], SCHEMA)


def row(company, slug, source="primary", price=None, **more):
    return {"company": company, "slug": slug, "source": source, "price": price, **more}


# Two batches and, derived by hand, the book and the counts after each.
FIRST = [
    row("Kx001 Alpha Ltd", "p-1", price=2.5, sector="S1"),
    row("Kx002 Bravo Ltd", "p-2", price=0.0),
    row("Kx001 Alpha Ltd", "p-1", sector="", isin="X"),  # empty values change nothing
    row("Kx001 Alpha Limited", "s-1", "secondary", 9.0),  # the same company
    row("Kx003 Power Nomatch", "s-3", "secondary", 1.5),  # unknown so far
]
ALPHA = {
    "company": "Kx001 Alpha Ltd", "slug": "p-1", "source": "primary", "price": 2.5, "sector": "S1", "isin": "X",
    "backup_price": 9.0, "aliases": ["Kx001 Alpha Limited"],
}
BRAVO = {"company": "Kx002 Bravo Ltd", "slug": "p-2", "source": "primary", "price": 0.0}
POWER = {"company": "Kx003 Power Nomatch", "slug": "s-3", "source": "secondary", "price": 1.5}
AFTER_FIRST, COUNTS_FIRST = {"p-1": ALPHA, "p-2": BRAVO, "s-3": POWER}, (5, 3, 2, 0)
SECOND = [row("Kx003 Power Nomatch Ltd", "p-3", price=4.0)]  # takes the secondary record in
POWER_FOUND = {
    "company": "Kx003 Power Nomatch Ltd", "slug": "p-3", "source": "primary", "price": 4.0,
    "backup_price": 1.5, "aliases": ["Kx003 Power Nomatch"],
}
AFTER_SECOND, COUNTS_SECOND = {"p-1": ALPHA, "p-2": BRAVO, "p-3": POWER_FOUND}, (1, 1, 0, 1)


def as_dict(book):
    keep = (*FIELDS, "backup_price", "aliases")
    return {r.slug: {k: r[k] for k in keep if r[k] is not None and not (k == "aliases" and not r[k])} for r in book.collect()}


def filled(rows):
    """Without the nulls and empty texts that no value took the place of."""
    return {slug: {k: x for k, x in r.items() if x not in (None, "")} for slug, r in rows.items()}


def test_two_batches(spark):
    book = books.empty_book(spark)
    for batch, (rows, want, counts) in enumerate(((FIRST, AFTER_FIRST, COUNTS_FIRST), (SECOND, AFTER_SECOND, COUNTS_SECOND))):
        result = upsert_stocks(book, frame(spark, rows), ts(batch + 1), batch=batch)
        assert filled(as_dict(result.book)) == want
        got = result.summary.first()
        assert (got.scraped, got.inserted, got.updated, got.removed) == counts
        assert [r.slug for r in result.book.orderBy("ord").collect()] == list(want)
        book = result.book


def test_rows_without_slug_count_as_scraped(spark):
    got = upsert_stocks(books.empty_book(spark), frame(spark, FIRST + [row("三菱", "")]), ts(1)).summary.first()
    assert (got.scraped, got.inserted) == (6, 3)


def test_same_batch_twice_changes_nothing(spark):
    rows = frame(spark, FIRST + SECOND)
    once = upsert_stocks(books.empty_book(spark), rows, ts(1), batch=0).book
    again = upsert_stocks(once, rows, ts(1), batch=1)
    assert as_dict(once) == as_dict(again.book)
    assert again.summary.first().inserted == 0


def test_documents_and_extras_count_as_empty(spark):
    raw = spark.createDataFrame(
        [(1, "A", "a", "primary", {"k": "v"}), (2, "A", "a", "primary", {}), (3, "A", "a", "primary", None)],
        "ord bigint, company string, slug string, source string, extra_data map<string,string>",
    )
    row = merge.upsert_primary(books.empty_book(spark), ops.normalize_listings(raw), ts(1)).first()
    assert row.extra_data == {"k": "v"} and row.documents == []


def test_merge_prefers_order_or_latest(spark):
    book = merge.upsert_primary(books.empty_book(spark), frame(spark, [{"company": "A", "slug": "a", "source": "primary"}]), ts(1))
    rows = spark.createDataFrame(
        [(1, "B", 5.0, "2024-02-02"), (2, "C", 6.0, "2024-02-01"), (3, "A", None, "2024-03-01")], "ord bigint, company string, price double, day string"
    ).selectExpr("ord", "company", "price", "cast(day AS timestamp) AS updated_at", "'a' AS matched_slug")
    by_order = merge.merge_backup(book, rows, ts(5)).first()
    assert (by_order.backup_price, by_order.aliases, by_order.updated_at.day) == (6.0, ["B", "C"], 5)
    latest = merge.merge_backup(book, rows, prefer="latest").first()
    assert (latest.backup_price, latest.updated_at.day) == (5.0, 1)


def test_publish_defaults(spark):
    raw = frame(spark, [{"company": "A", "slug": "a", "source": "primary", "price": 0.0}, {"company": "B", "slug": "b", "source": None}])
    book = merge.upsert_primary(books.empty_book(spark), raw, ts(1))
    rows = {r.Name: r.asDict() for r in publish.publish_prices(book).collect()}
    assert list(rows["A"]) == ["URL", "Name", "Short Name", "Aliases", "ISIN", "Latest Price", "Backup Price", "Change Abs", "Change Pct", "Last Updated", "Error"]
    assert rows["A"] == {
        "URL": None, "Name": "A", "Short Name": "", "Aliases": [], "ISIN": None, "Latest Price": 0.0, "Backup Price": None,
        "Change Abs": "0.00", "Change Pct": "0.00", "Last Updated": "2024-01-01 00:00:00", "Error": "",
    }
    assert [(r.metric, r.source, r.n_rows) for r in publish.book_metrics(book).collect()] == [("total", None, 2), ("source", "primary", 1)]
    assert [(r.metric, r.n_rows) for r in publish.book_metrics(books.empty_book(spark)).collect()] == [("total", 0)]
    assert publish.name_lookup(publish.publish_prices(book), "^b").first().Name == "B"


def test_published_files(spark, tmp_path):
    book = merge.upsert_primary(books.empty_book(spark), frame(spark, [{"company": "A", "slug": "a", "source": "primary"}]), ts(1))
    path = str(tmp_path / "out")
    publish.write_published(book, path)
    text = "".join(r.value for r in spark.read.text(path).collect())
    assert '"URL":null' in text and '"Backup Price":null' in text
    assert books.read_published(spark, path).collect() == publish.publish_prices(book).collect()
    array = tmp_path / "stocks.json"
    array.write_text("[" + text + ",\n" + text + "]")
    assert books.read_published(spark, str(array)).count() == 2


def test_published_order_and_swap(spark, tmp_path):
    def book_of(slugs, first=0):
        raw = frame(spark, [{"company": f"{s} Limited", "slug": s, "source": "primary"} for s in slugs])
        return merge.upsert_primary(books.empty_book(spark), raw.withColumn("ord", F.col("ord") + first), ts(1))

    path = str(tmp_path / "out")
    slugs = [f"s{i * 7919 % 100:02d}" for i in range(100)]
    publish.write_published(book_of(slugs).repartition(7), path)
    rows = books.read_published(spark, path, positions=True)
    assert [(r.Position, r.Name) for r in rows.orderBy("Position").collect()] == [(i, f"{s} Limited") for i, s in enumerate(slugs)]
    # The lines of the files, in order of their names, are the rows in order.
    lines = [json.loads(x)["Position"] for f in sorted((tmp_path / "out").glob("part-*")) for x in f.read_text().splitlines()]
    assert lines == list(range(100))
    assert publish.name_lookup(rows, "^S.*").first().Name == f"{slugs[0]} Limited"
    assert publish.name_lookup(books.read_published(spark, path), "^S.*").first().Name == "s00 Limited"
    index = lookup.trigram_index(rows)
    assert lookup.indexed_lookup(rows, index, "limited").first().Name == f"{slugs[0]} Limited"

    # A job that fails leaves the former table as it is; one that ends replaces all of it, and leaves nothing beside.
    broken = book_of(["x"]).withColumn("company", F.expr("raise_error('no')").cast("string"))
    with pytest.raises(Exception, match="no"):
        publish.write_published(broken, path)
    assert books.read_published(spark, path).count() == 100
    publish.write_published(book_of(["x", "y"], 5), path)
    assert [(r.Position, r.Name) for r in books.read_published(spark, path, positions=True).orderBy("Position").collect()] == [(0, "x Limited"), (1, "y Limited")]
    publish.write_published(books.empty_book(spark), path)
    assert books.read_published(spark, path, positions=True).collect() == []
    assert not [p for p in tmp_path.iterdir() if p.name.endswith(".old")]
    array = tmp_path / "stocks.json"
    array.write_text('[{"Name": "b"}, {"Name": "a"}]')
    assert publish.name_lookup(books.read_published(spark, str(array), positions=True), ".").first().Name == "b"


def test_run_batch(spark, tmp_path):
    root, out = str(tmp_path / "book"), str(tmp_path / "published")
    primary, secondary = frame(spark, FIRST[:3]), frame(spark, FIRST[3:])
    summary = run_batch(root, primary, secondary, ts(1), publish_to=out).first()
    assert (summary.scraped, summary.inserted, summary.updated, summary.removed) == COUNTS_FIRST
    assert filled(as_dict(books.read_book(spark, root))) == AFTER_FIRST
    assert books.read_published(spark, out).count() == 3
    wanted = spark.createDataFrame([("p-1",)], "entry string")
    again = run_batch(root, primary, secondary, ts(2), priority=wanted, source="primary").first()
    assert (again.scraped, again.inserted) == (2, 0)
    assert books.versions(spark, root) == [0, 1]
    nothing = run_batch(root, primary, secondary, ts(3), priority=wanted.limit(0)).first()
    assert (nothing.scraped, nothing.inserted) == (0, 0) and books.versions(spark, root) == [0, 1]
    third = frame(spark, [row("Third Source Ltd", "d-1", "detail", 3.0)])
    run_batch(root, primary.limit(0), third, ts(4))
    assert "d-1" in as_dict(books.read_book(spark, root))


def test_landed_sources_to_published_rows(spark, tmp_path):
    """Pages, API responses and detail pages in one batch: the first of two items of a run counts."""
    payload = '{"shares":[{"name":"Acme Rockets","slug":"acme","price":"10"},{"name":"Acme Rockets","slug":"acme","price":"20"}]}'
    pages = spark.createDataFrame([(1, 1, payload), (1, 60, payload.replace("Acme", "Zeta").replace("acme", "zeta"))], "source_run bigint, page_num bigint, body string")
    answer = '{"data":[{"UL_STOCKS_COMPNAME":"Bolt Works","current_price_calculated":"1_000"},{"UL_STOCKS_COMPNAME":"Acme Rockets","current_price_calculated":"11"}]}'
    responses = spark.createDataFrame([(0, answer)], "ord bigint, body string")
    detail_page = "<h1>\u682a\u5f0f\u4f1a\u793e</h1><p>&#x20B9; 55.5</p>"
    facts = detail.detail_listings(spark.createDataFrame([(1, "u/in/listing/kk", detail_page)], "page_id bigint, url string, html string"), "http://b")
    primary = (listings.read_listing_pages(pages, "http://p"), facts.withColumn("ord", F.lit(0)))
    secondary = api.scan_api_items(api.explode_responses(responses))
    root, out = str(tmp_path / "book"), str(tmp_path / "published")
    counts = run_batch(root, primary, secondary, ts(1), publish_to=out).first()
    assert (counts.scraped, counts.inserted, counts.updated) == (5, 4, 1)
    rows = {r.Name: (r["Latest Price"], r["Backup Price"]) for r in books.read_published(spark, out).collect()}
    assert rows == {
        "Acme Rockets": (10.0, 11.0), "Zeta Rockets": (10.0, None), "Bolt Works": (1000.0, None), "\u682a\u5f0f\u4f1a\u793e": (55.5, None),
    }


# --- streaming ---------------------------------------------------------------------------------


def test_feed_over_several_batches(spark, tmp_path):
    lines = tmp_path / "lines"
    lines.mkdir()
    for i in range(3):
        (lines / f"{i}.log").write_text(
            f'INFO {i}\nLIVE_DATA:{{"company": "c{i}", "price": {i}.5, "source": "s{i % 2}"}}\nLIVE_DATA:{{broken\nLIVE_DATA:{{"company": "x", "price": "1", "source": "s0"}}\n'
        )
    stream = lambda: feed.read_lines(spark, str(lines), maxFilesPerTrigger=1)
    out = str(tmp_path / "out")
    feed.append_to(feed.live_feed(stream()), out, str(tmp_path / "c1")).awaitTermination()
    got = sorted((r.company, r.price, r.source) for r in spark.read.parquet(out).collect())
    assert got == [("c0", "0.5", "s0"), ("c1", "1.5", "s1"), ("c2", "2.5", "s0"), ("x", "1", "s0"), ("x", "1", "s0"), ("x", "1", "s0")]
    counts = str(tmp_path / "counts")
    feed.snapshot_to(feed.live_source_counts(feed.live_feed(stream())), counts, str(tmp_path / "c2")).awaitTermination()
    assert {(r.source, r.n_rows) for r in feed.latest_snapshot(spark, counts, "source string, n_rows bigint").collect()} == {("s0", 5), ("s1", 1)}
    batch = feed.feed_other_lines(spark.read.text(str(lines)).withColumnRenamed("value", "line"))
    assert sorted(r.line for r in batch.collect()) == ["INFO 0", "INFO 1", "INFO 2"]


def test_stream_upsert_after_a_batch_and_a_lost_checkpoint(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "book")
    run_batch(root, frame(spark, FIRST[:3]), frame(spark, FIRST[3:]), ts(1))

    def run(state):
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(source))
        stream_upsert(stream, root, str(tmp_path / state), ts(1)).awaitTermination()

    # The stream's first batch has number 0, as the batch job's version has.
    frame(spark, SECOND).coalesce(1).write.mode("append").parquet(str(source))
    run("one")
    assert books.versions(spark, root) == [0, 1]
    assert filled(as_dict(books.read_book(spark, root))) == AFTER_SECOND
    # A lost checkpoint and new files: the old files change nothing, the new ones are merged.
    frame(spark, [row("Kx009 Late Ltd", "p-9", price=8.0)]).coalesce(1).write.mode("append").parquet(str(source))
    run("two")
    late = {"company": "Kx009 Late Ltd", "slug": "p-9", "source": "primary", "price": 8.0}
    assert filled(as_dict(books.read_book(spark, root))) == {**AFTER_SECOND, "p-9": late}
    made = books.versions(spark, root)
    # A batch that is replayed with its checkpoint is not made again.
    shutil.rmtree(tmp_path / "two" / "commits")
    run("two")
    assert books.versions(spark, root) == made
