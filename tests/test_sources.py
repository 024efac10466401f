"""Landed payloads: odd and broken input."""

import json

import pytest
from pyspark.sql import functions as F

from quotebook.operators import listings as ops
from quotebook.sources import api, book, cards, detail, listings, priority

BASE = "https://primary.example"


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), "source_run bigint, page_num bigint, body string")


def payload(*items, tail=',"more":[1]'):
    return 'x{"shares":[' + ",".join(i if isinstance(i, str) else json.dumps(i) for i in items) + "]" + tail


def test_payload_elements(spark):
    body = payload(
        {"name": "A [x] Ltd", "price": 12.5, "slug": "a", "lot_size": 100, "as_of": ""},
        "7", '"text"', "null", "[1]",
        {"name": "B", "price": "₹ 1,000", "slug": None, "as_of": "today"},
        {"name": "", "price": 1}, {"name": "C", "price": "n/a"},
    )
    rows = listings.project_primary_items(
        listings.scan_json_payload(pages(spark, (1, 1, body), (1, 2, "none"), (1, 3, 'x"shares":[{"name":'), (1, 4, None))), BASE
    )
    got = {r.company: r for r in rows.collect()}
    assert set(got) == {"A [x] Ltd", "B"}
    assert got["A [x] Ltd"].price == 12.5 and got["A [x] Ltd"].url == f"{BASE}/shares/a"
    assert got["A [x] Ltd"].extra_data == {"Lot Size": "100"}
    assert got["B"].price == 1000.0 and got["B"].url is None and got["B"].extra_data == {"As Of": "today"}


def card(name, price, href, extra=""):
    link = f'<a class="det x" href="{href}">go</a>' if href is not None else ""
    return f'<div class="card scard"><p class="nm"> {name} <b>Ltd</b></p><div class="price">{extra}<span class="p">{price}</span></div>{link}</div>'


def test_cards(spark):
    body = (
        "<div>" + card("A &amp; B", "₹ 1,200", "/shares/a-b/") + card("No price", "soon", "/x") + card("C", "7<br>.5", None)
        + '<div class="scard"><i class="nm">D</i><img><span class="p">9</span></div>' + card("E", "3", "http://other/e") + "</div>"
    )
    got = [(r.company, r.price, r.url, r.slug) for r in cards.scan_html_cards(pages(spark, (1, 1, body), (1, 2, "")), BASE).orderBy("pos").collect()]
    assert got == [
        ("A & B Ltd", 1200.0, f"{BASE}/shares/a-b/", "a-b"),
        ("C Ltd", 7.5, None, None),
        ("E Ltd", 3.0, "http://other/e", "e"),
    ]


def test_fallback_only_without_payload(spark):
    both = payload({"name": "A", "price": 1, "slug": "a"}) + card("Card", "5", "/c")
    rows = listings.page_fallback(pages(spark, (1, 1, both), (1, 2, card("B", "5", "/b")), (1, 3, "")), BASE)
    assert {(r.page_num, r.company) for r in rows.collect()} == {(1, "A"), (2, "B Ltd")}


@pytest.mark.parametrize(
    "filled, kept",
    [
        ([1, 2, 3], [1, 2, 3]),
        ([1, 3, 5, 8], [1, 3, 5]),
        ([3, 4], []),
        ([2, 4], [2, 4]),
        ([1, 40, 41], [1]),
        (list(range(1, 45)), list(range(1, 45))),
    ],
)
def test_cutoff(spark, filled, kept):
    rows = spark.createDataFrame([(1, p) for p in filled], "source_run bigint, page_num bigint")
    assert sorted(r.page_num for r in listings.page_cutoff(rows).collect()) == kept
    assert sorted(r.page_num for r in listings.page_cutoff(rows, 3).collect()) == [p for p in kept if p <= 3]


def test_read_listing_pages_order(spark):
    rows = listings.read_listing_pages(
        pages(spark, (1, 2, payload({"name": "C", "price": 1, "slug": "a"})), (1, 1, payload({"name": "A", "price": 1, "slug": "a"}, {"name": "B", "price": 2}))), BASE
    )
    first = ops.dedup_first(rows).orderBy("ord")
    assert [r.company for r in first.collect()] == ["A", "B"]
    assert "WindowGroupLimit" in first._jdf.queryExecution().toString()


def test_api_items(spark):
    items = [
        {"UL_STOCKS_COMPNAME": "A Ltd", "UL_PD_BID_PRICE": "", "current_price_calculated": 12.5, "MCAP": 0, "STOCK_PE": "0", "isin": "INE1", "ISIN": ""},
        {"UL_STOCKS_COMPNAME": "B_x Ltd", "UL_PD_BID_PRICE": 0, "current_price_calculated": "9", "UL_STOCKS_S_NAME": "BX", "UL_STOCKS_LOT_SIZE": 10},
        {"UL_STOCKS_COMPNAME": "C", "UL_PD_BID_PRICE": "abc", "current_price_calculated": 5},
        {"UL_STOCKS_COMPNAME": "D", "UL_PD_BID_PRICE": "-1"},
        {"UL_STOCKS_COMPNAME": "", "UL_PD_BID_PRICE": "5"},
        {"UL_STOCKS_COMPNAME": "E"},
    ]
    responses = spark.createDataFrame([(1, json.dumps({"data": items})), (2, "broken"), (3, "{}")], "ord bigint, body string")
    got = {r.company: r for r in api.scan_api_items(api.explode_responses(responses)).collect()}
    assert set(got) == {"A Ltd", "B_x Ltd"}
    assert (got["A Ltd"].price, got["A Ltd"].isin, got["A Ltd"].extra_data) == ("12.5", "INE1", {"P/E": "0"})
    assert (got["B_x Ltd"].price, got["B_x Ltd"].slug, got["B_x Ltd"].short_name) == ("9", "b-x-ltd", "BX")
    assert got["B_x Ltd"].extra_data == {"Lot Size": "10", "Short Name": "BX"}


def detail_page(spark, html, url="https://d.example/in/listing/foo/"):
    return spark.createDataFrame([(1, url, html)], "page_id bigint, url string, html string")


def test_page_facts(spark):
    html = "<!doctype html><style>₹ 1</style><script>var a='₹ 2'</script><!-- ₹ 3 --><h1> Foo &amp; <b>Bar</b></h1><p>Price&nbsp;&#8377; <i>1,234.50</i></p>XINE123456789Z"
    row = detail.extract_page_facts(detail_page(spark, html)).first()
    assert (row.company, row.price, row.isin, row.slug) == ("Foo &Bar", "1234.50", "INE123456789", "foo")
    assert detail.extract_page_facts(detail_page(spark, "<p>no heading ₹ 5</p>")).count() == 0


def test_pairs(spark):
    def pairs(html):
        return {r.key: r.value for r in detail.extract_kv_pairs(detail_page(spark, html)).collect()}

    assert pairs("<p>A: x B: y C: z</p>") == {"y C": "z"}
    assert pairs("<pre>PE: 12\nLot Size : 50\nPE: 13\nx</pre>") == {"PE": "13", "Lot Size": "50"}
    assert pairs("no pairs") == {}
    assert pairs("<p>" + "word " * 20000 + "</p>") == {}


def test_documents_and_links(spark):
    html = (
        '<a href="/r.pdf">One</a><a href="/r.pdf">Two</a><a href="x">Annual Report</a><a href="/y.PDF"></a>'
        '<a href="/in/listing/b">B</a><a href="/in/listing/a">A</a><a href="/in/listing/b">B again</a><a href="/in/listing">all</a>'
    )
    page = detail_page(spark, html)
    docs = {(r.title, r.url) for r in detail.extract_document_links(page, "https://d.example").collect()}
    assert docs == {("One", "https://d.example/r.pdf"), ("Annual Report", "https://d.example/x")}
    links = detail.harvest_listing_links(page, "https://d.example").orderBy("page_id", "pos").collect()
    assert [r.url for r in links] == ["https://d.example/in/listing/b", "https://d.example/in/listing/a"]


def test_priority_list(spark, tmp_path):
    path = tmp_path / "p.json"
    path.write_text('{"high_priority_stocks":\n ["a", "https://x/shares/b/"]}')
    read = lambda **kw: sorted(r.entry for r in priority.read_priority_list(spark, **kw).collect())
    assert read(path=str(path)) == ["a", "https://x/shares/b/"]
    assert read(inline='{"high_priority_stocks": ["c"]}', path=str(path)) == ["c"]
    assert read(inline="{broken", path=str(path)) == ["a", "https://x/shares/b/"]
    assert read() == []
    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "slug string")
    assert sorted(r.slug for r in ops.priority_semi_join(rows, priority.read_priority_list(spark, path=str(path))).collect()) == ["a", "b"]


def test_book_versions(spark, tmp_path):
    root = str(tmp_path / "book")
    assert book.read_book(spark, root).count() == 0
    rows = book.empty_book(spark)
    one = rows.unionByName(spark.createDataFrame([("A", "a")], "company string, slug string"), allowMissingColumns=True)
    assert book.write_book(one, root) == 0 and book.write_book(rows, root) == 1
    assert book.read_book(spark, root).count() == 0 and book.read_book(spark, root, before=1).count() == 1
    book.write_book(one, root, 1)  # already committed: left alone
    assert book.read_book(spark, root).count() == 0
    (tmp_path / "book" / "version=2").mkdir()  # a write that did not finish
    assert book.versions(spark, root) == [0, 1]


def test_import_json(spark, tmp_path):
    path = tmp_path / "book.json"
    path.write_text(json.dumps({"b": {"company": "B", "slug": "b", "price": 5, "documents": [{"title": "t", "url": "u"}], "aliases": ["x"], "updated_at": "2024-01-02T03:04:05.5"}, "a": {"company": "A", "extra_data": {"k": "v"}}}, indent=1))
    got = book.import_book_json(spark, str(path)).orderBy("ord").collect()
    assert [(r.slug, r.company, r.price) for r in got] == [("b", "B", 5.0), ("a", "A", None)]
    assert got[0].documents[0].title == "t" and got[0].updated_at.second == 5 and got[1].extra_data == {"k": "v"}
    path.write_text("{broken")
    assert book.import_book_json(spark, str(path)).count() == 0


def test_normalize(spark):
    raw = spark.createDataFrame([(1, "Foo Ltd", "", "₹ 5", 2.5, "s"), (2, "", "x", "1", 1.0, "s"), (3, None, "x", "1", 1.0, "s")], "ord int, company string, slug string, price string, pe double, short_name string")
    rows = ops.normalize_listings(raw)
    assert len(rows.columns) == 23
    row = rows.collect()
    assert len(row) == 1 and (row[0].slug, row[0].price, row[0].pe, row[0].documents, row[0].extra_data) == ("foo-ltd", 5.0, 2.5, [], {})
    assert "short_name" in ops.normalize_listings(raw, keep_short_name=True).columns


def test_filter_valid_numeric_price(spark):
    rows = spark.createDataFrame([(1.0,), (0.0,), (float("nan"),), (None,)], "price double")
    assert ops.filter_valid_price(rows).count() == 2
    assert ops.filter_source(rows.select(F.lit("primary").alias("source")), "secondary").count() == 0
    assert ops.filter_source(rows.select(F.lit("detail").alias("source")), "all").count() == 4


def test_sources_with_text_and_number_prices(spark):
    pages = spark.createDataFrame([(1, 10.5)], "ord bigint, price double")
    items = spark.createDataFrame([(1, "1_000"), (2, "7")], "ord bigint, price string")
    rows = ops.union_sources(pages, items).orderBy("ord").collect()
    assert [r.price for r in rows] == [10.5, 1000.0, 7.0]
    with pytest.raises(Exception, match="ord out of range"):
        ops.union_sources(pages.withColumn("ord", F.lit(ops.SOURCE_STRIDE)), items).collect()


def test_character_references(spark):
    texts = ["&#x20B9; 55.5", "a&#x2014;b", "&eacute;t&Eacute;", "&amp;lt; &lt;", "&#38;lt;", "&nosuch; &#0; &#1114112;", "&#65;&#X42;", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r.t for r in rows.select("i", detail._decode_entities(F.col("t")).alias("t")).orderBy("i").collect()]
    assert got == ["\u20b9 55.5", "a\u2014b", "\u00e9t\u00c9", "&lt; <", "&lt;", "&nosuch; &#0; &#1114112;", "AB", None]
    page = spark.createDataFrame([(1, "u/in/listing/x", "<h1>A</h1><p>&#x20B9; 55.5</p>")], "page_id bigint, url string, html string")
    assert detail.extract_page_facts(page).first().price == "55.5"
