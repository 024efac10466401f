import random

import numpy as np

from quotebook.llm import html_text
from quotebook.llm.queries import op2_html_text
from tests.conftest import SMALL


def _page(article, extra="", menu="Home About Contact", foot="All rights reserved by the owners of this very site"):
    return (
        f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t='</p><nav>';</script></head><body><header>Site</header>"
        f"<nav><ul><li><a href='/'>{menu}</a></li></ul></nav><!-- x --><div class=\"ad top\">Buy now</div>{article}{extra}<footer>{foot}</footer></body></html>"
    )


def test_structure():
    page = _page(
        "<article><h1>Title &amp; more</h1><p>One <b>two</b>\n three<br>four<p>Five &#x41;&eacute;<div class='share'>Share it</div><aside>Side</aside>"
        "<form><p>Name</p></form><p hidden>no</p><p title='a>b'>6 &lt; 7</article>",
        "<section id='comments'><article><p>Reader says</p></article></section>",
    )
    assert html_text.main_texts([1], [page]) == ["Title & more\nOne two three four\nFive Aé\n6 < 7"]
    assert html_text.main_texts([1, 2, 3], ["", "just text", "<p>a<p>b</p><script>x"]) == ["", "just text", "a\nb"]
    assert html_text.main_texts([1], ["<body><nav>Menu<ul><li>x<article>Kept <i>text"]) == ["Kept text"]


def test_runs_match_brute_force():
    rng = random.Random(6)
    for _ in range(60):
        pages = np.sort(np.array([rng.randrange(4) for _ in range(rng.randrange(1, 60))]))
        tokens = np.array([rng.randrange(3) for _ in pages])
        least = rng.randrange(1, 6)
        _, again = html_text.repeated_runs(tokens, pages, least)
        where = {}
        for i in range(len(tokens) - least + 1):
            if pages[i] == pages[i + least - 1]:
                where.setdefault(tuple(tokens[i : i + least]), set()).add(pages[i])
        want = [i + least <= len(tokens) and pages[i] == pages[i + least - 1] and len(where[tuple(tokens[i : i + least])]) > 1 for i in range(len(tokens))]
        assert again.tolist() == want


def test_repeated_boilerplate_goes_and_shared_articles_stay():
    line = "this text stands below every single page of our site and says nothing"
    free = [f"<div>{line}</div><div>page {i} tells story {i} with words {i} {i + 1}</div>" for i in range(4)]
    assert html_text.main_texts(list(range(4)), free) == [f"page {i} tells story {i} with words {i} {i + 1}" for i in range(4)]
    twins = [_page("<article><p>the same article is printed on these two pages of the same host</p></article>")] * 2
    assert html_text.main_texts([1, 2], twins) == ["the same article is printed on these two pages of the same host"] * 2
    mixed = [_page(f"<p>own words {i}</p><p>{line}</p>", foot=line) for i in range(2)]
    assert html_text.main_texts([1, 2], mixed) == ["own words 0", "own words 1"]
    quoted = [_page(f"<article><p>own words {i}</p><p>{line}</p></article>", foot=line) for i in range(2)]
    assert html_text.main_texts([1, 2], quoted) == [f"own words {i}\n{line}" for i in range(2)]
    assert html_text.main_texts([1, 1], [free[0]] * 2) == [f"{line}\n" + "page 0 tells story 0 with words 0 1"] * 2


def test_query_and_odd_tables(spark):
    rows = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    got = {r.page_id: r for r in op2_html_text(spark, SMALL).collect()}
    assert len(got) == len(rows)
    for r in rows:
        inside = r.html.split("<article>")[1].split("</article>")[0].split("<footer>")[0]
        plain = html_text.main_texts([0], [f"<article>{inside}</article>"])[0]
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (plain, len(plain), r.url)
    odd = spark.createDataFrame([(1, None, None, 0), (1, None, "x", 0), (None, "//h", "<p>y", 0), (2, "http://U@H:1/", "z" * 100_000, 0)], "page_id long, url string, html string, text int")
    assert sorted(r.n_chars for r in html_text.extract_text(odd, part_bytes=50).collect()) == [0, 1, 1, 100_000]
    assert html_text.extract_text(odd.limit(0)).collect() == []


def test_parts_of_a_host_share_their_repeats(spark, monkeypatch):
    rng = random.Random(9)
    pages = []
    for i in range(60):
        own = " ".join(f"w{rng.randrange(10**6)}" for _ in range(30))
        pair = " ".join(f"pair{i // 2}x{k}" for k in range(12))  # stands on two pages only
        body = f"<div>{own}</div><div>{pair}</div>"
        pages.append(_page(f"<article><p>{own}</p><p>{pair}</p></article>") if i % 10 == 0 else body)
    rows = [(i, "http://h/x", p) for i, p in enumerate(pages)] + [(5, "http://h/y", pages[5])] + [(900 + i, "http://small/", p) for i, p in enumerate(pages[1:3])]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")

    def texts(**options):
        return sorted((r.page_id, r.url, r.text) for r in html_text.extract_text(docs, **options).collect())

    whole = texts()
    assert texts(part_bytes=1000) == whole
    monkeypatch.setattr(html_text, "BROADCAST_ROWS", 0)
    assert texts(part_bytes=1000) == whole
    assert not any("pair1x" in t for i, _, t in whole if i < 900) and any("pair0x" in t for _, _, t in whole)


def test_remarks_on_the_layout_are_no_marks():
    text = "<p>The whole main text</p>"
    for page in (
        f"<body class='has-sidebar'>{text}</body>", f"<body class='sidebar'>{text}</body>", f"<html id='ad'><body>{text}</body></html>",
        f"<div class='content with-sidebar'>{text}</div>", f"<main class='site-main no-sidebar'>{text}</main>",
        f"<article class='post has-comments'>{text}</article>", f"<article class='comments'>{text}</article>",
        f"<div class='content-sidebar-wrap'>{text}</div>", f"<div class='layout--sidebar'>{text}</div>", f"<div class='search-engine-basics'>{text}</div>",
    ):
        assert html_text.main_texts([1], [page]) == ["The whole main text"], page
    for name in ("sidebar", "site-footer", "cookie_banner", "ad-container", "ad-box-2", "widget__nav", "share-buttons", "related-posts", "x sidebar--dark"):
        assert html_text.main_texts([1], [f"<div class='{name}'>gone</div>{text}"]) == ["The whole main text"], name


NOTICE = "we and our many partners read what your browser tells us about you"


def _main(i, words=60, notice=NOTICE):
    rng = random.Random(i)
    own = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    return f"<main><p>{' '.join(own)}</p><div>{notice}</div></main>", " ".join(own)


def test_runs_of_half_the_host_go_from_articles_too(spark, monkeypatch):
    few = [_main(i) for i in range(html_text.WIDE_PAGES - 1)]
    assert html_text.main_texts(list(range(len(few))), [p for p, _ in few]) == [f"{own}\n{NOTICE}" for _, own in few]
    # A passage on a third of the pages is shared content; a notice on all is not, and copies of a page stay whole.
    shared = "this passage of the article was taken over by some other pages of this very host and stays"
    pages = [_main(i) for i in range(30)]
    html = [p.replace("</main>", f"<p>{shared}</p></main>" if i % 3 == 0 else "</main>") for i, (p, _) in enumerate(pages)]
    want = [own + (f"\n{shared}" if i % 3 == 0 else "") for i, (_, own) in enumerate(pages)]
    assert html_text.main_texts(list(range(30)), html) == want
    copies = [_main(7)] * 20
    assert html_text.main_texts(list(range(20)), [p for p, _ in copies]) == [f"{own}\n{NOTICE}" for _, own in copies]
    rows = [(i, "http://h/", p) for i, p in enumerate(html)] + [(i, "http://copies/", p) for i, (p, _) in enumerate(copies)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    expect = sorted([(i, "http://h/", t) for i, t in enumerate(want)] + [(i, "http://copies/", f"{own}\n{NOTICE}") for i, (_, own) in enumerate(copies)])
    for rows in (html_text.BROADCAST_ROWS, 0):
        monkeypatch.setattr(html_text, "BROADCAST_ROWS", rows)
        for size in (300, 3000, 1 << 20):
            got = sorted((r.page_id, r.url, r.text) for r in html_text.extract_text(docs, part_bytes=size).collect())
            assert got == expect, (rows, size)


def test_forms_around_the_text_and_marks_by_camel_case():
    text = "<p>The whole main text of this page</p>"
    plain = "The whole main text of this page"
    for page in (
        f"<body><form id='aspnetForm'>{text}<select><option>no</select></form></body>",
        f"<div>Skip it</div><form>{text}<div class='sidebar'>no</div></form>",
        f"<form><article>{text}<form><p>Your name and a long mail address too</form></article></form>",
        "<p>The whole <button>no</button>main<span hidden> no <b>no</b></span> text of this page</p>",
        f"{text}<form><label>Name</label></form>",
        f"<div class='adBox'>no</div><span class='visually-hidden'>no</span><p class='sr-only'>no</p>{text}",
    ):
        got = html_text.main_texts([1], [page])[0].replace("Skip it\n", "")
        assert got == plain, page
