"""Main text of web pages: structure first, then a suffix array over the pages of a host.

1. A page is cut into blocks between block-level tags. Each block has a zone: `out` (menus, page headers, footers,
   sidebars, notices, adverts, forms, reader comments, told by element or by the head word of a class, id or role;
   html, body, main and the outermost article are never out by such a word), `article` (inside
   an article or main element) or `free` (the rest of a page). A form is out, unless it wraps an article, or the page
   has none and more words in its forms than around them (the whole body as one form).
2. The pages of a host are concatenated to one token stream. Its suffixes are ranked by their first MIN_RUN tokens
   (prefix doubling, so equal ranks are equal runs); a substring of that length or longer that stands on two
   distinct pages shows as consecutive positions of repeated rank.
3. A repeated run is boilerplate on free blocks, unless it is part of some page's article and of no `out` block.
   Articles may share passages, so there and everywhere a run is boilerplate only if it stands on half of the host's
   rows, WIDE_PAGES at least; and an article that would lose more than half of its words (a copy) is left whole.
   Blocks keep their unique runs (of a block covered in part, stretches shorter
   than a run stay); `out` blocks go altogether. A page
   with an article or main element keeps these blocks, any other its free ones.

A host above PART_BYTES is read in chunks where the scan has its pages, and repetition is still that of the whole host.
A run on half of all rows is on half of the rows of some chunk, so a first pass gives those as candidates, and tells
whether a host has pages without an article. A second pass counts: of hosts with such pages all distinct runs of a
chunk (a 64-bit hash of host and run, the least and the greatest page, the rows, the zones), of others the candidates.
The third pass cuts. Candidates and boilerplate go to the tasks up to BROADCAST_ROWS; beyond, all runs are counted, and
boilerplate meets its pages by an exchange.

White space in a block (no-break spaces too) becomes one space; blocks are joined by line feeds. Nulls: null html
is an empty page; a null url is a host of its own; null ids are carried along. Repeated rows each give a row and
count as one page (same id), but as rows for the half. Empty tables give an empty result. Other columns, whatever
their names, are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotebook.llm.staging import keep

MIN_RUN = 8
PART_BYTES = 8 << 20
#: A run on half of a host's rows is boilerplate wherever it stands, if these are so many at least.
WIDE_PAGES = 10
#: Hosts larger than one part, and hashes of runs, are broadcast up to so many, else joined by exchange.
BROADCAST_ROWS = 500_000

# Elements of HTML by how they take part in a page.
_OUT = frozenset("nav footer aside button select option menu dialog iframe svg head noscript template textarea object canvas video audio".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words of class, id and role that mark what is not the article.
_MARKS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense alert banner breadcrumb breadcrumbs comment comments commentlist "
    "complementary consent contentinfo cookie cookies disclaimer disqus footer gdpr header login masthead menu menubar modal nav navbar navigation "
    "newsletter notice notification overlay pager pagination popup promo promoted promotion related replies respond search share sharing "
    "sidebar signup social sponsor sponsored subscribe subscription toolbar widget".split()
)
_IN_ARTICLE = frozenset(("header", "alert"))
# Elements that marks do not touch (nor the outermost article), words that turn a mark into a remark on the
# layout (has-sidebar), and words that may follow a mark; after those of the second list, all words must be marks.
_UNMARKED = frozenset(("html", "body", "main"))
_REMARKS = frozenset("has have no not with without hide hidden show enable enabled disable disabled".split())
_TAILS = frozenset(
    "area bar block bottom box button buttons form icons item items left link links list message panel post posts right section slot text top unit".split()
)
# Class names of text for screen readers only.
_UNSEEN = frozenset("visually-hidden visuallyhidden sr-only screen-reader-text".split())
_WRAPS = frozenset("container content holder inner outer wrap wrapper".split())

_DROPPED = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<![^>]*>|<\?[^>]*>", re.S | re.I)
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^<>]*)(?:>|\Z)""")
_MARKED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""\shidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_BREAKS = re.compile(r"[^0-9a-z]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def _mark(name: str) -> str | None:
    """The mark that a class, id or role is: its head word, wherever it stands alone or as in site-footer or ad-box-2."""
    parts = [w for w in _BREAKS.split(name.split("--")[0]) if w]
    if not _REMARKS.isdisjoint(parts):
        return None
    wrapped = False
    while len(parts) > 1 and parts[-1] not in _MARKS and (parts[-1] in _TAILS or parts[-1] in _WRAPS or parts[-1].isdigit()):
        wrapped |= parts.pop() in _WRAPS
    if not parts or parts[-1] not in _MARKS or (wrapped and not _MARKS.issuperset(parts)):
        return None
    return parts[-1]


def _marks(attributes: str) -> set[str]:
    names = [n for m in _MARKED.finditer(attributes) for n in (m[1] or m[2] or m[3] or "").split()]
    return {mark for n in names if (mark := _mark(_CAMEL.sub("-", n).lower()))} | _UNSEEN.intersection(names)


def blocks_of(page: str) -> list[tuple[str, str]]:
    """(zone, text) of the page's blocks in order; zone is out, article or free."""
    page = _DROPPED.sub(" ", page)
    out: list[tuple[str, str]] = []
    parts: list[str] = []
    # Element, within something out, within an article, out by itself, within a form outside an article,
    # within something out in a line of text.
    stack: list[tuple[str, bool, bool, bool, bool, bool]] = []
    skip = article = form = unread = False

    def close() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            out.append(("out" if skip else "article" if article else "form" if form else "free", text))

    at = 0
    for m in _TAG.finditer(page):
        if not unread:
            parts.append(page[at : m.start()])
        at = m.end()
        ending, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        name = name.lower()
        if name in _BLOCK:
            close()
        elif name == "br":
            parts.append(" ")
        if ending:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
        elif name not in _VOID and not attributes.endswith("/"):
            if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == name:
                stack.pop()
            elif name in _BLOCK and any(s[0] == "p" for s in stack[-3:]):
                # A block ends an open paragraph, with the inline elements in it.
                while stack.pop()[0] != "p":
                    pass
            above = stack[-1] if stack else (name, False, False, False, False, False)
            inside = above[2] or name in ("article", "main")
            spared = name in _UNMARKED or (name == "article" and not above[2])
            marks = _marks(attributes) if attributes and not spared else set()
            if inside:
                marks = marks - _IN_ARTICLE
            own = name in _OUT or (name == "form" and inside) or (name == "header" and not inside) or bool(marks) or bool(attributes and _HIDDEN.search(attributes))
            if name in ("article", "main") and not marks:
                # An article ends what an unclosed menu or header would swallow, but not a comment's article.
                own = any(s[3] and s[0] in ("section", "div", "ol", "ul", "aside") for s in stack)
                stack.append((name, own, True, False, False, False))
            else:
                stack.append((name, above[1] or own, inside, own, above[4] or (name == "form" and not inside), above[5] or (own and name not in _BLOCK)))
        _, skip, article, _, form, unread = stack[-1] if stack else (name, False, False, False, False, False)
    if not unread:
        parts.append(page[at:])
    close()
    sizes = dict.fromkeys(("out", "article", "form", "free"), 0)
    for zone, text in out:
        sizes[zone] += text.count(" ") + 1
    body = "free" if not sizes["article"] and sizes["form"] > sizes["free"] else "out"
    return [(body if zone == "form" else zone, text) for zone, text in out]


def repeated_runs(
    tokens: np.ndarray, pages: np.ndarray, least: int, rows: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """For each position: the rank of the run of `least` tokens that starts there (-1 where the page ends before),
    and whether that run stands on more than one page. `pages` numbers each token's page, in ascending order, `rows` its
    row if a page has several."""
    rows = pages if rows is None else rows
    n = len(tokens)
    rank, width = np.unique(tokens, return_inverse=True)[1].astype(np.int64), 1
    while width < least:
        step = min(width, least - width)
        ahead = np.full(n, -1, np.int64)
        ahead[: max(0, n - step)] = rank[step:]
        rank = np.unique(rank * (n + 1) + ahead + 1, return_inverse=True)[1].astype(np.int64)
        width += step
    whole = np.zeros(n, bool)
    if n >= least:
        whole[: n - least + 1] = rows[: n - least + 1] == rows[least - 1 :]
    rank[~whole] = -1
    first = np.full(n + 1, np.iinfo(np.int64).max)
    last = np.full(n + 1, -1, np.int64)
    np.minimum.at(first, rank[whole], pages[whole])
    np.maximum.at(last, rank[whole], pages[whole])
    return rank, whole & (last[rank] > first[rank])


def _long_parts(gone: np.ndarray, least: int) -> np.ndarray:
    """Of a block that is covered in part, only stretches of a run's length: a run that began in the block before
    may end with words of this one."""
    if gone.all() or not gone.any():
        return gone
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    out = np.zeros(len(gone), bool)
    for a, b in zip(edges[::2], edges[1::2], strict=True):
        out[a:b] = b - a >= least
    return out


class Stream:
    """The blocks of (a part of) a host's pages, and their tokens as one stream."""

    def __init__(self, ids: list, pages: list[str]):
        self.cut = [blocks_of(p) for p in pages]
        self.number: dict[str, int] = {}
        page_of = {i: k for k, i in enumerate(dict.fromkeys(ids))}
        self.words, tokens, owner = [], [], []
        for row, (i, blocks) in enumerate(zip(ids, self.cut, strict=True)):
            for where, text in blocks:
                split = text.split(" ")
                self.words.append(split)
                tokens += [self.number.setdefault(w, len(self.number)) for w in split]
                owner.append((page_of[i], len(split), {"out": 0, "article": 1, "free": 2}[where], row))
        sizes = np.array([n for _, n, _, _ in owner], np.int64)
        pages_of = np.repeat(np.array([p for p, _, _, _ in owner], np.int64), sizes)
        # Rows of one id lie apart: order the stream by page, runs within a row stay together.
        order = np.argsort(pages_of, kind="stable")
        self.back = np.empty_like(order)
        self.back[order] = np.arange(len(order))
        self.tokens, self.pages = np.array(tokens, np.int64)[order], pages_of[order]
        self.zone = np.repeat(np.array([z for _, _, z, _ in owner], np.int64), sizes)[order]
        self.rows = np.repeat(np.array([r for _, _, _, r in owner], np.int64), sizes)[order]
        self.has_free = any(blocks and all(z != "article" for z, _ in blocks) for blocks in self.cut)

    def rows_with(self, at: np.ndarray, number: np.ndarray, n: int) -> np.ndarray:
        """On how many rows each of n runs begins; they stand at these positions."""
        pairs = np.unique(number * max(1, len(self.cut)) + self.rows[at])
        return np.bincount(pairs // max(1, len(self.cut)), minlength=n)

    def zones(self, at: np.ndarray, least: int) -> np.ndarray:
        """Of the runs at these positions: 1 wholly in out blocks, 2 partly in an article, 4 wholly in free blocks.
        A run across zones is no evidence."""
        within = [np.concatenate([[0], np.cumsum(self.zone == z)]) for z in range(3)]
        held = [w[at + least] - w[at] for w in within]
        return (held[0] == least) * 1 + (held[1] > 0) * 2 + (held[2] == least) * 4

    def hashes(self, host: str, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of runs within a row, and the hash of host and run at each."""
        n = max(0, len(self.tokens) - least + 1)
        at = np.flatnonzero(self.rows[:n] == self.rows[least - 1 :][:n])
        word = np.fromiter(map(xxhash.xxh64_intdigest, self.number), np.uint64, len(self.number))
        out = np.full(len(at), xxhash.xxh64_intdigest(host), np.uint64)
        with np.errstate(over="ignore"):
            for i in range(least):
                out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + word[self.tokens[at + i]]
            out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            out ^= out >> np.uint64(29)
        return at, out.view(np.int64)


def is_wide(rows: np.ndarray, of: int) -> np.ndarray:
    return (rows >= WIDE_PAGES) & (2 * rows >= of)


def chunk_candidates(host: str, ids: list, pages: list[str], of: int, least: int = MIN_RUN) -> tuple[np.ndarray, bool]:
    """Hashes of runs on half of the chunk's rows (`of`: rows of the host), and whether a page has no article."""
    stream = Stream(ids, pages)
    if of < WIDE_PAGES:
        return np.empty(0, np.int64), stream.has_free
    at, run = stream.hashes(host, least)
    found, number = np.unique(run, return_inverse=True)
    return found[2 * stream.rows_with(at, number, len(found)) >= len(pages)], stream.has_free


def chunk_runs(
    host: str, ids: list, keys: np.ndarray, pages: list[str], wanted: np.ndarray | None, least: int = MIN_RUN
) -> tuple[np.ndarray, ...]:
    """The distinct runs of a chunk, or those wanted: hash, least and greatest key of their pages, zones, rows.
    `keys` tells pages by id."""
    stream = Stream(ids, pages)
    at, run = stream.hashes(host, least)
    if wanted is not None:
        asked = np.isin(run, wanted)
        at, run = at[asked], run[asked]
    key = np.array(list(dict(zip(ids, keys.tolist(), strict=True)).values()), np.int64)[stream.pages[at]]
    found, number = np.unique(run, return_inverse=True)
    first, last = np.full(len(found), np.iinfo(np.int64).max), np.full(len(found), np.iinfo(np.int64).min)
    zones = np.zeros(len(found), np.int64)
    np.minimum.at(first, number, key)
    np.maximum.at(last, number, key)
    np.bitwise_or.at(zones, number, stream.zones(at, least))
    return found, first, last, zones, stream.rows_with(at, number, len(found))


def _covered(n: int, at: np.ndarray, least: int) -> np.ndarray:
    """Which of n tokens lie in a run that begins at one of these positions."""
    edges = np.zeros(n + least, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + least, -1)
    return np.cumsum(edges[:n]) > 0


def main_texts(
    ids: list, pages: list[str], least: int = MIN_RUN, host: str = "", known: tuple[np.ndarray, np.ndarray] | None = None
) -> list[str]:
    """Main text of each page of a host; of a chunk of one if `known` has the hashes of the host's boilerplate: of free
    blocks, and of all."""
    stream = Stream(ids, pages)
    n = len(stream.tokens)
    if not n:
        return [""] * len(pages)
    if known is None:
        rank, again = repeated_runs(stream.tokens, stream.pages, least, stream.rows)
        at = np.flatnonzero(again)
        zones = np.zeros(n + 1, np.int64)
        np.bitwise_or.at(zones, rank[at], stream.zones(at, least))
        wide = at[is_wide(stream.rows_with(at, rank[at], n + 1), len(pages))[rank[at]]]
        at = at[((zones[rank[at]] & 1) > 0) | ((zones[rank[at]] & 6) == 4)]
    else:
        every, run = stream.hashes(host, least)
        at, wide = (every[np.isin(run, k)] for k in known)
    wide = _covered(n, wide, least)[stream.back]
    free = _covered(n, at, least)[stream.back] | wide
    cut, words = stream.cut, stream.words

    texts, at, block = [], 0, 0
    for blocks in cut:
        wanted = "article" if any(z == "article" for z, _ in blocks) else "free"
        covered = wide if wanted == "article" else free
        whole, kept, lost, size = [], [], 0, 0
        for where, text in blocks:
            split = words[block]
            if where == wanted:
                gone = _long_parts(covered[at : at + len(split)], least)
                left = [w for w, c in zip(split, gone, strict=True) if not c]
                whole.append(text)
                if left:
                    kept.append(" ".join(left))
                lost += len(split) - len(left)
                size += len(split)
            at += len(split)
            block += 1
        texts.append("\n".join(whole if wanted == "article" and 2 * lost > size else kept))
    return texts


def extract_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", part_bytes: int = PART_BYTES
) -> DataFrame:
    """id, url, text and n_chars of every page."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    read = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"), host.alias("host"))
    sized = read.groupBy("host").agg(F.sum(F.octet_length("html")).alias("size"), F.count(F.lit(1)).alias("of"))
    heavy = keep(sized.where(F.col("size") > part_bytes).select("host", "of", F.ceil(F.col("size") / part_bytes).alias("parts")), "html-hosts")
    n_heavy = heavy.count()
    heavy = F.broadcast(heavy) if n_heavy <= BROADCAST_ROWS else heavy
    kind = pages.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, url string, text string, n_chars long"

    def texts(table: pa.Table, host: str = "", known: tuple[np.ndarray, np.ndarray] | None = None) -> pa.Table:
        texts = main_texts(table["id"].to_pylist(), table["html"].to_pylist(), host=host, known=known)
        return pa.table({"id": table["id"], "url": table["url"], "text": pa.array(texts, pa.string()), "n_chars": pa.array(list(map(len, texts)), pa.int64())})

    found = read.join(heavy, "host", "left_anti").groupBy("host").applyInArrow(lambda t: texts(t), schema)
    if n_heavy:
        large = read.join(heavy, "host").withColumn("page", F.xxhash64("id"))
        counts = _boilerplate(large, part_bytes)
        if counts.count() <= BROADCAST_ROWS:
            rows = counts.toArrow()  # At most BROADCAST_ROWS.
            known = tuple(rows["run"].filter(rows[k]).to_numpy() for k in ("free", "wide"))
            cut = large.mapInArrow(_by_host(lambda host, t: texts(t, host, known), part_bytes), schema)
        else:
            placed = large.withColumn("part", F.pmod("page", "parts")).select("host", "part", "page", "id", "url", "html")
            whose = "host string, part long, run long"

            def runs_of(table: pa.Table) -> pa.Table:
                host, part = table["host"][0].as_py(), table["part"][0].as_py()
                run = chunk_runs(host, table["id"].to_pylist(), table["page"].to_numpy(), table["html"].to_pylist(), None)[0]
                return pa.table({"host": pa.array([host] * len(run), pa.string()), "part": pa.array([part] * len(run), pa.int64()), "run": run})

            back = placed.groupBy("host", "part").applyInArrow(runs_of, whose).join(counts, "run")

            def cut_part(key: tuple, table: pa.Table, known: pa.Table) -> pa.Table:
                run = known["run"].to_numpy()
                return texts(table, key[0].as_py(), tuple(run[known[k].to_numpy()] for k in ("free", "wide")))

            cut = placed.groupBy("host", "part").cogroup(back.groupBy("host", "part")).applyInArrow(cut_part, schema)
        found = found.unionByName(cut)
    return found.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")


def _by_host(work, part_bytes: int):
    """A function for mapInArrow: the rows of a task in chunks of about part_bytes, and `work` gives a table for each
    host of a chunk."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                held.append(batch.slice(start, 256))
                # Of a slice its own bytes count, not those of the batch it is cut from.
                size += held[-1].nbytes
                if size >= part_bytes:
                    yield from out(held)
                    held, size = [], 0
        if held:
            yield from out(held)

    def out(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        place: dict[str, list[int]] = {}
        for i, host in enumerate(table["host"].to_pylist()):
            place.setdefault(host, []).append(i)
        for host, rows in place.items():
            yield from work(host, table.take(rows)).to_batches()

    return chunks


def _boilerplate(large: DataFrame, part_bytes: int) -> DataFrame:
    """run, free, wide: hashes of the large hosts' runs that go from free blocks, or from all."""

    def first(host: str, table: pa.Table) -> pa.Table:
        run, free = chunk_candidates(host, table["id"].to_pylist(), table["html"].to_pylist(), table["of"][0].as_py())
        rows = [None, *run.tolist()] if free else run.tolist()
        return pa.table({"host": pa.array([host] * len(rows), pa.string()), "run": pa.array(rows, pa.int64())})

    # A null run stands for a page without an article.
    seen = keep(large.select("host", "id", "html", "of").mapInArrow(_by_host(first, part_bytes), "host string, run long").distinct(), "html-candidates")
    few = seen.count() <= BROADCAST_ROWS
    rows = seen.toArrow() if few else pa.table({"host": pa.array([], pa.string()), "run": pa.array([], pa.int64())})  # At most BROADCAST_ROWS.
    mixed = set(rows["host"].filter(rows["run"].is_null()).to_pylist())
    wanted = rows["run"].drop_null().to_numpy()

    def second(host: str, table: pa.Table) -> pa.Table:
        asked = wanted if few and host not in mixed else None
        run, low, high, zones, n = chunk_runs(host, table["id"].to_pylist(), table["page"].to_numpy(), table["html"].to_pylist(), asked)
        of = np.full(len(run), table["of"][0].as_py(), np.int64)
        return pa.table({"run": run, "low": low, "high": high, "zones": zones, "n": n, "of": of})

    if few:
        # Hosts of which nothing can go are not read again.
        hosts = seen.select("host").distinct()
        large = large.join(F.broadcast(hosts), "host", "left_semi")
    runs = large.select("host", "id", "page", "html", "of").mapInArrow(
        _by_host(second, part_bytes), "run long, low long, high long, zones long, n long, of long"
    )
    whole = runs.groupBy("run").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.bit_or("zones").alias("zones"), F.sum("n").alias("n"), F.max("of").alias("of")
    )
    again = F.col("low") < F.col("high")
    free = again & F.expr("zones & 1 > 0 OR zones & 6 = 4")
    wide = again & (F.col("n") >= WIDE_PAGES) & (2 * F.col("n") >= F.col("of"))
    return keep(whole.select("run", free.alias("free"), wide.alias("wide")).where("free OR wide"), "html-boilerplate")
