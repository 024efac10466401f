"""HTML listing cards. Nested markup is no regular language, so this is the one Python stage."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotebook.functions.text import absolutize_url, clean_price, url_slug

_CARD_ROWS = "source_run bigint, page_num bigint, pos int, name string, price_text string, href string"
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _CardParser(HTMLParser):
    """Collects name text, price text and detail link of every card element."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, set, dict | None, str | None]] = []
        self.cards: list[dict] = []

    def handle_starttag(self, tag, attrs):
        given = dict(attrs)
        classes = set((given.get("class") or "").split())
        if "scard" in classes:
            card = {"name": None, "price": None, "href": None}
            self.cards.append(card)
        else:
            card = self.open[-1][2] if self.open else None
        slot = None
        if card is not None and "scard" not in classes:
            if "nm" in classes and card["name"] is None:
                slot = "name"
            elif "p" in classes and card["price"] is None and any("price" in o[1] for o in self.open):
                slot = "price"
            if slot:
                card[slot] = []
            if tag == "a" and "det" in classes and card["href"] is None:
                card["href"] = given.get("href") or ""
        if tag not in _VOID:
            self.open.append((tag, classes, card, slot))

    def handle_endtag(self, tag):
        if any(o[0] == tag for o in self.open):
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        words = data.strip()
        if words:
            for _, _, card, slot in self.open:
                if slot:
                    card[slot].append(words)


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for run, page, body in batch.itertuples(index=False):
            parser = _CardParser()
            parser.feed(body or "")
            parser.close()
            for pos, card in enumerate(parser.cards):
                name = None if card["name"] is None else " ".join(card["name"])
                price = None if card["price"] is None else " ".join(card["price"])
                rows.append((run, page, pos, name, price, card["href"]))
        yield pd.DataFrame(
            rows, columns=["source_run", "page_num", "pos", "name", "price_text", "href"]
        )


def scan_html_cards(pages: DataFrame, base_url: str, source: str = "primary") -> DataFrame:
    """One raw listing per card with a name and a price."""
    texts = pages.select(F.col("source_run").cast("bigint"), F.col("page_num").cast("bigint"), "body")
    href = F.when(F.col("href") != "", absolutize_url(F.col("href"), base_url))
    return (
        texts.filter(F.col("body").contains("scard"))
        .mapInPandas(_parse, _CARD_ROWS)
        .select(
            "source_run",
            "page_num",
            "pos",
            F.col("name").alias("company"),
            clean_price(F.col("price_text")).alias("price"),
            F.lit(source).alias("source"),
            href.alias("url"),
            url_slug(href).alias("slug"),
        )
        .filter((F.col("company") != "") & F.col("price").isNotNull())
    )
