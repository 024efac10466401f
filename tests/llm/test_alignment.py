"""The alignment against a token-by-token walk over both sides in plain Python."""

import hashlib
import json
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from quotebook.llm import alignment, queries
from quotebook.llm.merges import byte_alphabet
from tests.conftest import MEDIUM, SMALL

SCHEMA = "doc_id bigint, text string, chunk string, place string, n_docs string"
ODD = [
    "", None, "a  b", "a" * 3000, "<|endoftext|> <s> x", "日本 ▁ x", "日本語 привет שלום", "tab\tx\n\ny", "ab" * 2000 + "abc" * 500,
    " lead", "trail ", "x", "ﬁne", "😀 ok", "<0x41> <0x41>", "\u0000 nul",
]


@pytest.fixture(scope="module")
def walk():
    """Groups of a text as two lists of ids each."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    a_side = Tokenizer.from_file(path)
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    with open(path, encoding="utf-8") as f:
        tokens = {i: t for t, i in json.load(f)["model"]["vocab"].items()}
    alphabet = byte_alphabet()

    def bytes_b(i):
        piece = b_side.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_side.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(text):
        if not text:
            return []
        a = a_side.encode(" " + text, add_special_tokens=False).ids
        b = b_side.encode(text)
        as_a, as_b = [bytes(alphabet[c] for c in tokens[i]) for i in a], [bytes_b(i) for i in b]
        if b"".join(as_a) != (" " + text).encode() or b"".join(as_b) != (" " + text).encode():
            return []
        ends = []
        for parts in (as_a, as_b):
            at, found = 0, []
            for p in parts:
                at += len(p)
                found.append(at)
            ends.append(found)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        return [
            ([i for i, e in zip(a, ends[0]) if low < e <= high], [i for i, e in zip(b, ends[1]) if low < e <= high])
            for low, high in zip([0, *cuts], cuts)
        ]

    return groups


def expected(rows, walk):
    per_doc = []
    n_docs = Counter()
    for doc, text in rows:
        groups = walk(text)
        links = [(x, y) for a, b in groups for x in a for y in b]
        n_docs.update(set(links))
        per_doc.append((doc, groups, links))
    best = {}
    for (x, _), n in n_docs.items():
        best[x] = max(n, best.get(x, 0))
    found = []
    for doc, groups, links in per_doc:
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        found.append(
            (
                doc, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                sum(n_docs[x] == best[x[0]] for x in links), sum(n_docs[x] for x in links),
                hashlib.sha256(text.encode()).hexdigest() if text else "", text,
            )
        )
    return sorted(found, key=repr)


def shown(frame):
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups")
    return sorted([tuple(r[n] for n in names) for r in frame.collect()], key=repr)


@pytest.mark.parametrize("listed, chunk", [(64, 8_000_000), (2, 5_000)])
def test_same_as_by_walking(spark, monkeypatch, walk, listed, chunk):
    monkeypatch.setattr(alignment, "LINKS_LISTED", listed)
    monkeypatch.setattr(alignment, "CHUNK_BYTES", chunk)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (0, "the same id")] + [(7, "copies of one text")] * 5
    docs = spark.createDataFrame([(*r, "c", "p", "n") for r in rows], SCHEMA).repartition(3)
    assert shown(alignment.align(docs)) == expected(rows, walk)


def test_nothing_to_align(spark):
    docs = spark.createDataFrame([(1, None, "", "", ""), (2, "", "", "", "")], SCHEMA)
    assert shown(alignment.align(docs)) == [(i, 0, 0, 0, 0, 0, 0, "", "") for i in (1, 2)]
    assert alignment.align(docs.limit(0)).collect() == []


def test_both_libraries_agree_on_each_character():
    side = alignment.ByteSide(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [f"x{chr(c)} {chr(c)}y{chr(c)}{chr(c)}  z" for c in range(0x558)]
    fast = [ids.tolist() for ids in side.encode(texts)]
    assert fast == [side._tokenizer.encode(" " + t, add_special_tokens=False).ids for t in texts]


def test_query(spark):
    rows = queries.op13_token_alignment(spark, MEDIUM)
    assert rows.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows.count() == 1000
