import functools
import random

from quotebook.llm import bpe, token_counts
from quotebook.llm.queries import op1_token_counts
from tests.conftest import SMALL

ODD = [
    None, "", " ", "  ", "   ", "\n", " \n ", "a  b", "a   b", "a\n b", "a \nb", "a\n \nb", "\ta  b", "don't 's 't'll we're",
    "x<|endoftext|>y <|endoftext|>", "Größe für ciónñ, été!! 12½ ²³ ___", "你好 世界 한글 é", "\U0001f600 \U0001f468‍\U0001f469",
    "\x00\x1c \x1d", "end ", " start", "word," * 50, "a" * 20_000, "A 1,000.5-b_c/d",
]


@functools.cache
def _tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_tokenizer())


def _plain(text):
    return len(_tokenizer().encode(text or "", add_special_tokens=False).ids)


def test_pattern_agrees_with_the_tokenizer_on_every_sure_character():
    from tokenizers import Tokenizer

    pre = Tokenizer.from_file(bpe.default_tokenizer()).pre_tokenizer
    for code in range(0x558):
        text = "a" + chr(code) + "1" + chr(code) + "!" + chr(code) + " " + chr(code) * 2
        assert bpe.PRE_TOKEN.findall(text) == [text[a:b] for _, (a, b) in pre.pre_tokenize_str(text)]


def test_odd_and_random_texts(spark):
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice(" \n\t'aZ9é.,-世") for _ in range(rng.randrange(40))) for _ in range(400)]
    rows = [(i, t, -1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = {r.doc_id: r for r in token_counts.count_tokens(docs, limit=10).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        n = _plain(t)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((t or "").encode()), n > 10), repr(t)


def test_caches_that_overflow_change_no_value(monkeypatch):
    monkeypatch.setattr(bpe, "MAX_PIECES", 50)
    monkeypatch.setattr(bpe, "BATCH_CHARS", 300)
    rng = random.Random(2)
    texts = [" ".join(f"w{rng.randrange(200)}," for _ in range(20)) for _ in range(60)]
    cache = bpe.PieceCache(bpe.default_tokenizer(), False, {"w1,": 3})
    assert list(cache.values(texts)) == [_plain(t) for t in texts]


def test_empty_null_and_repeated_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.count_tokens(none).collect() == []
    twice = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_tokens) for r in token_counts.count_tokens(twice).collect()) == [(0, 2), (0, 2), (1, 0)]


def test_other_vocabularies(spark):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    texts = ["Hello  World again", "", "été 12"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    word, piece = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, tokenizer=word).collect()}
    assert got == {i: len(Tokenizer.from_file(word).encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, tokenizer=piece).collect()}
    assert got == {i: len(sentencepiece.SentencePieceProcessor(model_file=piece).encode(t)) for i, t in enumerate(texts)}


def test_query_matches_plain_encoding(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r.n_tokens for r in op1_token_counts(spark, SMALL).collect()}
    assert got == {r.doc_id: _plain(r.text) for r in rows}
