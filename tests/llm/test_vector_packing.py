"""Vector best-fit: exact round trip with the plain tokenizer, every capacity kept, close to the fewest sequences."""

import numpy as np
import pytest
from tokenizers import Tokenizer

from quotebook.llm import queries, vector_packing, word_ids
from quotebook.llm.vector_packing import Capacity, best_fit, vector_pack
from tests.conftest import MEDIUM

SCHEMA = "doc_id bigint, text string, ids string, piece int"


def plain(texts):
    found = Tokenizer.from_file(word_ids.default_tokenizer()).encode_batch_fast(texts, add_special_tokens=False)
    return [[*e.ids, 0] for e in found]


def checked(pieces, want, capacity):
    """All ids once and in order, sequences gapless and within every capacity; the number of sequences."""
    docs, sequences = {}, {}
    for r in pieces:
        ids = np.frombuffer(r["ids"], dtype="<u4").tolist()
        assert len(ids) == r["length"]
        docs.setdefault(r["doc_id"], []).append((r["start"], r["piece"], ids, r["doc_tokens"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc, parts in docs.items():
        parts.sort()
        assert [i for _, _, ids, _ in parts for i in ids] == want[doc]
        assert [p for _, p, _, _ in parts] == list(range(len(parts))) and {n for *_, n in parts} == {len(want[doc])}
        assert all(len(ids) == capacity.piece() for _, _, ids, _ in parts[:-1])
    assert docs.keys() == want.keys()
    limit = capacity.vector()
    for parts in sequences.values():
        parts.sort()
        assert [a for a, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert (np.array([sum(n for _, n in parts), len(parts), sum(n * n for _, n in parts)]) <= limit).all()
    return len(sequences)


def documents(spark):
    return spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text")


def test_whole_documents_in_few_sequences(spark):
    rows = documents(spark).collect()
    want = dict(zip([r.doc_id for r in rows], plain([r.text or "" for r in rows])))
    made = vector_pack(documents(spark).repartition(6, "doc_id")).collect()
    bound = -(-sum(map(len, want.values())) // 2048)
    assert checked(made, want, Capacity()) <= bound + 3


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_is_kept(spark, monkeypatch, rule):
    monkeypatch.setattr(vector_packing, "BLOCK_PIECES", 100)
    capacity = Capacity(tokens=600, documents=5, attention=90_000)
    rows = documents(spark).limit(300).collect()
    want = dict(zip([r.doc_id for r in rows], plain([r.text or "" for r in rows])))
    made = vector_pack(spark.createDataFrame(rows).repartition(3), capacity=capacity, rule=rule).collect()
    checked(made, want, capacity)
    assert capacity.piece() == 300


def test_least_norm_and_greatest_product_choose_differently():
    limit = np.array([10, 10, 100])
    lengths = np.array([7, 5, 3, 2])
    # 3 leaves nothing of the sequence with 7.
    assert best_fit(lengths, limit, "norm", (1.0, 0.0, 0.0))[0].tolist() == [0, 1, 0, 1]
    # The dot product puts it where there is more room.
    assert best_fit(lengths, limit, "dot", (1.0, 0.0, 0.0))[0].tolist() == [0, 1, 1, 0]
    # Attention: 7 * 7 + 3 * 3 is beyond 55, and 2 leaves nothing of the other sequence.
    assert best_fit(lengths, np.array([10, 10, 55]), "norm", (1.0, 0.0, 0.0))[0].tolist() == [0, 1, 1, 1]
    assert best_fit(np.array([1, 1, 1]), np.array([10, 2, 100]))[0].tolist() == [0, 0, 1]
    assert best_fit(np.array([], dtype=np.int64), limit)[0].tolist() == []


def test_as_few_as_exhaustive_search_on_small_cases():
    from itertools import product

    rng = np.random.default_rng(7)
    worse = 0
    for _ in range(40):
        lengths = rng.integers(1, 10, 6)
        fewest = next(
            k for k in range(1, 7)
            if any(all(sum(l for l, x in zip(lengths, at) if x == b) <= 10 for b in range(k)) for at in product(range(k), repeat=6))
        )
        worse += best_fit(lengths, np.array([10, 10, 100]), "norm", (1.0, 0.0, 0.0))[0].max() + 1 > fewest
    assert worse <= 2


def test_odd_rows_and_empty_table(spark):
    long = "wörd " * 5000
    rows = [(1, None, "x", 1), (2, "", "x", 1), (None, "a b", "x", 1), (3, long, "x", 1), (3, long, "x", 1), (4, "a\tb \n<|endoftext|>", "x", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    made = vector_pack(docs).collect()
    want = dict(zip((1, 2, None, 3, 4), plain(["", "", "a b", long, "a\tb \n<|endoftext|>"])))
    once = [r for i, r in enumerate(made) if r.doc_id != 3 or r.piece not in {m.piece for m in made[:i] if m.doc_id == 3}]
    for doc, ids in want.items():
        parts = sorted((r.start, np.frombuffer(r["ids"], dtype="<u4").tolist()) for r in once if r.doc_id == doc)
        assert [i for _, p in parts for i in p] == ids
    assert sum(r.length for r in made if r.doc_id == 3) == 2 * len(want[3])
    assert vector_pack(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        vector_pack(docs, capacity=Capacity(attention=0))


def test_word_ids_of_every_character_and_small_caches(monkeypatch):
    monkeypatch.setattr(word_ids, "MAX_PIECES", 3)
    monkeypatch.setattr(word_ids, "BATCH_CHARS", 10)
    cache = word_ids.WordIds(word_ids.default_tokenizer())
    texts = [f"x{chr(c)}Y {chr(c)}{chr(c)}\n{chr(c)}'LL" for c in range(0, 0x600) if not 0xD800 <= c < 0xE000]
    texts += ["Don't  stop.\n\nNow 1234 a_b--c", "<|endoftext|>", "x<|startoftext|>y", "<|", "ÀÉÎ straße İı ǅ", "é ́e", "日本 語"]
    got = [np.frombuffer(v, dtype=cache.dtype).tolist() for v in cache.values(texts)]
    assert got == [ids[:-1] for ids in plain(texts)]


def test_query(spark):
    assert queries.op12_vector_packing(spark, MEDIUM).columns == [
        "doc_id", "piece", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    ]
