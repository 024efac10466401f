import zlib

import numpy as np
import pytest

from quotebook.llm import bpe, packing
from quotebook.llm.queries import op6_packing
from tests.conftest import SMALL
from tests.llm.test_token_counts import _tokenizer


def _streams(texts):
    return {i: [*_tokenizer().encode(t or "", add_special_tokens=False).ids, 0] for i, t in texts}


def _check(pieces, streams, window):
    """Every id in exactly one piece; sequences full but for the last; offsets without gaps."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(streams)
    for i, ps in by_doc.items():
        ps.sort(key=lambda p: p.start)
        at = 0
        for p in ps:
            assert p.start == at and p.length > 0 and p.doc_tokens == len(streams[i])
            part = np.array(streams[i][at : at + p.length], dtype="<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(part)
            at += p.length
        assert at == len(streams[i])
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for s, ps in by_sequence.items():
        ps.sort(key=lambda p: p.offset)
        assert [p.offset for p in ps] == [sum(q.length for q in ps[:k]) for k in range(len(ps))]
        total = sum(p.length for p in ps)
        assert total == window or (s == len(by_sequence) - 1 and total < window)


def test_query_is_an_exact_round_trip(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    _check(op6_packing(spark, SMALL).collect(), _streams([(r.doc_id, r.text) for r in rows]), 1024)


@pytest.mark.parametrize("window", [1, 7, 64])
def test_small_windows_and_odd_texts(spark, window):
    from quotebook.llm.queries import piece_digests

    texts = [(0, None), (1, ""), (2, "one two three " * 30), (3, "x"), (4, "a  b <|endoftext|>"), (5, "é世界")] + [
        (i, "copy of a row") for i in range(6, 40)
    ]
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts], "doc_id long, text string, length int").repartition(5)
    _check(piece_digests(packing.pack(docs, window=window)).collect(), _streams(texts), window)


def test_empty_table_and_wide_ids(spark):
    import public_tokenizers

    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(none).collect() == []
    docs = spark.createDataFrame([(None, "hello world"), (None, "hello world")], "doc_id long, text string")
    path = public_tokenizers.path("piece_bpe_32k.model")
    got = packing.pack(docs, tokenizer=path, window=4, terminator=2).collect()
    ids = bpe.Vocabulary(path).encode(["hello world"])[0]
    assert sum(r.length for r in got) == 2 * (len(ids) + 1)
