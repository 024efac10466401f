import hashlib
import re
from collections import defaultdict

from quotebook.llm import exact_dedup
from quotebook.llm.queries import op3_exact_dedup
from tests.conftest import SMALL


def _norm(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def _expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[_norm(t)].append(i)
    return sorted(
        (i, min(g), len(g), i == min(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g
    )


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op3_exact_dedup(spark, SMALL).collect())) == _expected(rows)


def test_blanks_nulls_long_texts_and_clashing_names(spark):
    texts = ["a b", "a\t\n b", None, "", "a b", "A b", " a b", "x" * 300_000, "x" * 300_000] + ["hot copy"] * 900
    docs = spark.createDataFrame([(i, t, 0, "k") for i, t in enumerate(texts)], "doc_id long, text string, kept int, sha string")
    got = exact_dedup.find_copies(docs.repartition(7))
    assert sorted(map(tuple, got.collect())) == _expected(list(enumerate(texts)))
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [0, 2, 4, 5, 6, 7, 9]


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c")], "doc_id long, text string")
    got = exact_dedup.find_copies(docs).collect()
    assert sorted((r.text_sha256, r.group_size) for r in got if r.kept) == sorted(
        (hashlib.sha256(t).hexdigest(), n) for t, n in ((b"a", 2), (b"b", 1), (b"c", 2))
    )
    assert sorted(r.text for r in exact_dedup.drop_copies(docs).collect()) == ["a", "b", "c"]
    none = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.find_copies(none).collect() == [] and exact_dedup.drop_copies(none).collect() == []


def test_buckets_are_split_until_they_fit(spark):
    rows = [(i * 120, "t%05d" % i * 20) for i in range(500)]  # all alike in the first digit
    df = spark.createDataFrame(rows, "h long, content string")
    out, _ = exact_dedup.bucketed(df, target=500, bound=1_000)
    sizes = out.groupBy("bucket").count().collect()
    assert len(sizes) > 40 and max(r["count"] for r in sizes) <= 1_000 // 120 and sum(r["count"] for r in sizes) == 500


def test_table_compares_contents_when_hashes_collide():
    table = exact_dedup.ContentTable()
    entries = [table.entry(7, f"text {i % 700}") for i in range(2100)]
    assert len(table.contents) == 700 and [new for _, new in entries] == [i < 700 for i in range(2100)]
    assert entries[5][0] == entries[705][0] == 5
