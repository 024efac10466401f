import zlib
from collections import defaultdict

from quotebook.llm import sharding
from quotebook.llm.queries import op4_sharding
from tests.conftest import SMALL


def _check(rows, texts, shards, spread):
    """Every row once, gapless slots, near-equal bytes."""
    by = defaultdict(list)
    for r in rows:
        assert r["size"] == len((texts[r.doc_id] or "").encode()) + 1
        by[r.shard].append(r)
    assert sorted(r.doc_id for r in rows) == sorted(texts) and set(by) <= set(range(shards))
    for rs in by.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
    sizes = [sum(r["size"] for r in by[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= spread, sizes
    return by


def test_query_over_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    rows = op4_sharding(spark, SMALL).collect()
    assert all(r.law == "bytes" and r.grown_shard is None and r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode()) for r in rows)
    _check(rows, texts, 8, 2 * max(len((t or "").encode()) for t in texts.values()))


def test_hot_text_is_split_and_small_groups_stay_whole(spark):
    texts = {i: "hot " * 20 if i % 3 == 0 else f"text {i % 1500} " * 8 for i in range(6000)}
    docs = spark.createDataFrame([(i, t, "x", 9) for i, t in texts.items()], "doc_id long, text string, shard string, k1 int")
    rows = sharding.assign_shards(docs.drop("k1"), 8, lane_rows=100).collect()
    total = sum(len(t) + 1 for t in texts.values())
    by = _check(rows, texts, 8, 0.02 * total / 8)
    where = defaultdict(set)
    for s, rs in by.items():
        for r in rs:
            where[r.text].add(s)
    assert len(where["hot " * 20]) > 1
    assert sum(len(s) > 1 for t, s in where.items() if not t.startswith("hot")) == 0


def test_order_follows_the_key(spark):
    texts = {i: f"t{i}" for i in range(500)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    keyed = sharding.assign_shards(docs, 4).withColumn("k", sharding._half("text")).collect()
    ranges = [(min(r.k for r in keyed if r.shard == s), max(r.k for r in keyed if r.shard == s)) for s in range(4)]
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_nulls_repeated_rows_tiny_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a" * 50_000)], "doc_id long, text string")
    assert sorted(r["size"] for r in sharding.assign_shards(docs, 8).collect()) == [1, 1, 50_001]
    same = spark.createDataFrame([(7, "same")] * 300 + [(None, None)] * 3, "doc_id long, text string")
    rows = sharding.assign_shards(same, 4).collect()
    assert len(rows) == 303 and len({(r.shard, r.slot) for r in rows}) == 303
    none = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.assign_shards(none, 8).collect() == []
