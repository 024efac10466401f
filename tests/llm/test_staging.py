"""Joins of tables that grow with the input do not go by the size that Spark estimates."""

import random

import corpus_pipeline
from pyspark.sql import functions as F

from quotebook.llm import components, decontamination, exact_dedup, near_duplicates as near, packing, quality, staging


def _broadcasts(df):
    return "BroadcastExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_exploded_nodes_are_exchanged(spark):
    """Broadcast, they were 4.9 million rows and 637 MB at half a GB of documents, at an estimate of some MB."""
    prefixes = F.array(*[F.xxhash64(F.col("id") % 700, F.lit(tree)) for tree in range(near.TREES)])
    sets = staging.keep(spark.range(2000).select(F.col("id").alias("set"), prefixes.alias("prefixes")), "sets")
    nodes = sets.select("set", F.posexplode("prefixes").alias("tree", "prefix"))
    links = near.band_links(nodes)
    assert not _broadcasts(links)
    assert sorted(tuple(r) for r in links.collect()) == [(i, i % 700) for i in range(700, 2000)]


def test_beyond_the_bound_nothing_is_broadcast(spark):
    left, right = (staging.keep(spark.range(n).withColumn("x", F.lit(n)), "some") for n in (300, 200))
    joined = lambda side: left.select("id").join(side, "id")
    assert _broadcasts(joined(right)) and _broadcasts(joined(staging.sized(right, 200)))
    assert not _broadcasts(joined(staging.sized(right, 199))) and not _broadcasts(staging.exchanged(left).join(right, "id"))
    assert _broadcasts(joined(staging.planned(right, staging.PLANNED_ROWS)))
    assert not _broadcasts(joined(staging.planned(right, staging.PLANNED_ROWS + 1)))
    assert not _broadcasts(decontamination._same(left, staging.exchanged(right), ["x"], "left_semi"))
    assert joined(staging.sized(right, 0)).count() == 200


def test_stages_by_exchange_give_the_same_rows(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefgh") * 3 + str(rng.randrange(30)) for _ in range(40)) for _ in range(60)]
    texts += [t + " end" for t in texts[:20]] + texts[30:40] + [None, "", "one"]
    docs = [(i, t, "en" if i % 3 else None, "s", 0) for i, t in enumerate(texts)] + [(None, texts[50] + " x", "en", "s", 0), (3, texts[3], "en", "s", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i % 5 > 0), 0) for i in range(70)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    items = [(0, " ".join(texts[7].split()[5:17])), (1, "one"), (2, texts[45])]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    before = {}

    def stages():
        out, read = {}, staging.keep(spark.read.parquet(str(tmp_path / "documents.parquet")), "read")
        for name, stage in corpus_pipeline.STAGES:
            df = stage(spark, read, str(tmp_path))
            if before:
                assert not _broadcasts(df), name
            read = staging.keep(df, name)
            columns = read.columns[:2] if name != "packing" else ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            out[name] = sorted(map(str, read.select(columns).collect())) if name != "packing" else read.agg(F.sum("length")).first()[0]
        return out

    before |= stages()
    sizes = [len(before[n]) for n in ("quality", "exact_dedup", "near_dedup", "decontamination")]
    assert sizes == sorted(set(sizes), reverse=True), sizes  # every stage finds something
    monkeypatch.setattr(staging, "PLANNED_ROWS", 0)
    for module in (decontamination, near, quality):
        monkeypatch.setattr(module, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(packing, "BROADCAST_PARTITIONS", 0)
    seen, plain = [], staging.keep

    def spied(df, label, *partition_by):
        # By the planner alone: thresholds by language, and texts with copies (each row has a digest, which no file shortens).
        if label not in ("quality-rejected", "dedup-kept"):
            seen.append((label, _broadcasts(df)))
        return plain(df, label, *partition_by)

    for module in (components, decontamination, exact_dedup, near, packing, quality):
        monkeypatch.setattr(module, "keep", spied)
    assert stages() == before
    assert {"quality-model", "near-links", "near-verified", "cc-roots", "decon-hits"} <= {label for label, _ in seen}
    assert not [label for label, found in seen if found]
