import corpus_pipeline
from quotebook.llm.quality import classify
from tests.conftest import SMALL
from tests.llm import test_decontamination as decon
from tests.llm import test_exact_dedup as exact
from tests.llm import test_near_duplicates as near
from tests.llm import test_packing as packing


def test_every_stage_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SMALL)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == columns
        kept[name] = (before, docs)

    def rows(df):
        return sorted(tuple(r) for r in df.select("doc_id", "text").collect())

    before, after = kept["quality"]
    judged = classify(before, spark.read.parquet(f"{SMALL}/labels.parquet"))
    assert sorted(r.doc_id for r in judged.where("kept").collect()) == [i for i, _ in rows(after)]

    before, after = map(rows, kept["exact_dedup"])
    assert [i for i, *_ in after] == sorted({i for i, keep_id, *_ in exact._expected(before) if i == keep_id})

    before, after = map(rows, kept["near_dedup"])
    assert [i for i, _ in after] == sorted({first for _, first, _, _ in near._expected(before)})

    before, after = map(rows, kept["decontamination"])
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    assert [i for i, _ in after] == [r[0] for r in sorted(decon._expected(before, items)) if not r[-1]]

    before, after = kept["packing"]
    packing._check(after.collect(), packing._streams(rows(before)), 1024)


def test_run_gives_the_last_stage(spark):
    pieces = corpus_pipeline.run(spark, SMALL).collect()
    assert pieces and max(r.offset + r.length for r in pieces) <= 1024
