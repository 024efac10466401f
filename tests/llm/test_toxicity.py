import random
import zlib

import numpy as np

from quotebook.llm import toxicity
from quotebook.llm.queries import op10_toxicity

LARGE = "/root/testdata/sf0.1"  # the smaller tables have too few toxic rows outside English


def _auc(scores, labels):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    for v in np.unique(scores):
        ranks[scores == v] = ranks[scores == v].mean()
    pos = labels == 1
    return (ranks[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_held_out_rows_of_documents(spark):
    got = op10_toxicity(spark, LARGE).toPandas()
    docs = spark.read.parquet(f"{LARGE}/documents.parquet").count()
    assert len(got) == docs
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    assert ((got.score >= 0.5).astype(int) == got.predicted).all()
    labels = spark.read.parquet(f"{LARGE}/labels.parquet").toPandas()
    test = got.merge(labels, on="doc_id")
    test = test[test.held_out]
    assert _auc(test.score.to_numpy(), test.toxic.to_numpy()) > 0.9
    assert test[test.toxic == 0].predicted.mean() < 0.03


def test_label_model_sees_through_copied_voters():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.3
    noisy = lambda right: np.where(rng.random(4000) < right, truth, ~truth)
    bad = noisy(0.6)
    annotator = noisy(0.8)
    votes = np.column_stack([noisy(0.85), noisy(0.85), noisy(0.85), bad, bad, bad, annotator])
    ballots = np.where(votes, 1, -1).astype(np.int8)
    model = toxicity.fit_label_model(ballots, np.where(annotator, 0.9, 0.1))
    assert model.weights[3:6].max() < 0.6 < model.weights[:3].min()
    assert ((model.posterior(ballots) > 0.5) == truth).mean() > 0.9


def test_odd_tables(spark):
    rng = random.Random(1)
    rows = [(i, ("vile " if i % 4 == 0 else "") + " ".join(rng.choice("abcdefgh") for _ in range(8)), 7.0) for i in range(400)]
    docs = spark.createDataFrame(
        rows + [(1000, None, 0.0), (1001, "", 0.0), (None, "vile", 0.0), (1002, "x " * 100_000 + "vile", 0.0), (1002, "vile", 0.0)],
        "doc_id long, text string, score double",
    )
    labels = spark.createDataFrame(
        [(i, int(i % 4 == 0)) for i in range(400)] + [(0, 1), (0, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.score_toxicity(docs, labels).collect()
    assert len(got) == 405
    vile = {r[0] for r in rows if r[1].startswith("vile")} | {None, 1002}
    assert all(r.predicted == int(r.doc_id in vile) for r in got)
    assert toxicity.score_toxicity(docs.limit(0), labels).collect() == []
    assert all(r.predicted == 0 for r in toxicity.score_toxicity(docs, labels.limit(0)).collect())
