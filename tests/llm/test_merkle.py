"""The manifest against a tree folded by hand in Python, over several rounds of blocks, and tampered rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from quotebook.llm import merkle

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, h string, rank int"


def hashed(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf(row):
    values = [row[f] for f in merkle.FIELDS]
    return hashed(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(digests):
    """Root and, per leaf, its steps (left, right) from the bottom up."""
    paths = [[] for _ in digests]
    level = [(d, [i]) for i, d in enumerate(digests)]
    while len(level) > 1:
        runs = [level[i : i + 3] for i in range(0, len(level), 3)]
        for run in runs:
            for at, (_, members) in enumerate(run):
                step = tuple("".join(d for d, _ in part) for part in (run[:at], run[at + 1 :]))
                for m in members:
                    paths[m].append(step)
        level = [(hashed(*[d for d, _ in run]), [m for _, ms in run for m in ms]) for run in runs]
    return level[0][0], paths


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([h for *_, h in sorted(groups[s])]) for s in names]
    if not trees:
        return []
    root, tops = tree([t[0] for t in trees])
    found = []
    for name, (subroot, paths), above in zip(names, trees, tops):
        for (known, i, h), path in zip(sorted(groups[name]), paths):
            found.append((i if known else None, name, h, subroot, root, path + above))
    return sorted(found, key=repr)


def shown(frame):
    rows = frame.collect()
    return sorted([(r.id, r.group, r.leaf, r.subroot, r.root, [tuple(p) for p in r.proof]) for r in rows], key=repr)


def frame(spark, groups):
    """`groups`: source -> number of rows, with repeats, nulls and ties between ids."""
    rows = []
    for source, n in groups.items():
        for i in range(n):
            doc = None if i % 11 == 5 else i - i % 4
            rows.append((doc, source, "en" if i % 3 else None, i, None if i % 7 == 3 else f"é {i % 5}\n", "x", 1))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("digits", [2, 6])
def test_same_as_by_hand(spark, monkeypatch, digits):
    monkeypatch.setattr(merkle, "DIGITS", digits)
    monkeypatch.setattr(merkle, "BLOCK", 3**digits)
    docs = frame(spark, {None: 1, "": 2, "b": 3, "é": 4, "a": 28, "z": 10})
    made = merkle.manifest(docs)
    assert shown(made) == expected(docs.collect())
    assert made.filter(merkle.folded() != F.col("root")).isEmpty()


def test_one_group_one_row_and_none(spark):
    for groups in ({"a": 1}, {"a": 30}):
        docs = frame(spark, groups)
        assert shown(merkle.manifest(docs)) == expected(docs.collect())
    assert merkle.manifest(frame(spark, {"a": 1}).limit(0)).collect() == []


def test_hot_group_of_equal_rows(spark):
    docs = spark.range(2000).selectExpr("1L AS doc_id", "'s' AS source", "'en' AS lang", "1L AS n_chars", "'t' AS text")
    made = merkle.manifest(docs)
    assert shown(made) == expected(docs.collect())


def test_tampering_shows(spark):
    docs = frame(spark, {"a": 40, "b": 9})
    made = merkle.manifest(docs, presented={"text": F.translate("text", "\n", "")}).withColumn("ok", merkle.folded() == F.col("root"))
    honest = {(r.doc_id, leaf(r)) for r in docs.collect() if r.text is None}
    assert {(r.id, r.leaf) for r in made.filter("ok").collect()} == honest
    proof = made.withColumn("p", merkle.proof_hash()).first()
    assert proof.p == hashed(*[s.l + s.r for s in proof.proof])


def test_other_columns_as_group_and_order(spark):
    docs = frame(spark, {"a": 12}).withColumnRenamed("n_chars", "size")
    made = merkle.manifest(docs, ("size", "text"), "lang", "size")
    assert made.count() == 12 and made.select("root").distinct().count() == 1 and made.select("subroot").distinct().count() == 2
