import random
from collections import defaultdict

from quotebook.llm import components, near_duplicates as near
from tests.conftest import SMALL


def _sets(text):
    words = near._WORD.findall((text or "").lower())
    n = min(5, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def _expected(rows):
    """All pairs: links per row, and the least id of each row's component."""
    sets = [_sets(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * len(rows)
    by = defaultdict(set)
    for i, s in enumerate(sets):
        for x in s or {None}:
            by[x].add(i)
    for i, a in enumerate(sets):
        for j in {j for x in a or {None} for j in by[x]}:
            b = sets[j]
            if j != i and (a == b or (a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9)):
                links[i] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    comps = defaultdict(list)
    for i in range(len(rows)):
        comps[find(i)].append(rows[i][0])
    return sorted((rows[i][0], min(comps[find(i)]), links[i], len(comps[find(i)])) for i in range(len(rows)))


def _got(df):
    return sorted((r.doc_id, r.class_id, r.n_links, r.class_size) for r in df.collect())


def test_documents_match_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert _got(near.near_duplicates(docs)) == _expected(rows)


def _edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def test_hot_group_and_small_blocks(spark, monkeypatch):
    rng = random.Random(8)
    rows = []
    for g in range(30):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([12, 60, 200]))]
        for _ in range(rng.randrange(1, 6)):
            rows.append((len(rows), _edited(rng, words, rng.randrange(0, 4))))
    hot = [f"h{i}" for i in range(150)]
    for _ in range(150):
        rows.append((len(rows), _edited(rng, hot[: rng.randrange(120, 150)], rng.randrange(0, 3))))
    monkeypatch.setattr(near, "BLOCK_CLASSES", 20)
    rows += [(len(rows) + i, t) for i, t in enumerate([None, "", " ", "one two", "One, two!", "a b c d e f", "q " * 50_000])]
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id long, text string, row int, key string").repartition(6)
    got, want = _got(near.near_duplicates(docs)), _expected(rows)
    found, all_ = sum(r[2] for r in got), sum(r[2] for r in want)
    assert all(a[2] <= b[2] for a, b in zip(got, want, strict=True)) and found >= 0.995 * all_
    left = near.drop_near_copies(docs)
    assert left.columns == docs.columns and left.count() == len({r[1] for r in got})


def test_recall_at_the_threshold():
    forest, rng = near.Forest(near.TREES, near.prefix_length(near.TREES, near.DEPTH, 0.8, near.RECALL)), random.Random(1)
    met = 0
    for _ in range(400):
        shared = [rng.getrandbits(64) for _ in range(80)]
        a, b = ([*shared, *(rng.getrandbits(64) for _ in range(10))] for _ in range(2))
        import numpy as np

        x, y = (forest.prefixes(np.array(v, np.uint64)) for v in (a, b))
        met += bool((x == y).any())
    assert met >= 396


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1002, 1001)]
    got = dict(components.components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect())
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000, 1002: 1000}


def test_links_of_a_large_group_are_few(spark):
    rng, nodes = random.Random(12), []
    for tree in range(near.TREES):
        order = rng.sample(range(400), 400)  # in each tree other sets meet, in groups of one to 100
        at = 0
        while at < 400:
            size = rng.choice([1, 2, 5, 100])
            nodes += [(s, tree, at) for s in order[at : at + size]]
            at += size
    nodes += [(1000 + s, tree, -1 - s % 3) for s in range(9) for tree in range(near.TREES)]
    links = near.band_links(spark.createDataFrame(nodes, "set long, tree int, prefix long")).cache()
    got = dict(components.components(links, "set", "root").collect())
    assert got == {s: 0 for s in range(400)} | {1000 + s: 1000 + s % 3 for s in range(9)}
    assert links.count() <= 3 * 400


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")] * 3 + [(None, "a b c d e f"), (2, "z")], "doc_id long, text string")
    got = near.near_duplicates(docs).collect()
    assert sum(r.kept for r in got) == 2 and {(r.doc_id, r.class_id, r.n_links) for r in got} == {(1, 1, 3), (None, 1, 3), (2, 2, 0)}
    assert near.drop_near_copies(docs).count() == 2
    assert near.near_duplicates(docs.limit(0)).collect() == []


def test_empty_slots_count_no_link_twice(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK_SHINGLES", 100)
    rng, rows = random.Random(5), []
    for g in range(24):
        words = [f"g{g}w{k}" for k in range(150)]
        rows += [(2 * g, " ".join(words)), (2 * g + 1, _edited(rng, words, 1))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _got(near.near_duplicates(docs)) == _expected(rows)
