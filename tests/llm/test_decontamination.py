import hashlib
import random
import re

from quotebook.llm import decontamination as decon
from quotebook.llm.queries import op9_decontamination
from tests.conftest import SMALL

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _words(text):
    return WORD.findall((text or "").translate(LOWER))


def _expected(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = _words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + window]), set()).add(str(item) if item is not None else "")
    lengths = {len(w) for w in windows}
    out = []
    for i, text in docs:
        w, hit, ids = _words(text), set(), set()
        for n in lengths:
            for a in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[a : a + n]))) is not None:
                    hit.update(range(a, a + n))
                    ids |= found
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def _got(df):
    return sorted(
        ((r[0], r.n_words, r.n_hit, r.n_items, hashlib.sha256(r["items"].encode()).hexdigest(), r.contaminated) for r in df.collect()),
        key=str,
    )


def test_query_matches_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    got = sorted(map(tuple, op9_decontamination(spark, SMALL).collect()), key=str)
    assert got == _expected(docs, items) and any(r[-1] for r in got)


def test_random_texts_over_few_words(spark):
    rng = random.Random(11)
    say = lambda n: " ".join(rng.choice(["a", "b", "É", "é", "x1", "A"]) for _ in range(n))
    docs = [(i, say(rng.randrange(60))) for i in range(150)] + [
        (200, None), (201, ""), (202, " .,! "), (203, "!a b!"), (204, "long " * 30_000 + "x1 x1 x1"), (205, "q"), (None, "a b c a b c"),
    ]
    docs += [docs[3], docs[3], (3, "other text of the same id a b a b")]
    items = [(i, say(rng.randrange(1, 9))) for i in range(25)] + [(30, None), (31, "..."), (None, "a b a"), (32, "x1 x1 x1"), (5, say(4)), (33, "q")]
    d = spark.createDataFrame([(i, t, 0, 1) for i, t in docs], "doc_id long, text string, pos int, h int")
    b = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, df int")
    assert _got(decon.contamination(d, b, window=4)) == _expected(docs, items, 4)
    left = decon.drop_contaminated(d, b)
    assert left.columns == d.columns


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")
    assert decon.contamination(none, items).collect() == []
    no_items = decon.contamination(docs, items.where("item_id > 9")).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in no_items] == [(4, 0, False)]


def test_proximity_finds_moved_words(spark):
    docs = spark.createDataFrame(
        [(1, "one two three four five"), (2, "one two extra three four five"), (3, "one two x y z three four five")],
        "doc_id long, text string",
    )
    items = spark.createDataFrame([(1, "one two three four five")], "item_id long, text string")
    hit = lambda slop: {r.doc_id for r in decon.contamination(docs, items, slop=slop).collect() if r.contaminated}
    assert hit(0) == {1} and hit(1) == {1, 2} and hit(3) == {1, 2, 3}


def test_only_asked_postings_are_exchanged(spark, monkeypatch):
    """Postings of the rarest terms of no window, and of rows that the two rarest terms rule out, stay where they are."""
    docs = [(i, "a b c d " * 20 + ("r s" if i == 0 else "r t" if i % 2 else "s u")) for i in range(50)] + [(99, "d r s a b c")]
    items = [(1, "d r s a")]
    sides, plain = [], decon._same

    def spied(left, right, columns, how):
        if "pos" in columns:
            sides.append((left, right.count()))
        return plain(left, right, columns, how)

    monkeypatch.setattr(decon, "_same", spied)
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert _got(decon.contamination(d, b, window=4)) == _expected(docs, items, 4)
    # Once the second rarest term, in 26 rows at most; then the other two terms, in the two rows with r and s side by side.
    assert [n <= 60 for _, n in sides] == [True, True], [n for _, n in sides]
