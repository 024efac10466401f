import math
import random
from collections import Counter

import numpy as np
import pytest

from quotebook.llm import quality


def _model(texts):
    """Interpolated modified Kneser-Ney by its definition, over dictionaries."""
    tables = [Counter(g for t in texts for w in quality.words_of(t) for g in quality.grams_of(w))]
    for _ in range(quality.ORDER - 1):
        tables.insert(0, Counter(g[1:] for g in tables[0]))

    def of(counts):
        t = Counter(counts.values())
        if not t[1] or not t[2]:
            return 0.5, 0.75, 0.9
        y = t[1] / (t[1] + 2 * t[2])
        d2 = 2 - 3 * y * t[3] / t[2]
        d = 1 - 2 * y * t[2] / t[1], d2, 3 - 4 * y * t[4] / t[3] if t[3] else d2
        return tuple(min(max(x, 0.05), i + 0.95) for i, x in enumerate(d))

    ds = [of(t) for t in tables]

    def p(gram, k):
        if k == 0:
            return 1 / (len(tables[0]) + 1)
        lower = p(gram, k - 1)
        context = gram[len(gram) - k : len(gram) - 1]
        rows = {g: n for g, n in tables[k - 1].items() if g[:-1] == context}
        if not rows:
            return lower
        total, d = sum(rows.values()), ds[k - 1]
        n = rows.get(gram[len(gram) - k :], 0)
        own = max(n - d[min(n, 3) - 1], 0) / total if n else 0
        return own + sum(d[min(x, 3) - 1] for x in rows.values()) / total * lower

    def perplexity(text):
        ws = quality.words_of(text or "")
        logs = [math.log(p(g, quality.ORDER)) for w in ws for g in quality.grams_of(w)]
        return math.exp(-sum(logs) / len(logs)) if logs else None

    return perplexity


def test_perplexities_match_the_definition(spark, monkeypatch):
    monkeypatch.setattr(quality, "SHARD_GRAMS", 60)  # several shards
    rng = random.Random(4)
    say = lambda n: " ".join("".join(rng.choice("aabcé") for _ in range(rng.randrange(1, 6))) for _ in range(n))
    rows = [(i, say(rng.randrange(1, 12)), "xy"[i % 2], 0.5) for i in range(40)]
    rows += [(90, None, "x", 0.0), (91, "  ", None, 0.0), (None, "zz #", None, 0.0), (3, rows[3][1], "y", 0.0), (92, "long" * 900, "x", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, perplexity double").repartition(3)
    labels = spark.createDataFrame([(i, 1) for i in range(0, 40, 3)] + [(0, 0), (0, 1), (None, 1), (1, None), (2, 0)], "doc_id long, quality int")
    model = _model([t for i, t, _, _ in rows if i is not None and i < 40 and i % 3 == 0])
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(rows)
    expected = sorted(((i or -1), model(t) or 0) for i, t, _, _ in rows)
    for (i, p), r in zip(expected, sorted(got, key=lambda r: (r.doc_id or -1, r.perplexity or 0)), strict=True):
        assert (r.doc_id or -1) == i and (r.perplexity or 0) == pytest.approx(p, rel=1e-9)
        assert r.kept == (r.perplexity is not None and r.perplexity <= r.threshold)
    left = quality.drop_rejected(docs, labels)
    assert left.columns == docs.columns and left.count() == sum(r.kept for r in got)


def test_labelled_documents(spark):
    path = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{path}/labels.parquet")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    got = quality.classify(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id", how="left")
    assert len(got) == docs.count()
    kept = got.groupby("quality").kept.mean()
    print(kept, got.groupby(["lang", "quality"]).perplexity.describe(), got.groupby("lang").threshold.first())
    assert kept[1] > 0.97 and kept[0] < 0.5


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b", "en"), (2, "", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert sorted((r.doc_id, r.kept) for r in quality.classify(docs, labels).collect()) == [(1, True), (2, False)]
    assert quality.classify(docs.limit(0), labels).collect() == []


def test_order_and_repetition_count(spark, monkeypatch):
    rng = random.Random(7)
    words = ["the", "small", "house", "stands", "near", "river", "and", "we", "walk", "there"]
    after = {w: rng.sample(words, 2) for w in words}

    def say(n):
        out = [rng.choice(words)]
        while len(out) < n:
            out.append(rng.choice(after[out[-1]]))
        return out

    plain = say(400)
    texts = [" ".join(say(300)) for _ in range(30)] + [" ".join(plain), " ".join(rng.sample(plain, 400)), "house " * 400, "a\u0416\u4e2d" * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'en' AS lang")
    labels = spark.createDataFrame([(i, 1) for i in range(30)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert got[31].perplexity > 1.15 * got[30].perplexity and got[32].perplexity > 1.15 * got[30].perplexity
    assert got[30].kept and not got[31].kept and not got[32].kept
    # Pieces and alphabets of any size give the same n-grams.
    runs = ["", *texts[-4:], "".join(map(chr, range(0x4E00, 0x4E00 + 9000)))]
    for small in (50, 10**6):
        monkeypatch.setattr(quality, "PIECE_CHARS", small)
        cut = [[] for _ in runs]
        for grams, numbers, owner in quality.numbered(runs):
            for n, o in zip(numbers, owner, strict=True):
                cut[o].append(grams[n])
        assert cut == [quality.grams_of(r) if r else [] for r in runs]


def test_rows_of_code_points_stand_for_texts():
    rng, rows = random.Random(2), lambda texts: np.concatenate([quality.points_of(t) for t in texts]).reshape(-1, quality.ORDER)
    # The second alphabet is too large for five of its letters to fit into one number.
    for alphabet in ("ab\u00e9\u4e2d\U0001f600\x02", "".join(map(chr, range(0x4E00, 0x4E00 + 9000)))):
        texts = sorted({"".join(rng.choice(alphabet) for _ in range(quality.ORDER)) for _ in range(4000)} | {"ab\x02cd"})
        grams = rows(texts)
        assert quality.strings_of(grams).to_pylist() == texts and quality.text_of(grams).decode() == "".join(texts)
        others = ["".join(rng.choice(alphabet + "qz") for _ in range(quality.ORDER)) for _ in range(3000)] + texts[::3] + ["\U0010ffff" * quality.ORDER]
        codes, places = quality.Codes(grams), {t: i for i, t in enumerate(texts)}
        assert (np.diff(codes.codes) > 0).all()
        assert quality.found(codes.codes, codes.of(rows(others))).tolist() == [places.get(t, len(texts)) for t in others]
        merged, sums = quality._merged([(rows(others), np.ones(len(others), np.int64)), (grams[::2], np.full(len(grams[::2]), 5))])
        assert dict(zip(quality.strings_of(merged).to_pylist(), sums, strict=True)) == Counter(others) + Counter(texts[::2] * 5)
        keys = {""}.union(*({t[i:j] for t in texts} for i in range(quality.ORDER + 1) for j in range(max(i, quality.ORDER - 1), quality.ORDER + 1)))
        asked = [(i, b.decode().split("\n")) for i, b in quality.Asked(grams, 5).blocks()]
        assert sorted(k for _, ks in asked for k in ks) == sorted(keys)


def test_shards_are_the_same_in_spark_and_in_numpy(spark):
    texts = ["abcde", "\x02\x02\x02\x02a", "\u4e2d\U0001f600\u00e9 \x03", "\U0010ffff" * 5]
    grams = np.concatenate([quality.points_of(t) for t in sorted(texts)]).reshape(-1, quality.ORDER)
    asked = {k: i for i, b in quality.Asked(grams, 1000).blocks() for k in b.decode().split("\n")}
    rows = spark.createDataFrame([(k,) for k in asked], "gram string").select("gram", quality.shard_of("gram", 1000).alias("shard"))
    assert {r.gram: r.shard for r in rows.collect()} == asked


def test_distinct_ngrams_are_numbered_in_arrays():
    # One text for each n-gram and place took most of the time: a million characters were some 0.3 s and 100,000 texts.
    rng = random.Random(3)
    for dense in (10, 1 << 23):
        run = " ".join("".join(rng.choice("abcdefghijklmnop\u00e9\u4e2d") for _ in range(rng.randrange(1, 9))) for _ in range(2000))
        old, quality.DENSE_CODES = quality.DENSE_CODES, dense
        try:
            ((grams, numbers, _),) = quality.numbered([run])
        finally:
            quality.DENSE_CODES = old
        assert isinstance(grams.points, np.ndarray) and grams.points.shape == (len(grams), quality.ORDER)
        assert [grams[n] for n in numbers] == quality.grams_of(run)
