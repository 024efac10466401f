"""The stored book: same rows as the job over whole books, only touched buckets, writers at the same time."""

import os
import random
import threading

import pytest

from quotebook.operators.candidates import canonical_names
from quotebook.operators.resolve import token_index
from quotebook.plans.buckets import kept_token_index, merge_batch
from quotebook.plans.upsert import upsert_stocks
from quotebook.schemas import BOOK_FIELDS
from quotebook.sources import book as books
from quotebook.sources import versions as V
from tests.test_merge import frame, row, ts


def rows_of(book):
    return sorted((tuple(str(r[f]) for f in BOOK_FIELDS) for r in book.select(*BOOK_FIELDS).collect()))


def counts(summary):
    return tuple(summary.first()[c] for c in ("scraped", "inserted", "updated", "removed"))


WORDS = ["alphawood", "bravotown", "charlie", "deltaport", "echo", "power", "kilo", "limafield"]


def history(seed, n_batches):
    """Batches of listings whose names share tokens, repeat, change source, and match in all tiers."""
    rng = random.Random(seed)
    for batch in range(n_batches):
        rows = []
        for _ in range(14):
            words = rng.sample(WORDS, rng.randint(1, 4))
            name = " ".join(words) + rng.choice(["", " Ltd", " Limited", " (Formerly " + rng.choice(WORDS) + " works)"])
            if rng.random() < 0.1:
                name = " ".join(WORDS + [f"word{i}" for i in range(rng.randint(1, 3))])  # beyond the listed subsets
            source = rng.choice(["primary", "secondary", "secondary"])
            slug = "-".join(words) if rng.random() < 0.7 else f"{source[0]}-{rng.randint(0, 9)}"
            short = "".join(w[0] for w in words) if source == "secondary" and rng.random() < 0.3 else None
            rows.append(row(name, slug, source, rng.choice([None, 0.0, float(batch + 1)]), sector=rng.choice([None, "", "S"]), short_name=short))
        yield rows


def test_history_equals_the_job_over_whole_books(spark, tmp_path):
    root = str(tmp_path / "book")
    aliases = spark.createDataFrame([(1, "echo", "alphawood power")], "ord bigint, secondary_name string, primary_name string")
    whole = books.empty_book(spark)
    spared = 0
    for batch, rows in enumerate(history(2, 3)):
        listings = frame(spark, rows)
        expected = upsert_stocks(whole, listings, ts(batch + 1), aliases, batch=batch)
        whole = spark.createDataFrame(expected.book.collect(), expected.book.schema)
        got = merge_batch(spark, root, listings, ts(batch + 1), aliases)
        assert rows_of(books.read_book(spark, root)) == rows_of(whole), batch
        assert counts(got.summary) == counts(expected.summary)
        assert got.resolved_again <= got.n_leftovers
        spared += got.n_leftovers - got.resolved_again
        index = sorted(map(tuple, kept_token_index(spark, root).collect()))
        assert index == sorted(map(tuple, token_index(canonical_names(whole)).collect()))
    assert spared > 0


def files(df):
    return {f.split("version=")[1] for f in df.inputFiles()}


def test_a_batch_touches_its_buckets_only(spark, tmp_path):
    root = str(tmp_path / "book")
    first = [row(f"Company{i:03d} Works", f"c-{i}", price=1.0) for i in range(300)]
    merge_batch(spark, root, frame(spark, first), ts(1), n_buckets=64)
    before = files(books.read_book(spark, root))
    got = merge_batch(spark, root, frame(spark, [row("Company007 Works", "c-7", price=2.0), row("Company011 Works", "x-1", "secondary", 9.0)]), ts(2))
    assert (got.touched, got.n_buckets) == (2, 64)
    after = files(books.read_book(spark, root))
    assert {f.split("/")[0] for f in after - before} == {"1"} and len(before - after) <= 2
    written = os.listdir(tmp_path / "book" / "version=1" / "records")
    assert len([d for d in written if d.startswith("bucket=")]) == 2
    # The names stayed as they were, so no posting moved.
    assert not (tmp_path / "book" / "version=1" / "postings").exists()
    held = {r.slug: (r.price, r.backup_price) for r in books.read_book(spark, root).collect()}
    assert len(held) == 300 and held["c-7"] == (2.0, None) and held["c-11"] == (1.0, 9.0)
    one = V.read_part(spark, root, V.describe(spark, root, 1), "records", books.BOOK_SCHEMA, V.buckets_of(books.read_book(spark, root).filter("slug = 'c-7'"), "slug", 64))
    assert len(one.inputFiles()) < len(after) / 8


def test_writers_at_the_same_time_lose_nothing(spark, tmp_path):
    root = str(tmp_path / "book")
    merge_batch(spark, root, frame(spark, [row("Zulu Base Works", "z-0", price=1.0)]), ts(1))
    done, failed = [], []

    def write(i):
        try:
            done.append(merge_batch(spark, root, frame(spark, [row(f"Writer{i} Works", f"w-{i}", price=float(i))]), ts(2)).version)
        except Exception as e:  # shown by the assertion below
            failed.append(e)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and sorted(done) == [1, 2]
    assert {r.slug for r in books.read_book(spark, root).collect()} == {"z-0", "w-0", "w-1"}
    # Whole books without a number of their own take the next free one.
    assert [books.write_book(books.read_book(spark, root), root) for _ in range(2)] == [3, 4]


def test_only_one_creates_a_claim(spark, tmp_path):
    won = []
    threads = [threading.Thread(target=lambda: won.append(V.create_new(spark, str(tmp_path / "c" / "claim")))) for _ in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(won) == [False] * 7 + [True]


def test_claim_of_a_dead_writer_is_void(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "book")
    book = books.empty_book(spark)
    assert books.write_book(book, root) == 0
    assert V.create_new(spark, f"{root}/_claims/version=1")
    monkeypatch.setattr(V, "LEASE_SECONDS", 0)
    assert books.write_book(book, root) == 1
    with pytest.raises(V.VersionTaken):
        V.commit(spark, root, V.describe(spark, root, 0), {})
    assert V.versions(spark, root) == [0, 1]


def test_retired_versions_leave_what_newer_ones_use(spark, tmp_path):
    root = str(tmp_path / "book")
    for i in range(2):
        merge_batch(spark, root, frame(spark, [row(f"Company{i} Works", f"c-{i}", price=1.0)]), ts(1))
    before = rows_of(books.read_book(spark, root))
    assert books.retire(spark, root, 1) == [0]
    assert V.versions(spark, root) == [1] and rows_of(books.read_book(spark, root)) == before
    merge_batch(spark, root, frame(spark, [row("Company0 Works", "c-0", price=3.0)]), ts(2))
    assert {r.slug: r.price for r in books.read_book(spark, root).collect()} == {"c-0": 3.0, "c-1": 1.0}
    with pytest.raises(ValueError):
        books.retire(spark, root, 0)


def test_a_book_without_buckets_is_dealt_into_them(spark, tmp_path):
    root = str(tmp_path / "book")
    old = upsert_stocks(books.empty_book(spark), frame(spark, [row("Old Works", "o-1", price=1.0)]), ts(1)).book
    old.select(*BOOK_FIELDS).write.parquet(f"{root}/version=0")
    assert rows_of(books.read_book(spark, root)) == rows_of(old)
    merge_batch(spark, root, frame(spark, [row("New Works", "n-1", price=2.0)]), ts(2))
    assert {r.slug for r in books.read_book(spark, root).collect()} == {"o-1", "n-1"}
