"""Quality classification by an interpolated modified Kneser-Ney model of character n-grams.

The model is trained on the whole text of all trusted documents (those labelled good). It predicts each
character of a text, the spaces between words and the end included, from the four before it, across the
boundaries of words and in the order of the text. Its tables grow with the corpus but slowly, and what is
gathered from a part of the corpus is its distinct n-grams.

1. Tasks read their texts in chunks: the chunk's distinct n-grams in sorted order, how often trusted texts have
   each, and the texts (white space as single spaces), all three compressed. This table is all that later steps
   read. It lies in hash buckets by chunk, so that in step 3 the answers come to the chunks, which are not exchanged.
2. Counts of the n-grams of trusted texts are summed up by n-gram; continuation counts, discounts and
   interpolation weights of all lower orders follow by grouping. Every n-gram has one row: its own share of
   probability and the weight it leaves to the next lower order as a context.
3. Each chunk asks every shard of the model once, with a packed block of the n-grams it needs there, by length and sorted;
   the shard (a cogroup of blocks and rows of the model, by hash of the n-gram) answers with numbers in the order
   of the block, and the answers meet the chunk again. There are as many shards as keep blocks and rows of one
   within SHARD_GRAMS on average. The chunk's n-grams are scored once each, its documents by all places of theirs.

A document is rejected if its perplexity (per character) exceeds its language's threshold: a quantile of the
perplexities of that language's trusted documents, widened by a margin since the model has seen those.
Languages without trusted documents take the quantile of all.

Nulls: a null text or one without words has no perplexity and is rejected; a null language is a language of its
own; a null id is never trusted. An id labelled more than once is trusted if any label is good. Repeated rows
each give a row. Empty tables give an empty result; without trusted documents nothing but word-less rows is
rejected. Other columns of the inputs, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotebook.llm.bpe import texts_of
from quotebook.llm.staging import keep, keep_bucketed, planned, sized

ORDER = 5
CHUNK_CHARS = 16 << 20
#: Texts are cut into n-grams so many characters at a time (n-grams across the cuts included).
PIECE_CHARS = 1 << 20
#: Codes up to so many are numbered through a table of all of them, more by hashing.
DENSE_CODES = 1 << 23
#: A chunk's n-grams gathered from pieces before they are merged.
GATHERED_GRAMS = 1 << 19
#: N-grams asked of a shard, and rows of the model in it, on average.
SHARD_GRAMS = 1_000_000
QUANTILE = 0.99
MARGIN = 1.15
#: Buckets of the chunks, at most (one for each CHUNK_CHARS bytes of text below that).
MOST_BUCKETS = 100_000
#: Trusted ids are broadcast up to so many, else joined by exchange.
BROADCAST_ROWS = 1_000_000
# Marks of a text's start and end.
START, END = "\x02", "\x03"
#: An n-gram's shard: a weighted sum of its code points, the same in Spark and in numpy.
WEIGHTS, PRIME = (1_540_483_477, 1_103_515_245, 776_531_401, 505_563_883, 268_582_165), (1 << 31) - 1


def pack(data: bytes) -> bytes:
    """Compressed bytes. Copies far apart in a chunk are found too: the window spans a whole chunk."""
    how = zstandard.ZstdCompressionParameters.from_level(6, window_log=24, enable_ldm=True)
    return zstandard.ZstdCompressor(compression_params=how).compress(data)


def unpack(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def text_of(points: np.ndarray) -> bytes:
    return points.astype("<u4").tobytes().decode("utf-32-le").encode()


def unpack_grams(blob: bytes) -> np.ndarray:
    """The n-grams of highest order, packed one after the other, as rows of code points."""
    return points_of(unpack(blob).decode()).reshape(-1, ORDER)


def strings_of(grams: np.ndarray) -> pa.StringArray:
    """Rows of code points as texts."""
    sizes = (1 + (grams >= 0x80) + (grams >= 0x800) + (grams >= 0x10000)).sum(axis=1)
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(grams), pa.py_buffer(ends), pa.py_buffer(text_of(grams)))


def words_of(text: str) -> list[str]:
    """The text's words as one run with single spaces; none where there are no words."""
    run = " ".join(text.split())
    return [run] if run else []


def grams_of(run: str) -> list[str]:
    """The n-grams of highest order in the order of the text, one for each character and the end."""
    padded = START * (ORDER - 1) + run + END
    return [padded[i : i + ORDER] for i in range(len(run) + 1)]


class Grams:
    """N-grams as rows of code points; an item is a text."""

    def __init__(self, points: np.ndarray):
        self.points = points

    def __len__(self) -> int:
        return len(self.points)

    def __getitem__(self, i: int) -> str:
        return text_of(self.points[i]).decode()


class Codes:
    """Numbers for rows of code points, in the order of the rows. ``codes`` are those of the rows given."""

    def __init__(self, rows: np.ndarray):
        # Points that these rows lack have the last rank.
        used = np.zeros(int(rows.max(initial=0)) + 2, bool)
        for points in rows.T:
            used[points] = True
        self._base = int(used.sum()) + 1
        self._rank = np.where(used, np.cumsum(used) - 1, self._base - 1)
        self._prefixes: dict[int, np.ndarray] = {}
        size, code = 1, np.zeros(len(rows), np.int64)
        for k, points in enumerate(rows.T):
            if size * self._base >= 1 << 62:
                # Too many for one number: the distinct prefixes are numbered anew.
                self._prefixes[k] = np.unique(code)
                code, size = np.searchsorted(self._prefixes[k], code), len(self._prefixes[k]) + 1
            code = code * self._base + self._rank[points]
            size *= self._base
        self.codes = code

    def of(self, rows: np.ndarray) -> np.ndarray:
        """The codes of other rows; one that is not among the rows given has none of their codes."""
        code = np.zeros(len(rows), np.int64)
        for k, points in enumerate(rows.T):
            if k in self._prefixes:
                code = found(self._prefixes[k], code)
            code = code * self._base + self._rank[np.minimum(points, len(self._rank) - 1)]
        return code


def found(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each wanted number is among ascending values; behind the last one if it is not."""
    if not len(values):
        return np.zeros(len(wanted), np.int64)
    at = np.searchsorted(values, wanted)
    return np.where(values[np.minimum(at, len(values) - 1)] == wanted, at, len(values))


def distinct_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of code points in ascending order, and the place of each row among them."""
    number, codes = pd.factorize(Codes(rows).codes)
    order = np.argsort(codes)
    place, rank = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
    place[number] = np.arange(len(number))
    rank[order] = np.arange(len(order))
    return rows[place[order]], rank[number]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of all parts in ascending order, and the sums of their counts."""
    grams, at = distinct_rows(np.concatenate([g for g, _ in parts]))
    counts = np.zeros(len(grams), np.int64)
    np.add.at(counts, at, np.concatenate([n for _, n in parts]))
    return grams, counts


def _compact(code: np.ndarray, size: int) -> tuple[np.ndarray, int]:
    """Codes below a size, numbered without gaps."""
    if size > DENSE_CODES:
        number, codes = pd.factorize(code)
        return number, len(codes)
    used = np.zeros(size, bool)
    used[code] = True
    codes = np.flatnonzero(used)
    rank = np.zeros(size, np.int32)
    rank[codes] = np.arange(len(codes), dtype=np.int32)
    return rank[code], len(codes)


def _distinct(stream: str) -> tuple[Grams, np.ndarray]:
    """The stream's distinct n-grams and, for each place where one begins, its number among them."""
    points = points_of(stream)
    rank, letters = _compact(points, int(points.max()) + 1)
    code, size = rank, letters
    for k in range(1, ORDER):
        if size * letters > DENSE_CODES:
            code, size = _compact(code, size)
        code = code[:-1].astype(np.int64 if size * letters >= 1 << 31 else np.int32) * letters + rank[k:]
        size *= letters
    number, n = _compact(code, size)
    place = np.zeros(n, np.int64)
    place[number] = np.arange(len(number))
    return Grams(points[place[:, None] + np.arange(ORDER)]), number


def numbered(runs: Iterable[str]) -> Iterator[tuple[Grams, np.ndarray, np.ndarray]]:
    """The n-grams of all runs in pieces: (n-grams, their numbers at all places, the run of each place). A piece's
    list also holds the few n-grams that cross from one run to the next; no place has their numbers."""
    owners, cut, size = [], [], 0

    def piece() -> tuple[Grams, np.ndarray, np.ndarray]:
        grams, number = _distinct("".join(cut))
        lengths = np.fromiter(map(len, cut), np.int64, len(cut))
        inside = np.ones(lengths.sum(), bool)
        inside[(np.cumsum(lengths)[:, None] - np.arange(1, ORDER)).ravel()] = False
        return grams, number[inside[: len(number)]], np.repeat(owners, lengths - (ORDER - 1))

    for i, run in enumerate(runs):
        padded = START * (ORDER - 1) + run + END if run else ""
        for at in range(0, len(run) + 1 if run else 0, PIECE_CHARS):
            cut.append(padded[at : at + PIECE_CHARS + ORDER - 1])
            owners.append(i)
            size += len(cut[-1])
            if size >= PIECE_CHARS:
                yield piece()
                owners, cut, size = [], [], 0
    if cut:
        yield piece()


def coded(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str, label_col: str, key: Column
) -> tuple[DataFrame, str, int]:
    """One row per chunk: n-grams, how often trusted texts have each, and the packed documents. With the name of the
    table and its number of buckets."""
    good = labels.where(F.col(label_col) > 0).select(F.col(id_col).alias("_id")).where("_id is not null").distinct()
    good = good.withColumn("_good", F.lit(1))
    good = sized(good, BROADCAST_ROWS)
    read = docs.select(
        F.col(id_col).alias("id"), key.alias("key"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    good_ = F.coalesce("_good", F.lit(0)).alias("good")
    read = read.join(good, F.col("id") == F.col("_id"), "left").select("key", "lang", good_, "text")
    kind = read.schema["key"].dataType.simpleString()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId() << 24, 0
        none = np.zeros((0, ORDER), "<u4"), np.zeros(0, np.int64)
        rows: list[pa.RecordBatch] = []
        seen, gathered, texts, ends, size = [none], 0, [], [], 0

        def chunk() -> pa.RecordBatch:
            small = pa.Table.from_batches(rows).combine_chunks()
            grams, trusted = _merged(seen)
            packed = (text_of(grams), trusted.astype("<i8").tobytes(), b"".join(texts))
            one = lambda column: pa.ListArray.from_arrays(
                pa.array([0, len(column)], pa.int32()), column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part + number], pa.int64()), pa.array([len(grams)], pa.int64()),
                    *(one(small.column(i)) for i in range(3)), one(pa.array(ends, pa.int32())),
                    *(pa.array([pack(data)], pa.binary()) for data in packed),
                ],
                names=["chunk", "n", "ids", "langs", "good", "ends", "grams", "trusted", "blob"],
            )

        for batch in batches:
            for at in range(0, len(batch), 256):
                piece = batch.slice(at, 256)
                rows.append(piece.select([0, 1, 2]))
                runs = ["".join(words_of(text)) for text in texts_of(piece.column(3))]
                good_ = piece.column(2).to_numpy(zero_copy_only=False) > 0
                for grams, numbers, owner in numbered(runs):
                    used = np.bincount(numbers, minlength=len(grams)) > 0
                    trusted = np.bincount(numbers[good_[owner]], minlength=len(grams))
                    seen.append((grams.points[used], trusted[used]))
                    gathered += len(seen[-1][1])
                    if gathered >= GATHERED_GRAMS:
                        seen, gathered = [_merged(seen)], 0
                # As bytes: one rare character would widen a whole chunk of text.
                for run in runs:
                    texts.append(run.encode())
                    ends.append((ends[-1] if ends else 0) + len(texts[-1]))
                size += sum(map(len, runs))
                if size >= CHUNK_CHARS:
                    yield chunk()
                    rows, seen, gathered, texts, ends, size = [], [none], 0, [], [], 0
                    number += 1
                    pa.default_memory_pool().release_unused()
        if rows:
            yield chunk()

    schema = (
        f"chunk long, n long, ids array<{kind}>, langs array<string>, good array<int>, ends array<int>, "
        "grams binary, trusted binary, blob binary"
    )
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    least = 2 * docs.sparkSession.sparkContext.defaultParallelism
    buckets = min(max(size // CHUNK_CHARS + 1, least), MOST_BUCKETS)
    return *keep_bucketed(read.mapInArrow(code, schema), "quality-coded", "chunk", buckets), buckets


def _trusted_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for packed, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            n = np.frombuffer(unpack(counts), "<i8")
            yield pa.RecordBatch.from_arrays([strings_of(unpack_grams(packed)[n > 0]), pa.array(n[n > 0])], names=["gram", "n"])


def discounts(table: DataFrame) -> tuple[float, float, float]:
    """D1, D2, D3+ from the numbers of n-grams that occur once, twice, three and four times."""
    found = {r.n: r.k for r in table.where("n <= 4").groupBy("n").agg(F.count("*").alias("k")).collect()}
    t1, t2, t3, t4 = (found.get(i, 0) for i in range(1, 5))
    if not t1 or not t2:
        return 0.5, 0.75, 0.9
    y = t1 / (t1 + 2 * t2)
    d1, d2 = 1 - 2 * y * t2 / t1, 2 - 3 * y * t3 / t2
    d3 = 3 - 4 * y * t4 / t3 if t3 else d2
    return tuple(min(max(d, 0.05), i + 0.95) for i, d in enumerate((d1, d2, d3)))


def train(counts: DataFrame, order: int = ORDER) -> tuple[DataFrame, int]:
    """Rows (gram, own, left) of all orders from counts (gram, n) of the highest; and the number of characters.

    p(w | context) = own(context w) + left(context) * p(w | shorter context), and below single characters the
    uniform distribution. An n-gram that was not seen has no own share; a context not seen leaves everything.
    """
    table, parts, symbols = counts, [], 0
    for k in range(order, 0, -1):
        if k < order:
            table = keep(table.groupBy(F.substring("gram", 2, order).alias("gram")).agg(F.count("*").alias("n")), "quality-counts")
        d1, d2, d3 = discounts(table)
        rows = table.count()
        discount = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        split = table.select("gram", "n", discount.alias("d"), F.substring("gram", 1, k - 1).alias("context"))
        contexts = split.groupBy("context").agg(F.sum("n").alias("total"), (F.sum("d") / F.sum("n")).alias("left"))
        own = split.join(planned(contexts, rows), "context").select("gram", (F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total")).alias("own"))
        parts += [own.select("gram", "own", F.lit(0.0).alias("left")), contexts.select(F.col("context").alias("gram"), F.lit(0.0).alias("own"), "left")]
        symbols = rows if k == 1 else symbols
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return keep(union.groupBy("gram").agg(F.sum("own").alias("own"), F.sum("left").alias("left")), "quality-model"), symbols


def shard_of(gram: str, shards: int) -> Column:
    parts = [F.ascii(F.substring(gram, i + 1, 1)).cast("long") * w for i, w in enumerate(WEIGHTS)]
    return reduce(Column.__add__, parts) % PRIME % shards


class Asked:
    """What the scores of n-grams (distinct, ascending) take from the shards of the model: the n-grams, their contexts,
    and the same of all lower orders."""

    def __init__(self, grams: np.ndarray, shards: int):
        # levels[k]: the keys of k characters; shorter[k]: the place of each without its first character in levels[k - 1].
        self.levels, self._shorter = {ORDER: grams}, {}
        below, at = distinct_rows(np.concatenate([grams[:, :-1], grams[:, 1:]]))
        self._contexts, self._shorter[ORDER] = at[: len(grams)], at[len(grams) :]
        for k in range(ORDER - 1, 0, -1):
            self.levels[k] = below
            below, self._shorter[k] = distinct_rows(below[:, 1:])
        self.levels[0] = np.zeros((1, 0), "<u4")
        # The keys of a shard, by level, in the order of its block.
        self._keys: list[list[tuple[int, np.ndarray]]] = [[] for _ in range(shards)]
        for k, keys in self.levels.items():
            shard = keys.astype(np.int64) @ np.array(WEIGHTS[:k], np.int64) % PRIME % shards
            order = np.argsort(shard, kind="stable")
            for some in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
                if len(some):
                    self._keys[shard[some[0]]].append((k, some))

    def blocks(self) -> Iterator[tuple[int, bytes]]:
        """(shard, its keys, each on a line of its own) for every shard that is asked."""
        for shard, parts in enumerate(self._keys):
            lines = [np.pad(self.levels[k][some], ((0, 0), (0, 1)), constant_values=10).ravel() for k, some in parts]
            if lines:
                yield shard, text_of(np.concatenate(lines))[:-1]

    def log_probabilities(self, answers: list[dict], symbols: int) -> np.ndarray:
        """log p of the n-grams, from the answers of the shards."""
        own, left = ({k: np.zeros(len(keys)) for k, keys in self.levels.items()} for _ in range(2))
        for answer in answers:
            both, at = np.frombuffer(unpack(answer["block"])).reshape(2, -1), 0
            for k, some in self._keys[answer["shard"]]:
                own[k][some], left[k][some] = both[:, at : at + len(some)]
                at += len(some)
        n = len(self.levels[ORDER])
        parts, contexts = {ORDER: np.arange(n)}, {ORDER - 1: self._contexts}
        for k in range(ORDER, 0, -1):
            parts[k - 1] = self._shorter[k][parts[k]]
            if k < ORDER:
                contexts[k - 1] = self._shorter[k][contexts[k]]
        p = np.full(n, 1 / (symbols + 1))
        for k in range(1, ORDER + 1):
            # What was not found has no own share, and leaves everything as a context.
            rest = left[k - 1][contexts[k - 1]]
            p = own[k][parts[k]] + np.where(rest == 0.0, 1.0, rest) * p
        return np.log(p)


def _asks(shards: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                blocks = [(i, pack(keys)) for i, keys in Asked(unpack_grams(packed), shards).blocks()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * len(blocks), pa.int64()), pa.array([i for i, _ in blocks], pa.int64()), pa.array([b for _, b in blocks], pa.binary())],
                    names=["chunk", "shard", "block"])

    return ask


def _answers(asks: pa.Table, rows: pa.Table) -> pa.Table:
    """A shard's answers to all blocks: the own shares and the weights left, in the order of the block."""
    blocks = pc.split_pattern(pa.array([unpack(b) for b in asks["block"].to_pylist()], pa.binary()).cast(pa.large_string()), "\n")
    keys = blocks.flatten().cast(pa.string())
    at = pc.fill_null(pc.index_in(keys, value_set=rows["gram"].combine_chunks().cast(pa.string())), rows.num_rows).to_numpy(zero_copy_only=False)
    own, left = (np.append(rows[c].to_numpy(), 0.0)[at] for c in ("own", "left"))
    stops = np.cumsum(pc.list_value_length(blocks).to_numpy(zero_copy_only=False))[:-1]
    values = [pack(np.concatenate(pair).tobytes()) for pair in zip(np.split(own, stops), np.split(left, stops), strict=True)] if len(blocks) else []
    pa.default_memory_pool().release_unused()
    return pa.table({"chunk": asks["chunk"], "shard": asks["shard"], "block": pa.array(values, pa.binary())})


def perplexities(chunks: DataFrame, model: DataFrame, symbols: int, buckets: int) -> DataFrame:
    """id, lang, good, perplexity of every document. The answers are dealt as the chunks are, so these stay in place."""
    size = max(chunks.agg(F.sum("n")).first()[0] or 0, model.count())
    shards = size // SHARD_GRAMS + 1
    asks = chunks.select("chunk", "grams").mapInArrow(_asks(shards), "chunk long, shard long, block binary")
    rows = model.withColumn("shard", shard_of("gram", shards))
    answers = asks.groupBy("shard").cogroup(rows.groupBy("shard")).applyInArrow(_answers, "chunk long, shard long, block binary")
    answers = answers.repartition(buckets, "chunk").groupBy("chunk").agg(F.collect_list(F.struct("shard", "block")).alias("answers"))
    kind = chunks.schema["ids"].dataType.elementType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                ids, langs, good, ends, blob, packed, answer = (batch.column(c)[i] for c in range(7))
                known = unpack_grams(packed.as_py())
                # A piece also has n-grams across documents, which no place refers to: behind the last one.
                values = np.append(Asked(known, shards).log_probabilities(answer.as_py() or [], symbols), 0.0)
                codes = Codes(known)
                text, stops = unpack(blob.as_py()), ends.values.to_pylist()
                runs = (text[a:b].decode() for a, b in zip([0, *stops[:-1]], stops, strict=True))
                log, chars = np.zeros(len(stops)), np.zeros(len(stops), np.int64)
                for grams, numbers, owner in numbered(runs):
                    logs = values[found(codes.codes, codes.of(grams.points))]
                    log += np.bincount(owner, weights=logs[numbers], minlength=len(stops))
                    chars += np.bincount(owner, minlength=len(stops))
                value = np.exp(-log / np.maximum(chars, 1))
                yield pa.RecordBatch.from_arrays(
                    [ids.values, langs.values, good.values, pa.array(value, mask=chars == 0)],
                    names=["id", "lang", "good", "perplexity"])
                pa.default_memory_pool().release_unused()

    joined = chunks.join(answers, "chunk", "left").select("ids", "langs", "good", "ends", "blob", "grams", "answers")
    return joined.mapInArrow(score, f"id {kind}, lang string, good int, perplexity double")


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    label_col: str = "quality",
    quantile: float = QUANTILE,
    margin: float = MARGIN,
    key: Column | None = None,
) -> DataFrame:
    """id (or `key` in its place), lang, perplexity, threshold and kept of every row."""
    chunks, table, buckets = coded(docs, labels, id_col, text_col, lang_col, label_col, F.col(id_col) if key is None else key)
    counts = chunks.select("grams", "trusted").mapInArrow(_trusted_grams, "gram string, n long")
    counts = keep(counts.groupBy("gram").agg(F.sum("n").alias("n")), "quality-counts")
    model, symbols = train(counts)
    scored = keep(perplexities(chunks, model, symbols, buckets), "quality-scores")
    docs.sparkSession.sql(f"DROP TABLE {table}")
    at = F.percentile_approx("perplexity", F.lit(quantile), F.lit(10_000)) * margin
    trusted = scored.where("good = 1 and perplexity is not null")
    limits = trusted.groupBy("lang").agg(at.alias("own_limit")).withColumnRenamed("lang", "_lang")
    general = trusted.agg(at.alias("limit")).first()[0]
    limits = keep(limits, "quality-limits")
    threshold = F.coalesce("own_limit", F.lit(general).cast("double"))
    out = scored.join(limits, F.col("lang").eqNullSafe(F.col("_lang")), "left").select(
        F.col("id").alias(id_col), "lang", "perplexity", threshold.alias("threshold"))
    fits = F.col("threshold").isNull() | (F.col("perplexity") <= F.col("threshold"))
    return out.withColumn("kept", F.col("perplexity").isNotNull() & fits)


def drop_rejected(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of `docs`, with all their columns, that the classifier keeps."""
    # Rows of one id may differ in their text, so a decision is told by both.
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"))
    found = classify(docs, labels, id_col, text_col, lang_col, key=key)
    rejected = keep(found.where(~F.col("kept")).select(F.col(id_col).alias("_key")).distinct(), "quality-rejected")
    return docs.join(sized(rejected, BROADCAST_ROWS), key.eqNullSafe(F.col("_key")), "left_anti")
