"""N-gram Jaccard join by banded MinHash LSH with exact verification.

1. Each text becomes the set of its five-word shingles (hashed to 64 bits). Equal sets are one class from here
   on, however many rows it has.
2. This is banded LSH, not an LSH forest: a class has TREES bands of MinHash values, all of one length, and no trie
   is walked. Two classes of similarity s agree in some band of length k with probability 1 - (1 - s^k)^TREES. The
   length is fixed before the data is seen: the greatest, up to DEPTH, that reaches the target recall at the threshold.
3. Classes that agree in a band meet in the least class of that value. A class is linked to the least of those it
   meets in, and that one to the others, each pair once (`band_links`); the connected components of these links hold
   all candidate pairs.
4. The sets of a component meet once for each pair of blocks: blocks hold a bounded number of classes and
   shingles and are formed by size, since sets of Jaccard similarity t differ in size by at most 1/t, so only
   blocks of neighbouring size levels meet. A block pair is verified by counting common shingles over posting
   lists; it returns a link count for each class and its root within the block pair, never the pairs.
5. The connected components of the verified links are the groups of near duplicates.

Words are runs of letters, digits and underscores in lower case. A text of fewer than five words is one shingle.
Nulls: a null text counts as empty. Texts without words have equal (empty) sets and so form one class. A null id
orders last. Repeated rows are copies of each other. Empty tables give an empty result. Other columns of the
input, whatever their names, are not read; `drop_near_copies` returns them untouched.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotebook.llm.bpe import texts_of
from quotebook.llm.components import components
from quotebook.llm.staging import exchanged, keep, planned

NGRAM = 5
THRESHOLD = 0.8
TREES = 24
DEPTH = 10
RECALL = 0.998
#: Bounds of a block of one component.
BLOCK_CLASSES = 1_000
BLOCK_SHINGLES = 1_000_000
#: Candidate classes are broadcast to the scan of the texts if they and the pairs of blocks they meet in are so many at most,
#: else joined by exchange.
BROADCAST_ROWS = 500_000
_KNOWN_WORDS = 500_000
_WORD = re.compile(r"\w+")


def prefix_length(trees: int, depth: int, threshold: float, recall: float) -> int:
    """The longest prefix whose match in some tree finds pairs at the threshold with the target recall."""
    for k in range(depth, 0, -1):
        if 1 - (1 - threshold**k) ** trees >= recall:
            return k
    raise ValueError("more trees are needed for this recall")


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = WordHashes()


def shingles(text: str, n: int = NGRAM) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    found = _WORD.findall(text.lower())
    h = np.fromiter(map(_HASHES.__getitem__, found), np.uint64, len(found))
    if not len(h):
        return h
    with np.errstate(over="ignore"):
        width = min(n, len(h))
        out = np.zeros(len(h) - width + 1, np.uint64)
        for i in range(width):
            out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - width + 1 + i]
        out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(29)
    return np.unique(out)


class Forest:
    """The prefixes, of one length, of a set's labels in all trees."""

    def __init__(self, trees: int, length: int):
        rng = np.random.default_rng(20)
        self._shape = (trees, length)
        self._factors = rng.integers(0, 1 << 31, trees * length, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self._shifts = rng.integers(0, 1 << 32, trees * length, dtype=np.uint32)

    def prefixes(self, hashes: np.ndarray) -> np.ndarray:
        low = np.full(len(self._factors), 0xFFFFFFFF, np.uint32)
        x = (hashes >> np.uint64(32)).astype(np.uint32)
        with np.errstate(over="ignore"):
            for at in range(0, len(x), 1024):
                values = np.multiply.outer(x[at : at + 1024], self._factors)
                values += self._shifts
                np.minimum(low, values.min(axis=0), out=low)
            out = np.zeros(self._shape[0], np.uint64)
            for column in low.reshape(self._shape).T.astype(np.uint64):
                out = (out ^ (out >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + column + np.uint64(1)
        return out.view(np.int64)


def sketches(docs: DataFrame, id_col: str, text_col: str, ngram: int, trees: int, length: int) -> DataFrame:
    """row, id, h (hash of the text), key (digest of the set), size and prefixes of every row."""
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"))
    kind = docs.schema[id_col].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, at = Forest(trees, length), TaskContext.get().partitionId() << 33
        for batch in batches:
            keys, sizes, prefixes = [], [], []
            for text in texts_of(batch.column(1)):
                found = shingles(text, ngram)
                keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                sizes.append(len(found))
                prefixes.append(forest.prefixes(found))
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(at, at + len(batch), dtype=np.int64)), batch.column(0), batch.column(2),
                    pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1, dtype=np.int32) * trees), pa.array(flat)),
                ],
                names=["row", "id", "h", "key", "size", "prefixes"],
            )
            at += len(batch)

    schema = f"row long, id {kind}, h long, key binary, size int, prefixes array<long>"
    return keep(read.mapInArrow(sketch, schema), "near-sketches")


def _verify(table: pa.Table, threshold: float) -> pa.Table:
    """Links within one block pair: for each class the rows it is linked to, and its root among these classes."""
    # Two different blocks compare across only, also where one of them has no class: (slot, slot) counts the rest.
    crossed = any(table[a][0].as_py() != table[b][0].as_py() for a, b in (("low", "high"), ("slot1", "slot2")))
    ids, first = np.unique(table["set"].to_numpy(), return_index=True)
    table = table.take(pa.array(first))
    left = np.array(table["left"].to_pylist(), bool)
    weight = table["weight"].to_numpy()
    data = [np.frombuffer(b.as_buffer(), np.uint64) for b in table["shingles"].combine_chunks()]
    sizes = np.array([len(d) for d in data])
    owner = np.repeat(np.arange(len(data)), sizes)
    _, number, df = np.unique(np.concatenate(data), return_inverse=True, return_counts=True)
    shared = df[number] > 1
    owner, number = owner[shared], number[shared]
    order = np.argsort(number, kind="stable")
    posted = owner[order]
    starts = np.searchsorted(number[order], np.arange(len(df) + 1))
    begin = np.searchsorted(owner, np.arange(len(data) + 1))

    root = np.arange(len(data))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = np.zeros(len(data), np.int64)
    for i in range(len(data)):
        own = number[begin[i] : begin[i + 1]]
        if not len(own):
            continue
        a, n = starts[own], starts[own + 1] - starts[own]
        at = np.repeat(a - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        common = np.bincount(posted[at], minlength=len(data))
        similar = common >= threshold * (sizes + sizes[i] - common) - 1e-9
        similar[i] = False
        if crossed:
            similar &= left != left[i]
        partners = np.flatnonzero(similar)
        links[i] = weight[partners].sum()
        for j in partners[partners > i]:
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    kept = np.flatnonzero(links)
    return pa.table(
        {"set": pa.array(ids[kept]), "links": pa.array(links[kept]), "root": pa.array([ids[find(i)] for i in kept], pa.int64())}
    )


def verified(candidates: DataFrame, docs: DataFrame, id_col: str, text_col: str, ngram: int, threshold: float) -> DataFrame:
    """set, links, root: partial results of all block pairs of the candidates (set, comp, weight, size, id, h)."""
    level = F.floor(F.log(F.col("size")) / F.log(F.lit(1.0001 / threshold))).cast("int")
    candidates = candidates.withColumn("level", level)
    blocks = candidates.groupBy("comp", "level").agg(F.count("*").alias("n"), F.sum("size").alias("total"))
    count = F.greatest(F.ceil(F.col("n") / BLOCK_CLASSES), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    blocks = keep(blocks.select("comp", "level", count.alias("parts")), "near-blocks")
    n = blocks.count()
    for name, step in (("above", 1), ("below", -1)):
        other = blocks.select("comp", (F.col("level") - step).alias("level"), F.col("parts").alias(name))
        candidates = candidates.join(planned(other, n), ["comp", "level"], "left")
    candidates = candidates.join(planned(blocks, n), ["comp", "level"])
    candidates = candidates.withColumn("slot", F.pmod(F.xxhash64("set"), F.col("parts")).cast("int"))

    def pairs(n: str, fn) -> F.Column:
        return F.when(F.coalesce(n, F.lit(0)) > 0, F.transform(F.sequence(F.lit(0), F.col(n) - 1), fn)).otherwise(F.array())

    def pair(low, slot, high, other, left) -> F.Column:
        named = zip(("low", "slot1", "high", "slot2", "left"), (low, slot, high, other, left), strict=True)
        return F.struct(*[(c if isinstance(c, F.Column) else F.col(c)).alias(k) for k, c in named])

    same = pairs("parts", lambda o: pair("level", F.least("slot", o), "level", F.greatest("slot", o), F.col("slot") <= o))
    up = pairs("above", lambda o: pair("level", "slot", F.col("level") + 1, o, F.lit(True)))
    down = pairs("below", lambda o: pair(F.col("level") - 1, o, "level", "slot", F.lit(False)))
    placed = candidates.select("set", "comp", "weight", "id", "h", F.concat(same, up, down).alias("meets"))
    placed = keep(placed, "near-placed")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                sets = [shingles(t, ngram).tobytes() for t in texts_of(part.column(4))]
                yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(sets, pa.binary())], names=["set", "comp", "weight", "meets", "shingles"])

    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("_h"))
    entries = placed.agg(F.sum(F.size("meets") + 1)).first()[0] or 0
    small = F.broadcast(placed) if entries <= BROADCAST_ROWS else exchanged(placed)
    found = texts.join(small, (F.col("_h") == F.col("h")) & F.col("_id").eqNullSafe(F.col("id")))
    meets = placed.schema["meets"].dataType.simpleString()
    cut_ = found.select("set", "comp", "weight", "meets", "text").mapInArrow(
        cut, f"set long, comp long, weight long, meets {meets}, shingles binary")
    spread = cut_.select("set", "comp", "weight", "shingles", F.explode("meets").alias("m")).select("set", "comp", "weight", "shingles", "m.*")
    # A class alone in its pair of blocks has nobody to meet.
    return spread.groupBy("comp", "low", "slot1", "high", "slot2").applyInArrow(
        lambda t: _verify(t, threshold), "set long, links long, root long")


def band_links(nodes: DataFrame) -> DataFrame:
    """(set, root): links that connect all sets with a common (tree, prefix), from (set, tree, prefix).

    Linking a set to the root of each of its bands gives up to TREES links for each member of a large group, and most
    of these roots have the same least one. So a set gets one link, to the least of its roots, and the other links lie
    between roots, which few sets are. Spark takes the exploded nodes for a fraction of their rows, so the join is told
    to exchange them.
    """
    met = nodes.groupBy("tree", "prefix").agg(F.min("set").alias("root"), F.count("*").alias("n")).where("n > 1")
    roots = nodes.join(exchanged(met), ["tree", "prefix"]).groupBy("set").agg(F.min("root").alias("least"), F.collect_set("root").alias("roots"))
    own = roots.select("set", F.col("least").alias("root"))
    between = roots.select(F.explode("roots").alias("set"), F.col("least").alias("root"))
    return own.unionByName(between).where("set <> root").distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ngram: int = NGRAM,
    threshold: float = THRESHOLD,
    trees: int = TREES,
    depth: int = DEPTH,
    recall: float = RECALL,
) -> DataFrame:
    """id, h, class_id, class_size, n_links (rows at or above the threshold) and kept of every row."""
    length = prefix_length(trees, depth, threshold, recall)
    rows = sketches(docs, id_col, text_col, ngram, trees, length)
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("row"))
    sets = rows.groupBy("key").agg(
        F.min("row").alias("set"), F.count("*").alias("weight"), F.any_value("size").alias("size"),
        F.any_value("prefixes").alias("prefixes"), F.min_by(F.struct("id", "h"), "row").alias("at"), F.min(order).alias("first"),
    )
    sets = keep(sets, "near-sets")
    nodes = sets.where("size > 0").select("set", F.posexplode("prefixes").alias("tree", "prefix"))
    links = keep(band_links(nodes), "near-links")
    comps = components(links, "set", "root").select(F.col("node").alias("set"), F.col("root").alias("comp"))
    candidates = sets.select("set", "weight", "size", "at.id", "at.h").join(planned(comps, comps.count()), "set")
    found = keep(verified(candidates, docs, id_col, text_col, ngram, threshold), "near-verified")
    n, n_rows = found.count(), rows.count()
    partners = found.groupBy("set").agg(F.sum("links").alias("partners"))
    groups = components(found.where("set <> root"), "set", "root").withColumnsRenamed({"node": "set"})

    classes = sets.select("key", "set", "weight", "first").join(planned(groups, n), "set", "left")
    classes = classes.join(planned(partners, n), "set", "left")
    classes = classes.withColumn("root", F.coalesce("root", "set"))
    whole = classes.groupBy("root").agg(F.min("first").alias("keep"), F.sum("weight").alias("class_size"))
    classes = classes.join(planned(whole, n_rows), "root").select(
        "key", "class_size", "keep", (F.coalesce("partners", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    return rows.select("key", "row", "id", "h").join(planned(classes, n_rows), "key").select(
        F.col("id").alias(id_col), "h", F.col("keep.id").alias("class_id"), "class_size", "n_links",
        (F.col("row") == F.col("keep.row")).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs`, with all their columns, of which one stays for each group of near duplicates."""
    found = near_duplicates(docs, id_col, text_col, **options)
    kept = keep(found.where("kept").select(F.col(id_col).alias("_id"), F.col("h").alias("_h")), "near-kept")
    h, n = F.xxhash64(text_col), kept.count()
    rows = docs.join(planned(kept, n), F.col(id_col).eqNullSafe(F.col("_id")) & (h == F.col("_h")), "left_semi")
    if rows.count() > n:  # repeated rows: of those alike, one
        rows = rows.withColumn("_h", h).dropDuplicates([id_col, "_h"]).drop("_h")
    return rows
