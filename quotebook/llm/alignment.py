"""Alignment of two tokenizers over the same texts, and how often their tokens stand together in the corpus.

Both tokenizers cut the same bytes (a space and the text). Offsets where tokens of both end cut them into groups;
every token of one side is linked with every token of the other side in its group. A pair of ids counts the documents
that hold it linked; each document then sums these counts over its links and finds how many links are the best of
their first id.

Scan partitions are read in chunks of about CHUNK_BYTES of text. In a chunk the ids are Arrow lists: flattened, with
parent indices; byte ends are cumulative sums, restarted per document; an Acero hash join on (document, end) finds
the common ends; Table.group_by adds up the links of a document and the documents of a pair. These partial counts
(one row per chunk and pair) are merged by Spark. A chunk gets the counts of its own pairs back, once each, and
meets them in a cogroup; the tables of a chunk are bounded by its text, and no count table is held whole anywhere.

A group with many tokens (unlike long runs of one character, natural text hardly has any) first counts its distinct
ids on either side, so its links are not listed one by one.

Texts that are null, empty, or that either side does not give back byte for byte have no tokens: zeros and an empty
``groups``. Null ids are carried along; repeated rows count as documents of their own; empty tables give no row.
Other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotebook.llm.bpe import UNSURE, PRE_TOKEN, texts_of
from quotebook.llm.merges import byte_alphabet, vocabulary_ranks
from quotebook.llm.staging import keep

CHUNK_BYTES = 2_000_000
#: Groups with more links than this are counted by distinct ids first.
LINKS_LISTED = 64
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers as p

    return p.path("byte_bpe_50k.json"), p.path("piece_bpe_32k.model")


class ByteSide:
    """Ids and token bytes of a byte-level vocabulary; strings of special tokens are plain text."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        self.bytes = [b""] * self._tokenizer.get_vocab_size(with_added_tokens=True)
        for token, i in spec["model"]["vocab"].items():
            self.bytes[i] = bytes(alphabet[c] for c in token)
        for added in spec.get("added_tokens", []):
            self.bytes[added["id"]] = added["content"].encode()
        ranks = vocabulary_ranks(spec)
        # The same ids, sooner, for texts whose characters both libraries class alike.
        self._fast = ranks and tiktoken.Encoding("a", pat_str=PRE_TOKEN.pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        found: list[np.ndarray] = []
        for text in texts:
            if self._fast and not UNSURE.search(text):
                found.append(np.array(self._fast.encode_ordinary(" " + text), dtype=np.int32))
            else:
                found.append(np.array(self._tokenizer.encode(" " + text, add_special_tokens=False).ids, dtype=np.int32))
        return found


class PieceSide:
    """Ids and token bytes of a sentencepiece model that writes the leading space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self._processor = p = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [
            bytes([int(p.id_to_piece(i)[3:-1], 16)]) if p.is_byte(i) else p.id_to_piece(i).replace("▁", " ").encode()
            for i in range(p.get_piece_size())
        ]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, dtype=np.int32) for ids in self._processor.encode(texts, num_threads=1)]


_SIDES: dict[str, ByteSide | PieceSide] = {}


def _side(path: str) -> ByteSide | PieceSide:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _SIDES:
        _SIDES[path] = PieceSide(path) if path.endswith(".model") else ByteSide(path)
    return _SIDES[path]


# --- one chunk -------------------------------------------------------------------------------------


def _encoded(texts: list[str], a: ByteSide | PieceSide, b: ByteSide | PieceSide) -> tuple[pa.ListArray, pa.ListArray]:
    """The ids of both sides, empty lists where a side does not give the text back."""
    lists: tuple[list, list] = ([], [])
    for first in range(0, len(texts), 64):
        part = texts[first : first + 64]
        for text, mine, theirs in zip(part, a.encode(part), b.encode(part)):
            raw = b" " + text.encode()
            same = text != "" and all(
                b"".join(map(side.bytes.__getitem__, ids.tolist())) == raw for side, ids in ((a, mine), (b, theirs))
            )
            for held, ids in zip(lists, (mine, theirs)):
                held.append(ids if same else ids[:0])

    def listed(held: list[np.ndarray]) -> pa.ListArray:
        offsets = np.zeros(len(held) + 1, np.int32)
        np.cumsum([len(x) for x in held], out=offsets[1:])
        flat = np.concatenate(held) if held else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))

    return listed(lists[0]), listed(lists[1])


def _ends(ids: pa.ListArray, sizes: pa.Array) -> pa.Table:
    """key (document and byte end) and place of every token."""
    doc = pc.list_parent_indices(ids).cast(pa.int64())
    total = pc.cumulative_sum(pc.take(sizes, ids.flatten()))
    starts = np.asarray(ids.offsets)[:-1]
    # What the documents before have summed up to; a list without tokens asks for nothing.
    before = np.concatenate([[0], total.to_numpy(zero_copy_only=False)])[starts]
    end = pc.subtract(total, pc.take(pa.array(before, pa.int64()), doc))
    key = pc.add(pc.shift_left(doc, 40), end)
    return pa.table({"key": key, "at": pa.array(np.arange(len(doc), dtype=np.int64))})


def _side_by_group(ids: np.ndarray, group: np.ndarray, large: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, id, times), by group: tokens one by one, in large groups each distinct id once."""
    many = large[group]
    one = np.ones(int((~many).sum()), np.int64)
    if not many.any():
        return group, ids, one
    counted = (
        pa.table({"g": group[many], "i": ids[many]}).group_by(["g", "i"], use_threads=False).aggregate([([], "count_all")])
    )
    g = np.concatenate([group[~many], counted["g"].to_numpy()])
    i = np.concatenate([ids[~many], counted["i"].to_numpy()])
    n = np.concatenate([one, counted["count_all"].to_numpy()])
    order = np.argsort(g, kind="stable")
    return g[order], i[order], n[order]


def _links(a: tuple, b: tuple, n_groups: int, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, pair, times) of all links, pair = id of a * base + id of b."""
    (ga, ia, na), (gb, ib, nb) = a, b
    in_b = np.bincount(gb, minlength=n_groups)
    first_b = np.cumsum(in_b) - in_b
    repeat = in_b[ga]
    left = np.repeat(np.arange(len(ga)), repeat)
    within = np.arange(len(left)) - np.repeat(np.cumsum(repeat) - repeat, repeat)
    right = first_b[ga[left]] + within
    return ga[left], ia[left].astype(np.int64) * base + ib[right], na[left] * nb[right]


def _decimal(ids: pa.Array, until: np.ndarray) -> pa.Array:
    """The ids of each group, comma-joined; groups end after these tokens."""
    offsets = np.zeros(len(until) + 1, np.int32)
    offsets[1:] = until + 1
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), ids.cast(pa.string())), ",")


def align_chunk(texts: list[str], a: ByteSide | PieceSide, b: ByteSide | PieceSide, with_groups: bool) -> dict[str, pa.Array]:
    """Columns of a chunk's documents; ``pairs`` and ``docs`` (its partial counts) stand on the first one."""
    base, n = len(b.bytes), len(texts)
    ids_a, ids_b = _encoded(texts, a, b)
    sizes = [pa.array([len(t) for t in side.bytes], pa.int64()) for side in (a, b)]
    ends_a, ends_b = _ends(ids_a, sizes[0]), _ends(ids_b, sizes[1])
    common = ends_a.join(ends_b, "key", join_type="inner", right_suffix="_b", use_threads=False).sort_by("at")
    last_a, last_b = common["at"].to_numpy(), common["at_b"].to_numpy()
    doc_of_group = common["key"].to_numpy() >> 40
    flat_a, flat_b = ids_a.flatten().to_numpy(), ids_b.flatten().to_numpy()
    # A token lies in the group of the first common end at or after it.
    group_a = np.searchsorted(last_a, np.arange(len(flat_a)))
    group_b = np.searchsorted(last_b, np.arange(len(flat_b)))
    size_a, size_b = np.bincount(group_a, minlength=len(common)), np.bincount(group_b, minlength=len(common))
    large = size_a * size_b > LINKS_LISTED
    n_links = np.zeros(n, np.int64)
    np.add.at(n_links, doc_of_group, size_a * size_b)

    group, pair, times = _links(
        _side_by_group(flat_a, group_a, large), _side_by_group(flat_b, group_b, large), len(common), base
    )
    per_doc = (
        pa.table({"doc": doc_of_group[group], "pair": pair, "times": times})
        .group_by(["doc", "pair"], use_threads=False).aggregate([("times", "sum")])
    )
    partial = per_doc.group_by("pair", use_threads=False).aggregate([([], "count_all")]).sort_by([("count_all", "descending"), ("pair", "ascending")])
    place = pc.index_in(per_doc["pair"].combine_chunks(), partial["pair"].combine_chunks())
    links = pa.table({"doc": per_doc["doc"], "place": place, "times": per_doc["times_sum"]}).sort_by([("doc", "ascending"), ("place", "ascending")])
    offsets = np.zeros(n + 1, np.int32)
    np.cumsum(np.bincount(links["doc"].to_numpy(), minlength=n), out=offsets[1:])

    def listed(name: str, kind: pa.DataType) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(offsets), links[name].combine_chunks().cast(kind))

    def on_first(values: pa.Array) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array([0] + [len(values)] * n, pa.int32()), values)

    cut = np.searchsorted(doc_of_group, np.arange(n + 1)).astype(np.int32)
    written = pc.binary_join_element_wise(_decimal(ids_a.flatten(), last_a), _decimal(ids_b.flatten(), last_b), "|")
    groups = pc.binary_join(pa.ListArray.from_arrays(pa.array(cut), written), ";")
    hashes = [hashlib.sha256(text).hexdigest() if text else "" for text in groups.cast(pa.binary()).to_pylist()]
    return {
        "n_a": pc.list_value_length(ids_a).cast(pa.int64()), "n_b": pc.list_value_length(ids_b).cast(pa.int64()),
        "n_groups": pa.array(np.diff(cut).astype(np.int64)), "n_links": pa.array(n_links),
        "groups_sha256": pa.array(hashes), "groups": groups if with_groups else pa.nulls(n, pa.string()),
        "places": listed("place", pa.int32()), "times": listed("times", pa.int64()),
        "pairs": on_first(partial["pair"].combine_chunks()), "docs": on_first(partial["count_all"].combine_chunks()),
    }


# --- the corpus ------------------------------------------------------------------------------------


def align(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizers: tuple[str, str] | None = None,
    with_groups: bool = True,
) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and groups.

    ``groups`` (`a1,a2|b1;a3|b2,b3`) is null with ``with_groups=False``; its hash is there either way.
    """
    path_a, path_b = tokenizers or default_tokenizers()
    base = len(_side(path_b).bytes)
    long = T.LongType()
    schema = T.StructType(
        [
            T.StructField("chunk", long), T.StructField("id", docs.schema[id_col].dataType),
            *[T.StructField(c, long) for c in _COUNTS],
            T.StructField("groups_sha256", T.StringType()), T.StructField("groups", T.StringType()),
            T.StructField("places", T.ArrayType(T.IntegerType())), T.StructField("times", T.ArrayType(long)),
            T.StructField("pairs", T.ArrayType(long)), T.StructField("docs", T.ArrayType(long)),
        ]
    )

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _side(path_a), _side(path_b)
        number = TaskContext.get().partitionId() << 32
        ids: list = []
        texts: list[str] = []
        size = 0

        def done(id_type: pa.DataType) -> pa.RecordBatch:
            columns = align_chunk(texts, a, b, with_groups)
            head = {"chunk": pa.array(np.full(len(ids), number, np.int64)), "id": pa.array(ids, id_type)}
            return pa.RecordBatch.from_pydict(head | columns)

        for batch in batches:
            keys, column = batch.columns
            for i, text in enumerate(texts_of(column)):
                ids.append(keys[i].as_py())
                texts.append(text)
                size += len(text)
                if size >= CHUNK_BYTES:
                    yield done(keys.type)
                    ids, texts, size, number = [], [], 0, number + 1
        if texts:
            yield done(keys.type)

    read = keep(docs.select(id_col, text_col).mapInArrow(chunks, schema), "alignment")
    asks = read.filter(F.size("pairs") > 0).select(
        F.col("chunk"), F.posexplode(F.arrays_zip("pairs", "docs")).alias("place", "x")
    ).select("chunk", "place", F.col("x.pairs").alias("pair"), F.col("x.docs").alias("n_docs"))
    counts = keep(asks.groupBy("pair").agg(F.sum("n_docs").alias("n_docs")), "alignment-counts")
    # One row per id of the first vocabulary, whatever the corpus.
    first_id = F.expr(f"pair div {base}")
    best = counts.groupBy(first_id.alias("a")).agg(F.max("n_docs").alias("most"))
    told = asks.select("chunk", "place", "pair").join(counts, "pair").select("chunk", "place", "n_docs", first_id.alias("a"))
    answers = told.join(F.broadcast(best), "a").select(
        F.col("chunk").alias("of"), "place", "n_docs", (F.col("n_docs") == F.col("most")).alias("is_best")
    )
    shown = ["id", *_COUNTS, "groups_sha256", "groups"]

    def meet(held: pa.Table, told: pa.Table) -> pa.Table:
        n_docs, is_best = np.zeros(len(told) + 1, np.int64), np.zeros(len(told) + 1, np.int64)
        where = told["place"].to_numpy()
        n_docs[where], is_best[where] = told["n_docs"].to_numpy(), told["is_best"].cast(pa.int64()).to_numpy()
        places = held["places"].combine_chunks()
        flat, times = places.flatten().to_numpy(), held["times"].combine_chunks().flatten().to_numpy()
        until = np.concatenate([[0], np.cumsum(pc.list_value_length(places).to_numpy())])

        def summed(values: np.ndarray) -> pa.Array:
            total = np.concatenate([[0], np.cumsum(values[flat] * times)])
            return pa.array(np.diff(total[until]))

        return held.select(shown).append_column("n_best", summed(is_best)).append_column("count_sum", summed(n_docs))

    out = T.StructType([schema[c] for c in shown] + [T.StructField("n_best", long), T.StructField("count_sum", long)])
    held = read.select("chunk", *shown, "places", "times")
    met = held.groupBy("chunk").cogroup(answers.groupBy("of")).applyInArrow(meet, out)
    return met.select(
        F.col("id").alias(id_col), *_COUNTS, "n_best", "count_sum", "groups_sha256", "groups"
    )
