"""Best-fit packing of whole documents into sequences with several capacities (vector best-fit).

A sequence has room for so many tokens, documents (pieces) and so much attention cost (the sum of the squared
lengths of its pieces, which is what a block-diagonal mask costs). Pieces are taken from the longest to the
shortest. Each goes to the open sequence that can take it under every capacity and suits it best: the least
weighted norm of what is left over (``rule="norm"``), or the greatest weighted dot product of the piece's demand
and the room (``rule="dot"``). Weights are the mean demands of the block, so a capacity counts as much as it is
used, unless given. A piece that fits nowhere opens a sequence.

Only documents longer than a sequence are cut. Whole sequences of them leave at once; all else is packed in two
rounds. Round one packs the pieces of a scan partition in blocks of at most BLOCK_PIECES, while they are
tokenized, so nothing is shuffled. Round two takes the pieces of the sequences that it left with more than
``slack`` of their tokens free (a few per block, as a rule), deals them evenly over as many partitions as they
fill blocks, and packs them anew. So a small last block of a partition costs nothing. Both rounds are written to
the shared folder: a lost executor repeats a task, whose blocks are its own.

The capacities must admit the longest piece (checked). Nulls: a null text is an empty document (its terminator
alone); null ids are carried along. Repeated rows are packed each. Empty tables give no piece. Other columns of
the input, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotebook.llm import word_ids
from quotebook.llm.bpe import texts_of
from quotebook.llm.staging import keep

BLOCK_PIECES = 16_384
BLOCK_TOKENS = 8_000_000
#: A sequence with more than this share of its tokens free goes to round two.
SLACK = 0.01
_BATCH_TOKENS = 1_000_000
#: Open sequences are looked through for full ones after so many pieces.
_SWEEP = 256


@dataclass(frozen=True)
class Capacity:
    """What one sequence may hold. The defaults for documents and attention follow from the tokens alone, so they
    never bind; set them lower to bound the masks' number or cost."""

    tokens: int = 2048
    documents: int | None = None
    attention: int | None = None

    def vector(self) -> np.ndarray:
        docs = self.tokens if self.documents is None else self.documents
        cost = self.tokens**2 if self.attention is None else self.attention
        return np.array([self.tokens, docs, cost], dtype=np.int64)

    def piece(self) -> int:
        """The longest piece that fits an empty sequence."""
        tokens, docs, cost = (int(x) for x in self.vector())
        if min(tokens, docs, cost) < 1:
            raise ValueError("every capacity must be 1 or more")
        return min(tokens, math.isqrt(cost))


def best_fit(
    lengths: np.ndarray, capacity: np.ndarray, rule: str = "norm", weights: tuple[float, ...] | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece: sequences numbered from 0, offsets in tokens."""
    if rule not in ("norm", "dot"):
        raise ValueError("rule is norm or dot")
    n = len(lengths)
    demand = np.stack([lengths, np.ones(n, np.int64), lengths * lengths], axis=1).astype(np.int64)
    scale = 1.0 / capacity
    share = demand * scale
    w = np.array(weights, dtype=float) if weights is not None else share.mean(axis=0) if n else np.ones(3)
    sequence, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    room = np.zeros((max(n, 1), 3), np.int64)  # of the open sequences
    names = np.zeros(max(n, 1), np.int64)
    opened = made = 0
    smallest = int(lengths.min()) if n else 0
    for done, i in enumerate(np.argsort(-lengths, kind="stable")):
        if done % _SWEEP == 0 and opened:
            usable = np.flatnonzero((room[:opened, 0] >= smallest) & (room[:opened, 1] >= 1))
            room[: len(usable)], names[: len(usable)] = room[usable], names[usable]
            opened = len(usable)
        left = room[:opened] - demand[i]
        fits = np.flatnonzero((left[:, 0] >= 0) & (left[:, 1] >= 0) & (left[:, 2] >= 0))
        if len(fits):
            if rule == "norm":
                at = fits[np.argmin(((left[fits] * scale) ** 2) @ w)]
            else:
                at = fits[np.argmax((room[fits] * scale) @ (w * share[i]))]
        else:
            at = opened
            room[at], names[at] = capacity, made
            opened, made = opened + 1, made + 1
        sequence[i], offset[i] = names[at], capacity[0] - room[at, 0]
        room[at] -= demand[i]
    return sequence, offset


class _Block:
    """Pieces waiting to be packed together."""

    def __init__(self, capacity: Capacity, rule: str, weights: tuple[float, ...] | None, slack: float, first: int):
        self._how = (capacity.vector(), rule, weights)
        self._tokens, self._slack, self._next = capacity.tokens, slack, first
        self.rows: list[tuple] = []  # (id, piece, start, doc_tokens, ids)
        self.lengths: list[int] = []
        self.tokens = 0

    def add(self, row: tuple, length: int) -> None:
        self.rows.append(row)
        self.lengths.append(length)
        self.tokens += length

    def full(self) -> bool:
        return len(self.rows) >= BLOCK_PIECES or self.tokens >= BLOCK_TOKENS

    def packed(self, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        lengths = np.array(self.lengths, dtype=np.int64)
        sequence, offset = best_fit(lengths, *self._how)
        filled = np.bincount(sequence, weights=lengths) if len(lengths) else np.zeros(0)
        loose = (filled < (1 - self._slack) * self._tokens)[sequence]
        yield from _batches(self.rows, lengths, sequence + self._next, offset, loose, id_type)
        self._next += len(filled)
        self.rows, self.lengths, self.tokens = [], [], 0

    def alone(self, rows: list[tuple], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        """Pieces that fill a sequence each."""
        lengths = np.full(len(rows), self._tokens, np.int64)
        zero = np.zeros(len(rows), np.int64)
        yield from _batches(rows, lengths, self._next + np.arange(len(rows)), zero, zero.astype(bool), id_type)
        self._next += len(rows)


def _batches(rows, lengths, sequence, offset, loose, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    cuts = np.searchsorted(np.cumsum(lengths), np.arange(_BATCH_TOKENS, lengths.sum() + _BATCH_TOKENS, _BATCH_TOKENS))
    first = 0
    for last in np.minimum(cuts + 1, len(rows)):
        if last > first:
            part = rows[first:last]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in part], id_type), pa.array([r[1] for r in part], pa.int32()),
                    pa.array([r[2] for r in part], pa.int64()), pa.array(lengths[first:last]),
                    pa.array([r[3] for r in part], pa.int64()), pa.array(sequence[first:last]),
                    pa.array(offset[first:last]), pa.array([r[4] for r in part], pa.binary()), pa.array(loose[first:last]),
                ],
                names=["id", "piece", "start", "length", "doc_tokens", "sequence_id", "offset", "ids", "loose"],
            )
            first = last


def vector_pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    capacity: Capacity = Capacity(),
    terminator: int = 0,
    rule: str = "norm",
    weights: tuple[float, ...] | None = None,
    slack: float = SLACK,
) -> DataFrame:
    """One row per piece: id, piece, start, length, doc_tokens, sequence_id, offset, ids (binary, uint32 each)."""
    path = tokenizer or word_ids.default_tokenizer()
    longest = capacity.piece()
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()),
            *[T.StructField(c, T.LongType()) for c in ("start", "length", "doc_tokens", "sequence_id", "offset")],
            T.StructField("ids", T.BinaryType()), T.StructField("loose", T.BooleanType()),
        ]
    )

    def block(round_bit: int) -> _Block:
        # Sequences are numbered by round and partition; a block never leaves its partition.
        return _Block(capacity, rule, weights, slack, round_bit << 62 | TaskContext.get().partitionId() << 32)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, waiting = word_ids.worker_ids(path), block(0)
        end, id_type = np.array([terminator], dtype="<u4"), None
        for batch in batches:
            ids, texts = batch.columns
            id_type = ids.type
            for i, blob in enumerate(cache.values(texts_of(texts))):
                stream = np.concatenate([np.frombuffer(blob, dtype=cache.dtype).astype("<u4"), end])
                n, key, whole = len(stream), ids[i].as_py(), []
                for piece, start in enumerate(range(0, n, longest)):
                    cut = stream[start : start + longest]
                    row = (key, piece, start, n, cut.tobytes())
                    if len(cut) == capacity.tokens:
                        whole.append(row)
                    else:
                        waiting.add(row, len(cut))
                        if waiting.full():
                            yield from waiting.packed(id_type)
                    if len(whole) * longest >= _BATCH_TOKENS:
                        yield from waiting.alone(whole, id_type)
                        whole = []
                yield from waiting.alone(whole, id_type)
        if waiting.rows:
            yield from waiting.packed(id_type)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, id_type = block(1), None
        for batch in batches:
            id_type = batch.column("id").type
            for row in zip(*(batch.column(c).to_pylist() for c in ("id", "piece", "start", "doc_tokens", "ids"))):
                waiting.add(row, len(row[4]) // 4)
                if waiting.full():
                    yield from waiting.packed(id_type)
        if waiting.rows:
            yield from waiting.packed(id_type)

    first = keep(docs.select(id_col, text_col).mapInArrow(encode, schema), "fit-first")
    loose = first.filter("loose")
    size = loose.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    parts = max(1, -(-size[0] // BLOCK_PIECES), -(-size[1] // BLOCK_TOKENS))
    # A fixed order in each partition: a repeated task packs its pieces as before.
    dealt = loose.repartition(parts).sortWithinPartitions(F.desc("length"), "id", "piece", F.crc32("ids"))
    second = keep(dealt.mapInArrow(again, schema), "fit-second")
    placed = first.filter("NOT loose").unionByName(second)
    return placed.select(F.col("id").alias(id_col), *[c for c in placed.columns if c not in ("id", "loose")])
