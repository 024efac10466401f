"""Tokenizing whole texts in Python workers with caches that outlive a task.

A text is cut at every single space. In a byte-level vocabulary a space belongs to the word after it, so
" word" tokenizes the same wherever it stands, and a text's ids are the ids of its pieces one after the
other. This does not hold where blanks meet (two spaces, a space between other white space) or where the
text spells a special token; such texts go to the tokenizer whole.

A piece that is not cached is a word, a word and a mark, or is cut into pre-tokens by their pattern; each of them
goes through the merge table by itself (``merges``). Texts that may not be cut, and pieces whose characters may be
classed differently, reach the tokenizer. The cache has two generations: what was used since the last change stays.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex

from quotebook.llm.merges import piece_encoder

# One process encodes one stream; Spark already runs one worker per core.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# The pre-token pattern of byte-level vocabularies.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# Up to this code point the pattern library and the tokenizer class every character alike (tested).
UNSURE = re.compile("[^\x00-՗]")
_BLANKS_MEET = re.compile(r"  |\s \s")

BATCH_CHARS = 1_000_000
MAX_PIECES = 600_000
# Punctuation that most often ends a word.
ENDS = ".,;:!?"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Vocabulary:
    """The tokenizer file and whether texts may be cut at spaces before encoding."""

    def __init__(self, path: str):
        self.path = path
        if path.endswith(".model"):
            import sentencepiece

            self._processor = sentencepiece.SentencePieceProcessor(model_file=path)
            self.by_piece, self.special, self.size = False, [], self._processor.get_piece_size()
            self.merge = None
            return
        from tokenizers import Tokenizer

        self._processor = None
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.by_piece = (
            spec.get("normalizer") is None
            and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space")
        )
        self.merge = (self.by_piece and piece_encoder(spec)) or self._encode_one
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.size = self._tokenizer.get_vocab_size(with_added_tokens=True)

    def _encode_one(self, piece: str) -> list[int]:
        return self._tokenizer.encode(piece, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> list[list[int]]:
        if not texts:
            return []
        if self._processor is not None:
            return self._processor.encode(texts, num_threads=1)
        return [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class PieceCache:
    """Texts to a value that adds up over their pieces: token counts (int) or token ids (bytes)."""

    def __init__(self, path: str, ids: bool, known: dict[str, int] | None = None):
        self.vocabulary = Vocabulary(path)
        self.dtype = np.dtype("<u2") if self.vocabulary.size <= 1 << 16 else np.dtype("<u4")
        self._value = self._as_bytes if ids else len
        self._sum = b"".join if ids else sum
        self._known = known or {}
        self._pieces: dict[str, object] = dict(self._known)
        self._older: dict[str, object] = {}
        self._marks: dict[str, object] = {}

    def _as_bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def _whole(self, text: str) -> bool:
        return (
            not self.vocabulary.by_piece
            or _BLANKS_MEET.search(text) is not None
            or any(s in text for s in self.vocabulary.special)
        )

    def _learn(self, needed: set[str]) -> None:
        """Hold the values of these pieces, each as it stands after a space."""
        missing = needed.difference(self._pieces)
        if len(self._pieces) + len(missing) > MAX_PIECES:
            self._older, self._pieces = self._pieces, dict(self._known)
            missing = needed.difference(self._pieces)
        pieces, older, merge, value = self._pieces, self._older, self.vocabulary.merge, self._value
        unsure: list[str] = []
        for piece in missing:
            if piece in older:
                pieces[piece] = older[piece]
            elif UNSURE.search(piece):
                unsure.append(piece)
            elif piece.isalpha():
                pieces[piece] = value(merge(" " + piece))
            elif piece[:-1].isalpha() and piece[-1] in ENDS:
                pieces[piece] = value(merge(" " + piece[:-1])) + self._mark(piece[-1])
            else:
                pieces[piece] = self._sum([value(merge(t)) for t in PRE_TOKEN.findall(" " + piece)])
        pieces.update(zip(unsure, map(value, self.vocabulary.encode([" " + p for p in unsure])), strict=True))

    def _mark(self, mark: str) -> object:
        if mark not in self._marks:
            self._marks[mark] = self._value(self.vocabulary.merge(mark))
        return self._marks[mark]

    def _some(self, texts: list[str]) -> list:
        whole = [i for i, t in enumerate(texts) if self._whole(t)]
        values: dict[int, object] = dict(
            zip(whole, map(self._value, self.vocabulary.encode([texts[i] for i in whole])), strict=True)
        )
        parts = {i: t.split(" ") for i, t in enumerate(texts) if i not in values}
        heads = [p[0] for p in parts.values()]
        head_values = list(map(self._value, self.vocabulary.encode(heads)))
        needed: set[str] = set()
        for p in parts.values():
            del p[0]
            needed.update(p)
        self._learn(needed)
        for (i, p), head in zip(parts.items(), head_values, strict=True):
            rest = self._sum(map(self._pieces.__getitem__, p))
            values[i] = head + rest
        return [values[i] for i in range(len(texts))]

    def values(self, texts: Iterable[str]) -> Iterator:
        """One value per text, in order; memory is bounded by BATCH_CHARS and the longest text."""
        batch: list[str] = []
        size = 0
        for text in texts:
            batch.append(text)
            size += len(text)
            if size >= BATCH_CHARS:
                yield from self._some(batch)
                batch, size = [], 0
        yield from self._some(batch)


def texts_of(column: pa.Array) -> Iterator[str]:
    """Python strings of a text column, few at a time; a null counts as an empty text."""
    for at in range(0, len(column), 256):
        for text in column.slice(at, 256).to_pylist():
            yield text or ""


_CACHES: dict[tuple, PieceCache] = {}


def worker_cache(path: str, ids: bool, key: object = None, known=None) -> PieceCache:
    """The worker process's cache; a reused worker goes on with what earlier tasks have learnt."""
    at = (path, ids, key)
    if at not in _CACHES:
        _CACHES.clear()
        _CACHES[at] = PieceCache(path, ids, known() if known else None)
    return _CACHES[at]
