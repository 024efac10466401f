"""Ids of whole texts in vocabularies that drop white space, through worker caches of space-free pieces.

Such a vocabulary lower-cases, turns white space into one space and encodes what lies between spaces by itself,
so a text's ids are the ids of its pieces between spaces and line ends, one after the other. A piece of letters
up to U+02FF is one pre-token, other such pieces are cut by the pattern; both go through the merge table
(``merges``). Pieces with any other character, or with the start of a special token, reach the tokenizer. A
vocabulary of another kind gets whole texts.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import regex

from quotebook.llm.merges import piece_encoder

# One process encodes one stream; Spark already runs one worker per core.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Fixed value: the pre-token pattern of vocabularies with word ends.
PRE_TOKEN_TEXT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PRE_TOKEN = regex.compile(PRE_TOKEN_TEXT)
# Not white space, equal in NFC, and lower-cased to one character (U+0130 is not).
_SURE = re.compile("(?:[!-~¡-įı-˿]+)?\\Z")

BATCH_CHARS = 1_000_000
MAX_PIECES = 600_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _drops_white_space(spec: dict) -> bool:
    steps = [(s.get("type"), (s.get("pattern") or {}).get("Regex")) for s in (spec.get("normalizer") or {}).get("normalizers", [])]
    pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        steps == [("NFC", None), ("Replace", r"\s+"), ("Lowercase", None)]
        and len(pre) == 2
        and (pre[0].get("pattern") or {}).get("Regex") == PRE_TOKEN_TEXT
        and pre[0].get("behavior") == "Removed"
        and pre[1].get("type") == "ByteLevel"
        and not pre[1].get("use_regex")
        and not pre[1].get("add_prefix_space")
    )


class WordIds:
    """Texts to their ids (little-endian, ``dtype``), each piece encoded once per worker as long as it is in use."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        size = self._tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self._special = [t["content"][:2] for t in spec.get("added_tokens", [])]
        self._merge = piece_encoder(spec) if _drops_white_space(spec) else None
        self._pieces: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The tokenizer's own ids."""
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [self._bytes(e.ids) for e in found]

    def _learn(self, needed: set[str]) -> None:
        missing = needed.difference(self._pieces)
        if len(self._pieces) + len(missing) > MAX_PIECES:
            self._older, self._pieces = self._pieces, {}
            missing = needed
        pieces, older, merge, as_bytes = self._pieces, self._older, self._merge, self._bytes
        unsure: list[str] = []
        for piece in missing:
            if piece in older:
                pieces[piece] = older[piece]
            elif not _SURE.match(piece) or any(s in piece for s in self._special):
                unsure.append(piece)
            elif piece.isalpha():
                pieces[piece] = as_bytes(merge(piece.lower()))
            else:
                pieces[piece] = b"".join([as_bytes(merge(t)) for t in _PRE_TOKEN.findall(piece.lower())])
        pieces.update(zip(unsure, self.encode(unsure), strict=True))

    def _some(self, texts: list[str]) -> list[bytes]:
        if self._merge is None:
            return self.encode(texts)
        parts = [t.replace("\n", " ").split(" ") for t in texts]
        self._learn(set().union(*parts))
        get = self._pieces.__getitem__
        return [b"".join(map(get, p)) for p in parts]

    def values(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text, in order; memory is bounded by BATCH_CHARS and the longest text."""
        batch: list[str] = []
        size = 0
        for text in texts:
            batch.append(text)
            size += len(text)
            if size >= BATCH_CHARS:
                yield from self._some(batch)
                batch, size = [], 0
        yield from self._some(batch)


_WORKER: dict[str, WordIds] = {}


def worker_ids(path: str) -> WordIds:
    """The worker process's cache; a reused worker goes on with what earlier tasks have learnt."""
    if path not in _WORKER:
        _WORKER.clear()
        _WORKER[path] = WordIds(path)
    return _WORKER[path]
