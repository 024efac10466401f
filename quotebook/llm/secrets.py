"""Secret scans: fixed patterns, and a battery of randomness tests for strings that no pattern knows.

Every run of 20 or more characters of an encoding's alphabet is a candidate. Its encoding is inferred from the
characters it uses (hex, base32, base36 in either case, base62, base64). Three tests ask whether it could be uniform
random symbols of that alphabet: chi-squared over the alphabet, the runs above and below the alphabet's middle, and
the serial correlation of neighbours. A candidate with joiners (+ / _ -) is cut there too, and parts of 20 or more
letters and digits are tested in its place if it fits no alphabet or they tell more than the whole; p-values are doubled
for that choice.

What passes is weighed against ordinary text: a chain of digits, letters of either case and joiners that stays in its
class with a probability fixed by encoding, with the letter shares of text within a class. The ratio of a string's
probability under text to that under random symbols bounds the chance that text looks so random, whatever the length
(Markov's inequality), so it is used as p-value: short strings of small alphabets carry little evidence, long ones much.
These go through the Benjamini-Hochberg procedure within classes of encoding and length, over all candidates of all
documents; those that the battery rejected count with a p-value of 1.

Strings of digits only, or of letters of one case only, are no candidates. Nulls: a null text counts as empty; null
ids are carried along. Repeated rows each give a row (and count each in the procedure). Empty tables give an empty
result. Other columns of the input are not read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotebook.llm.bpe import texts_of
from quotebook.llm.staging import keep

# The patterns of known secrets, with the least length of what must be secret in them.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ASSIGN_LEAST = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 16
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
_PART = re.compile(r"[A-Za-z0-9]{20,}")
#: Rate of false discoveries among the reported strings, and level of each randomness test.
FALSE_DISCOVERIES = 0.01
TEST_LEVEL = 0.001
#: Classes of length begin at 20 and at these.
LENGTHS = (24, 32, 48, 64)
_BINS_PER_DECADE = 4
_DECADES = 40
#: Bins taken off (the p-value at least doubled) where the better of a string and its parts was chosen.
_CHOICE = math.ceil(_BINS_PER_DECADE * math.log10(2))

_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
_ALPHABETS = {
    "hex": _DIGITS + "abcdef",
    "upper hex": _DIGITS + "ABCDEF",
    "base32": "234567" + _UPPER,
    "base36": _DIGITS + _LOWER,
    "upper base36": _DIGITS + _UPPER,
    "base62": _DIGITS + _UPPER + _LOWER,
    "base64": "+/" + _DIGITS + _UPPER + _LOWER,
    "base64url": "-" + _DIGITS + _UPPER + "_" + _LOWER,
}
ENCODINGS = tuple(_ALPHABETS)
# How often text stays in its class of characters (hex digits in text are mostly whole numbers), shares
# of the letters a to z in percent, and the part of letters that follow no such shares.
_STAYS = {"hex": 0.9, "upper hex": 0.9}
_STAYS_ELSE = 0.8
_LETTERS = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4, 6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.074)
_ANY_LETTER = 0.1
_INDEX = {name: {c: i for i, c in enumerate(symbols)} for name, symbols in _ALPHABETS.items()}


def _class_of(symbol: str) -> int:
    return 0 if symbol in _DIGITS else 1 if symbol in _LOWER else 2 if symbol in _UPPER else 3


def _text_model(encoding: str) -> tuple[dict[str, tuple[int, float]], float, float, float]:
    """Class and log10 share within it of every symbol; log10 of starting in a class, staying in it, going to another."""
    symbols = _ALPHABETS[encoding]
    members: dict[int, list[str]] = {}
    for c in symbols:
        members.setdefault(_class_of(c), []).append(c)
    shares = {}
    for group, among in members.items():
        weight = [_LETTERS[ord(c.lower()) - 97] if group in (1, 2) else 1.0 for c in among]
        for c, w in zip(among, weight, strict=True):
            shares[c] = group, math.log10((1 - _ANY_LETTER) * w / sum(weight) + _ANY_LETTER / len(among))
    stay = _STAYS.get(encoding, _STAYS_ELSE)
    return shares, -math.log10(len(members)), math.log10(stay), math.log10((1 - stay) / (len(members) - 1))


_TEXT = {name: _text_model(name) for name in _ALPHABETS}


def infer_encoding(text: str) -> str | None:
    """The smallest alphabet that holds the string; None where it has digits only, or letters of one case only."""
    body = text.rstrip("=")
    symbols = set(body)
    if len({_class_of(c) for c in symbols} - {3}) < 2:
        return None
    for name, index in _INDEX.items():
        if symbols <= index.keys():
            return name
    return None


def _normal_tail(z: float) -> float:
    """Two-sided p-value of a standard normal."""
    return math.erfc(abs(z) / math.sqrt(2))


def battery(text: str, encoding: str) -> float:
    """Least p-value of the three randomness tests."""
    index = _INDEX[encoding]
    values = [index[c] for c in text.rstrip("=")]
    n, size = len(values), len(index)
    counts = [0] * size
    for v in values:
        counts[v] += 1
    chi = size / n * sum(c * c for c in counts) - n
    df = size - 1
    # Wilson-Hilferty, both tails: too uneven for random symbols, or too even.
    uniform = _normal_tail(((chi / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))

    high = [2 * v >= size for v in values]
    up = sum(high)
    down = n - up
    runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
    if up and down:
        mean = 1 + 2 * up * down / n
        var = (mean - 1) * (mean - 2) / (n - 1)
        by_runs = _normal_tail((runs - mean) / math.sqrt(var)) if var > 0 else 0.0
    else:
        by_runs = 0.0

    average = sum(values) / n
    spread = sum((v - average) ** 2 for v in values)
    lag = sum((a - average) * (b - average) for a, b in zip(values, values[1:]))
    serial = _normal_tail((lag / spread + 1 / n) * math.sqrt(n)) if spread else 0.0

    return min(uniform, by_runs, serial)


def evidence(text: str, encoding: str) -> float:
    """Minus log10 of the p-value under ordinary text: its probability there against that of random symbols."""
    shares, start, stay, leave = _TEXT[encoding]
    log_text, before, n = start, None, 0
    for c in text.rstrip("="):
        group, share = shares[c]
        log_text += share + (0.0 if before is None else stay if group == before else leave)
        before, n = group, n + 1
    return min(max(-n * math.log10(len(shares)) - log_text, 0.0), _DECADES)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _tested(string: str, start: int) -> tuple[int, int, int, int, int] | None:
    """(start, end, encoding, class of length, bin of the p-value) of a candidate; bin -1 if the battery rejects it."""
    encoding = infer_encoding(string)
    if encoding is None:
        return None
    bin_ = -1
    if battery(string, encoding) >= TEST_LEVEL:
        bin_ = int(evidence(string, encoding) * _BINS_PER_DECADE)
    return start, start + len(string), ENCODINGS.index(encoding), bisect_right(LENGTHS, len(string.rstrip("="))), bin_


def candidates(text: str, known: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """(start, end, encoding, class of length, bin of the p-value) of all candidates outside known spans. Bin 0 (a
    p-value of 1) has what the battery rejects."""
    out = []
    for m in CANDIDATE.finditer(text):
        free = not any(a < m.end() and m.start() < b for a, _, b in known)
        whole = _tested(m[0], m.start()) if free else None
        at = [(m.start() + p.start(), p[0]) for p in _PART.finditer(m[0]) if len(p[0]) < len(m[0].rstrip("="))]
        tested = [_tested(s, i) for i, s in at if not any(a < i + len(s) and i < b for a, _, b in known)]
        parts = [t for t in tested if t]
        if whole and parts:
            best = [whole] if whole[4] >= max(t[4] for t in parts) else parts
            found = [(*t[:4], t[4] - _CHOICE) for t in best]
        else:
            found = [whole] if whole else parts
        out += [(*t[:4], max(t[4], 0)) for t in found]
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    maybe = pa.list_(pa.struct([(c, pa.int32()) for c in ("start", "end", "enc", "long", "bin")]))
    for batch in batches:
        spans, more = [], []
        for text in texts_of(batch.column(1)):
            known = base_spans(text)
            spans.append([{"start": a, "kind": k, "end": b} for a, k, b in known])
            more.append([dict(zip(("start", "end", "enc", "long", "bin"), c, strict=True)) for c in candidates(text, known)])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(spans, base), pa.array(more, maybe)], names=["id", "base", "maybe"]
        )


def thresholds(found: DataFrame, level: float) -> DataFrame:
    """Benjamini-Hochberg over all candidates, for each class of encoding and length: the least bin that is discovered.

    A bin holds p-values of at most 10^(-bin / 4); with k candidates in it or in higher bins, of m in the class,
    it is discovered if that bound is at most level * k / m. There are at most 8 * 5 * 161 bins, whatever the corpus.
    """
    bins = found.select(F.explode("maybe").alias("c")).groupBy("c.enc", "c.long", "c.bin").agg(F.count("*").alias("n"))
    above = F.sum("n").over(Window.partitionBy("enc", "long").orderBy(F.desc("bin")))
    whole = F.sum("n").over(Window.partitionBy("enc", "long"))
    bound = F.pow(F.lit(10.0), -F.col("bin") / _BINS_PER_DECADE)
    passed = bins.select("enc", "long", "bin", (bound <= level * above / whole).alias("passed")).where("passed")
    return passed.groupBy("enc", "long").agg(F.min("bin").alias("least"))


def _discovered(candidate: Column, least: dict[tuple[int, int], int]) -> Column:
    out = F.lit(False)
    for (encoding, length), bin_ in least.items():
        out |= (candidate.enc == encoding) & (candidate.long == length) & (candidate.bin >= bin_)
    return out


def written(spans: str | Column) -> Column:
    """kind:start:end, comma-joined."""
    kind = F.lit(list(KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kind, s.kind + 1), s.start, s.end)))


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", false_discoveries: float = FALSE_DISCOVERIES
) -> DataFrame:
    """id, base and spans (arrays of start, kind, end in order; kind as in KINDS) of every row."""
    span = "struct<start:int,kind:int,end:int>"
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, base array<{span}>, maybe array<struct<start:int,end:int,enc:int,long:int,bin:int>>"
    found = keep(docs.select(F.col(id_col).alias("id"), text_col).mapInArrow(_scan, schema), "secrets")
    # At most one number for each of the forty classes of encoding and length.
    least = {(r.enc, r.long): r.least for r in thresholds(found, false_discoveries).collect()}
    chosen = F.filter("maybe", lambda c: _discovered(c, least))
    added = F.transform(chosen, lambda c: F.struct(c.start.alias("start"), F.lit(3).alias("kind"), c.end.alias("end")))
    return found.select(F.col("id").alias(id_col), "base", F.array_sort(F.concat("base", added)).alias("spans"))
