"""Company-name features: match keys, token sets, variants and acronyms, as built-in expressions.

Every function takes SQL expression text (usually a column name) and returns SQL expression
text. Parsing one text is much cheaper for the driver than building the same deep expression
call by call, and the executors see the same built-in functions either way.
``F.expr(name_tokens("company"))`` makes a column of it.
"""

from __future__ import annotations

from itertools import count

from quotebook.functions.text import WORD, WS_CHARS
from quotebook.functions.vocabulary import (
    DESCRIPTOR_TOKENS,
    KEY_NOISE,
    MIN_IDENTITY_LENGTH,
    STOP_TOKENS,
    TRAILING_WORDS,
)

_PARENTHESISED = r"\(([^)]+)\)"
_WS_LITERAL = "".join(f"\\u{ord(c):04x}" for c in WS_CHARS)
_SPLIT_WORDS = ("formerly", "previously", "known as")
_EDGE_PUNCTUATION = r" \t-–—,()"
NO_TOKENS = "cast(array() AS array<string>)"

_fresh = count()


def let(value: str, body) -> str:
    """``body(name)`` with the value computed once, however often the body uses it."""
    name = f"v{next(_fresh)}"
    return f"get(transform(array({value}), {name} -> {body(name)}), 0)"


def any_of(words: tuple, e: str) -> str:
    listed = ", ".join(f"'{w}'" for w in dict.fromkeys(words))
    return f"({e} IN ({listed}))"


def _whole_word(pattern: str) -> str:
    # Look-arounds instead of \b: its meaning for non-ASCII letters differs between JDK releases.
    return f"(?i)(?<![{WORD}])(?:{pattern})(?![{WORD}])"


def _expand_abbreviations(e: str) -> str:
    # Most names have neither letter sequence, so the expressions run behind a plain search.
    def spelled(x: str, short: str, long: str) -> str:
        return f"if(contains(lower({x}), '{short}'), regexp_replace({x}, r'{_whole_word(short)}', '{long}'), {x})"

    both = let(spelled(e, "ent", "enterprise"), lambda x: spelled(x, "lab", "laboratories"))
    return f"if({_contains_any(e, 'ent', 'lab')}, {both}, {e})"


def _contains_any(e: str, *parts: str) -> str:
    """Condition: the lower-cased text has one of these (lower-case) parts."""
    return f"({' OR '.join(f'contains(lower({e}), {chr(39)}{p}{chr(39)})' for p in parts)})"


def _runs(e: str) -> str:
    return f"regexp_extract_all({e}, '[a-z0-9]+', 0)"


def _inner(e: str) -> str:
    return f"regexp_extract_all({e}, r'{_PARENTHESISED}', 1)"


def canonical_match_name(e: str) -> str:
    expanded = _expand_abbreviations(f"coalesce({e}, '')")
    return f"btrim({expanded}, '{_WS_LITERAL}')"


def normalize_for_match(e: str) -> str:
    # White space at the ends goes with the other characters.
    expanded = _expand_abbreviations(f"coalesce({e}, '')")
    key = f"regexp_replace(lower({expanded}), '[^a-z0-9]+', '')"
    for noise in KEY_NOISE:
        key = f"replace({key}, '{noise}', '')"
    return key


def stem(t: str) -> str:
    return f"if(endswith({t}, 's') AND length({t}) > 4 AND NOT endswith({t}, 'ss'), left({t}, length({t}) - 1), {t})"


def name_tokens(e: str) -> str:
    """Distinct stemmed tokens of a name; joined-up forms of hyphenated words are added."""
    # Everything outside the two lambdas is compiled; white space at the ends is in no run.
    expanded = _expand_abbreviations(f"coalesce({e}, '')")
    low = f"lower({expanded})"
    squeezed = f"""translate({low}, "-'/", '')"""
    hyphens = f"""(contains({expanded}, '-') OR contains({expanded}, "'") OR contains({expanded}, '/'))"""
    words = f"if({hyphens}, concat({_runs(low)}, {_runs(squeezed)}), {_runs(low)})"
    kept = f"filter({words}, w -> length(w) > 1 AND NOT {any_of(STOP_TOKENS, 'w')})"
    return f"array_distinct(transform({kept}, w -> {stem('w')}))"


def identity_tokens(tokens: str) -> str:
    """The tokens that can tell a company apart."""
    return (
        f"filter({tokens}, t -> length(t) >= {MIN_IDENTITY_LENGTH} AND NOT {any_of(DESCRIPTOR_TOKENS, 't')})"
    )


def name_variants(e: str) -> str:
    """The name, its parenthesised parts and the pieces around "formerly" and the like."""
    e = f"coalesce({e}, '')"
    split = f"split({e}, r'{_whole_word('|'.join(_SPLIT_WORDS))}', -1)"
    trimmed = f"transform(concat(array({e}), {_inner(e)}, {split}), p -> btrim(p, '{_EDGE_PUNCTUATION}'))"
    kept = f"filter(array_distinct({trimmed}), p -> length(p) >= 3)"
    spelled = f"flatten(transform({kept}, p -> array(p, {_expand_abbreviations('p')})))"

    # first spelling of each case-insensitive form
    def distinct(v: str) -> str:
        return let(
            f"transform({v}, p -> lower(p))",
            lambda folded: f"filter({v}, (p, i) -> array_position({folded}, get({folded}, i)) = i + 1)",
        )

    # A name without parentheses, split words and abbreviations is its only variant. Most are like this.
    plain = f"NOT contains({e}, '(') AND NOT {_contains_any(e, *_SPLIT_WORDS, 'ent', 'lab')}"
    alone = f"btrim({e}, '{_EDGE_PUNCTUATION}')"
    return f"if({plain}, if(length({alone}) >= 3, array({alone}), {NO_TOKENS}), {let(spelled, distinct)})"


def _fluff(drop_limited: bool) -> tuple:
    return tuple(w for w in TRAILING_WORDS if drop_limited or w not in ("limited", "ltd"))


def _without_tail(words: str, drop_limited: bool) -> str:
    return let(
        f"array_position(transform(reverse({words}), w -> NOT {any_of(_fluff(drop_limited), 'w')}), true)",
        lambda tail: f"if({tail} > 0, slice({words}, 1, cast(size({words}) - {tail} + 1 AS int)), {NO_TOKENS})",
    )


def significant_words(e: str, drop_limited: bool = True) -> str:
    """Words of a name up to the last one that is not a trailing word."""
    return let(_runs(f"lower(coalesce({e}, ''))"), lambda words: _without_tail(words, drop_limited))


def acronyms_of(e: str) -> str:
    """Initials of the significant words, with and without "limited", 2 to 6 letters long."""
    def initials(words: str) -> str:
        # Up to the last word that is not a trailing one; words are ASCII, one letter each.
        letters = f"array_join(transform({words}, w -> left(w, 1)), '')"

        def kept(drop_limited: bool) -> str:
            return f"array_max(transform({words}, (w, i) -> if({any_of(_fluff(drop_limited), 'w')}, 0, i + 1)))"

        return let(letters, lambda all_: f"array(left({all_}, {kept(True)}), left({all_}, {kept(False)}))")

    both = let(_runs(f"lower(coalesce({e}, ''))"), initials)
    return f"array_distinct(filter({both}, a -> length(a) BETWEEN 2 AND 6))"


def paren_chunks(e: str) -> str:
    """Parenthesised parts, each with its normalized form."""
    inner = _inner(f"coalesce({e}, '')")
    return f"flatten(transform({inner}, i -> filter(array(i, {normalize_for_match('i')}), x -> x != '')))"


def short_keys(e: str) -> str:
    """Keys under which a short form finds this name: parenthesised chunks and acronyms."""
    chunks = f"if(contains({e}, '('), transform({paren_chunks(e)}, c -> {normalize_for_match('c')}), {NO_TOKENS})"
    return f"array_distinct(filter(concat({chunks}, {acronyms_of(e)}), k -> length(k) >= 3))"


def token_jaccard(a: str, b: str) -> str:
    """Jaccard similarity of two token arrays, 0 where either is empty."""
    return (
        f"if(size({a}) = 0 OR size({b}) = 0, 0D, "
        f"size(array_intersect({a}, {b})) / size(array_union({a}, {b})))"
    )
