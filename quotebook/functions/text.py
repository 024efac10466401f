"""Column helpers for prices, slugs, URLs and emptiness. All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The whitespace of str.strip(), spelled out so that the class does not depend on the regex engine.
WS = r"\t-\r\x1c-\x1f \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WS_CHARS = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
# Letters, digits and underscore in any script.
WORD = r"\p{L}\p{N}_"

RUPEE = "₹"
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
_FLOAT = rf"(?i)^[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?|inf(?:inity)?)$"
_NAN = r"(?i)^[+-]?nan$"
_INTEGER = rf"^[+-]?{_DIGITS}$"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WS_CHARS))


def remove(c: Column, *parts: str) -> Column:
    """Delete literal substrings one after the other."""
    for part in parts:
        c = F.replace(c, F.lit(part), F.lit(""))
    return c


def _float(c: Column) -> Column:
    """String -> double where the text is a decimal float, else null (stricter than a bare cast)."""
    return (
        F.when(c.rlike(_NAN), F.lit(float("nan")))
        .when(c.rlike(_FLOAT), remove(c, "_").try_cast("double"))
    )


def clean_value(c: Column) -> Column:
    return strip(remove(c, RUPEE, ",", "%"))


def parse_float(c: Column) -> Column:
    return F.when(~c.isin("", "N/A", "-"), _float(clean_value(c)))


def clean_price(c: Column) -> Column:
    """Price text to double; without a decimal point only plain integers count."""
    s = strip(remove(c, RUPEE, ",", " ", "\n"))
    return F.when(s.contains("."), _float(s)).when(s.rlike(_INTEGER), remove(s, "_").try_cast("double"))


def number(df_type: T.DataType, c: Column) -> Column:
    return c.cast("double") if isinstance(df_type, T.NumericType) else parse_float(c.cast("string"))


def is_positive_price(c: Column) -> Column:
    """Numeric and not <= 0. NaN sorts above every number in Spark, so it passes."""
    return F.coalesce(_float(strip(c)) > 0, F.lit(False))


def _dashed(c: Column, separators: str) -> Column:
    """Runs of separators and dashes to one dash, none at the ends."""
    one_kind = F.translate(c, separators, "-" * len(separators))
    return F.btrim(F.regexp_replace(one_kind, "--+", "-"), F.lit("-"))


def slugify_ascii(c: Column) -> Column:
    return _dashed(F.regexp_replace(F.lower(c), f"[^a-z0-9 {WS}-]+", ""), WS_CHARS)


def slugify_unicode(c: Column) -> Column:
    return _dashed(F.regexp_replace(strip(F.lower(c)), f"[^a-z0-9 {WORD}{WS}-]+", ""), WS_CHARS + "_")


def nonempty(c: Column) -> Column:
    """Null instead of an empty string."""
    return F.when(c != "", c)


def meaningful(c: Column, dtype: T.DataType) -> Column:
    """Not null, not an empty string, array or map. Zero and false are meaningful."""
    if isinstance(dtype, T.StringType):
        return c.isNotNull() & (c != "")
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return c.isNotNull() & (F.size(c) > 0)
    return c.isNotNull()


def display_price(price: Column, backup: Column) -> Column:
    return F.when(price.isNull() | (price == 0), F.coalesce(backup, price)).otherwise(price)


def display_timestamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def display_iso(c: Column) -> Column:
    """ISO timestamp text for display: seconds resolution, a space instead of the T."""
    return F.substring(F.replace(c, F.lit("T"), F.lit(" ")), 1, 19)


def absolutize_url(c: Column, base: str) -> Column:
    return (
        F.when(c.startswith("http"), c)
        .when(c.startswith("/"), F.concat(F.lit(base), c))
        .otherwise(F.concat(F.lit(base + "/"), c))
    )


def url_slug(c: Column) -> Column:
    return F.element_at(F.split(F.rtrim(c, F.lit("/")), "/"), -1)


def path_slug(c: Column, marker: str) -> Column:
    """What follows the last occurrence of ``marker``, without trailing slashes."""
    return F.rtrim(F.substring_index(c, marker, -1), F.lit("/"))
