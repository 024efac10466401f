"""Hand-derived values of the column helpers."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from quotebook.functions import names, text
from quotebook.operators.candidates import subsets


def of_text(spark, fn, *inputs):
    return values_col(spark, fn(F.col("x")), inputs)


def of_name(spark, fn, *inputs):
    return values_col(spark, F.expr(fn("x")), inputs)


def values_col(spark, column, inputs):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r.y for r in rows.select("i", column.alias("y")).orderBy("i").collect()]


def test_slugs(spark):
    assert of_text(spark, text.slugify_ascii, "Foo_Bar Ltd", "Café Ltd", " -A  b- ", None) == ["foobar-ltd", "caf-ltd", "a-b", None]
    assert of_text(spark, text.slugify_unicode, "Foo_Bar Ltd", "Café Ltd", "__a b__") == ["foo-bar-ltd", "café-ltd", "a-b"]


def test_parse_float(spark):
    got = of_text(spark, text.parse_float, "₹ 1,234.50", "12%", "N/A", "-", "", None, "1e5", "1.0d", "0x1p3", "1_000", ".5", "5.", " 7 ", "abc", "-3")
    assert got == [1234.5, 12.0, None, None, None, None, 100000.0, None, None, 1000.0, 0.5, 5.0, 7.0, None, -3.0]
    nan, inf = of_text(spark, text.parse_float, "nan", "-Infinity")
    assert math.isnan(nan) and inf == -math.inf


def test_clean_price(spark):
    got = of_text(spark, text.clean_price, "1e5", "₹ 1 200", "₹ 1,200.50", "", None, "12.", "+7", "x", "1\n2")
    assert got == [None, 1200.0, 1200.5, None, None, 12.0, 7.0, None, 12.0]


def test_positive_price(spark):
    assert of_text(spark, text.is_positive_price, "1", "0", "-1", "abc", None, "nan", "inf") == [True, False, False, False, False, True, True]


def test_match_keys(spark):
    got = of_name(spark, names.normalize_for_match, "Incred Holdings Limited", "Cochin International Airport Limited Unlisted Shares", None, "Foo Ent", "Lab-tech Lab")
    assert got == ["redholdings", "chininternationalairport", "", "fooenterprise", "laboratoriestechlaboratories"]


def test_name_tokens(spark):
    got = of_name(spark, names.name_tokens, "Matrix Gas And Renewables Unlisted Shares", "Kurl-on Limited", "Transline Technologies Limited", "Glass A", None)
    assert [sorted(t) for t in got] == [["gas", "matrix", "renewable"], ["kurl", "kurlon", "on"], ["technologie", "transline"], ["glass"], []]


def test_acronyms(spark):
    got = of_name(spark, names.acronyms_of, "NSE India Limited Unlisted Shares", "Hindustan Power Exchange Limited", "Limited", "One", None)
    assert [sorted(a) for a in got] == [["ni", "nil"], ["hpe", "hpel"], [], [], []]


def test_significant_words(spark):
    assert of_name(spark, names.significant_words, "Foo Share Ltd Bar Pvt Ltd", "Ltd") == [["foo", "share", "ltd", "bar"], []]
    keep = lambda e: names.significant_words(e, False)
    assert of_name(spark, keep, "Foo Pvt Ltd Shares") == [["foo", "pvt", "ltd"]]


def test_name_variants(spark):
    got = of_name(spark, names.name_variants, "Foo Ent (Formerly Bar) Known As Baz", "ab", None)
    assert got[0] == [
        "Foo Ent (Formerly Bar) Known As Baz", "Foo enterprise (Formerly Bar) Known As Baz",
        "Formerly Bar", "Foo Ent", "Foo enterprise", "Bar", "Baz",
    ]
    assert got[1:] == [[], []]


def test_paren_chunks(spark):
    assert of_name(spark, names.paren_chunks, "Foo (HPX India) (Ltd)", "none") == [["HPX India", "hpxindia", "Ltd"], []]


def test_display_price(spark):
    rows = spark.createDataFrame([(0, None, 12.5), (1, 0.0, None), (2, 0.0, 0.0), (3, 10.0, 12.5), (4, None, None)], "i int, p double, b double")
    got = [r.y for r in rows.orderBy("i").select(text.display_price(F.col("p"), F.col("b")).alias("y")).collect()]
    assert got == [12.5, 0.0, 0.0, 10.0, None]


def test_urls_and_times(spark):
    base = lambda c: text.absolutize_url(c, "https://x.example")
    assert of_text(spark, base, "http://a/b", "/c", "d") == ["http://a/b", "https://x.example/c", "https://x.example/d"]
    assert of_text(spark, text.url_slug, "https://x/a/b//", "b") == ["b", "b"]
    ts = F.lit(datetime.datetime(2024, 1, 2, 3, 4, 5, 678)).cast("timestamp")
    assert spark.range(1).select(text.display_timestamp(ts).alias("y")).first().y == "2024-01-02 03:04:05"
    assert of_text(spark, text.display_iso, "2024-01-02T03:04:05.000678") == ["2024-01-02 03:04:05"]


@pytest.mark.parametrize("dropped, count", [(5, 32), (1, 6), (0, 1)])
def test_subsets(spark, dropped, count):
    made = spark.range(1).selectExpr(f"{subsets('''array('a','b','c','d','e')''', str(dropped))} AS s").first().s
    assert len(made) == count == len({x.k for x in made})
    assert all(x.n == x.k.count("|") and x.n >= 5 - dropped for x in made)
