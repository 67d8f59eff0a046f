"""Printed values and text forms, all cases of a function in one frame."""

from __future__ import annotations

import unicodedata
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from tallyward.functions import text as t
from tallyward.functions import values as n


def applied(spark, cases, function):
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, v string")
    return [r[0] for r in rows.select("i", function(F.col("v")).alias("x")).orderBy("i").select("x").collect()]


def check(spark, expected, function):
    got = applied(spark, list(expected), function)
    assert dict(zip(expected, got, strict=True)) == expected


def test_numbers(spark):
    check(spark, {
        "1.234,56": "1234.56", "1,234.56": "1234.56", "1234,56": "1234.56", "67,3": "67.3", "1234.56": "1234.56", "1.234": "1.234", "5.": "5.", "1.234.567": "1234567", "1040.00": "1040.00", "12": "12",
        "10,000": None, "1,234,567": None, "1,2345": None, "": "", "  ": "", None: None, ".": None, "abc": None, "1,2.3,4": None, "12a": None, "--5": None, "-": None, "()": None,
        "-123.45": "-123.45", "+7": "7", "(123.45)": "-123.45", "( 5,5 )": "-5.5", "12.5%": "12.5", "12,5 %": "12.5", "EUR 12.10": "12.10", "12.10 EUR": "12.10", "€12.10": "12.10", "12.10 $": "12.10", "1 234,5": "1234.5",
        "1,234.": "1234", "1.234,": "1234", "1\u2009234": None}, n.number)


def test_currencies(spark):
    check(spark, {"EUR": "EUR", "usd": "USD", "€": "EUR", "$": "USD", "£12": "GBP", "12 ¥": "JPY", "S$": "USD", "S$250.00": None, "XYZ": None, "": "", None: "", " ₹ ": "INR"}, n.currency)


def test_dates(spark):
    check(spark, {
        "2024-03-05": "2024-03-05", "05.03.2024": "2024-03-05", "5-3-2024": "2024-03-05", "5/3/2024": "2024-03-05", "5 March 2024": "2024-03-05", "5 Sept. 2024": "2024-09-05", "31.02.2026": "2026-02-31", "12.03.2567": "2024-03-12",
        "12.03.2500 B.E.": "1957-03-12", "1 Foo 2024": None, "13/13/2024": None, "2024-00-01": None, "01.01.1800": None, "5.3-2024": None, "": None, None: None, "March 5": None}, n.date)


def test_printed_forms(spark):
    got = applied(spark, ["1040.06", "12.5", "1234567", "-1234.5", "abc", "1000"], lambda v: F.array_sort(n.printed_forms(v)))
    assert [set(x) for x in got] == [{"1040.06", "1040,06", "1.040,06", "1,040.06"}, {"12.5", "12,5"}, {"1234567", "1.234.567", "1,234,567"}, {"-1234.5", "1234,5", "-1.234,5", "-1,234.5"}, {"abc"}, {"1000", "1.000", "1,000"}]


def test_numeric_fields_and_magnitudes(spark):
    check(spark, {"": True, None: True, "1.5": True, "-2": True, "nan": True, "inf": True, "1e5": True, "1,5": False, "x": False, "12d": False}, n.is_numeric)
    check(spark, {"-5": "5", "5": "5", "": "", None: "", " -1.0 ": "1.0"}, n.magnitude)


def test_keys_fold_unicode(spark):
    check(spark, {"  Müller, GmbH. ": "müller gmbh", "ＡＣＭＥ　Ltd": "acme ltd", "Straße": "strasse", "A-B c": "a-b c", None: ""}, t.name_key)
    check(spark, {"de 209-177 122": "DE209177122", "ＥＥ１": "EE1", None: ""}, t.vat_key)
    check(spark, {" po-7 /a ": "PO-7 /A", None: ""}, t.order_key)
    check(spark, {"Net. 30  days": "net 30 days"}, t.term_key)
    check(spark, {" ee ": "EE"}, t.country_key)


def test_similarity_is_by_blocks_in_this_order(spark):
    pairs = [("abcd", "bcde"), ("", ""), ("x" * 300 + "y", "y" + "x" * 300), (None, "a")]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = [r[0] for r in rows.orderBy("i").select(t.similarity("a", "b")).collect()]
    assert got == [None if a is None else SequenceMatcher(None, a, b).ratio() for a, b in pairs]


def test_text_quality_and_regions(spark):
    check(spark, {"": False, None: False, "short": False, "long enough to be used": True, "-" * 40 + "ab": False, "............abcdefgh": True}, t.sufficient)
    check(spark, {"a\n\n b\r\nc": "a\n b\nc", "\n".join(str(i) for i in range(12)): "\n".join(str(i) for i in range(8)), None: ""}, t.top_region)
    check(spark, {"This is a COPY": True, "copyright": False, "Reprint": True, None: False}, t.copy_label)
    assert unicodedata.normalize("NFKC", "ﬁ") == applied(spark, ["ﬁ"], t.compatible)[0]
