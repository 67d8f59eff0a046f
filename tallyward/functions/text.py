"""Text forms: trimming, folding, comparison keys, and similarity.

Everything is a column expression in the JVM.  Python comes in twice: for Unicode
folding of rows that aren't plain ASCII, and for sequence similarity, neither of
which Spark has.
"""

from __future__ import annotations

import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A page's own text counts if it has this many characters and this share of letters and digits.
MIN_TEXT_CHARS, MIN_ALNUM_SHARE = 15, 0.3
TOP_LINES = 8
COPY_LABEL = r"(?iU)\b(copy|duplicate|reprint|copy\s+tax\s+invoice)\b"


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it.

    Deep ladders over a derived value would otherwise repeat its whole expression at each mention.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Looks for what may be white space of any script before that is asked, which takes Java far longer.
_GAP = r"(?=[\x09-\x0D\x20\x80-\x{10FFFF}])"


def strip(value: Column | str) -> Column:
    """White space of any script off both ends."""
    return F.regexp_replace(col(value), rf"(?U)^\s+|{_GAP}\s+$", "")


def collapse(value: Column | str) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(col(value), rf"(?U){_GAP}\s+", " "))


def present(value: Column | str) -> Column:
    """Neither null nor empty."""
    return F.length(F.coalesce(col(value), F.lit(""))) > 0


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(col(value), F.lit(""))


@F.pandas_udf(T.StringType())
def _compatible(values: pd.Series) -> pd.Series:
    return values.map(lambda s: unicodedata.normalize("NFKC", s), na_action="ignore")


@F.pandas_udf(T.StringType())
def _folded(values: pd.Series) -> pd.Series:
    return values.map(str.casefold, na_action="ignore")


def _off_ascii(value: Column, python, plain: Column) -> Column:
    """``plain`` for ASCII rows; the Python function sees the other rows only, and null for the rest."""
    ascii_only = value.rlike(r"^\p{ASCII}*$")
    return F.when(ascii_only, plain).otherwise(python(F.when(~ascii_only, value)))


def compatible(value: Column | str) -> Column:
    """Unicode compatibility form; null gives an empty text."""
    value = F.coalesce(col(value), F.lit(""))
    return _off_ascii(value, _compatible, value)


def folded(value: Column | str) -> Column:
    """Full case folding; null gives an empty text."""
    value = F.coalesce(col(value), F.lit(""))
    return _off_ascii(value, _folded, F.lower(value))


def name_key(value: Column | str, unicode: bool = True) -> Column:
    """Names: commas and stops are gaps, hyphens stay."""
    base = compatible(value) if unicode else F.coalesce(col(value), F.lit(""))
    spaced = collapse(F.regexp_replace(base, "[,.]", " "))
    return folded(spaced) if unicode else F.lower(spaced)


def vat_key(value: Column | str, unicode: bool = True) -> Column:
    """Tax registration numbers: without gaps and hyphens, upper case."""
    base = compatible(value) if unicode else F.coalesce(col(value), F.lit(""))
    return F.upper(F.regexp_replace(base, r"(?U)[\s\-]", ""))


def order_key(value: Column | str, unicode: bool = True) -> Column:
    """Purchase order numbers: gaps collapsed, upper case, punctuation kept."""
    return F.upper(collapse(compatible(value) if unicode else F.coalesce(col(value), F.lit(""))))


def term_key(value: Column | str, unicode: bool = True) -> Column:
    """Payment term wording: without stops, gaps collapsed."""
    base = compatible(value) if unicode else F.coalesce(col(value), F.lit(""))
    spaced = collapse(F.regexp_replace(base, r"\.", ""))
    return folded(spaced) if unicode else F.lower(spaced)


def country_key(value: Column | str, unicode: bool = True) -> Column:
    """Country codes: trimmed, upper case."""
    return F.upper(strip(compatible(value) if unicode else F.coalesce(col(value), F.lit(""))))


def hash_form(value: Column | str) -> Column:
    """The form in which texts are compared and hashed."""
    return F.lower(collapse(F.coalesce(col(value), F.lit(""))))


def ratio(new: str, prior: str) -> float:
    """``SequenceMatcher(None, new, prior).ratio()``, told without it where one text is the other less one stretch.

    If what both begin with is a longest block that they share, or what both end with is the only one, the matcher takes it first and
    then all that is left of the shorter text.  From 200 characters on the matcher leaves out frequent ones, so there it is asked.
    """
    short, long = (new, prior) if len(new) <= len(prior) else (prior, new)
    n, total = len(short), len(short) + len(long)
    if not n or len(prior) >= 200:
        return SequenceMatcher(None, new, prior).ratio()
    if short == long:
        return 1.0
    begin = next((i for i in range(n) if short[i] != long[i]), n)
    end = next((i for i in range(n) if short[-1 - i] != long[-1 - i]), n)
    if begin + end >= n:
        if begin >= end:
            sure = not any(short[i : i + begin + 1] in long for i in range(n - begin))
        else:
            sure = long.find(short[n - end :]) == len(long) - end and not any(short[i : i + end] in long for i in range(n - end))
        if sure:
            return 2.0 * n / total
    return SequenceMatcher(None, new, prior).ratio()


@F.pandas_udf(T.DoubleType())
def similarity(new: pd.Series, prior: pd.Series) -> pd.Series:
    """Share of matching blocks, in this order of arguments; null if either is null."""
    return pd.Series([None if a is None or b is None else ratio(a, b) for a, b in zip(new, prior, strict=True)], dtype="float64")


#: Characters whose number in a text is told apart up to three, three bits each, in two words of 60 bits.
TOLD = "etaoinshrdlucmfwypvb", "gkjqxz0123456789 .,-"


def letters(value: Column | str) -> Column:
    """``struct<a, b, more>``: how often each of :data:`TOLD` stands in a text, as one to three bits, and how many characters these leave untold."""
    value = col(value)

    def word(chars: str) -> tuple[Column, Column]:
        out, told = F.lit(0).cast("long"), F.lit(0)
        for i, c in enumerate(chars):
            n = F.least(F.length(value) - F.length(F.replace(value, F.lit(c), F.lit(""))), F.lit(3))
            out = out.bitwiseOR(F.shiftleft(F.when(n == 0, 0).when(n == 1, 1).when(n == 2, 3).otherwise(7).cast("long"), 3 * i))
            told = told + n
        return out, told

    (a, in_a), (b, in_b) = word(TOLD[0]), word(TOLD[1])
    return F.struct(a.alias("a"), b.alias("b"), (F.length(value) - in_a - in_b).alias("more"), F.length(value).alias("size"))


def may_share(new: Column, prior: Column, least: float) -> Column:
    """False only where :func:`similarity` of two texts is below ``least``, by their :func:`letters`.

    Matching blocks hold no character more often than either text; what isn't told counts as shared.
    """
    common = F.bit_count(new["a"].bitwiseAND(prior["a"])) + F.bit_count(new["b"].bitwiseAND(prior["b"])) + F.least(new["more"], prior["more"])
    return 2.0 * common >= F.lit(least) * (new["size"] + prior["size"]) - 1e-9


def may_be_similar(new: Column | str, prior: Column | str, least: float) -> Column:
    """False only where :func:`similarity` is below ``least``.

    Matching blocks of M characters leave T - 2M of both texts' T to delete and insert, so the edit distance is
    at most (1 - ratio) T.  Spark looks for a distance only up to that limit, along a band.
    """
    new, prior = col(new), col(prior)
    limit = F.floor((F.length(new) + F.length(prior)) * F.lit(1 - least) + F.lit(1e-9)).cast("int")
    return F.call_function("levenshtein", new, prior, limit) >= 0


def sufficient(value: Column | str) -> Column:
    """Whether a page's own text is enough to go by."""
    text = strip(F.coalesce(col(value), F.lit("")))
    alnum = F.length(F.regexp_replace(text, r"[^\p{L}\p{N}]", ""))
    solid = F.length(F.regexp_replace(text, r"(?U)\s", ""))
    return (F.length(text) >= MIN_TEXT_CHARS) & F.coalesce(F.try_divide(alnum, solid) >= MIN_ALNUM_SHARE, F.lit(False))


def top_region(value: Column | str, lines: int = TOP_LINES) -> Column:
    """The first lines that aren't blank."""
    solid = F.filter(F.split(F.coalesce(col(value), F.lit("")), r"\R"), lambda x: x.rlike(r"(?U)\S"))
    return F.array_join(F.slice(solid, 1, lines), "\n")


def copy_label(value: Column | str) -> Column:
    """Whether a text is labelled a copy; this alone declines nothing."""
    return F.coalesce(col(value), F.lit("")).rlike(COPY_LABEL)


def quoted(value: Column | str) -> Column:
    """A text in quotes, single ones unless they stand in it, None for null."""
    value = col(value)
    plain = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    double = F.contains(value, F.lit("'")) & ~F.contains(value, F.lit('"'))
    single = F.concat(F.lit("'"), F.replace(plain, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(value.isNull(), F.lit("None")).when(double, F.concat(F.lit('"'), plain, F.lit('"'))).otherwise(single)


def listed(values: Column) -> Column:
    """Texts in quotes, in brackets."""
    return F.concat(F.lit("["), F.array_join(F.transform(values, quoted), ", "), F.lit("]"))


def captured(value: Column, pattern: str, group: int = 1) -> Column:
    """A group of the leftmost match, null without one or if the group is empty."""
    return blank_to_null(F.regexp_extract(value, pattern, group))
