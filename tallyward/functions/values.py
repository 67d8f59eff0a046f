"""Printed numbers, currencies and dates as plain ones.  Null is "can't tell": nothing is guessed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, let, strip

# Fixed values.
CURRENCY_CODES = "EUR USD GBP CHF THB SGD MYR ZAR KES GHS DKK PLN AUD CAD SEK NOK RON VND INR JPY".split()
CURRENCY_SYMBOLS = {"€": "EUR", "$": "USD", "£": "GBP", "¥": "JPY", "₹": "INR"}
MONTHS = {
    "jan": 1, "january": 1, "feb": 2, "february": 2, "mar": 3, "march": 3, "apr": 4, "april": 4, "may": 5, "jun": 6, "june": 6,
    "jul": 7, "july": 7, "aug": 8, "august": 8, "sep": 9, "sept": 9, "september": 9, "oct": 10, "october": 10, "nov": 11,
    "november": 11, "dec": 12, "december": 12,
}
ERA_MARK = r"(?iU)(พ\.?\s*ศ\.?|B\.?E\.?)"
ERA_YEARS, ERA_FROM = 543, 2400
YEARS = (1900, 2200)

#: What a plain number looks like, so that no cast takes more than that.
PLAIN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
#: What most numbers look like: nothing to trim or to resolve, so that one look is enough.
DIGITS = r"^[0-9]+(\.[0-9]+)?\z"


def to_double(value: Column) -> Column:
    """A plain number's value, null for anything else."""
    trimmed = strip(value)
    return F.when(value.rlike(DIGITS), value.try_cast("double")).when(trimmed.rlike(PLAIN), trimmed.try_cast("double"))


def number(value: Column | str) -> Column:
    """A printed number as a dot-decimal text; "" for blank, null where its separators leave doubt.

    Both separators: the last is the decimal point.  One comma with one or two digits
    after it: a decimal comma; other commas alone are in doubt.  One dot: a decimal
    point; several: thousands.
    """
    return let(strip(value), lambda raw: F.when((raw == "") | raw.rlike(DIGITS), raw).otherwise(let(_unwrapped(raw), _signed)))


def _unwrapped(raw: Column) -> Column:
    """``struct<minus, digits>`` without parentheses, percent sign and currency."""
    in_parens = raw.rlike(r"(?s)^\(.*\)$")
    bare = F.when(in_parens, F.substring(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw)
    bare = F.regexp_replace(strip(bare), "%$", "")
    bare = F.regexp_replace(strip(bare), r"^[€$£¥₹ \t]+|[€$£¥₹ \t]+$", "")
    bare = strip(F.regexp_replace(F.regexp_replace(bare, r"(?U)^[A-Z]{3}\s*", ""), r"(?U)\s*[A-Z]{3}$", ""))
    return F.struct(in_parens.alias("minus"), bare.alias("digits"))


def _signed(u: Column) -> Column:
    digits = strip(F.regexp_replace(u["digits"], r"^[-+]", ""))
    minus = u["minus"] | u["digits"].startswith("-")
    checked = let(digits, lambda d: F.when(d.rlike(r"(?U)^[\d.,\s]+$"), let(F.replace(d, F.lit(" "), F.lit("")), _pointed)))
    return F.when(minus, F.concat(F.lit("-"), checked)).otherwise(checked)


def _pointed(plain: Column) -> Column:
    """Digits with their separators resolved, null in doubt."""
    whole = lambda x: F.regexp_replace(x, r"\.$", "")
    comma_last = plain.contains(".") & plain.rlike(r",[^.]*$")
    swapped = F.replace(F.regexp_replace(F.replace(plain, F.lit("."), F.lit("")), r",([^,]*)$", "#$1"), F.lit("#"), F.lit("."))
    shaped = (
        F.when(comma_last, whole(swapped))
        .when(plain.contains(".") & plain.contains(","), whole(F.replace(plain, F.lit(","), F.lit(""))))
        .when(plain.rlike(r"^[^,]*,[^,]{1,2}$"), F.replace(plain, F.lit(","), F.lit(".")))
        .when(plain.contains(","), F.lit(None).cast("string"))
        .when(plain.rlike(r"\..*\."), F.replace(plain, F.lit("."), F.lit("")))
        .otherwise(plain))
    return let(shaped, lambda x: F.when(x.rlike(r"^(\d+\.?\d*|\.\d+)$"), x))


def currency(value: Column | str) -> Column:
    """The ISO code of a printed currency; "" for blank or null, null in doubt."""
    raw = strip(F.coalesce(col(value), F.lit("")))
    out = F.when(raw == "", F.lit("")).when(F.upper(raw).isin(CURRENCY_CODES), F.upper(raw))
    for symbol, code in CURRENCY_SYMBOLS.items():
        out = out.when(raw.startswith(symbol) | raw.endswith(symbol), F.lit(code))
    return out


def date(value: Column | str, era_marked: Column | None = None) -> Column:
    """A printed date as YYYY-MM-DD, null if its form or range isn't known.  Days are 1 to 31 in any month."""
    raw = strip(value)
    marked = raw.rlike(ERA_MARK) if era_marked is None else era_marked
    return let(F.struct(strip(F.regexp_replace(raw, ERA_MARK, "")).alias("text"), marked.alias("marked")), _dated)


def _dated(d: Column) -> Column:
    clean = d["text"]
    part = lambda pattern, group: F.regexp_extract(clean, pattern, group).try_cast("int")
    iso, dots, slashes = r"^(\d{4})-(\d{2})-(\d{2})$", r"^(\d{1,2})([.\-])(\d{1,2})\2(\d{4})$", r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
    named = r"(?U)^(\d{1,2})\s+([A-Za-z]+)\.?\s+(\d{4})$"
    months = F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair])
    parts = F.struct(
        F.coalesce(part(iso, 1), part(dots, 4), part(slashes, 3), part(named, 3)).alias("y"),
        F.coalesce(part(iso, 2), part(dots, 3), part(slashes, 2), F.try_element_at(months, F.lower(F.regexp_extract(clean, named, 2)))).alias("m"),
        F.coalesce(part(iso, 3), part(dots, 1), part(slashes, 1), part(named, 1)).alias("d"))

    def text(p: Column) -> Column:
        year = F.when(d["marked"] | (p["y"] >= ERA_FROM), p["y"] - ERA_YEARS).otherwise(p["y"])
        return F.when(year.between(*YEARS) & p["m"].between(1, 12) & p["d"].between(1, 31), F.format_string("%04d-%02d-%02d", year, p["m"], p["d"]))

    return let(parts, text)


def optional(normalised: Column) -> Column:
    """Blank instead of doubt."""
    return F.coalesce(normalised, F.lit(""))


def magnitude(value: Column | str) -> Column:
    """A text amount without its leading minus."""
    return F.regexp_replace(strip(F.coalesce(col(value), F.lit(""))), "^-", "")


def is_numeric(value: Column | str) -> Column:
    """Blank, or a text that reads as a number (also nan and inf, with any of their spellings)."""
    whole = F.coalesce(col(value), F.lit(""))
    text = strip(whole)
    return (whole == "") | whole.rlike(DIGITS) | text.rlike(PLAIN) | text.rlike(r"(?i)^[+-]?(nan|inf|infinity)$")


def not_finite(value: Column | str) -> Column:
    whole = F.coalesce(col(value), F.lit(""))
    return (whole != "") & ~whole.rlike(DIGITS) & strip(whole).rlike(r"(?i)^[+-]?(nan|inf|infinity)$")


def printed_forms(value: Column | str) -> Column:
    """The ways in which a plain number may have been printed."""
    return let(col(value), lambda plain: F.when(to_double(plain).isNull(), F.array(plain)).otherwise(let(_parts(plain), _forms)))


def _parts(plain: Column) -> Column:
    unsigned = F.regexp_replace(plain, "^-", "")
    whole = F.substring_index(unsigned, ".", 1)
    part = F.when(unsigned.contains("."), F.substring(unsigned, F.length(whole) + 2, F.length(unsigned))).otherwise(F.lit(""))
    minus = F.when(plain.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    return F.struct(plain.alias("plain"), minus.alias("minus"), unsigned.alias("unsigned"), whole.alias("whole"), part.alias("part"))


def _forms(p: Column) -> Column:
    grouped = lambda mark, point: F.concat(
        p["minus"], F.regexp_replace(p["whole"], r"(?<=\d)(?=(\d{3})+$)", mark), F.when(p["part"] != "", F.concat(F.lit(point), p["part"])).otherwise(F.lit("")))
    plain = F.array(p["plain"], F.replace(p["unsigned"], F.lit("."), F.lit(",")))
    return F.array_distinct(F.when(F.length(p["whole"]) > 3, F.concat(plain, F.array(grouped(".", ","), grouped(",", ".")))).otherwise(plain))
