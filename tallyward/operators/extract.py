"""Header fields of a text by label patterns: the leftmost match, or nothing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocabulary as v
from ..functions.text import captured, strip
from .shared import spare

RAW_TAX = "struct<tax_type:string,tax_rate_raw:string,tax_amount_raw:string>"
TEXT_FIELDS = ("invoice_number", "po_number", "currency", "invoice_date_raw", "due_date_raw", "supplier_name", "buyer_name", "supplier_vat_id",
               "supplier_country", "buyer_country", "payment_term_text", "gross_total_raw", "subtotal_raw")


def unglued(text: Column) -> Column:
    """Spaces put back between currency codes and the digits or labels that recognition stuck to them."""
    apart = F.regexp_replace(text, v.led(v.CODE_THEN_DIGIT), "$1 $2")
    apart = F.regexp_replace(apart, v.led(v.DIGIT_THEN_CODE), "$1 $2")
    return F.regexp_replace(apart, v.led(v.LABEL_THEN_CODE), "$1 $2")


def _every(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(v.led(pattern)), F.lit(group))


def _vat_ids(text: Column) -> Column:
    """Tax numbers that hold a digit; others are table headings."""
    return F.filter(_every(text, v.VAT_ID, 1), lambda x: x.rlike(r"(?U)\d"))


def _country(vat: Column) -> Column:
    return captured(vat, r"^([A-Z]{2})")


def _name(found: Column) -> Column:
    """A captured name, null for labels that stand where names do."""
    return F.when(~strip(found).rlike(v.NOT_NAME), F.regexp_replace(strip(found), "[,.]+$", ""))


def _after_buyer(text: Column) -> Column:
    """The stretch behind the first buyer label and name."""
    return captured(text, rf"(?s)(?:{v.led(v.BUYER)})(?-i:(.{{0,{v.BUYER_REACH}}}))", 2)


def _tax_name(kind: Column) -> Column:
    return F.when(kind.isin("Tax", "tax", "TAX"), F.lit("VAT")).when(kind.isin("VAT", "GST", "IVA", "SST"), kind).when(F.upper(kind) == "TAX", F.lit("VAT")).otherwise(F.upper(kind))


def extracted(rows: DataFrame, text: str = "text", name: str = "fields", condition: Column | None = None, only: Sequence[str] | None = None) -> DataFrame:
    """``rows`` with the struct of all fields of a text, each null if it isn't found, with ``confidence_notes``.

    The struct is null where ``condition`` doesn't hold, and nothing is searched there.
    Each pattern is a column of its own, computed once; of the fields ``only`` names, and no others, patterns are searched.
    """
    x = spare(rows, "found")
    c = lambda key: F.col(x + key)
    plain = strip(F.coalesce(F.col(text), F.lit("")))
    start = rows.withColumn(x + "text", unglued(plain if condition is None else F.when(condition, plain)))
    t = c("text")
    firsts = {key: captured(t, v.led(pattern)) for key, pattern in (
        ("number", v.INVOICE_NUMBER), ("order", v.ORDER_NUMBER), ("code", v.CODE), ("symbol", v.SYMBOL), ("dated", v.INVOICE_DATE), ("due", v.DUE_DATE), ("supplier", v.SUPPLIER), ("buyer", v.BUYER),
        ("terms", v.TERMS), ("labelled", v.TOTAL), ("subtotal", v.SUBTOTAL), ("net", v.NET_BASE))}
    firsts |= {"rate": captured(t, v.led(v.KM_RATE), 1), "rate_tax": captured(t, v.led(v.KM_RATE), 2), "stated_kind": F.regexp_extract(t, v.led(v.TOTAL_TAX), 1), "stated": F.regexp_extract(t, v.led(v.TOTAL_TAX), 2),
               "after": _after_buyer(t), "vats": _vat_ids(t), "dates": F.array_distinct(_every(t, v.DATES, 0)),
               "before_sign": _every(t, v.ANY_AMOUNT, 1), "after_sign": _every(t, v.ANY_AMOUNT, 2)}
    firsts |= {key: _every(t, v.RATED_TAX, group) for key, group in (("kinds", 1), ("rates", 2), ("amounts", 3))}
    first = start.withColumns({x + key: value for key, value in firsts.items()})
    rated = F.transform(F.arrays_zip(c("kinds").alias("k"), c("rates").alias("r"), c("amounts").alias("a")), lambda z: F.struct(
        _tax_name(z["k"]).alias("tax_type"), F.replace(z["r"], F.lit(","), F.lit(".")).alias("tax_rate_raw"), z["a"].alias("tax_amount_raw"))).cast(f"array<{RAW_TAX}>")
    one = lambda kind, rate, amount: F.array(F.struct(kind.alias("tax_type"), rate.alias("tax_rate_raw"), amount.alias("tax_amount_raw"))).cast(f"array<{RAW_TAX}>")
    total = F.when(c("subtotal").isNotNull() & (c("stated") != ""), one(_tax_name(c("stated_kind")), F.lit(""), c("stated")))
    amounts = F.zip_with(c("before_sign"), c("after_sign"), lambda a, b: F.when(a != "", a).otherwise(b))
    second = first.withColumns({
        x + "vat": F.get(c("vats"), F.lit(0)), x + "after_vats": _vat_ids(F.coalesce(c("after"), F.lit(""))), x + "last": F.try_element_at(amounts, F.lit(-1)),
        x + "taxes": F.when(F.size(c("kinds")) > 0, rated).otherwise(total),
        # a net amount beside a rate, in the form of a line of a tax table, where neither subtotal nor tax was found
        x + "pair": c("subtotal").isNull() & (F.size(c("kinds")) <= 0) & c("net").isNotNull() & c("rate").isNotNull()})
    symbols = F.create_map(*[F.lit(s) for pair in v.SYMBOLS.items() for s in pair])
    others = F.filter(c("after_vats"), lambda z: ~z.eqNullSafe(c("vat")))
    cells = {
        "invoice_number": F.when(~c("number").rlike(v.LIKE_PHONE) & ~c("number").rlike(v.LIKE_DATE), c("number")),
        "po_number": c("order"),
        "currency": F.coalesce(c("code"), F.try_element_at(symbols, c("symbol"))),
        "invoice_date_raw": F.coalesce(c("dated"), F.when(c("due").isNull() & (F.size(c("dates")) == 1), F.get(c("dates"), F.lit(0)))),
        "due_date_raw": c("due"),
        "supplier_name": _name(c("supplier")),
        "buyer_name": _name(c("buyer")),
        "supplier_vat_id": c("vat"),
        "supplier_country": _country(c("vat")),
        "buyer_country": _country(F.get(others, F.lit(0))),
        "payment_term_text": strip(c("terms")),
        "gross_total_raw": F.coalesce(c("labelled"), c("last")),
        "subtotal_raw": F.when(c("pair"), c("net")).otherwise(c("subtotal")),
    }
    notes = F.array_compact(F.array(
        F.when(t == "", F.lit("no text available")),
        F.when(c("labelled").isNull() & c("last").isNotNull(), F.lit("gross_total_raw is the last amount of the text: low confidence"))))
    taxes = F.when(c("pair"), one(F.lit("VAT"), F.replace(c("rate"), F.lit(","), F.lit(".")), c("rate_tax"))).otherwise(c("taxes"))
    cells |= {"header_taxes_raw": taxes, "confidence_notes": notes}
    whole = F.struct(*[value.alias(n) for n, value in cells.items() if only is None or n in only])
    return second.select(*[F.col(f"`{k}`") for k in rows.columns if k.lower() != name.lower()], (whole if condition is None else F.when(condition, whole)).alias(name))


def any_field(found: Column) -> Column:
    """Whether anything was found at all."""
    out = found["header_taxes_raw"].isNotNull()
    for name in TEXT_FIELDS:
        out = out | found[name].isNotNull()
    return out


def line_agrees(quantity: Column, price: Column, total: Column, absolute: float = 0.02, relative: float = 0.01) -> Column:
    """Whether quantity by price is about the printed total, by either tolerance."""
    off = F.abs(quantity * price - total)
    share = F.when(total != 0, off / F.abs(total)).otherwise(F.lit(float("inf")))
    return ((total == 0) & (quantity * price == 0)) | (off <= absolute) | (share <= relative)

