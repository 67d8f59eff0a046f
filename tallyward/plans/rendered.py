"""Business documents rendered from the order tables, in SQL that Spark and DuckDB both read.

Digits come from integers, never from doubles, so both engines render the same text.
Sixteen shapes by order key; of these the first eight are a full invoice, a lone total, a credit note, a delivery
note, a reminder, an internal form, nothing, and an invoice mixed with a packing list.  The others reach what
these don't: a label where a name belongs, an amount without a label, a net amount beside a rate in a tax table, no currency,
a total that doesn't add up, words of an invoice without any field, a bare total, and one text in many files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_BASE = """
base AS (
  SELECT o_orderkey AS k, o_custkey AS c, cast(round(o_totalprice * 100) AS bigint) AS net, cast(cast(o_orderdate AS date) AS string) AS d,
         cast(o_orderkey % 16 AS int) AS shape, cast(o_orderkey % 3 AS int) AS loc,
         CASE cast(o_orderkey % 4 AS int) WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' WHEN 2 THEN 'GBP' ELSE 'ZAR' END AS cur
  FROM {orders}),
sums AS (SELECT *, (net * 20 + 50) {div} 100 AS tax, net + (net * 20 + 50) {div} 100 AS gross FROM base),
"""


def printed(cents: str) -> str:
    """SQL for an amount in the order's own number format: dot, comma, or grouped with a dot."""
    whole, part = f"({cents} {{div}} 100)", f"lpad(cast({cents} % 100 AS string), 2, '0')"
    grouped = f"CASE WHEN {whole} >= 1000 THEN concat(cast({whole} {{div}} 1000 AS string), ',', lpad(cast({whole} % 1000 AS string), 3, '0')) ELSE cast({whole} AS string) END"
    return (f"CASE loc WHEN 0 THEN concat(cast({whole} AS string), '.', {part}) WHEN 1 THEN concat(cast({whole} AS string), ',', {part}) "
            f"ELSE concat({grouped}, '.', {part}) END")


def plain(cents: str) -> str:
    """SQL for an amount with a decimal point."""
    return f"concat(cast({cents} {{div}} 100 AS string), '.', lpad(cast({cents} % 100 AS string), 2, '0'))"


_NL = "chr(10)"


def _lines(*lines: str) -> str:
    """SQL for a text of lines, each given as SQL expressions."""
    return "concat(" + ", ".join(f"{line}, {_NL}" for line in lines) + ")"


_K, _C = "cast(k AS string)", "cast(c AS string)"
_PARTIES = _lines(f"'Supplier: Supplier ', {_C}, ' Ltd'", f"'VAT No: EE', lpad({_C}, 9, '0')", f"'Bill To: Customer ', {_C}", f"'VAT ID: DE', lpad({_K}, 9, '0')")
_DATES = _lines("'Invoice Date: ', d", "'Due Date: ', substr(d, 9, 2), '.', substr(d, 6, 2), '.', substr(d, 1, 4)", "'Payment terms: Net 30'")
_TOTAL = "'Total: ', cur, ' ', gross_text"
#: The one text of many files.
SAME = _lines("'INVOICE'", "'Invoice No: SAME-1'", "'Supplier: Supplier 1 Ltd'", "'Qty Unit price'", "'Total: EUR 120.00'")
_SHAPES = (
    _lines("'INVOICE'", f"'Invoice No: INV-', {_K}", "parties, dates, 'PO No. PO-', cast(k AS string)", "'Qty Unit price Description'", "'Subtotal: ', cur, net_text", "'VAT 20% ', tax_text", _TOTAL),
    _lines("'INVOICE'", f"'Invoice Number ', {_K}, '/A'", f"'Vendor: Seller ', {_C}", "'Amount due ', cur, ' ', gross_text", "'Date ', d"),
    _lines("'CREDIT NOTE'", f"'CreditNoteNo.: ', {_K}", f"parties, 'referring to invoice INV-', {_K}", "'Subtotal ', net_text", "'TOTAL VAT ', tax_text", "'TOTAL', cur, ' ', gross_text"),
    _lines("'DELIVERY NOTE'", f"'Delivery No: D-', {_K}", "'Waybill of ', d", "'Pieces: ', cast(k % 50 AS string)"),
    _lines("'REMINDER'", "'Dunning letter, your payment of ', d, ' is late'"),
    _lines("'Donation and Sponsorship form'", "'Requestor: office ', cast(k % 9 AS string)", "'Group CFO: yes'", _TOTAL),
    "''",
    _lines("'INVOICE'", f"'Invoice No: INV-', {_K}", "parties, 'Packing list'", _TOTAL),
    _lines("'INVOICE'", f"'Invoice No: INV-', {_K}", "'Supplier: Ship to'", f"'Bill To: Customer ', {_C}", "'Qty Unit price'", _TOTAL),
    _lines("'INVOICE'", f"'Invoice Number ', {_K}, '/B'", f"'Vendor: Seller ', {_C}", "'Payment terms: Net 14'", "'Quantity one at ', cur, ' ', gross_text"),
    _lines("'ARVE'", f"'Arve nr: A-', {_K}", "'Müüja: Supplier ', cast(c % 9 + 1 AS string), ' Ltd'", "'Summa km-ta 20% ', net_text", "'KM 20% ', tax_text", "'Kokku: ', cur, ' ', gross_text"),
    _lines("'INVOICE'", f"'Invoice No: INV-', {_K}", f"'Bill To: Customer ', {_C}", "'Qty'", "'Total: ', gross_text"),
    _lines("'INVOICE'", f"'Invoice No: INV-', {_K}", "parties, 'Subtotal: ', cur, net_text", "'VAT 20% ', tax_text", "'Total: ', cur, ' ', net_text"),
    _lines("'vendor; vat; subtotal; quantity; nothing more'"),
    _lines("'Amount due ', cur, ' ', gross_text", "'VAT Qty'"),
    SAME,
)
_LINES = f"""
shown AS (SELECT *, {printed("net")} AS net_text, {printed("tax")} AS tax_text, {printed("gross")} AS gross_text FROM sums),
head AS (SELECT *, {_PARTIES} AS parties, {_DATES} AS dates FROM shown),
doc AS (
  SELECT k, c, d, shape, loc, cur, net, tax, gross, CASE shape {" ".join(f"WHEN {i} THEN {text}" for i, text in enumerate(_SHAPES))} END AS text
  FROM head)
"""

WITH = "WITH " + _BASE + _LINES


def spark_sql(text: str) -> str:
    return text.replace("{div}", "div")


def duck_sql(text: str, **tables: str) -> str:
    out = text.replace("{div}", "//")
    for name in ("orders", *tables):
        out = out.replace("{" + name + "}", tables.get(name, name))
    return out


def documents(spark: SparkSession, orders: DataFrame) -> DataFrame:
    """``k, c, d, shape, loc, cur, net, tax, gross, text`` per order; amounts in cents."""
    return spark.sql(spark_sql(WITH) + " SELECT * FROM doc", orders=orders)
