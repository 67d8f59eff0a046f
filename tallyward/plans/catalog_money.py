"""Queries on amounts: the recomputed gross, reconciliation, structures tried, and printed values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions import values as n
from ..operators import classify, erp, extract, model, rules
from ..operators.shared import fixed, spread
from . import rendered
from .twins import collapse, money


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents_text(cents: Column) -> Column:
    """Cents as a text with a decimal point."""
    return F.concat(F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as the texts of a payable's lines: every third has a discount by amount, every fourth a stated tax."""
    item, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    cents = F.round(F.col("p_retailprice") * 100).cast("bigint")
    by_amount, stated = F.col("l_linenumber") % 3 == 1, F.col("l_linenumber") % 4 == 2
    return item.join(part, item["l_partkey"] == part["p_partkey"]).select(
        "l_orderkey", "l_linenumber", model.struct_of(
            model.LINE, item_type=F.lit("GOODS"), quantity=F.col("l_quantity").cast("int").cast("string"), unit_price=cents_text(cents),
            discount=F.when(by_amount, F.lit("5.50")).otherwise(F.lit("")),
            discount_percentage=F.when(by_amount, F.lit("")).otherwise(F.round(F.col("l_discount") * 100).cast("int").cast("string")),
            tax_rate=F.round(F.col("l_tax") * 100).cast("int").cast("string"), tax_amount=F.when(stated, F.lit("1.25")).otherwise(F.lit(""))).alias("line"))


_L = f"""
WITH i AS (
  SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS INT) AS DOUBLE) AS q, CAST(round(p_retailprice * 100) AS BIGINT) / 100 AS p,
         CAST(CAST(round(p_retailprice * 100) AS BIGINT) // 100 AS VARCHAR) || '.' || lpad(CAST(CAST(round(p_retailprice * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0') AS p_text,
         CASE WHEN l_linenumber % 3 = 1 THEN 5.5::DOUBLE ELSE 0::DOUBLE END AS off, CASE WHEN l_linenumber % 3 = 1 THEN 0 ELSE CAST(round(l_discount * 100) AS INT) END AS pct,
         CAST(round(l_tax * 100) AS INT) AS rate, CASE WHEN l_linenumber % 4 = 2 THEN 1.25::DOUBLE ELSE 0::DOUBLE END AS stated
  FROM lineitem JOIN part ON l_partkey = p_partkey),
n AS (
  SELECT *, CASE WHEN pct > 0 THEN {money("q * p - q * p * pct / 100.0::DOUBLE")} WHEN off > 0 AND q <> 0 THEN {money("(p - off / abs(q)) * q")} ELSE {money("q * p")} END AS base FROM i),
x AS (SELECT *, CASE WHEN stated = 0 AND rate > 0 THEN {money("base * rate / 100.0::DOUBLE")} ELSE stated END AS tax FROM n)
"""


def erp_line_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", erp.line_base(F.col("line")).alias("base"))


def erp_line_tax(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("line")
    return _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", erp.line_taxes(line, erp.line_base(line)).alias("tax"))


def erp_header_tax(spark: SparkSession, sf_dir: str) -> DataFrame:
    tax = lambda rate: F.array(model.struct_of(model.TAX, tax_rate=rate), model.struct_of(model.TAX, tax_rate=F.lit("7"), tax_amount=F.lit("-3.00")))
    rate = (F.col("o_orderkey") % 5 * 5).cast("string")
    return table(spark, sf_dir, "orders").select("o_orderkey", erp.total_taxes(tax(rate), F.col("o_totalprice")).alias("tax"))


def _payables(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir).groupBy("l_orderkey").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    orders = table(spark, sf_dir, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    taxes = F.when(F.col("o_orderkey") % 2 == 0, F.array(model.struct_of(model.TAX, tax_rate=F.lit("5")))).otherwise(F.array().cast(f"array<{model.TAX}>"))
    facts = model.struct_of(model.FACTS, invoice_type=F.lit("INVOICE"), currency=F.lit("EUR"), line_items=F.coalesce("lines", F.array().cast(f"array<{model.LINE}>")),
                            header_taxes=taxes, discount_amount=F.lit("-2.00"), freight_charges=F.lit("10.00"), stated_gross=cents_text(cents))
    return orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left").select("o_orderkey", model.payload(facts).alias("p"))


# Doubles are added in the order in which Spark has sorted the lines: by their texts.
_ORDER = "CAST(CAST(q AS INT) AS VARCHAR), p_text, CASE WHEN off > 0 THEN '5.50' ELSE '' END, CASE WHEN off > 0 THEN '' ELSE CAST(pct AS VARCHAR) END, CAST(rate AS VARCHAR), CASE WHEN stated > 0 THEN '1.25' ELSE '' END"
_G = f"""{_L},
s AS (SELECT l_orderkey, list_reduce(list(base ORDER BY {_ORDER}), lambda a, b: a + b) AS net, list_reduce(list(tax ORDER BY {_ORDER}), lambda a, b: a + b) AS tax FROM x GROUP BY 1),
o AS (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, coalesce(net, 0) AS net, coalesce(tax, 0) AS tax FROM orders LEFT JOIN s ON o_orderkey = l_orderkey),
g AS (SELECT o_orderkey, cents, {money(f"net - 2.0::DOUBLE + tax + CASE WHEN o_orderkey % 2 = 0 THEN {money('(net - 2.0::DOUBLE) * 5 / 100.0::DOUBLE')} ELSE 0 END + 10.0::DOUBLE")} AS gross FROM o)
"""


def erp_gross(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: every order's gross recomputed from its lines, against the stated one."""
    p = F.col("p")
    return _payables(spark, sf_dir).withColumn("gross", erp.gross(p)).select(
        "o_orderkey", "gross", n.to_double(F.col("p.gross_total")).alias("stated"), erp.reconciles(F.col("gross"), F.col("p.gross_total")).alias("reconciles"))


def reconcile_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gross stated exactly, a cent off, unreadable, or blank by key."""
    k = F.col("o_orderkey") % 4
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    stated = F.when(k == 0, cents_text(cents)).when(k == 1, cents_text(cents + 1)).when(k == 2, F.lit("n/a")).otherwise(F.lit(""))
    line = F.array(model.line(cents_text(cents)))
    facts = model.struct_of(model.FACTS, line_items=line, stated_gross=stated)
    return table(spark, sf_dir, "orders").select("o_orderkey", model.payload(facts).alias("p")).select(
        "o_orderkey", erp.reconciles(erp.gross(F.col("p")), F.col("p.gross_total")).alias("reconciles"))


def charge_hypotheses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fee of 90.00 beside 7 % tax, with the gross stated for each structure in turn."""
    orders = table(spark, sf_dir, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    net = cents.cast("double") / 100
    tax = lambda base: F.round(F.round(base * 7 / 100.0, 2) * 100).cast("bigint")
    k = F.col("o_orderkey") % 4
    stated = F.when(k == 0, cents + 9000 + tax(net + 90.0)).when(k == 1, cents + 9000 + tax(net)).when(k == 2, cents + tax(net)).otherwise(F.lit(99999999999))
    facts = model.struct_of(model.FACTS, invoice_type=F.lit("INVOICE"), currency=F.lit("EUR"), line_items=F.array(model.line(cents_text(cents))),
                            header_taxes=F.array(model.struct_of(model.TAX, tax_rate=F.lit("7"))), stated_gross=cents_text(stated),
                            ambiguous_charges=F.array(F.struct(F.lit("90.00").alias("amount"), F.lit("fee").alias("description"))))
    return orders.select("o_orderkey", model.canonical(facts).alias("c")).select(
        "o_orderkey", F.coalesce("c.hypothesis", F.lit("irreconcilable")).alias("hypothesis"), F.coalesce(F.size("c.payload.line_items"), F.lit(0)).alias("n_lines"))


def credit_memo_signs(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    minus = F.concat(F.lit("-"), cents_text(cents))
    kind = F.when(F.col("o_orderkey") % 2 == 0, F.lit("CREDIT_MEMO")).otherwise(F.lit("INVOICE"))
    facts = model.struct_of(model.FACTS, invoice_type=kind, line_items=F.array(model.line(minus)), stated_gross=minus, discount_amount=F.lit("-1.00"))
    once = table(spark, sf_dir, "orders").select("o_orderkey", model.positive_credit(facts).alias("f"))
    return once.select("o_orderkey", F.col("f.stated_gross").alias("stated_gross"), F.get("f.line_items", F.lit(0))["unit_price"].alias("unit_price"),
                       F.col("f.discount_amount").alias("discount_amount"), (model.positive_credit(F.col("f")) == F.col("f")).alias("idempotent"))


def facts_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rendered.documents(spark, table(spark, sf_dir, "orders"))
    payable = classify.classified(docs.select("k", "text")).where(classify.payable(F.col("classification")))
    read = extract.extracted(payable, only=("currency", "gross_total_raw", "subtotal_raw", "header_taxes_raw"))
    return read.select("k", model.facts_of(F.col("fields"), F.col("classification.doc_class")).alias("x")).select(
        "k", F.col("x.invoice_type").alias("invoice_type"), F.get("x.line_items", F.lit(0))["unit_price"].alias("unit_price"), F.size("x.header_taxes").alias("n_taxes"),
        F.col("x.stated_gross").alias("stated_gross"))


#: Printed numbers by key % 14: the text around an amount of cents, and what it comes to; null where it is in doubt.
_NUMBERS = (
    ("w || '.' || p", "w || '.' || p"), ("w || ',' || p", "w || '.' || p"), ("'EUR ' || w || '.' || p", "w || '.' || p"), ("'(' || w || '.' || p || ')'", "'-' || w || '.' || p"),
    ("'-' || w || ',' || p", "'-' || w || '.' || p"), ("w || '.' || p || ' %'", "w || '.' || p"), ("'10,' || lpad(p, 3, '0')", None), ("'1.' || lpad(p, 3, '0') || '.' || lpad(p, 3, '0')", "'1' || lpad(p, 3, '0') || lpad(p, 3, '0')"),
    ("'1.' || lpad(p, 3, '0') || ',' || p", "'1' || lpad(p, 3, '0') || '.' || p"), ("'1,' || lpad(p, 3, '0') || '.' || p", "'1' || lpad(p, 3, '0') || '.' || p"), ("'abc' || w", None), ("''", "''"), ("'$' || w", "w"),
    ("'1,234,' || lpad(p, 3, '0')", None))


def _number_case(side: int) -> str:
    cells = " ".join(f"WHEN {i} THEN {row[side] if row[side] is not None else 'CAST(NULL AS STRING)'}" for i, row in enumerate(_NUMBERS))
    return f"CASE CAST(o_orderkey % {len(_NUMBERS)} AS INT) {cells} END"


_PARTS = "SELECT o_orderkey, CAST(c {div} 100 AS STRING) AS w, lpad(CAST(c % 100 AS STRING), 2, '0') AS p FROM (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM {orders}) q"


def normalize_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(rendered.spark_sql(f"SELECT o_orderkey, {_number_case(0)} AS raw FROM ({_PARTS}) s"), orders=table(spark, sf_dir, "orders"))
    return rows.select("o_orderkey", "raw", n.number("raw").alias("value"))


#: Printed dates by key % 8, from the order's year, month and day, and what they come to.
_DATES = (
    ("y || '-' || m || '-' || d", "iso"), ("d || '.' || m || '.' || y", "iso"), ("d || '-' || m || '-' || y", "iso"), ("d || '/' || m || '/' || y", "iso"), ("CAST(CAST(d AS INT) AS STRING) || ' March ' || y", "y || '-03-' || d"),
    ("d || '/' || m || '/' || CAST(CAST(y AS INT) + 543 AS STRING)", "iso"), ("'31.02.' || y", "y || '-02-31'"), ("m || ' of ' || y", None))
_DAYS = "SELECT o_orderkey, iso, substr(iso, 1, 4) AS y, substr(iso, 6, 2) AS m, substr(iso, 9, 2) AS d FROM (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS STRING) AS iso FROM {orders}) q"


def _date_case(side: int) -> str:
    cells = " ".join(f"WHEN {i} THEN {row[side] if row[side] is not None else 'CAST(NULL AS STRING)'}" for i, row in enumerate(_DATES))
    return f"CASE CAST(o_orderkey % {len(_DATES)} AS INT) {cells} END"


def normalize_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(rendered.spark_sql(f"SELECT o_orderkey, {_date_case(0)} AS raw FROM ({_DAYS}) s"), orders=table(spark, sf_dir, "orders"))
    return rows.select("o_orderkey", "raw", n.date("raw").alias("value"))


_CURRENCIES = (("EUR", "EUR"), ("usd", "USD"), ("€", "EUR"), ("£12.10", "GBP"), ("S$250.00", None), ("S$", "USD"), ("", ""), ("XYZ", None), ("5 ₹", "INR"))
_CURRENCY_ROWS = "CASE CAST(o_orderkey % 9 AS INT) " + " ".join(f"WHEN {i} THEN '{raw}'" for i, (raw, _) in enumerate(_CURRENCIES)) + " END"


def normalize_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_CURRENCY_ROWS).alias("raw")).select("o_orderkey", "raw", n.currency("raw").alias("value"))


def normalize_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comparison keys of names, tax numbers, order numbers, terms and countries; some in full-width letters, or with letters that fold to two."""
    c = table(spark, sf_dir, "customer")
    wide = F.col("c_custkey") % 3 == 0
    name = F.concat(F.when(wide, F.lit("  Ｓｔｒａße ")).otherwise(F.lit("  ")), "c_name", F.lit(",  Ltd. "))
    return c.select("c_custkey", t.name_key(name).alias("name_key"), t.vat_key(F.concat(F.when(wide, F.lit("ｅｅ　１０-")).otherwise(F.lit("ee 10-")), F.col("c_custkey").cast("string"))).alias("vat_key"),
                    t.order_key(F.concat(F.lit(" po-"), F.col("c_custkey").cast("string"), F.lit(" /a  b"))).alias("order_key"),
                    t.term_key(F.concat(F.lit("Net. "), (F.col("c_custkey") % 90).cast("string"), F.lit("  Days."))).alias("term_key"), t.country_key(F.lit(" ee ")).alias("country_key"))


def printed_forms_grounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a plain gross is in the rendered text in any printed form."""
    docs = rendered.documents(spark, table(spark, sf_dir, "orders"))
    plain = cents_text(F.col("gross"))
    return docs.select("k", F.size(n.printed_forms(plain)).alias("n_forms"), F.exists(n.printed_forms(plain), lambda x: F.contains("text", x)).alias("grounded"))


def line_sanity(spark: SparkSession, sf_dir: str) -> DataFrame:
    item, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return item.join(part, item["l_partkey"] == part["p_partkey"]).select(
        "l_orderkey", "l_linenumber", extract.line_agrees(F.col("l_quantity"), F.col("p_retailprice"), F.col("l_extendedprice")).alias("agrees"))


def ocr_glue(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rendered.documents(spark, table(spark, sf_dir, "orders"))
    return docs.select("k", extract.unglued(F.replace("text", F.lit(" "), F.lit(""))).alias("repaired"))


#: Payables by key: a good one, and as many with a defect.
DEFECTS = 13


def adjudicate_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One defect by key put into an otherwise good payable: its issues in order."""
    k = F.col("o_orderkey") % DEFECTS
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    good = cents_text(cents)
    bad = lambda i, wrong, right: F.when(k == i, wrong).otherwise(right)
    kind = bad(1, F.lit("RECEIPT"), bad(8, F.lit("CREDIT_MEMO"), F.lit("INVOICE")))
    price = bad(8, F.concat(F.lit("-"), good), good)
    tax = F.array(model.struct_of(model.TAX, tax_type=F.lit("VAT"), tax_rate=bad(9, F.lit("150"), F.lit("0")), tax_amount=bad(9, F.lit("0.00"), F.lit("0.00"))))
    line = model.struct_of(model.LINE, item_type=bad(2, F.lit("GIFT"), F.lit("SERVICE")), quantity=F.lit("1"), unit_price=price, total=price)
    gross = bad(8, F.concat(F.lit("-"), good), bad(10, cents_text(cents + 1), bad(9, cents_text(cents + F.round(F.round(cents.cast("double") / 100 * 150 / 100.0, 2) * 100).cast("bigint")), good)))
    cells = {
        "invoice_type": kind, "currency": bad(7, F.lit(""), F.lit("EUR")), "line_items": F.array(line), "taxes": tax, "discount_amount": F.lit(""), "freight_charges": F.lit(""),
        "insurance_charges": F.lit(""), "extra_charges": F.lit(""), "excise_duties": F.lit(""), "gross_total": gross, "invoice_number": F.concat(F.lit("INV-"), F.col("o_orderkey").cast("string")),
        "invoice_date": F.lit(""), "due_date": F.lit(""),
        "supplier": F.struct(bad(6, F.lit("ACME"), F.lit("Other")).alias("name"), bad(5, F.lit("nobody"), F.lit("")).alias("supplier_id"), F.lit("").alias("address"), F.lit("").alias("vat_id")),
        "buyer": F.struct(F.lit("acme").alias("company_code"), F.lit("").alias("business_unit_code"), F.lit("").alias("location_code")), "payment_term_id": F.lit(""), "po_number": F.lit(""), "po_id": F.lit(""),
        "subtotal": bad(12, F.lit("x1"), F.lit("")), "total_tax_amount": F.lit("")}
    payable = F.struct(*[v.alias(x) for x, v in cells.items()])
    text = F.when(k == 3, F.lit("no amounts")).otherwise(F.concat(F.lit("INV-"), F.col("o_orderkey").cast("string"), F.lit(" total "), gross))
    fields = F.struct(F.when(k != 4, F.lit("INV")).alias("invoice_number"), F.lit(None).cast("string").alias("supplier_name"), F.lit(None).cast("string").alias("invoice_date_raw"), F.lit(None).cast("string").alias("subtotal_raw"))
    evidence = F.when(k == 11, F.array(F.lit("invoice identity pattern"))).when(k == 8, F.array(F.lit("Credit note"), F.lit("x"))).otherwise(F.array(F.lit("a"), F.lit("b")))
    cls = F.struct(bad(8, F.lit(classify.CREDIT_MEMO), F.lit(classify.INVOICE)).alias("doc_class"), evidence.alias("evidence"))
    known = {"supplier": k != 5, "unit": F.lit(True), "term": F.lit(True), "po": F.lit(True), "taxes": F.array().cast("array<string>")}
    # built once per row: each check mentions the payable
    cell = F.struct(payable.alias("p"), text.alias("text"), fields.alias("f"), cls.alias("c"), known["supplier"].alias("ks"))
    rows = fixed(spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey"), "x", cell).select("o_orderkey", "x.*")
    known["supplier"] = F.col("ks")
    return fixed(rows, "issues", rules.adjudicate(F.col("p"), F.col("f"), F.col("c"), F.col("text"), known)).select("o_orderkey", "issues")


def adjudicate_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adjudicate_defects(spark, sf_dir).select("o_orderkey", F.array_join(F.transform("issues", lambda x: x["check"]), ",").alias("checks"))


def adjudicate_first_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = rules.first_failure(F.col("issues"))
    return adjudicate_defects(spark, sf_dir).select("o_orderkey", F.coalesce(first["decline_reason"], F.lit("")).alias("decline_reason"), F.coalesce(first["check"], F.lit("")).alias("first_check"),
                                                    (rules.message(F.col("issues")) == "").alias("ok"))


QUERIES = {f.__name__: f for f in (
    erp_line_base, erp_line_tax, erp_header_tax, erp_gross, reconcile_exact, charge_hypotheses, credit_memo_signs, facts_bridge, normalize_number, normalize_date, normalize_currency, normalize_keys,
    printed_forms_grounded, line_sanity, ocr_glue, adjudicate_issues, adjudicate_first_failure)}

_DOC = rendered.duck_sql(rendered.WITH)


def _cents(x: str) -> str:
    """SQL for cents as a text with a decimal point."""
    return f"CAST({x} // 100 AS VARCHAR) || '.' || lpad(CAST({x} % 100 AS VARCHAR), 2, '0')"


def _months(x: str) -> str:
    """SQL for the number of a month's name."""
    return f"CASE lower({x}) " + " ".join(f"WHEN '{name}' THEN {number}" for name, number in n.MONTHS.items()) + " END"


def _symbols(x: str) -> str:
    """SQL branches for a currency sign at either end."""
    return " ".join(f"WHEN starts_with({x}, '{sign}') OR ends_with({x}, '{sign}') THEN '{code}'" for sign, code in n.CURRENCY_SYMBOLS.items())


def _plain(x: str) -> str:
    return rendered.duck_sql(rendered.plain(x))


_STICKY = "EUR|USD|GBP|CHF|THB|SGD|MYR|ZAR|KES|GHS|DKK|PLN|AUD|CAD|SEK|NOK|RON|VND|INR|JPY|GHC"
def _defects() -> str:
    """SQL for each order's payable with its defect, and the checks that fail on it in their order."""
    cents = "CAST(round(o_totalprice * 100) AS BIGINT)"
    tax = money("c / 100 * rate / 100.0::DOUBLE")
    checks = (
        ("schema.invoice_type", "kind NOT IN ('INVOICE', 'CREDIT_MEMO')"), ("schema.line_item_type", "item NOT IN ('GOODS', 'SERVICE', 'FREIGHT', 'TAX')"),
        ("schema.numeric_value", "subtotal <> '' AND TRY_CAST(subtotal AS DOUBLE) IS NULL"), ("groundedness.gross_total", "NOT contains(text, gross)"),
        ("groundedness.invoice_number", "NOT contains(text, 'INV-' || o_orderkey)"), ("evidence.minimum_corroboration", "number IS NULL"),
        ("classification.credit_memo_evidence", "kind = 'CREDIT_MEMO' AND len(list_filter(evidence, lambda e: contains(lower(e), 'credit'))) = 0"),
        ("classification.thin_invoice_evidence", "kind <> 'CREDIT_MEMO' AND len(evidence) < 2"), ("master_data.supplier_id", "supplier_id <> '' AND NOT known"),
        ("identity.supplier_equals_buyer", "lower(name) = 'acme'"), ("financial.malformed_number", "subtotal <> '' AND TRY_CAST(subtotal AS DOUBLE) IS NULL"), ("financial.missing_currency", "currency = ''"),
        ("credit_memo.negative_gross", "kind = 'CREDIT_MEMO' AND CAST(gross AS DOUBLE) < 0"), ("credit_memo.negative_line_amount", "kind = 'CREDIT_MEMO' AND CAST(price AS DOUBLE) < 0"),
        ("tax.implausible_rate", "abs(rate) > 100"), ("erp.reconciliation", f"CAST(CAST(price AS DECIMAL(18,2)) + CAST({money('CAST(price AS DOUBLE) * rate / 100.0::DOUBLE')} AS DECIMAL(18,2)) AS DECIMAL(18,2)) <> CAST(gross AS DECIMAL(18,2))"))
    why = {"schema": "SCHEMA_VIOLATION", "groundedness": "GROUNDEDNESS_FAILURE", "evidence.minimum_corroboration": "INSUFFICIENT_EVIDENCE", "classification.credit_memo_evidence": "CONFLICTING_SIGNALS",
           "classification.thin_invoice_evidence": "INSUFFICIENT_EVIDENCE", "master_data": "MASTER_DATA_INVALID", "identity": "CONFLICTING_SIGNALS", "financial.malformed_number": "SCHEMA_VIOLATION",
           "financial.missing_currency": "INSUFFICIENT_EVIDENCE", "credit_memo": "BUSINESS_RULE_VIOLATION", "tax": "BUSINESS_RULE_VIOLATION", "erp": "ERP_MISMATCH_IRRECONCILABLE"}
    failed = ", ".join(f"CASE WHEN {bad} THEN '{name}' END" for name, bad in checks)
    reasons = " ".join(f"WHEN '{name}' THEN '{why.get(name) or why[name.split('.')[0]]}'" for name, _ in checks)
    return f"""
WITH c AS (SELECT o_orderkey, o_orderkey % {DEFECTS} AS k, {cents} AS c, CASE WHEN o_orderkey % {DEFECTS} = 9 THEN 150 ELSE 0 END AS rate FROM orders),
g AS (SELECT *, {_cents('c')} AS good, {_cents('(c + 1)')} AS more, c + CAST(round({tax} * 100) AS BIGINT) AS taxed FROM c),
p AS (
  SELECT *, CASE k WHEN 1 THEN 'RECEIPT' WHEN 8 THEN 'CREDIT_MEMO' ELSE 'INVOICE' END AS kind, CASE k WHEN 2 THEN 'GIFT' ELSE 'SERVICE' END AS item, CASE k WHEN 12 THEN 'x1' ELSE '' END AS subtotal,
         CASE k WHEN 8 THEN '-' || good WHEN 9 THEN {_cents('taxed')} WHEN 10 THEN more ELSE good END AS gross, CASE k WHEN 8 THEN '-' || good ELSE good END AS price,
         CASE WHEN k <> 4 THEN 'INV' END AS number, CASE k WHEN 11 THEN ['invoice identity pattern'] WHEN 8 THEN ['Credit note', 'x'] ELSE ['a', 'b'] END AS evidence,
         CASE k WHEN 5 THEN 'nobody' ELSE '' END AS supplier_id, k <> 5 AS known, CASE k WHEN 6 THEN 'ACME' ELSE 'Other' END AS name, CASE k WHEN 7 THEN '' ELSE 'EUR' END AS currency FROM g),
t AS (SELECT *, CASE k WHEN 3 THEN 'no amounts' ELSE 'INV-' || o_orderkey || ' total ' || gross END AS text FROM p),
f AS (SELECT o_orderkey, list_filter([{failed}], lambda x: x IS NOT NULL) AS failed FROM t),
w AS (SELECT *, CASE failed[1] {reasons} ELSE '' END AS decline_reason FROM f)"""


ORACLE_SQL = {
    "erp_line_base": f"{_L} SELECT l_orderkey, l_linenumber, base FROM x",
    "erp_line_tax": f"{_L} SELECT l_orderkey, l_linenumber, tax FROM x",
    "erp_header_tax": f"SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN {money('o_totalprice * (o_orderkey % 5 * 5) / 100.0::DOUBLE')} ELSE 0 END - 3.0::DOUBLE AS tax FROM orders",
    "erp_gross": f"{_G} SELECT o_orderkey, gross, cents / 100 AS stated, CAST(gross AS DECIMAL(18,2)) = CAST(cents AS DECIMAL(18,2)) / 100 AS reconciles FROM g",
    "reconcile_exact": f"""
WITH p AS (
  SELECT o_orderkey, c, CASE o_orderkey % 4 WHEN 0 THEN {_cents('c')} WHEN 1 THEN {_cents('(c + 1)')} WHEN 2 THEN 'n/a' ELSE '' END AS stated
  FROM (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders))
SELECT o_orderkey, coalesce(TRY_CAST(stated AS DECIMAL(38,2)) = CAST(c AS DECIMAL(38,2)) / 100, false) AS reconciles FROM p""",
    "charge_hypotheses": f"""
WITH p AS (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders),
t AS (SELECT *, CAST(round({money("(c / 100 + 90.0::DOUBLE) * 7 / 100.0::DOUBLE")} * 100) AS BIGINT) AS with_fee, CAST(round({money("c / 100 * 7 / 100.0::DOUBLE")} * 100) AS BIGINT) AS without FROM p),
s AS (SELECT *, CASE o_orderkey % 4 WHEN 0 THEN c + 9000 + with_fee WHEN 1 THEN c + 9000 + without WHEN 2 THEN c + without ELSE 99999999999 END AS stated FROM t)
SELECT o_orderkey, CASE stated WHEN c + 9000 + with_fee THEN 'charge_taxed_together' WHEN c + 9000 + without THEN 'charge_post_tax' WHEN c + without THEN 'baseline' ELSE 'irreconcilable' END AS hypothesis,
       CAST(CASE stated WHEN c + 9000 + with_fee THEN 2 WHEN c + 9000 + without THEN 1 WHEN c + without THEN 1 ELSE 0 END AS INT) AS n_lines FROM s""",
    "credit_memo_signs": rendered.duck_sql(
        f"SELECT o_orderkey, s || a AS stated_gross, s || a AS unit_price, s || '1.00' AS discount_amount, true AS idempotent FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE '-' END AS s, "
        f"{rendered.plain('c')} AS a FROM (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders))"),
    "normalize_number": rendered.duck_sql(f"""
WITH r AS (SELECT o_orderkey, {_number_case(0)} AS raw FROM ({_PARTS})),
a AS (SELECT *, raw LIKE '(%)' AS parens, CASE WHEN raw LIKE '(%)' THEN raw[2:-2] ELSE raw END AS x FROM r),
b AS (SELECT *, trim(regexp_replace(regexp_replace(trim(regexp_replace(trim(x), '%$', '')), '^[€$£¥₹ ]+|[€$£¥₹ ]+$', '', 'g'), '^[A-Z]{{3}}\\s*|\\s*[A-Z]{{3}}$', '', 'g')) AS y FROM a),
c AS (SELECT *, parens OR y LIKE '-%' AS minus, replace(trim(regexp_replace(y, '^[-+]', '')), ' ', '') AS d FROM b),
e AS (
  SELECT *, CASE WHEN NOT regexp_matches(d, '^[0-9.,]+$') THEN NULL
                 WHEN contains(d, '.') AND regexp_matches(d, ',[^.]*$') THEN replace(replace(d, '.', ''), ',', '.')
                 WHEN contains(d, '.') AND contains(d, ',') THEN replace(d, ',', '')
                 WHEN regexp_matches(d, '^[^,]*,[^,]{{1,2}}$') THEN replace(d, ',', '.')
                 WHEN contains(d, ',') THEN NULL
                 WHEN regexp_matches(d, '\\..*\\.') THEN replace(d, '.', '') ELSE d END AS v FROM c)
SELECT o_orderkey, raw, CASE WHEN raw = '' THEN '' ELSE CASE WHEN minus THEN '-' ELSE '' END || v END AS value FROM e"""),
    "normalize_date": rendered.duck_sql(f"""
WITH r AS (SELECT o_orderkey, {_date_case(0)} AS raw FROM ({_DAYS})),
a AS (
  SELECT *, CASE WHEN regexp_matches(raw, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN [raw[1:4], raw[6:7], raw[9:10]]
                 WHEN regexp_matches(raw, '^\\d{{1,2}}[./-]\\d{{1,2}}[./-]\\d{{4}}$') THEN list_reverse(string_split(replace(replace(raw, '.', '-'), '/', '-'), '-'))
                 WHEN regexp_matches(raw, '^\\d{{1,2}} [A-Za-z]+ \\d{{4}}$') THEN [split_part(raw, ' ', 3), CAST({_months("split_part(raw, ' ', 2)")} AS VARCHAR), split_part(raw, ' ', 1)] END AS p FROM r),
b AS (SELECT *, CAST(p[1] AS INT) AS y, CAST(p[2] AS INT) AS m, CAST(p[3] AS INT) AS d FROM a)
SELECT o_orderkey, raw, CASE WHEN CASE WHEN y >= {n.ERA_FROM} THEN y - {n.ERA_YEARS} ELSE y END BETWEEN {n.YEARS[0]} AND {n.YEARS[1]} AND m BETWEEN 1 AND 12 AND d BETWEEN 1 AND 31
  THEN printf('%04d-%02d-%02d', CASE WHEN y >= {n.ERA_FROM} THEN y - {n.ERA_YEARS} ELSE y END, m, d) END AS value FROM b"""),
    "normalize_currency": f"""
WITH r AS (SELECT o_orderkey, {_CURRENCY_ROWS} AS raw FROM orders)
SELECT o_orderkey, raw, CASE WHEN trim(raw) = '' THEN '' WHEN upper(trim(raw)) IN ({", ".join(repr(c) for c in n.CURRENCY_CODES)}) THEN upper(trim(raw)) {_symbols("trim(raw)")} END AS value FROM r""",
    "normalize_keys": f"SELECT c_custkey, lower({collapse('CASE WHEN c_custkey % 3 = 0 THEN ' + repr('strasse ') + ' ELSE ' + repr('  ') + ' END || replace(c_name, ' + repr(',') + ', ' + repr(' ') + ') || ' + repr('   Ltd  '))}) AS name_key, 'EE10' || c_custkey AS vat_key, "
                      "'PO-' || c_custkey || ' /A B' AS order_key, 'net ' || (c_custkey % 90) || ' days' AS term_key, 'EE' AS country_key FROM customer",
    "printed_forms_grounded": f"{_DOC}, p AS (SELECT *, {_plain('gross')} AS plain, regexp_replace(CAST(gross // 100 AS VARCHAR), '(\\d)(\\d{{3}})$', '\\1,\\2') AS us FROM doc) "
                              "SELECT k, CAST(CASE WHEN gross >= 100000 THEN 4 ELSE 2 END AS INT) AS n_forms, contains(text, plain) OR contains(text, replace(plain, '.', ',')) "
                              "OR (gross >= 100000 AND (contains(text, us || right(plain, 3)) OR contains(text, replace(us, ',', '.') || ',' || right(plain, 2)))) AS grounded FROM p",
    "line_sanity": "SELECT l_orderkey, l_linenumber, (l_extendedprice = 0 AND l_quantity * p_retailprice = 0) OR abs(l_quantity * p_retailprice - l_extendedprice) <= 0.02::DOUBLE "
                   "OR (l_extendedprice <> 0 AND abs(l_quantity * p_retailprice - l_extendedprice) / abs(l_extendedprice) <= 0.01::DOUBLE) AS agrees FROM lineitem JOIN part ON l_partkey = p_partkey",
    "ocr_glue": f"{_DOC} SELECT k, regexp_replace(regexp_replace(regexp_replace(replace(text, ' ', ''), '\\b({_STICKY})(\\d)', '\\1 \\2', 'g'), '(\\d)({_STICKY})\\b', '\\1 \\2', 'g'), "
                f"'(?i)\\b(total|subtotal|amount|sum)({_STICKY})\\b', '\\1 \\2', 'g') AS repaired FROM doc",
    "adjudicate_issues": f"{_defects()} SELECT o_orderkey, array_to_string(failed, ',') AS checks FROM w",
    "adjudicate_first_failure": f"{_defects()} SELECT o_orderkey, decline_reason, coalesce(failed[1], '') AS first_check, len(failed) = 0 AS ok FROM w",
}
