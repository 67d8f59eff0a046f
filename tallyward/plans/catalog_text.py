"""Queries on texts: sufficiency, segments, classification, extraction and routing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions import vocabulary as v
from ..operators import classify, extract, segment
from ..operators.shared import fixed
from . import rendered
from .catalog_money import table
from .pipeline import NO_FACTS, NO_FIELDS, NO_STRUCTURE, read, report
from .twins import every, found, hit, re2, strip


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendered.documents(spark, table(spark, sf_dir, "orders"))


def text_sufficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a text is enough to go by; every fifth turn is reduced to its punctuation."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 5 == 4, F.regexp_replace("text", r"[\p{L}\p{N}]", "")).otherwise(F.col("text")).alias("text"))
    return rows.select("conv_id", "turn", t.sufficient("text").alias("sufficient"))


def top_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(t.top_region("text"), 256).alias("top_sha256"))


_PAGES = """
SELECT conv_id AS doc_id, turn AS page_number, CASE CAST(turn % 4 AS INT) WHEN 0 THEN concat('INVOICE', chr(10), 'Invoice No: ', CAST(conv_id AS STRING), '-', CAST(turn AS STRING), chr(10), text)
  WHEN 2 THEN concat('Delivery note', chr(10), 'Delivery No: ', CAST(turn AS STRING), chr(10), text) WHEN 3 THEN '' ELSE text END AS text
FROM (SELECT conv_id, turn, min(coalesce(text, '')) AS text FROM {conversations} GROUP BY conv_id, turn) q
"""


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_PAGES, conversations=table(spark, sf_dir, "conversations"))


def segment_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.boundaries(_pages(spark, sf_dir)).select("doc_id", "page_number", "opens", F.array_join("titles", "|").alias("titles"), F.array_join("ids", "|").alias("ids"))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.segments(_pages(spark, sf_dir)).select(
        "doc_id", "seg_no", F.array_join(F.transform("page_numbers", lambda x: x.cast("string")), ",").alias("pages"), "role_hint", "confidence", F.sha2("text", 256).alias("text_sha256"))


def classify_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.signals(_docs(spark, sf_dir)).select(
        "k", "signals.positive", "signals.negative", "signals.credit", "signals.reversal", "signals.governance", F.size("signals.evidence").alias("n_evidence"))


def classify_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.classified(_docs(spark, sf_dir)).select("k", "classification.doc_class", "classification.doc_type", "classification.confidence", "classification.reason")


def classify_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus's own documents, which are no invoices."""
    return (classify.classified(table(spark, sf_dir, "documents").select("doc_id", "text")).groupBy("classification.doc_class")
            .agg(F.count(F.lit(1)).alias("n")).select("doc_class", "n"))


def _read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(_docs(spark, sf_dir))


def decline_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each rendered document leaves the pipeline before the masters."""
    return _read(spark, sf_dir).select(
        "k", F.coalesce("early.doc_type", F.lit("")).alias("doc_type"), F.coalesce("early.reason", F.lit("")).alias("reason"), F.col("early").isNull().alias("candidate"),
        F.coalesce("canonical.hypothesis", F.lit("")).alias("hypothesis"))


def disposition_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates and declines by document type, with subtotals."""
    return report(_read(spark, sf_dir).select(F.col("early").isNull().alias("booked"), F.coalesce("early.doc_type", F.lit("candidate")).alias("reason")))


def _fields(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    return extract.extracted(_docs(spark, sf_dir), only=names).select("k", *[f"fields.{n}" for n in names])


def extract_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fields(spark, sf_dir, "invoice_number", "po_number", "currency")


def extract_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fields(spark, sf_dir, "invoice_date_raw", "due_date_raw", "payment_term_text")


def extract_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fields(spark, sf_dir, "supplier_name", "buyer_name", "supplier_vat_id", "supplier_country", "buyer_country")


def extract_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fields(spark, sf_dir, "gross_total_raw", "subtotal_raw", "confidence_notes").withColumn("notes", F.array_join("confidence_notes", "; ")).drop("confidence_notes")


def extract_taxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fields(spark, sf_dir, "header_taxes_raw").select("k", F.coalesce(F.array_join(F.transform("header_taxes_raw", lambda x: F.concat_ws(
        "/", x["tax_type"], x["tax_rate_raw"], x["tax_amount_raw"])), ";"), F.lit("")).alias("taxes"))


def payload_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A payload to JSON and back: its scalars, and the number of its lines and taxes."""
    rows = _read(spark, sf_dir).select("k", F.col("canonical.payload").alias("p"))
    kind = rows.schema["p"].dataType
    sent = fixed(rows, "body", F.to_json("p")).where("body is not null")
    back = sent.select("k", "body", F.from_json("body", kind).alias("q"))
    return back.select("k", F.col("q.invoice_type").alias("invoice_type"), F.col("q.currency").alias("currency"), F.col("q.gross_total").alias("gross_total"), F.size("q.line_items").alias("n_lines"),
                       F.size("q.taxes").alias("n_taxes"), (F.to_json("q") == F.col("body")).alias("same"))


QUERIES = {f.__name__: f for f in (
    text_sufficiency, top_region, segment_boundaries, segments, classify_score, classify_verdict, classify_documents, decline_route, disposition_report, extract_identity, extract_dates, extract_parties,
    extract_amounts, extract_taxes, payload_roundtrip)}

_DOC = rendered.duck_sql(rendered.WITH)
_STICKY = v.STICKY_CODES
_GLUE = (f"regexp_replace(regexp_replace(regexp_replace({strip('text')}, '\\b({_STICKY})(\\d)', '\\1 \\2', 'g'), '(\\d)({_STICKY})\\b', '\\1 \\2', 'g'), "
         f"'(?i)\\b(total|subtotal|amount|sum)({_STICKY})\\b', '\\1 \\2', 'g')")
_D = f"{_DOC}, g AS (SELECT *, {strip('text')} AS t FROM doc), u AS (SELECT *, {_GLUE} AS x FROM doc)"



def _sum(rows, weight) -> str:
    return " + ".join(f"CASE WHEN {hit('t', r[-1])} THEN {weight(r)} ELSE 0 END" for r in rows)


_GOVERNANCE = f"len(list_distinct(list_transform({every('t', v.GOVERNANCE)}, lambda z: lower(z))))"
def _signals(before: str) -> str:
    """Scores and the deciding rung of the ladder, over a common table ``g (k, t, …)``."""
    return (f"{before}, s AS (SELECT *, {_sum(v.POSITIVE, lambda r: r[1])} AS positive, {_sum(v.NEGATIVE, lambda r: 2)} AS negative, {hit('t', v.CREDIT[1])} AS credit, {hit('t', v.REVERSAL[1])} AS reversal, "
            f"{_GOVERNANCE} AS governance, {_sum(v.POSITIVE, lambda r: 1)} + {_sum((v.CREDIT, v.REVERSAL, v.MINUS), lambda r: 1)} + {_sum(v.NEGATIVE, lambda r: 1)} AS hits FROM g), "
            "c AS (SELECT *, CASE WHEN length(t) < 20 THEN 0 WHEN governance >= 2 THEN 1 WHEN credit AND negative = 0 AND (positive >= 1 OR reversal) THEN 2 WHEN positive >= 2 AND negative >= 2 THEN 3 "
            "WHEN negative >= 2 THEN 4 WHEN positive >= 3 THEN 5 ELSE 6 END AS rung FROM s)")


_SIGNALS = _signals(_D)
_CLASS = "CASE rung WHEN 1 THEN 'NON_PAYABLE' WHEN 2 THEN 'PAYABLE_CREDIT_MEMO' WHEN 4 THEN 'NON_PAYABLE' WHEN 5 THEN 'PAYABLE_INVOICE' ELSE 'AMBIGUOUS_UNSOLVABLE' END"
_TYPE = "CASE rung WHEN 1 THEN 'internal_approval_form' WHEN 2 THEN 'credit_memo' WHEN 4 THEN 'non_payable_document' WHEN 5 THEN 'invoice' ELSE 'unknown' END"


def quote(text: str) -> str:
    """A text as an SQL literal."""
    return "'" + text.replace("'", "''") + "'"


def _name_of(pattern: str) -> str:
    """A captured name in SQL: labels that stand where names do are none."""
    raw = f"nullif(regexp_extract(x, {re2(pattern)}, 1), '')"
    labels = ", ".join(map(quote, v.NOT_NAMES))
    return f"CASE WHEN lower({strip(raw)}) NOT IN ({labels}) THEN regexp_replace({strip(raw)}, '[,.]+$', '') END"


def _plain_number(x: str) -> str:
    """SQL for a printed number of the rendered texts as a decimal."""
    return (f"CAST(CASE WHEN {x} NOT LIKE '%.%' AND regexp_matches({x}, '^[^,]*,[^,]{{1,2}}$') THEN replace({x}, ',', '.') ELSE replace({x}, ',', '') END AS DECIMAL(18,2))")


_VATS = f"list_filter({every('x', v.VAT_ID, 1)}, lambda z: regexp_matches(z, '\\d'))"
_RATED = {group: every("x", v.RATED_TAX, group) for group in (1, 2, 3)}
#: Fields over a common table ``u (x, …)``: what the extraction finds, as SQL computes it from the text.
_FIELDS = f"""f0 AS (
  SELECT *, {found('x', v.INVOICE_NUMBER)} AS invoice_number, {found('x', v.ORDER_NUMBER)} AS po_number, {found('x', v.CODE)} AS currency, {_name_of(v.SUPPLIER)} AS supplier_name,
         {_name_of(v.BUYER)} AS buyer_name, {_VATS} AS vats, {found('x', v.INVOICE_DATE)} AS dated, {found('x', v.DUE_DATE)} AS due_date_raw, list_distinct({every('x', v.DATES)}) AS all_dates,
         trim({found('x', v.TERMS)}) AS payment_term_text, {found('x', v.TOTAL)} AS labelled,
         list_transform(list_zip({every('x', v.ANY_AMOUNT, 1)}, {every('x', v.ANY_AMOUNT, 2)}), lambda z: coalesce(nullif(z[1], ''), z[2]))[-1] AS last_amount,
         {found('x', v.SUBTOTAL)} AS subtotal, {_RATED[1]} AS kinds, {_RATED[2]} AS rates, {_RATED[3]} AS amounts, {found('x', v.TOTAL_TAX, 1)} AS stated_kind, {found('x', v.TOTAL_TAX, 2)} AS stated,
         {found('x', v.NET_BASE)} AS net_base, {found('x', v.KM_RATE, 1)} AS km_rate, {found('x', v.KM_RATE, 2)} AS km_tax
  FROM u),
f AS (
  SELECT *, coalesce(dated, CASE WHEN due_date_raw IS NULL AND len(all_dates) = 1 THEN all_dates[1] END) AS invoice_date_raw, coalesce(labelled, last_amount) AS gross_total_raw,
         vats[1] AS supplier_vat_id, nullif(regexp_extract(vats[1], '^([A-Z]{{2}})', 1), '') AS supplier_country,
         CASE WHEN buyer_name IS NOT NULL THEN nullif(regexp_extract(vats[2], '^([A-Z]{{2}})', 1), '') END AS buyer_country,
         subtotal IS NULL AND len(kinds) = 0 AND net_base IS NOT NULL AND km_rate IS NOT NULL AS pair,
         CASE WHEN subtotal IS NULL AND len(kinds) = 0 AND km_rate IS NOT NULL THEN net_base ELSE subtotal END AS subtotal_raw FROM f0)"""
_FOUND = f"{_D}, {_FIELDS}"
#: Per text its class, the fields, the amounts, and why it doesn't become a candidate ("" if it does).
_CLASS_REASON = "CASE rung " + " ".join(f"WHEN {rung} THEN {quote(classify.REASONS[name])}" for rung, name in enumerate(("short", "governance", "credit", "conflict", "other", "invoice", "weak"))) + " END"
READ = f"""{_SIGNALS}, {_FIELDS},
m AS (
  SELECT f.*, rung, {_TYPE} AS doc_type, {_CLASS} AS doc_class, {_CLASS_REASON} AS class_reason, {_plain_number('gross_total_raw')} AS g, {_plain_number('subtotal_raw')} AS s,
         {_plain_number("CASE WHEN pair THEN km_tax WHEN len(kinds) > 0 THEN nullif(amounts[1], '') WHEN subtotal IS NOT NULL THEN stated END")} AS t,
         coalesce(invoice_number, po_number, currency, invoice_date_raw, due_date_raw, supplier_name, buyer_name, supplier_vat_id, payment_term_text, gross_total_raw, subtotal_raw) IS NOT NULL
         OR len(kinds) > 0 AS any_field
  FROM f JOIN (SELECT k AS class_k, rung FROM c) ON k = class_k),
r AS (
  SELECT *, s IS NOT NULL AND t IS NOT NULL AS structured,
         CASE WHEN rung NOT IN (2, 5) THEN class_reason WHEN NOT any_field THEN {quote(NO_FIELDS)} WHEN g IS NULL THEN {quote(NO_FACTS)}
              WHEN s IS NOT NULL AND t IS NOT NULL AND s + t <> g THEN {quote(NO_STRUCTURE)} ELSE '' END AS reason
  FROM m)"""
_TOPS = "array_to_string(list_filter(string_split_regex(text, '\\r\\n|[\\n\\r]'), lambda z: regexp_matches(z, '\\S'))[1:8], chr(10))"
_SEG = (f"WITH p AS (SELECT *, {_TOPS} AS top FROM ({_PAGES.replace('{conversations}', 'conversations')})), "
        f"q AS (SELECT *, list_sort(list_distinct(list_transform({every('top', v.TITLES)}, lambda z: upper(z)))) AS titles, list_sort(list_distinct(list_transform({every('top', v.IDENTITY)}, lambda z: lower(z)))) AS ids FROM p), "
        "l AS (SELECT *, lag(titles) OVER w AS tb, lag(ids) OVER w AS ib FROM q WINDOW w AS (PARTITION BY doc_id ORDER BY page_number)), "
        "b AS (SELECT *, coalesce(tb IS NOT NULL AND top <> '' AND (len(list_filter(titles, lambda z: NOT list_contains(tb, z))) > 0 OR (len(list_filter(ids, lambda z: NOT list_contains(ib, z))) > 0 AND len(titles) > 0)), false) AS opens FROM l)")


_TAXES = ("CASE WHEN pair THEN 'VAT/' || replace(km_rate, ',', '.') || '/' || coalesce(km_tax, '') WHEN len(kinds) > 0 THEN array_to_string(list_transform(list_zip(kinds, rates, amounts), "
          "lambda z: CASE WHEN upper(z[1]) = 'TAX' THEN 'VAT' ELSE upper(z[1]) END || '/' || replace(z[2], ',', '.') || '/' || coalesce(z[3], '')), ';') "
          "WHEN subtotal IS NOT NULL AND stated IS NOT NULL THEN upper(stated_kind) || '//' || stated ELSE '' END")
ORACLE_SQL = {
    "text_sufficiency": "SELECT conv_id, turn, length(s) >= 15 AND coalesce(length(regexp_replace(s, '[^\\p{L}\\p{N}]', '', 'g')) / nullif(length(regexp_replace(s, '\\s', '', 'g')), 0) >= 0.3, false) AS sufficient FROM ("
                        f"SELECT conv_id, turn, {strip('text')} AS s FROM (SELECT conv_id, turn, CASE WHEN turn % 5 = 4 THEN regexp_replace(coalesce(text, ''), '[\\p{{L}}\\p{{N}}]', '', 'g') ELSE coalesce(text, '') END AS text FROM conversations))",
    "top_region": f"SELECT doc_id, sha256({_TOPS.replace('text', 'coalesce(text, ' + repr('') + ')')}) AS top_sha256 FROM documents",
    "segment_boundaries": f"{_SEG} SELECT doc_id, page_number, opens, array_to_string(titles, '|') AS titles, array_to_string(ids, '|') AS ids FROM b",
    "segments": f"{_SEG}, n AS (SELECT *, sum(CAST(opens AS INT)) OVER (PARTITION BY doc_id ORDER BY page_number ROWS UNBOUNDED PRECEDING) + 1 AS seg_no FROM b), "
                "m AS (SELECT doc_id, seg_no, string_agg(CAST(page_number AS VARCHAR), ',' ORDER BY page_number) AS pages, coalesce(string_agg(nullif(text, ''), chr(10) ORDER BY page_number), '') AS text FROM n GROUP BY 1, 2) "
                "SELECT doc_id, CAST(seg_no AS BIGINT) AS seg_no, pages, CASE WHEN parts > 1 THEN 'detected_segment' ELSE 'whole_document' END AS role_hint, CASE WHEN parts > 1 THEN 0.6::DOUBLE ELSE 1.0::DOUBLE END AS confidence, "
                "sha256(text) AS text_sha256 FROM (SELECT *, max(seg_no) OVER (PARTITION BY doc_id) AS parts FROM m)",
    "classify_score": f"{_SIGNALS} SELECT k, CAST(positive AS INT) AS positive, CAST(negative AS INT) AS negative, credit, reversal, CAST(governance AS INT) AS governance, "
                      "CAST(hits + CASE WHEN governance >= 2 THEN 1 ELSE 0 END AS INT) AS n_evidence FROM c",
    "classify_verdict": f"{_SIGNALS} SELECT k, {_CLASS} AS doc_class, {_TYPE} AS doc_type, CASE rung WHEN 0 THEN 0.0 WHEN 1 THEN 0.85 WHEN 2 THEN 0.8 WHEN 3 THEN 0.3 WHEN 4 THEN 0.75 "
                        f"WHEN 5 THEN least(0.5::DOUBLE + 0.1::DOUBLE * positive, 0.95::DOUBLE) ELSE 0.2 END::DOUBLE AS confidence, {_CLASS_REASON} AS reason FROM c",
    "classify_documents": _signals(f"WITH g AS (SELECT doc_id AS k, {strip('coalesce(text, ' + repr('') + ')')} AS t FROM documents)") + f" SELECT {_CLASS} AS doc_class, count(*) AS n FROM c GROUP BY 1",
    "decline_route": f"{READ} SELECT k, CASE WHEN reason = '' THEN '' ELSE doc_type END AS doc_type, reason, reason = '' AS candidate, CASE WHEN reason = '' THEN 'baseline' ELSE '' END AS hypothesis FROM r",
    "disposition_report": f"{READ}, o AS (SELECT CASE WHEN reason = '' THEN 'booked' ELSE 'declined' END AS d, CASE WHEN reason = '' THEN 'candidate' ELSE doc_type END AS w FROM r) "
                          "SELECT coalesce(d, 'all') AS disposition, coalesce(w, 'all') AS reason, count(*) AS n FROM o GROUP BY ROLLUP (d, w)",
    "extract_identity": f"{_FOUND} SELECT k, invoice_number, po_number, currency FROM f",
    "extract_dates": f"{_FOUND} SELECT k, invoice_date_raw, due_date_raw, payment_term_text FROM f",
    "extract_parties": f"{_FOUND} SELECT k, supplier_name, buyer_name, supplier_vat_id, supplier_country, buyer_country FROM f",
    "extract_amounts": f"{_FOUND} SELECT k, gross_total_raw, subtotal_raw, CASE WHEN x = '' THEN 'no text available' WHEN labelled IS NULL AND last_amount IS NOT NULL "
                       "THEN 'gross_total_raw is the last amount of the text: low confidence' ELSE '' END AS notes FROM f",
    "extract_taxes": f"{_FOUND} SELECT k, {_TAXES} AS taxes FROM f",
    "facts_bridge": f"{READ} SELECT k, CASE WHEN g IS NOT NULL THEN CASE rung WHEN 2 THEN 'CREDIT_MEMO' ELSE 'INVOICE' END END AS invoice_type, CAST(CASE WHEN structured THEN s ELSE g END AS VARCHAR) AS unit_price, "
                    "CAST(CASE WHEN g IS NOT NULL THEN CASE WHEN structured THEN 1 ELSE 0 END END AS INT) AS n_taxes, CAST(g AS VARCHAR) AS stated_gross FROM r WHERE rung IN (2, 5)",
    "payload_roundtrip": f"{READ} SELECT k, CASE rung WHEN 2 THEN 'CREDIT_MEMO' ELSE 'INVOICE' END AS invoice_type, coalesce(currency, '') AS currency, CAST(g AS VARCHAR) AS gross_total, CAST(1 AS INT) AS n_lines, "
                         "CAST(CASE WHEN structured THEN 1 ELSE 0 END AS INT) AS n_taxes, true AS same FROM r WHERE reason = ''",
}
