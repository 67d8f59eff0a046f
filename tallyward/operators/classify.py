"""What a text is: weighted signals in one projection, and an ordered verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocabulary as v
from ..functions.text import strip
from .shared import fixed, spare

INVOICE, CREDIT_MEMO, NON_PAYABLE, AMBIGUOUS = "PAYABLE_INVOICE", "PAYABLE_CREDIT_MEMO", "NON_PAYABLE", "AMBIGUOUS_UNSOLVABLE"
CLASSES = (INVOICE, CREDIT_MEMO, NON_PAYABLE, AMBIGUOUS)
TYPE = "struct<doc_class:string,doc_type:string,reason:string,confidence:double,evidence:array<string>>"


# Why a text is of its class.
REASONS = {
    "short": "Insufficient extracted text to classify (render failed, empty scan, or no interpretable content).",
    "governance": ("Internal governance/compliance workflow vocabulary (multiple distinct signals) dominates — this is an internal approval form, not a supplier invoice, "
                   "regardless of any currency amount present."),
    "credit": "Credit note/memo vocabulary with supporting structural signals.",
    "conflict": "Conflicting payable and non-payable signals; declining to guess.",
    "other": "Non-payable vocabulary (delivery/customs/dunning/internal) dominates with no strong invoice structure.",
    "invoice": "Invoice identity plus supporting structural signals (totals/tax/line items/terms).",
    "weak": "Insufficient or too-weak signal to confidently classify.",
}
#: Evidence of a text that is too short.
SHORT_EVIDENCE = "text length below minimum evidence threshold"


def signals(rows: DataFrame, text: str = "text", name: str = "signals") -> DataFrame:
    """``rows`` with a struct of all signals of a text: its length, scores, flags, distinct governance phrases, and evidence in order.

    Each pattern is a column of its own, computed once.
    """
    x = spare(rows, "signal")
    c = lambda key: F.col(x + str(key))
    plain = rows.withColumn(x + "text", strip(F.coalesce(F.col(text), F.lit(""))))
    known = (*v.POSITIVE, v.CREDIT, v.REVERSAL, v.MINUS, *v.NEGATIVE)
    place = {row[0]: i for i, row in enumerate(known)}
    phrases = F.array_distinct(F.transform(F.regexp_extract_all(c("text"), F.lit(v.led(v.GOVERNANCE)), F.lit(0)), F.lower))
    hits = plain.withColumns({x + "phrases": F.size(phrases)} | {x + str(i): c("text").rlike(v.led(row[-1])) for i, row in enumerate(known)})
    hit = lambda row: c(place[row[0]])
    score = lambda found, weight: sum((F.when(hit(r), F.lit(weight(r))).otherwise(F.lit(0)) for r in found), F.lit(0))
    named = lambda found: [F.when(hit(r), F.lit(r[0])) for r in found]
    many = c("phrases")
    whole = F.struct(
        F.length(c("text")).alias("length"), score(v.POSITIVE, lambda r: r[1]).alias("positive"), score(v.NEGATIVE, lambda r: 2).alias("negative"),
        hit(v.CREDIT).alias("credit"), hit(v.REVERSAL).alias("reversal"), many.alias("governance"),
        F.array_compact(F.array(
            *named(v.POSITIVE), *named((v.CREDIT, v.REVERSAL, v.MINUS)), *named(v.NEGATIVE),
            F.when(many >= v.MIN_GOVERNANCE, F.concat(F.lit("internal governance/compliance workflow vocabulary ("), many.cast("string"), F.lit(" distinct phrases)"))))).alias("evidence"))
    return hits.select(*[F.col(f"`{k}`") for k in rows.columns if k.lower() != name.lower()], whole.alias(name))


def classified(rows: DataFrame, text: str = "text", name: str = "classification") -> DataFrame:
    """``rows`` with the classification struct of a text; the first rule that holds decides.

    Filters on it may follow: they don't evaluate the patterns again.
    """
    x = spare(rows, "class")
    s = F.col(x + "s")
    p, n = s["positive"], s["negative"]
    out = lambda cls, kind, reason, sure, evidence=s["evidence"]: F.struct(
        F.lit(cls).alias("doc_class"), F.lit(kind).alias("doc_type"), F.lit(REASONS[reason]).alias("reason"), sure.cast("double").alias("confidence"), evidence.alias("evidence")).cast(TYPE)
    ladder = (
        F.when(s["length"] < v.MIN_EVIDENCE_CHARS, out(AMBIGUOUS, "unknown", "short", F.lit(0.0), F.array(F.lit(SHORT_EVIDENCE))))
        .when(s["governance"] >= v.MIN_GOVERNANCE, out(NON_PAYABLE, "internal_approval_form", "governance", F.lit(0.85)))
        .when(s["credit"] & (n == 0) & ((p >= 1) | s["reversal"]), out(CREDIT_MEMO, "credit_memo", "credit", F.lit(0.8)))
        .when((p >= 2) & (n >= 2), out(AMBIGUOUS, "unknown", "conflict", F.lit(0.3)))
        .when(n >= 2, out(NON_PAYABLE, "non_payable_document", "other", F.lit(0.75)))
        .when(p >= 3, out(INVOICE, "invoice", "invoice", F.least(0.5 + 0.1 * p, F.lit(0.95))))
        .otherwise(out(AMBIGUOUS, "unknown", "weak", F.lit(0.2))))
    found = fixed(signals(rows, text, x + "s"), x + "s", s)
    return found.select(*[F.col(f"`{k}`") for k in rows.columns if k.lower() != name.lower()], ladder.alias(name))


def payable(classification: Column) -> Column:
    return classification["doc_class"].isin(INVOICE, CREDIT_MEMO)
