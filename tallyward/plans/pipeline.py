"""The whole adjudication: pages in, one result per file out.

Narrow from segments to payloads, with joins against the masters; one shuffle by
file for the segments' window, a fixpoint for duplicates, and one shuffle by file
for the results.  Checks don't read the registry of duplicates, so they run before it;
a duplicate still outranks a failed check in the disposition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions import values as n
from ..operators import classify, dedupe, extract, match, model, rules, segment
from ..operators.shared import checkpointed, fixed, tasks

PAYABLE_FIELDS = (
    "invoice_type", "currency", "line_items", "taxes", "discount_amount", "freight_charges", "insurance_charges", "extra_charges", "excise_duties", "gross_total",
    "invoice_number", "invoice_date", "due_date", "supplier", "buyer", "payment_term_id", "po_number", "po_id", "subtotal", "total_tax_amount")
PAYABLE = (
    f"struct<invoice_type:string,currency:string,line_items:array<{model.LINE}>,taxes:array<{model.TAX}>,discount_amount:string,freight_charges:string,"
    "insurance_charges:string,extra_charges:string,excise_duties:string,gross_total:string,invoice_number:string,invoice_date:string,due_date:string,"
    "supplier:struct<name:string,supplier_id:string,address:string,vat_id:string>,buyer:struct<company_code:string,business_unit_code:string,location_code:string>,"
    "payment_term_id:string,po_number:string,po_id:string,subtotal:string,total_tax_amount:string>")
DUPLICATE_TYPE = "duplicate_payable"


@dataclass
class Masters:
    """The masters as frames, with the columns that :mod:`operators.match` names."""

    suppliers: DataFrame
    units: DataFrame
    taxes: DataFrame
    aliases: DataFrame
    days: DataFrame
    orders: DataFrame


# Why a payable never becomes a candidate.
NO_FIELDS = ("Classified as payable but no extractable fields (no stated gross total found in the available text) — no OCR/LLM vision available in this environment to interpret "
             "the scanned page. Declining rather than guessing.")
NO_FACTS = "Classified as payable but could not build financial facts (missing or unnormalizable stated gross total)."
NO_STRUCTURE = ("Could not reconcile a candidate payable against erp.py: No ambiguous charges to resolve, and the baseline structure does not reproduce the document's stated gross exactly.")


def read(segments: DataFrame) -> DataFrame:
    """``segments`` with ``classification, fields, facts, canonical, early``, each null past the first decline.

    early: ``struct<doc_type, reason>`` of what never becomes a candidate, null for candidates.  Patterns are columns computed
    once; nothing is searched in texts that aren't payable, nothing built where no field was found.
    """
    seen = classify.classified(segments)
    c, f, x, k = (F.col(name) for name in ("classification", "fields", "facts", "canonical"))
    found = extract.extracted(seen, condition=classify.payable(c))
    found = fixed(found, "fields", F.when(extract.any_field(f), f))
    built = fixed(found, "facts", F.when(f.isNotNull(), model.facts_of(f, c["doc_class"])))
    built = fixed(built, "canonical", F.when(x.isNotNull(), model.canonical(x)))
    entry = lambda reason: F.struct(c["doc_type"].alias("doc_type"), reason.alias("reason"))
    early = (F.when(~classify.payable(c), entry(c["reason"])).when(f.isNull(), entry(F.lit(NO_FIELDS))).when(x.isNull(), entry(F.lit(NO_FACTS))).when(k.isNull(), entry(F.lit(NO_STRUCTURE))))
    return built.select("*", early.alias("early"))


def resolve(candidates: DataFrame, masters: Masters, unicode: bool = True) -> DataFrame:
    """``candidates`` (with ``seq``) with ``payload``, the full payable, and ``known``, the flags of its identifiers."""
    f = lambda name: F.coalesce(F.col(f"fields.{name}"), F.lit(""))
    probe = candidates.select(
        F.col("seq").alias("probe_id"), f("supplier_name").alias("name"), f("supplier_vat_id").alias("vat_id"), f("supplier_country").alias("country"),
        f("buyer_country").alias("buyer_country"), F.lit("").alias("bu_code"), f("payment_term_text").alias("term_text"), f("po_number").alias("po_number"),
        n.optional(n.date(F.col("fields.invoice_date_raw"))).alias("invoice_date"), n.optional(n.date(F.col("fields.due_date_raw"))).alias("due_date"),
        f("currency").alias("currency"))
    # a payable carries an identifier or none, no scores
    found = match.supplier(probe, masters.suppliers, unicode=unicode, scores=False).withColumn("supplier_id", match.id_or_blank(F.col("supplier")))
    found = match.buyer(found, masters.units, unicode=unicode)
    found = match.payment_term(found, masters.aliases, masters.days, unicode=unicode)
    found = match.purchase_order(found, masters.orders, unicode=unicode)
    taxes = candidates.select(F.col("seq").alias("probe_id"), F.coalesce(F.nullif(f("supplier_country"), F.lit("")), f("buyer_country")).alias("country"),
                              F.posexplode("canonical.payload.taxes").alias("pos", "t"))
    coded = match.tax(taxes.select("probe_id", "pos", "country", F.col("t.tax_type").alias("tax_type"), n.to_double(F.col("t.tax_rate")).alias("rate"),
                                   F.col("t.tax_type_code").alias("tax_code"), "t"), masters.taxes, unicode=unicode)
    coded = (coded.groupBy("probe_id").agg(F.transform(F.array_sort(F.collect_list(F.struct(
        "pos", F.col("t").withField("tax_type_code", F.when(F.col("tax.status") == match.MATCHED, F.col("tax.matched_id")).otherwise(F.col("t.tax_type_code"))).alias("t")))),
        lambda x: x["t"]).alias("coded")))
    joined = candidates.join(found.drop("currency"), candidates["seq"] == found["probe_id"], "left").drop("probe_id").join(coded, F.col("seq") == coded["probe_id"], "left")
    base = F.col("canonical.payload")
    subtotal = n.optional(n.number(F.col("fields.subtotal_raw")))
    cells = {
        "taxes": F.coalesce(F.col("coded"), base["taxes"]), "invoice_number": f("invoice_number"), "invoice_date": F.col("invoice_date"), "due_date": F.col("due_date"),
        "supplier": F.struct(f("supplier_name").alias("name"), F.col("supplier_id").alias("supplier_id"), F.lit("").alias("address"), f("supplier_vat_id").alias("vat_id")),
        "buyer": F.struct("company_code", "business_unit_code", "location_code"), "payment_term_id": match.id_or_blank(F.col("term")),
        "po_number": f("po_number"), "po_id": match.id_or_blank(F.col("po")),
        "subtotal": F.when(base["invoice_type"] == "CREDIT_MEMO", n.magnitude(subtotal)).otherwise(subtotal), "total_tax_amount": F.lit("")}
    payload = F.struct(*[(cells[x] if x in cells else base[x]).alias(x) for x in PAYABLE_FIELDS]).cast(PAYABLE)
    checked, known = known_identifiers(fixed(joined, "payload", payload), masters)
    issues = rules.adjudicate(F.col("payload"), F.col("fields"), F.col("classification"), F.col("text"), known)
    return checked.withColumn("issues", issues).select(*candidates.columns, "payload", "issues")


def known_identifiers(rows: DataFrame, masters: Masters) -> tuple[DataFrame, dict[str, Column]]:
    """``rows`` with a flag per identifier of ``payload``, whether its master has it, and the tax codes that none has.

    Each master's distinct identifiers are joined once, broadcast if their counted rows are few.
    """
    p = F.col("payload")
    flags = {}
    for flag, value, ids in (
            ("supplier", p["supplier"]["supplier_id"], masters.suppliers.select("supplier_id")), ("unit", p["buyer"]["business_unit_code"], masters.units.select("business_unit_code")),
            ("term", p["payment_term_id"], masters.aliases.select("payment_term_id").unionByName(masters.days.select("payment_term_id"))), ("po", p["po_id"], masters.orders.select("po_id"))):
        name = f"known_{flag}"
        rows = match.exists(rows.withColumn("probed", value), "probed", ids.toDF("n"), "n", name).drop("probed")
        flags[flag] = F.col(name)
    codes = masters.taxes.select(F.col("code").alias("n"))
    lines = F.flatten(F.transform(F.coalesce(p["line_items"], F.array()), lambda line: F.coalesce(line["taxes"], F.array().cast(f"array<{model.TAX}>"))))
    used = F.array_distinct(F.transform(F.concat(F.coalesce(p["taxes"], F.array().cast(f"array<{model.TAX}>")), lines), lambda tax: tax["tax_type_code"]))
    rows = rows.withColumn("used_codes", F.filter(used, t.present))
    unknown = (match.exists(rows.select("seq", F.explode("used_codes").alias("probed")), "probed", codes, "n", "has").where(~F.col("has"))
               .groupBy("seq").agg(F.collect_set("probed").alias("unknown_codes")))
    rows = rows.join(unknown.withColumnRenamed("seq", "unknown_seq"), F.col("seq") == F.col("unknown_seq"), "left").drop("unknown_seq", "used_codes")
    return rows, flags | {"taxes": F.coalesce(F.col("unknown_codes"), F.array().cast("array<string>"))}


def adjudicate(pages: DataFrame, files: DataFrame, masters: Masters, unicode: bool = True) -> DataFrame:
    """``file, payables, declined`` for every one of ``files (file, sort_key, file_hash, render_error)``.

    ``pages (doc_id, page_number, text)`` are of files that could be opened; doc_id is the
    file's name.  A file that couldn't gets two empty arrays.
    """
    usable = files.where("render_error is null").select(F.col("file").alias("doc_id"), "sort_key", "file_hash")
    found = segment.without_pages(usable, segment.segments(pages.repartition(tasks(files.sparkSession), "doc_id")))
    rows = read(found.join(usable, "doc_id")).withColumn("seq", F.struct("sort_key", F.col("doc_id").alias("file"), "seg_no"))
    rows = checkpointed(rows)
    candidates = checkpointed(resolve(rows.where("early is null"), masters, unicode))
    identity = F.coalesce(F.nullif(F.col("payload.supplier.supplier_id"), F.lit("")), F.col("payload.supplier.name"))
    proof = dedupe.evidence(candidates.select(
        "seq", F.col("doc_id").alias("file"), "file_hash", F.col("text").alias("full_text"), identity.alias("supplier_identity"), "payload.invoice_number",
        "payload.invoice_date", "payload.currency", "payload.gross_total", rules.first_failure(F.col("issues")).isNull().alias("bookable")))
    verdicts = dedupe.settle(proof)
    judged = candidates.join(verdicts, "seq")
    late = (F.when(F.col("verdict") == dedupe.DUPLICATE, F.struct(F.lit(DUPLICATE_TYPE).alias("doc_type"), F.concat(
        F.lit(f"{dedupe.DUPLICATE}: "), dedupe.reason(F.col("payload.currency"), F.col("payload.gross_total"))).alias("reason")))
        .when(~F.col("booked"), F.struct(F.col("classification.doc_type").alias("doc_type"), rules.message(F.col("issues")).alias("reason"))))
    outcome = rows.where("early is not null").select("doc_id", "seg_no", F.lit(None).cast(PAYABLE).alias("payable"), F.col("early").alias("decline")).unionByName(
        judged.select("doc_id", "seg_no", F.when(F.col("booked"), F.col("payload")).alias("payable"), late.alias("decline")))
    return results(outcome, files)


def results(outcome: DataFrame, files: DataFrame) -> DataFrame:
    """Both arrays of each file in segment order; files without any outcome get empty ones."""
    ordered = lambda c: F.transform(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct("seg_no", F.col(c).alias("x"))))), lambda s: s["x"])
    grouped = outcome.groupBy("doc_id").agg(ordered("payable").alias("payables"), ordered("decline").alias("declined"))
    return files.join(grouped, files["file"] == grouped["doc_id"], "left").select(
        "file", F.coalesce("payables", F.array().cast(f"array<{PAYABLE}>")).alias("payables"),
        F.coalesce("declined", F.array().cast("array<struct<doc_type:string,reason:string>>")).alias("declined"))


def report(outcomes: DataFrame) -> DataFrame:
    """Counts of ``outcomes (booked, doc_type, reason)`` by disposition and reason, with subtotals."""
    kind = F.when(F.col("booked"), F.lit("booked")).otherwise(F.lit("declined"))
    return (outcomes.withColumn("disposition", kind).rollup("disposition", "reason").agg(F.count(F.lit(1)).alias("n"))
            .select(F.coalesce("disposition", F.lit("all")).alias("disposition"), F.coalesce("reason", F.lit("all")).alias("reason"), "n"))
