"""The battery of checks on a payable, in a fixed order; the first hard failure names the reason.

Each check is an array of issues built by column expressions.  ``payable`` is the
struct of :data:`plans.pipeline.PAYABLE`; its shape is enforced by the type, so of the
structural checks those on values remain.  :func:`shape_issues` checks raw JSON.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import values as n
from ..functions.text import let, listed, present, quoted, strip
from . import erp
from .classify import CREDIT_MEMO, INVOICE

ISSUE = "struct<check:string,reason:string,severity:string,decline_reason:string,field:string>"
ISSUES = f"array<{ISSUE}>"
HARD = "HARD_FAIL"
# The reasons for declining, and below the words of each issue.
REASONS = ("INSUFFICIENT_EVIDENCE", "CONFLICTING_SIGNALS", "UNBUILDABLE_FINANCIAL_FACTS", "NON_PAYABLE_DOCUMENT", "DUPLICATE_OF_BOOKED_PAYABLE",
           "ERP_MISMATCH_IRRECONCILABLE", "UNSUPPORTED_AMBIGUOUS_FORMAT", "MASTER_DATA_INVALID", "GROUNDEDNESS_FAILURE", "BUSINESS_RULE_VIOLATION", "SCHEMA_VIOLATION")
REQUIRED = ("invoice_number", "invoice_date", "due_date", "invoice_type", "currency", "supplier", "buyer", "payment_term_id", "po_number", "po_id", "gross_total", "subtotal",
            "total_tax_amount", "discount_amount", "freight_charges", "insurance_charges", "extra_charges", "excise_duties", "taxes", "line_items")
TYPES, ITEM_TYPES = ("INVOICE", "CREDIT_MEMO"), ("GOODS", "SERVICE", "FREIGHT", "TAX")
BARE_TOTAL = ("only a bare total-like number (and, at most, a currency code) was found — no invoice number, supplier name, date, or distinct subtotal to corroborate that "
              "this is genuinely a payable document")
TOP_NUMBERS = ("gross_total", "subtotal", "total_tax_amount", "discount_amount", "freight_charges", "insurance_charges", "extra_charges", "excise_duties")
LINE_NUMBERS = ("quantity", "unit_price", "total", "discount", "discount_percentage", "tax_rate", "tax_amount")


def issue(check: str, reason: Column | str, decline: str, field: Column | str = "") -> Column:
    return F.struct(F.lit(check).alias("check"), (reason if isinstance(reason, Column) else F.lit(reason)).alias("reason"), F.lit(HARD).alias("severity"), F.lit(decline).alias("decline_reason"),
                    (field if isinstance(field, Column) else F.lit(field)).alias("field")).cast(ISSUE)


def when(bad: Column, check: str, reason: Column | str, decline: str, field: Column | str = "") -> Column:
    """One issue if ``bad``, else none."""
    return F.when(F.coalesce(bad, F.lit(False)), F.array(issue(check, reason, decline, field))).otherwise(F.array().cast(ISSUES))


def joined(*parts: Column) -> Column:
    return F.flatten(F.array(*parts))


def _cells(whole: Column, names: tuple[str, ...], check: Callable[[Column, Column], Column]) -> Column:
    """Issues of ``check(value, name)``, of which plain numbers and blanks have none, for each of the cells in turn.

    The check stands in the plan once, however many cells there are, and isn't asked where one look tells that all are blank or digits.
    """
    text = F.concat(*[part for x in names for part in (F.coalesce(whole[x], F.lit("")), F.lit("\x00"))])
    plain = text.rlike(rf"^(?:(?:[0-9]+(?:\.[0-9]+)?)?\x00){{{len(names)}}}\z")
    cells = F.array(*[F.struct(whole[x].cast("string").alias("value"), F.lit(x).alias("name")) for x in names])
    return F.when(plain, F.array().cast(ISSUES)).otherwise(F.flatten(F.transform(cells, lambda c: check(c["value"], c["name"]))))


def said(*parts: Column | str) -> Column:
    """A reason made of fixed words and cells."""
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _at(place: str, i: Column, tail: str = "") -> Column:
    return F.concat(F.lit(f"{place}["), i.cast("string"), F.lit(f"]{tail}"))


def schema_issues(p: Column) -> Column:
    """Values of fixed sets, and texts where numbers belong."""
    bad_number = lambda v, where: when(~n.is_numeric(v), "schema.numeric_value", said(where, " not numeric: ", quoted(v)), "SCHEMA_VIOLATION", where)

    def of_line(line: Column, i: Column) -> Column:
        kind = when(present(line["item_type"]) & ~line["item_type"].isin(*ITEM_TYPES), "schema.line_item_type", said(_at("line_items", i), " invalid item_type: ", quoted(line["item_type"])),
                    "SCHEMA_VIOLATION", _at("line_items", i, ".item_type"))
        return joined(kind, _cells(line, LINE_NUMBERS, lambda v, x: bad_number(v, F.concat(_at("line_items", i, "."), x))))

    of_tax = lambda tax, i: _cells(tax, ("tax_rate", "tax_amount"), lambda v, x: bad_number(v, F.concat(_at("taxes", i, "."), x)))
    return joined(
        when(~F.coalesce(p["invoice_type"], F.lit("")).isin(*TYPES), "schema.invoice_type", said("invalid invoice_type: ", quoted(p["invoice_type"])), "SCHEMA_VIOLATION", "invoice_type"),
        F.flatten(F.transform(p["line_items"], of_line)), F.flatten(F.transform(p["taxes"], of_tax)), _cells(p, TOP_NUMBERS, bad_number))


def shape_issues(raw: Column | str) -> Column:
    """Structural issues of a payable as JSON text: missing keys, and parts that aren't objects or lists."""
    text = F.col(raw) if isinstance(raw, str) else raw
    keys = F.coalesce(F.json_object_keys(text), F.array().cast("array<string>"))
    missing = F.array_sort(F.array_except(F.array(*[F.lit(k) for k in REQUIRED]), keys))
    part = lambda name: F.get_json_object(text, f"$.{name}")
    lacks = lambda name, wanted: F.size(F.array_except(F.array(*[F.lit(k) for k in wanted]), F.coalesce(F.json_object_keys(part(name)), F.array().cast("array<string>")))) > 0
    return joined(
        when(F.size(missing) > 0, "schema.required_keys", said("missing top-level keys: ", listed(missing)), "SCHEMA_VIOLATION", F.array_join(missing, ",")),
        when(~F.coalesce(part("invoice_type"), F.lit("")).isin(*TYPES), "schema.invoice_type", said("invalid invoice_type: ", quoted(part("invoice_type"))), "SCHEMA_VIOLATION", "invoice_type"),
        when(lacks("supplier", ("name", "supplier_id", "address", "vat_id")), "schema.supplier_shape", said("malformed supplier object: ", F.coalesce(part("supplier"), F.lit("None"))), "SCHEMA_VIOLATION", "supplier"),
        when(lacks("buyer", ("company_code", "business_unit_code", "location_code")), "schema.buyer_shape", said("malformed buyer object: ", F.coalesce(part("buyer"), F.lit("None"))), "SCHEMA_VIOLATION", "buyer"),
        when(F.json_array_length(part("line_items")).isNull(), "schema.line_items_type", "line_items must be a list", "SCHEMA_VIOLATION", "line_items"),
        when(F.json_array_length(part("taxes")).isNull(), "schema.taxes_type", "taxes must be a list", "SCHEMA_VIOLATION", "taxes"))


def grounded(p: Column, text: Column) -> Column:
    """The gross, in a form it may have been printed in, and the invoice number must be in the text."""
    whole = F.coalesce(text, F.lit(""))
    seen = F.exists(n.printed_forms(p["gross_total"]), lambda form: F.contains(whole, form))
    return joined(
        when(present(p["gross_total"]) & ~seen, "groundedness.gross_total",
             said("gross_total ", quoted(p["gross_total"]), " not found in source text under any plausible printed number format"), "GROUNDEDNESS_FAILURE", "gross_total"),
        when(present(p["invoice_number"]) & ~F.contains(whole, p["invoice_number"]), "groundedness.invoice_number",
             said("invoice_number ", quoted(p["invoice_number"]), " not found in source text"), "GROUNDEDNESS_FAILURE", "invoice_number"))


def corroborated(fields: Column) -> Column:
    """A bare total isn't enough."""
    enough = present(fields["invoice_number"]) | present(fields["supplier_name"]) | present(fields["invoice_date_raw"]) | present(fields["subtotal_raw"])
    return when(~enough, "evidence.minimum_corroboration", BARE_TOTAL, "INSUFFICIENT_EVIDENCE")


def classification_consistent(classification: Column) -> Column:
    kind, evidence = classification["doc_class"], classification["evidence"]
    return joined(
        when((kind == CREDIT_MEMO) & ~F.exists(evidence, lambda e: F.lower(e).contains("credit")), "classification.credit_memo_evidence", "classified as a credit memo but no credit-memo vocabulary/evidence was recorded", "CONFLICTING_SIGNALS"),
        when((kind == INVOICE) & (F.size(evidence) < 2), "classification.thin_invoice_evidence", said("classified as an invoice on too little corroborating evidence: ", listed(evidence)), "INSUFFICIENT_EVIDENCE"))


def masters_valid(p: Column, known: dict[str, Column]) -> Column:
    """Identifiers that aren't blank must be in their masters; ``known`` has a flag per master and, as ``taxes``, the array of unknown tax codes."""
    def bad(value: Column, flag: Column, name: str, master: str, field: str) -> Column:
        return when(present(value) & ~flag, f"master_data.{name}", said(f"{name} ", quoted(value), f" does not exist in {master}"), "MASTER_DATA_INVALID", field)

    return joined(
        bad(p["supplier"]["supplier_id"], known["supplier"], "supplier_id", "supplier master", "supplier.supplier_id"),
        bad(p["buyer"]["business_unit_code"], known["unit"], "business_unit_code", "chart of books", "buyer.business_unit_code"),
        bad(p["payment_term_id"], known["term"], "payment_term_id", "payment-terms master", "payment_term_id"),
        bad(p["po_id"], known["po"], "po_id", "PO master", "po_id"),
        F.transform(known["taxes"], lambda code: issue("master_data.tax_type_code", said("tax_type_code ", quoted(code), " does not exist in tax master"), "MASTER_DATA_INVALID", "taxes[].tax_type_code")))


def parties_differ(p: Column) -> Column:
    name = lambda x: strip(F.coalesce(x, F.lit("")))
    ascii_only = lambda x: F.octet_length(x) == F.length(x)
    # lower case, which takes long, is asked only of names that it may make equal: those of ASCII letters keep their lengths
    differ = lambda a, b: ascii_only(a) & ascii_only(b) & (F.length(a) != F.length(b))
    both = F.struct(name(p["supplier"]["name"]).alias("mine"), name(p["buyer"]["company_code"]).alias("theirs"))
    same = let(both, lambda x: present(x["mine"]) & ~differ(x["mine"], x["theirs"]) & (F.lower(x["mine"]) == F.lower(x["theirs"])))
    return when(same, "identity.supplier_equals_buyer",
                said("supplier and buyer identity are identical (", quoted(F.lower(name(p["supplier"]["name"]))), ") — likely a mislabeled document rather than a genuine transaction"), "CONFLICTING_SIGNALS")


def financially_sound(p: Column) -> Column:
    def of(value: Column, name: Column) -> Column:
        return joined(when(~n.is_numeric(value), "financial.malformed_number", said(name, "=", quoted(value), " is not a valid number"), "SCHEMA_VIOLATION", name),
                      when(n.not_finite(value), "financial.non_finite_number", said(name, "=", quoted(value), " is NaN/infinite"), "SCHEMA_VIOLATION", name))

    return joined(_cells(p, TOP_NUMBERS, of), when(~present(p["currency"]), "financial.missing_currency", "currency is blank on a payable", "INSUFFICIENT_EVIDENCE", "currency"))


def credit_positive(p: Column) -> Column:
    minus = lambda x: F.coalesce(n.to_double(x) < 0, F.lit(False))
    credit = p["invoice_type"] == "CREDIT_MEMO"
    lines = F.flatten(F.transform(p["line_items"], lambda line, i: when(
        minus(line["unit_price"]) | minus(line["total"]), "credit_memo.negative_line_amount", said(_at("line_items", i), " has a negative amount on a credit memo"), "BUSINESS_RULE_VIOLATION", _at("line_items", i))))
    return F.when(credit, joined(when(minus(p["gross_total"]), "credit_memo.negative_gross", "credit memo gross_total is negative; schema requires positive magnitudes", "BUSINESS_RULE_VIOLATION", "gross_total"), lines)).otherwise(
        F.array().cast(ISSUES))


def rates_plausible(p: Column) -> Column:
    def of(tax: Column, where: Column) -> Column:
        return let(n.to_double(tax["tax_rate"]), lambda rate: joined(
            when(present(tax["tax_rate"]) & rate.isNull(), "tax.malformed_rate", said(where, "=", quoted(tax["tax_rate"]), " not numeric"), "SCHEMA_VIOLATION", where),
            when((rate < -100) | (rate > 100), "tax.implausible_rate", said(where, "=", rate.cast("string"), " outside plausible range"), "BUSINESS_RULE_VIOLATION", where)))

    header = F.flatten(F.transform(p["taxes"], lambda x, i: of(x, _at("taxes", i, ".tax_rate"))))
    lines = F.flatten(F.transform(p["line_items"], lambda line, k: F.flatten(F.transform(
        line["taxes"], lambda x, i: of(x, F.concat(_at("line_items", k, ".taxes"), _at("", i, ".tax_rate")))))))
    return joined(header, lines)


def reconciled(p: Column) -> Column:
    return when(~erp.reconciles(erp.gross(p), p["gross_total"]), "erp.reconciliation",
                said("payload does not reconcile exactly to gross_total=", quoted(p["gross_total"])), "ERP_MISMATCH_IRRECONCILABLE", "gross_total")


def adjudicate(p: Column, fields: Column, classification: Column, text: Column, known: dict[str, Column]) -> Column:
    """All issues of a payable, in the fixed order of checks.

    Its arguments are mentioned hundreds of times: let them be columns that hold (:func:`operators.shared.fixed`), not expressions.
    """
    return joined(*(
        schema_issues(p), grounded(p, text), corroborated(fields), classification_consistent(classification), masters_valid(p, known),
        parties_differ(p), financially_sound(p), credit_positive(p), rates_plausible(p), reconciled(p)))


def first_failure(issues: Column) -> Column:
    """The first hard failure, null if there is none."""
    return F.get(F.filter(issues, lambda x: x["severity"] == HARD), F.lit(0))


def message(issues: Column) -> Column:
    """``REASON: check: detail`` of the first hard failure, "" if there is none."""
    told = let(first_failure(issues), lambda f: F.concat(f["decline_reason"], F.lit(": "), f["check"], F.lit(": "), f["reason"]))
    return F.coalesce(told, F.lit(""))
