"""From extracted facts to a payable whose recomputed gross equals the stated one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import let, present
from ..functions.values import magnitude, number, optional
from . import erp

TAX = "struct<tax_type:string,tax_name:string,tax_rate:string,tax_amount:string,tax_type_code:string>"
LINE = (f"struct<description:string,item_type:string,uom:string,quantity:string,unit_price:string,total:string,discount:string,"
        f"discount_percentage:string,tax_rate:string,tax_amount:string,taxes:array<{TAX}>>")
CHARGE = "struct<amount:string,description:string>"
FACTS = (f"struct<invoice_type:string,currency:string,line_items:array<{LINE}>,header_taxes:array<{TAX}>,discount_amount:string,"
         f"freight_charges:string,insurance_charges:string,extra_charges:string,excise_duties:string,ambiguous_charges:array<{CHARGE}>,stated_gross:string>")
AMOUNTS = ("discount_amount", "freight_charges", "insurance_charges", "extra_charges", "excise_duties")
#: Structures tried for charges whose place is uncertain, in this order.
TOGETHER, AFTER_TAX, BASELINE = "charge_taxed_together", "charge_post_tax", "baseline"


def struct_of(type_: str, **given: Column) -> Column:
    """A struct of the type with the fields given, others blank or empty."""
    names = [f.split(":")[0] for f in _fields(type_)]
    kinds = dict(zip(names, (f.split(":", 1)[1] for f in _fields(type_)), strict=True))
    cells = []
    for name in names:
        value = given.get(name)
        if value is None:
            value = F.array().cast(kinds[name]) if kinds[name].startswith("array") else F.lit("")
        cells.append(value.cast(kinds[name]).alias(name))
    return F.struct(*cells)


def _fields(type_: str) -> list[str]:
    inner, depth, out, at = type_[len("struct<") : -1], 0, [], 0
    for i, c in enumerate(inner):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(inner[at:i])
            at = i + 1
    return [*out, inner[at:]]


def line(price: Column, **more: Column) -> Column:
    """A line of one unit."""
    return struct_of(LINE, item_type=F.lit("SERVICE"), quantity=F.lit("1"), unit_price=price, total=price, **more)


def positive_credit(facts: Column) -> Column:
    """Facts of a credit memo with all amounts as magnitudes; other facts as they are.  Twice does no more than once."""
    flip = lambda tax: tax.withField("tax_amount", magnitude(tax["tax_amount"]))
    flip_line = lambda x: (x.withField("unit_price", magnitude(x["unit_price"])).withField("total", magnitude(x["total"]))
                           .withField("discount", magnitude(x["discount"])).withField("tax_amount", magnitude(x["tax_amount"]))
                           .withField("taxes", F.transform(x["taxes"], flip)))
    out = (facts.withField("line_items", F.transform(facts["line_items"], flip_line))
           .withField("header_taxes", F.transform(facts["header_taxes"], flip))
           .withField("ambiguous_charges", F.transform(facts["ambiguous_charges"], lambda c: c.withField("amount", magnitude(c["amount"]))))
           .withField("stated_gross", magnitude(facts["stated_gross"])))
    for name in AMOUNTS:
        out = out.withField(name, magnitude(facts[name]))
    return F.when(facts["invoice_type"] == "CREDIT_MEMO", out).otherwise(facts)


def payload(facts: Column) -> Column:
    """The payable's financial part as facts state it."""
    return F.struct(
        facts["invoice_type"].alias("invoice_type"), facts["currency"].alias("currency"), facts["line_items"].alias("line_items"),
        facts["header_taxes"].alias("taxes"), *[facts[n].alias(n) for n in AMOUNTS], facts["stated_gross"].alias("gross_total"))


def candidates(facts: Column) -> Column:
    """The structures to try: ``array<struct<hypothesis, payload>>``."""
    base, charges = payload(facts), facts["ambiguous_charges"]
    extra = F.transform(charges, lambda c: line(c["amount"], description=c["description"]))
    together = base.withField("line_items", F.concat(base["line_items"], extra))
    added = F.aggregate(charges, erp.amount(base["extra_charges"]), lambda sum_, c: sum_ + erp.amount(c["amount"]))
    after = base.withField("extra_charges", added.cast("string"))
    named = lambda name, p: F.struct(F.lit(name).alias("hypothesis"), p.alias("payload"))
    return F.when(F.size(F.coalesce(charges, F.array().cast(f"array<{CHARGE}>"))) > 0, F.array(named(TOGETHER, together), named(AFTER_TAX, after), named(BASELINE, base))).otherwise(
        F.array(named(BASELINE, base)))


def canonical(facts: Column) -> Column:
    """``struct<hypothesis, payload>`` of the first structure that reproduces the stated gross; null if none does."""

    def first(fact: Column) -> Column:
        fits = lambda c: present(fact["stated_gross"]) & erp.reconciles(erp.gross(c["payload"]), fact["stated_gross"])
        return F.get(F.filter(candidates(fact), fits), F.lit(0))  # the filter's lambda is the only mention of each structure

    return let(positive_credit(facts), first)


def facts_of(fields: Column, doc_class: Column) -> Column:
    """Facts from extracted fields; null without a usable gross.

    A subtotal with at least one readable tax gives a net line and header taxes;
    otherwise one line carries the gross and taxes are left out.
    """
    taxes = F.filter(
        F.transform(F.coalesce(fields["header_taxes_raw"], F.array()), lambda t: struct_of(
            TAX, tax_type=t["tax_type"], tax_name=t["tax_type"], tax_rate=optional(number(t["tax_rate_raw"])),
            tax_amount=optional(number(t["tax_amount_raw"])))),
        lambda t: present(t["tax_rate"]) | present(t["tax_amount"]))
    kind = F.when(doc_class == "PAYABLE_CREDIT_MEMO", F.lit("CREDIT_MEMO")).otherwise(F.lit("INVOICE"))
    parts = F.struct(number(fields["gross_total_raw"]).alias("gross"), number(fields["subtotal_raw"]).alias("subtotal"), taxes.alias("taxes"), kind.alias("kind"),
                     F.coalesce(fields["currency"], F.lit("")).alias("currency"))
    none = F.array().cast(f"array<{TAX}>")

    def build(p: Column) -> Column:
        structured = present(p["subtotal"]) & (F.size(p["taxes"]) > 0)
        fact = struct_of(FACTS, invoice_type=p["kind"], currency=p["currency"], stated_gross=p["gross"],
                         line_items=F.array(line(F.when(structured, p["subtotal"]).otherwise(p["gross"]))),
                         header_taxes=F.when(structured, p["taxes"]).otherwise(none))
        return F.when(present(p["gross"]), fact)

    return let(parts, build)
