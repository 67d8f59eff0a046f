"""The recomputed gross and the structures tried for it."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tallyward import erp_cli
from tallyward.operators import erp, model


def facts(**given):
    lines = [F.struct(*[F.lit(str(line.get(k, "1" if k == "quantity" else ""))).alias(k) for k in ("description", "item_type", "uom", "quantity", "unit_price", "total", "discount", "discount_percentage", "tax_rate", "tax_amount")],
                      taxes(line.get("taxes", ())).alias("taxes")).cast(model.LINE) for line in given.pop("lines")]
    charges = [F.struct(F.lit(c).alias("amount"), F.lit("fee").alias("description")) for c in given.pop("charges", ())]
    cells = {"invoice_type": F.lit(given.pop("kind", "INVOICE")), "currency": F.lit("EUR"), "line_items": F.array(*lines), "header_taxes": taxes(given.pop("header", ())), "stated_gross": F.lit(given.pop("stated"))}
    if charges:
        cells["ambiguous_charges"] = F.array(*charges)
    return model.struct_of(model.FACTS, **cells, **{k: F.lit(v) for k, v in given.items()})


def taxes(rows):
    cells = [model.struct_of(model.TAX, tax_type=F.lit("VAT"), tax_rate=F.lit(r), tax_amount=F.lit(a)) for r, a in rows]
    return (F.array(*cells) if cells else F.array()).cast(f"array<{model.TAX}>")


CASES = {
    "two lines": (dict(lines=[dict(quantity=4, unit_price=73), dict(quantity=2, unit_price=73)], stated="438.00"), "baseline"),
    "percentage": (dict(lines=[dict(quantity=10, unit_price=10, discount_percentage=10)], stated="90.00"), "baseline"),
    "amount": (dict(lines=[dict(quantity=10, unit_price=10, discount=20)], stated="80.00"), "baseline"),
    "header tax": (dict(lines=[dict(unit_price=100)], header=[("20", "")], stated="120.00"), "baseline"),
    "line rates": (dict(lines=[dict(unit_price=100, tax_rate=5), dict(unit_price=100, taxes=[("12", "")])], stated="217.00"), "baseline"),
    "amount at no rate": (dict(lines=[dict(unit_price=100)], header=[("0", "5.00")], stated="105.00"), "baseline"),
    "withholding": (dict(lines=[dict(unit_price=100)], header=[("7", ""), ("", "-3.00")], stated="104.00"), "baseline"),
    "negative rate": (dict(lines=[dict(unit_price=100)], header=[("-5", "")], stated="100.00"), "baseline"),
    "fee taxed": (dict(lines=[dict(unit_price=1000)], header=[("7", "")], charges=["90"], stated="1166.30"), "charge_taxed_together"),
    "fee untaxed": (dict(lines=[dict(unit_price=1000)], header=[("7", "")], charges=["90"], stated="1160.00"), "charge_post_tax"),
    "fee left out": (dict(lines=[dict(unit_price=1000)], header=[("7", "")], charges=["90"], stated="1070.00"), "baseline"),
    "header discount": (dict(lines=[dict(unit_price=100)], discount_amount="10", stated="90.00"), "baseline"),
    "all charges": (dict(lines=[dict(unit_price=100)], freight_charges="1", insurance_charges="2", extra_charges="3", excise_duties="4", stated="110"), "baseline"),
    "credit memo": (dict(kind="CREDIT_MEMO", lines=[dict(unit_price=-400)], stated="-400.00"), "baseline"),
    "a cent off": (dict(lines=[dict(unit_price=100)], stated="100.01"), None),
    "no stated gross": (dict(lines=[dict(unit_price=100)], stated=""), None),
    "nothing fits": (dict(lines=[dict(unit_price=100)], header=[("10", "")], charges=["20"], stated="500.00"), None),
}


def test_structures(spark):
    row = spark.range(1).select(*[model.canonical(facts(**{**case})).alias(name) for name, (case, _) in ((k, (dict(v[0]), v[1])) for k, v in CASES.items())]).first()
    assert {k: row[k]["hypothesis"] if row[k] else None for k in CASES} == {k: v[1] for k, v in CASES.items()}
    assert row["credit memo"]["payload"]["gross_total"] == "400.00" and row["fee taxed"]["payload"]["line_items"][1]["unit_price"] == "90"


def test_rounding_is_half_up_on_the_shortest_form(spark):
    rng = random.Random(2)
    values = [rng.randrange(10**7) / 1000 for _ in range(2000)] + [2.675, 1.005, 8065.214999999999, -2.675, 0.125]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").orderBy("i").select(erp.money(F.col("v")))
    assert [r[0] for r in frame.collect()] == [float(Decimal(str(v)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)) for v in values]


def test_amounts(spark):
    cases = {"€ 5.50": 5.5, "20%": 20.0, "": 0.0, None: 0.0, "x": 0.0, "12d": 0.0, " -3 ": -3.0, "1e2": 100.0, "5 EUR": 0.0}
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, v string").orderBy("i").select(erp.amount(F.col("v")))
    assert [r[0] for r in rows.collect()] == list(cases.values())


def test_command_line(spark):
    assert erp_cli.booked(spark, '{"currency": "EUR", "line_items": [{"quantity": 4, "unit_price": "73"}, {"quantity": "2", "unit_price": 73.0}]}') == {"will_book_gross": 438.0, "currency": "EUR"}
    assert erp_cli.booked(spark, "{}") == {"will_book_gross": 0.0, "currency": ""}
    with pytest.raises(ValueError, match="object"):
        erp_cli.booked(spark, "[1]")
