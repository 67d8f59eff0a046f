"""Masters: loading, and one identifier or none."""

from __future__ import annotations

import hashlib
import json
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from tallyward.operators import match
from tallyward.sources import masters


def results(frame, struct):
    return {r["probe_id"]: (r[struct]["status"], r[struct]["matched_id"], r[struct]["method"]) for r in frame.collect()}


SUPPLIERS = [("1", "Alpha Trading GmbH", "DE111", "DE", 0), ("2", "Beta, Holding OU.", "EE 22-2", "EE", 1), ("3", "Gamma Logistics International", "", "EE", 2), ("4", "Gamma Logistics Internationel", "", "LV", 3), ("5", "Delta", "DE111", "DE", 4)]


def test_suppliers(spark):
    master = spark.createDataFrame(SUPPLIERS, "supplier_id string, name string, vat_id string, country string, load_order int")
    probes = [
        (1, "", "ee222", ""), (2, "Beta Holding OU", "XX9", "EE"), (3, "BETA   holding ou", "", ""), (4, "Gamma Logistic International", "", "EE"), (5, "Gamma Logistics Internationl", "", ""), (6, "", "", "EE"),
        (7, "Unheard of", "", "EE"), (8, "x", "de-111", ""), (9, "Gamma Logistic International", "", "FR"), (10, None, None, None), (11, "Beta Holding OÜ", "", "EE")]
    got = match.supplier(spark.createDataFrame(probes, "probe_id int, name string, vat_id string, country string"), master)
    fuzzy = "fuzzy_name_blocked_by_country"
    found = results(got, "supplier")
    assert found == {
        1: ("MATCHED", "2", "exact_vat_id"), 2: ("UNMATCHED", "", "exact_vat_id"), 3: ("MATCHED", "2", "exact_normalized_name"), 4: ("MATCHED", "3", fuzzy), 5: ("AMBIGUOUS", "", fuzzy), 6: ("UNMATCHED", "", ""),
        7: ("UNMATCHED", "", fuzzy), 8: ("MATCHED", "5", "exact_vat_id"), 9: ("AMBIGUOUS", "", fuzzy), 10: ("UNMATCHED", "", ""), 11: ("MATCHED", "2", fuzzy)}
    assert {r["probe_id"]: r["supplier"]["candidate_count"] for r in got.collect()}[5] == 5
    assert got.count() == len(probes)


def test_similar_names_against_all_pairs(spark):
    """The band of lengths loses no winner and no runner-up that matters."""
    from difflib import SequenceMatcher
    import random

    rng = random.Random(4)
    base = ["".join(rng.choices("abcde ", k=rng.randint(4, 24))).strip() or "a" for _ in range(12)]
    names = list(dict.fromkeys(base + [b[:-1] + "x" for b in base] + [b + "yz" for b in base]))
    master = spark.createDataFrame([(str(i), n, "", "EE", i) for i, n in enumerate(names)], "supplier_id string, name string, vat_id string, country string, load_order int")
    asked = [(i, n[:3] + "q" + n[3:], "", "EE") for i, n in enumerate(names)]
    done = match.supplier(spark.createDataFrame(asked, "probe_id int, name string, vat_id string, country string"), master).collect()
    got = {r["probe_id"]: (r["supplier"]["status"], r["supplier"]["matched_id"]) for r in done}
    told = {r["probe_id"]: (r["supplier"]["score"], r["supplier"]["reason"]) for r in done}
    norm = [" ".join(n.split()) for n in names]
    for i, n, *_ in asked:
        q = " ".join(n.split())
        if q in norm:
            continue
        scored = sorted(((SequenceMatcher(None, q, m).ratio(), -j) for j, m in enumerate(norm)), reverse=True)
        best, second = scored[0], scored[1]
        expected = ("MATCHED", str(-best[1])) if best[0] >= 0.9 and best[0] - second[0] >= 0.08 else ("AMBIGUOUS" if best[0] >= 0.9 else "UNMATCHED", "")
        assert got[i][:2] == expected and told[i][0] == best[0]
        assert told[i][1] == ("" if expected[0] == "MATCHED" else f"best={best[0]:.3f} runner_up={second[0]:.3f} (threshold=0.9, margin=0.08)")


def test_scores_that_nobody_reads_are_not_sought(spark, monkeypatch):
    """Holding each name that matches nothing against its whole block is quadratic; who asks for identifiers only gets the same ones without it."""
    rows = [(str(i), f"supplier {i * 7919} ltd", "", "EE", i) for i in range(40)]
    asked = [(0, "supplier 7919 ltd", "", ""), (1, "suppliers 15838 ltd", "", "EE"), (2, "seller 12", "", ""), (3, "", "", "EE"), (4, "someone else", "", "EE")]
    master = spark.createDataFrame(rows, "supplier_id string, name string, vat_id string, country string, load_order int")
    probes = spark.createDataFrame(asked, "probe_id int, name string, vat_id string, country string")
    told = lambda df: {r["probe_id"]: (r["supplier"]["status"], r["supplier"]["matched_id"], r["supplier"]["method"] if r["supplier"]["matched_id"] else "") for r in df.collect()}
    expected = told(match.supplier(probes, master))

    def never(*_):
        raise AssertionError("asked for scores")

    monkeypatch.setattr(match, "_best_two", never)
    assert told(match.supplier(probes, master, scores=False)) == expected and expected[2][0] == "UNMATCHED" and expected[0][0] == "MATCHED"


def test_the_two_best_names_at_any_score(spark, monkeypatch):
    """In tiles and parts, against all pairs; names that the master has twice, and blocks that are asked for without having any."""
    from difflib import SequenceMatcher
    import random

    rng = random.Random(11)
    name = lambda: " ".join("".join(rng.choices("abcdeéz", k=rng.randint(1, 7))) for _ in range(rng.randint(1, 4)))
    rows = [(str(i), name(), "", rng.choice(["EE", "LV", ""]), i) for i in range(150)]
    rows.append((*rows[7][:1], rows[7][1], "", rows[7][3], 150))
    asked = [(i, name(), "", rng.choice(["EE", "LV", "FR", ""])) for i in range(60)] + [(60, rows[7][1] + "q", "", "")]
    monkeypatch.setattr(match, "TILE", 40)
    monkeypatch.setattr(match, "ASKED", 10)
    got = match.supplier(spark.createDataFrame(asked, "probe_id int, name string, vat_id string, country string"),
                         spark.createDataFrame(rows, "supplier_id string, name string, vat_id string, country string, load_order int"))
    told = {r["probe_id"]: r["supplier"] for r in got.collect()}
    exact = {n for _, n, *_ in rows}
    for i, asked_name, _, country in asked:
        if asked_name not in exact:
            block = [n for _, n, _, c, _ in rows if c == country] if country in ("EE", "LV") else [n for _, n, *_ in rows]
            best, second = sorted((SequenceMatcher(None, asked_name, n).ratio() for n in block), reverse=True)[:2]
            assert told[i]["score"] == best and told[i]["candidate_count"] == len(block)
            assert told[i]["status"] == "MATCHED" or told[i]["reason"] == f"best={best:.3f} runner_up={second:.3f} (threshold=0.9, margin=0.08)"


def test_units(spark, tmp_path):
    chart = {"companies": [{"company_code": "C", "business_units": [
        {"business_unit_code": "EE001", "locations": [{"location_code": "L1"}, {"location_code": "L2"}]}, {"business_unit_code": "EE004", "locations": [{"location_code": "L3"}]},
        {"business_unit_code": "LV001", "locations": [{"location_code": "L4"}]}, {"business_unit_code": "odd", "locations": [{"location_code": "L5"}]}]}]}
    (tmp_path / "c.json").write_text(json.dumps(chart, indent=1))
    units = masters.business_units(spark, f"file://{tmp_path}/c.json")
    assert {(r["business_unit_code"], r["country"]) for r in units.collect()} == {("EE001", "EE"), ("EE004", "EE"), ("LV001", "LV"), ("odd", None)}
    probes = spark.createDataFrame([(1, "lv", ""), (2, "EE", ""), (3, "", " ee001 "), (4, "LV", "XX1"), (5, "FR", ""), (6, None, None)], "probe_id int, buyer_country string, bu_code string")
    got = match.buyer(probes, units)
    assert results(got, "buyer") == {1: ("MATCHED", "LV001", "country_unique_bu"), 2: ("AMBIGUOUS", "", ""), 3: ("MATCHED", "EE001", "exact_bu_code"), 4: ("UNMATCHED", "", ""), 5: ("UNMATCHED", "", ""), 6: ("UNMATCHED", "", "")}
    assert {r["probe_id"]: (r["company_code"], r["location_code"]) for r in got.collect()}[3] == ("C", "L2")


def test_taxes(spark):
    master = spark.createDataFrame([("A", "EE", "VAT", 20.0), ("B", "EE", "VAT", 9.0), ("C", "GH", "LEVY", 2.5), ("D", "GH", "NHIL", 2.5), ("E", "GH", "VAT", 15.0)], "code string, country string, tax_type string, rate double")
    probes = [(1, "ee", "VAT", 20.0, ""), (2, "EE", "", 20.004, ""), (3, "EE", "VAT", 20.01, ""), (4, "GH", "", 2.5, ""), (5, "GH", "nhil", 2.5, ""), (6, "GH", "GST", 2.5, ""), (7, "", "VAT", 20.0, " A "), (8, "EE", "VAT", 20.0, "zz"),
              (9, "EE", "VAT", None, ""), (10, "GH", "VAT", 2.5, ""), (11, None, None, None, None)]
    got = results(match.tax(spark.createDataFrame(probes, "probe_id int, country string, tax_type string, rate double, tax_code string"), master), "tax")
    assert got == {1: ("MATCHED", "A", "country_type_rate"), 2: ("MATCHED", "A", "country_rate_only"), 3: ("UNMATCHED", "", ""), 4: ("AMBIGUOUS", "", ""), 5: ("MATCHED", "D", "country_type_rate"), 6: ("AMBIGUOUS", "", ""),
                   7: ("MATCHED", "A", "explicit_tax_code"), 8: ("MATCHED", "A", "country_type_rate"), 9: ("UNMATCHED", "", ""), 10: ("UNMATCHED", "", ""), 11: ("UNMATCHED", "", "")}


def test_many_rates_of_a_country_by_bands(spark):
    """Rates at and around the edges of bands against all pairs; rates that aren't finite meet none."""
    rng = random.Random(4)
    master = [(f"C{i}", "EE", "VAT", round(rng.uniform(-1, 60), 3)) for i in range(3000)] + [("N", "EE", "VAT", None), ("X", "EE", "VAT", float("nan"))]
    rates = [rng.choice([round(rng.uniform(-1, 60), 3), rng.randint(0, 600) / 100, rng.randint(0, 600) / 100 + 0.005]) for _ in range(400)] + [float("nan"), float("inf"), 1e300]
    probes = spark.createDataFrame([(i, "EE", "VAT", r, "") for i, r in enumerate(rates)], "probe_id int, country string, tax_type string, rate double, tax_code string")
    got = {r["probe_id"]: r["tax"]["candidate_count"] for r in match.tax(probes, spark.createDataFrame(master, "code string, country string, tax_type string, rate double")).collect()}
    assert got == {i: sum(m[3] is not None and abs(m[3] - r) <= match.RATE_SLACK for m in master) for i, r in enumerate(rates)} and max(got.values()) > 1


def test_blank_keys_stay_apart(spark):
    rows = spark.range(1000).select(F.col("id").alias("probe_id"), F.when(F.col("id") % 10 == 0, F.lit("K")).otherwise(F.when(F.col("id") % 2 == 0, F.lit(""))).alias("key"))
    key = match.keyed_or_apart("key", "probe_id")
    assert rows.select(key.alias("k")).distinct().count() == 901
    found = match.exists(rows, "key", spark.createDataFrame([("K",), ("",), (None,)], "n string"), "n", "known")
    assert found.where("known").count() == 100 and found.count() == 1000


def test_terms_and_orders(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps({"payment_terms": [{"payment_term_id": "T30", "days": 30, "text_aliases": ["Net 30", "30 days"]}, {"payment_term_id": "T0", "days": 0, "text_aliases": []}, {"payment_term_id": "TX", "days": 0, "text_aliases": ["Net 30."]}]}))
    path = f"file://{tmp_path}/t.json"
    probes = [(1, "net  30.", "", ""), (2, "", "2024-01-01", "2024-01-31"), (3, "", "2024-01-01", "2024-01-01"), (4, "other", "2024-01-01", "2024-01-31"), (5, "", "2024-01-02", "2024-01-01"), (6, "", "2024-02-31", "2024-03-31"), (7, None, None, None)]
    got = results(match.payment_term(spark.createDataFrame(probes, "probe_id int, term_text string, invoice_date string, due_date string"), masters.term_aliases(spark, path), masters.term_days(spark, path)), "term")
    assert got == {1: ("MATCHED", "TX", "exact_text_alias"), 2: ("MATCHED", "T30", "unique_day_count"), 3: ("AMBIGUOUS", "", ""), 4: ("MATCHED", "T30", "unique_day_count"), 5: ("UNMATCHED", "", ""), 6: ("UNMATCHED", "", ""), 7: ("UNMATCHED", "", "")}
    orders = spark.createDataFrame([("I1", "PO-1", "S1", "EUR", 0), ("I2", "PO 2", "", "", 1)], "po_id string, po_number string, supplier_id string, currency string, load_order int")
    asked = spark.createDataFrame([(1, "po-1", "S2", "USD"), (2, "PO  2", "S9", "USD"), (3, "PO-10", "", ""), (4, "", "", ""), (5, "PO-1", "", "")], "probe_id int, po_number string, supplier_id string, currency string")
    po = match.purchase_order(asked, orders)
    assert results(po, "po") == {1: ("MATCHED", "I1", "exact_po_number"), 2: ("MATCHED", "I2", "exact_po_number"), 3: ("UNMATCHED", "", ""), 4: ("UNMATCHED", "", ""), 5: ("MATCHED", "I1", "exact_po_number")}
    assert {r["probe_id"]: r["po"]["reason"] for r in po.collect()}[1] == "another supplier in the master; another currency in the master"
    known = match.exists(asked, "po_number", orders, "po_number", "known")
    assert {r["probe_id"]: r["known"] for r in known.collect()} == {1: False, 2: False, 3: False, 4: False, 5: True}


def test_a_malformed_master_fails(spark, tmp_path):
    (tmp_path / "bad.json").write_text("{not json")
    with pytest.raises(Exception, match="(?i)malformed|parse|FAILFAST"):
        masters.suppliers(spark, f"file://{tmp_path}/bad.json").collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        masters.suppliers(spark, f"file://{tmp_path}/none.json").collect()


def test_other_masters_load(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"suppliers": [{"supplier_id": "1", "name": "A"}, {"supplier_id": "2", "name": "B"}]}))
    (tmp_path / "x.json").write_text(json.dumps({"taxes": [{"code": "A", "country": "EE", "tax_type": "VAT", "rate": 20}]}))
    (tmp_path / "p.json").write_text(json.dumps({"purchase_orders": [{"po_id": "I", "po_number": "1", "po_lines": []}]}))
    assert [r["load_order"] for r in masters.suppliers(spark, f"file://{tmp_path}/s.json").collect()] == [0, 1]
    assert masters.taxes(spark, f"file://{tmp_path}/x.json").first()["rate"] == 20.0
    assert masters.purchase_orders(spark, f"file://{tmp_path}/p.json").select(F.col("po_id")).first()[0] == "I"


def test_every_customer_is_matched(spark):
    """The query on similar names, against all pairs; no customer is left out."""
    from difflib import SequenceMatcher

    from tallyward.plans import catalog_match

    folder = "/root/testdata/sf0.001"
    master, probes = [], {}
    for k, segment, nation, start in spark.read.parquet(f"{folder}/customer.parquet").select(
            "c_custkey", "c_mktsegment", "c_nationkey", F.sha2(F.col("c_custkey").cast("string"), 224).substr(1, 28)).collect():
        name = f"{start} {segment}".lower()
        master.append((str(k), name, nation))
        if k % 10 == 5:
            master.append((f"{k}b", name + "s", nation))
        probes[k] = (f"zz zz yy yy {segment.lower()[::-1]} qq" if k % 10 == 3 else name[:5] + name[6:], nation if k % 2 == 0 else None)
    got = {r["c_custkey"]: (r["status"], r["matched_id"], r["score"]) for r in catalog_match.match_supplier_fuzzy(spark, folder).collect()}
    assert got.keys() == probes.keys()
    for k, (asked, nation) in probes.items():
        scored = sorted(((SequenceMatcher(None, asked, m).ratio(), i) for i, m, n in master if nation is None or n == nation), reverse=True)
        best, second = scored[0], scored[1][0] if len(scored) > 1 else 0
        status = "UNMATCHED" if best[0] < 0.9 else "MATCHED" if best[0] - second >= 0.08 else "AMBIGUOUS"
        assert got[k] == (status, best[1] if status == "MATCHED" else "", round(best[0], 6) if best[0] >= 0.82 else None)


def test_scores_told_for_every_supplier(spark):
    """The query on names that match nothing, against all pairs."""
    from difflib import SequenceMatcher

    from tallyward.plans import catalog_match

    folder = "/root/testdata/sf0.001"
    names = sorted({f"{b} {t}".lower() for b, t in spark.read.parquet(f"{folder}/part.parquet").select("p_brand", "p_type").collect()})
    got = catalog_match.match_supplier_scores(spark, folder).collect()
    assert len(got) == spark.read.parquet(f"{folder}/supplier.parquet").count()
    for r in got:
        k = r["s_suppkey"]
        asked = f"brand {k % 57} " + ("copper promo", "large steel", "tin small", "zinc")[k % 4]
        block = [n for n in names if k % 2 or len(n) % 3 == 1] or names
        best, second = [*sorted((SequenceMatcher(None, asked, n).ratio() for n in block), reverse=True), 0.0][:2]
        assert (r["status"], r["score"], r["candidate_count"]) == ("UNMATCHED", round(best, 6), len(block))
        assert r["reason"] == f"best={best:.3f} runner_up={second:.3f} (threshold=0.9, margin=0.08)"


def test_pairs_of_a_block_meet_only_where_they_can_be_near(spark, monkeypatch):
    """Names of one block and length that share no piece aren't joined; runners-up below the acceptance of similar names still count."""
    from tallyward.operators import near

    met, pairs = [], near.pairs
    monkeypatch.setattr(match.near, "pairs", lambda *a, **k: met.append(pairs(*a, **k)) or met[-1])
    names = [hashlib.sha256(str(i).encode()).hexdigest()[:36] for i in range(300)]
    best = names[0]
    master = spark.createDataFrame([(f"S{i}", n, "", "EE", i) for i, n in enumerate([*names, best[:31] + "zzz" + best[34:]])], "supplier_id string, name string, vat_id string, country string, load_order int")
    asked = [("near", best[:10] + "zz" + best[12:]), ("clear", names[5][:10] + names[5][11:])]
    got = {r["probe_id"]: r["supplier"] for r in match.supplier(spark.createDataFrame([(a, n, "", "EE") for a, n in asked], "probe_id string, name string, vat_id string, country string"), master).collect()}
    scores = sorted((SequenceMatcher(None, asked[0][1], m).ratio() for m in [*names, best[:31] + "zzz" + best[34:]]), reverse=True)[:2]
    assert 0.82 < scores[1] < 0.9 <= scores[0]
    assert got["near"]["status"] == "MATCHED" if scores[0] - scores[1] >= 0.08 else got["near"]["reason"].startswith(f"best={scores[0]:.3f} runner_up={scores[1]:.3f}")
    assert got["clear"]["matched_id"] == "S5" and met[0].count() == 2


def test_names_asked_for_meet_the_master_only(spark, monkeypatch):
    """Names asked for that are alike in a crowd aren't compared with each other, and tiles tell what all pairs tell."""
    from tallyward.operators import near

    monkeypatch.setattr(near, "_within", lambda *a: (_ for _ in ()).throw(AssertionError("all names of a block in one task")))
    monkeypatch.setattr(near, "tokens", lambda *a: (_ for _ in ()).throw(AssertionError("moved by pieces")))
    monkeypatch.setattr(near, "ASKED", 40)
    monkeypatch.setattr(near, "TILE", 20)
    names = [f"supplier {i * 37} of {'north' if i % 2 else 'south'}" for i in range(60)]
    asked = [f"supplier {i * 37 + i % 3} of north" for i in range(90)] + [f"seller {i}" for i in range(90)]
    new = spark.createDataFrame([("*", i, n, 1) for i, n in enumerate(asked)], "block string, id long, form string, seq int")
    prior = spark.createDataFrame([("*", i, n, 0) for i, n in enumerate(names)], "block string, id long, form string, seq int")
    got = {(r["id"], r["p_id"]): r["score"] for r in near.pairs(new, prior, 0.9, ("block",), short=True).collect()}
    expected = {(i, j): SequenceMatcher(None, a, b).ratio() for i, a in enumerate(asked) for j, b in enumerate(names) if a != b}
    assert got == {k: v for k, v in expected.items() if v >= 0.9} and len(got) > 60


@pytest.mark.parametrize("least", [0.9, 0.82, 0.7])
def test_short_texts_meet_by_parts_but_for_a_character(least):
    """Against all pairs, with letters lost, added and changed anywhere, and sizes around those that are bounded together."""
    from tallyward.operators import near

    rng = random.Random(int(least * 100))
    for alphabet in ("ab", "abcdefghij 0123", "abcdef0123456789é一"):
        sizes = (1, 2, 4, 9, 12, 25, 38, 64, 65) if len(alphabet) < 17 else (12, 38, 130, near.WIDTH - 1, near.WIDTH + 2)
        base = ["".join(rng.choice(alphabet) for _ in range(n)) for n in sizes]

        def changed(text):
            for _ in range(rng.randint(0, max(1, len(text) // 8))):
                i = rng.randrange(len(text) + 1)
                text = text[:i] + rng.choice(["", rng.choice(alphabet)]) + text[i + rng.randint(0, 1):]
            return text

        mine, theirs = (sorted({changed(rng.choice(base)) for _ in range(30)}) for _ in range(2))
        got = {(a, b): s for a, b, s in near.across(mine, theirs, least)}
        expected = {(i, j): SequenceMatcher(None, a, b).ratio() for i, a in enumerate(mine) for j, b in enumerate(theirs) if a != b}
        assert got == {k: v for k, v in expected.items() if v >= least}
