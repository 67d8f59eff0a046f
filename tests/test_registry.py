"""Duplicates in booking order against a sequential model."""

from __future__ import annotations

import random
from difflib import SequenceMatcher

import numpy as np

from tallyward.operators import dedupe, links, near
from tallyward.operators.shared import checkpointed
from tallyward.streaming import duplicates

SCHEMA = "seq int, file string, file_hash string, full_text string, supplier_identity string, invoice_number string, invoice_date string, currency string, gross_total string, bookable boolean"


def sequential(rows, remarks=False):
    """One row after the other, as a clerk would: booked rows are remembered."""
    booked, out = [], {}
    for seq, file, fh, text, *key, currency, gross, ok in sorted(rows):
        form = " ".join((text or "").split()).lower()
        bk = "|".join(x.strip().lower() for x in (*key, currency, gross)) if all(x and x.strip() for x in (*key, currency, gross)) else ""
        first = lambda test: next((b for b in booked if test(b)), None)
        tiers = (("file_hash", first(lambda b: fh and b["fh"] == fh and b["file"] != file)), ("content_hash", first(lambda b: form and b["form"] == form and b["file"] != file)), ("business_key", first(lambda b: bk and b["bk"] == bk)),
                 ("high_confidence_near_duplicate", first(lambda b: form and b["form"] and b["file"] != file and currency.strip() and gross.strip() and b["cur"] == currency.strip() and b["gross"] == gross.strip()
                                                          and SequenceMatcher(None, form, b["form"]).ratio() >= 0.97)))
        hit = next(((m, b) for m, b in tiers if b), None)
        if hit:
            out[seq] = ("DUPLICATE_OF_BOOKED_PAYABLE", hit[0], hit[1]["file"], False)
        else:
            near = first(lambda b: form and b["form"] and b["file"] != file and SequenceMatcher(None, form, b["form"]).ratio() >= 0.92) if remarks else None
            out[seq] = ("ADVISORY", "near_duplicate", near["file"], ok) if near else ("NONE", "", "", ok)
            if ok:
                booked.append({"file": file, "fh": fh, "form": form, "bk": bk, "cur": currency.strip(), "gross": gross.strip()})
    return out


def settled(spark, rows, remarks=False):
    got = dedupe.settle(dedupe.evidence(spark.createDataFrame(rows, SCHEMA).repartition(3)), remarks)
    return {r["seq"]: (r["verdict"], r["method"], r["matched_against"], r["booked"]) for r in got.collect()}


LONG = "the quick brown fox jumps over the lazy dog near the river bank while seven wizards quietly box up forty liquor jugs for the party"


def test_cases(spark):
    none = ("", "", "")
    rows = [
        (1, "a", "h1", "one", *none, "", "", True), (2, "b", "h1", "two", *none, "", "", True), (3, "c", "h3", " ONE ", *none, "", "", True), (4, "a", "h1", "one", *none, "", "", True),
        (5, "d", "", "five", "S", "N1", "D", "EUR", "5", False), (6, "e", "", "six", "S", "N1", "D", "EUR", "5", True), (7, "e", "", "seven", "s ", "n1", "d", "eur", "5", True), (8, "f", "", "eight", "S", "N-1", "D", "EUR", "5", True),
        (9, "g", "", LONG, *none, "EUR", "9.00", True), (10, "h", "", LONG + "x", *none, "EUR", "9.00", True), (11, "i", "", LONG + "y", *none, "EUR", "9.01", True), (12, "j", "", "", *none, "", "", True), (13, "k", "", "", *none, "", "", True)]
    assert settled(spark, rows) == sequential(rows)
    got = settled(spark, rows)
    assert got[2][1] == "file_hash" and got[3][1] == "content_hash" and got[4][0] == "NONE" and got[6][3] and got[7][1] == "business_key" and got[8][0] == "NONE" and got[10][1] == "high_confidence_near_duplicate" and got[13][3]


def test_copy_labels_only_remark(spark):
    rows = [(1, "a", "", "copy tax invoice one", "", "", "", "", "", True), (2, "b", "", "plain", "", "", "", "", "", True)]
    got = settled(spark, rows)
    assert got[1] == ("ADVISORY", "copy_indicator", "", True) and got[2][0] == "NONE"


def test_random_sequences(spark):
    """Several unlinked sequences in one frame, told apart by their values."""
    rng = random.Random(6)
    rows, seq = [], 0
    for group in range(25):
        for _ in range(rng.randint(3, 9)):
            seq += 1
            text = rng.choice([f"{group} alpha", f"{group} beta", f"{group} {LONG}", f"{group} {LONG}!", ""])
            rows.append((seq, f"{group}-{rng.randint(0, 3)}", rng.choice(["", f"{group}h", f"{group}k"]), text, rng.choice(["", f"S{group}"]), rng.choice([f"N{group}", f"M{group}"]), "D", rng.choice(["EUR", ""]), rng.choice([f"{group}.00", f"{group}.10"]), rng.random() < 0.7))
    assert settled(spark, rows) == sequential(rows)


def test_long_runs_of_unbookable_copies(spark):
    rows = [(i, f"f{i}", "same", "same", "", "", "", "", "", i >= 60) for i in range(80)]
    got = settled(spark, rows)
    assert got[59] == ("NONE", "", "", False) and got[60][3] and all(got[i][2] == "f60" for i in range(61, 80))


def varied(rng, n):
    """Rows of a few amounts, keys and wordings, all linked with each other in some way."""
    words = LONG.split()

    def text():
        own = list(words)
        for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
            own[rng.randrange(len(own))] = rng.choice(["alpha", "beta", "x", ""])
        return " ".join(own)

    return [(i, f"f{rng.randint(0, n // 2)}", rng.choice(["", "", "", f"h{rng.randint(0, n // 4)}"]), rng.choice([text(), text(), text(), "", "short"]), rng.choice(["", "S"]), f"N{rng.randint(0, n // 4)}", "D",
             rng.choice(["EUR", "EUR", ""]), rng.choice(["49.00", "49.00", "50.00"]), rng.random() < 0.7) for i in range(n)]


def test_near_texts_of_any_amount_are_remarked(spark):
    rng = random.Random(8)
    rows = varied(rng, 150)
    got = settled(spark, rows, remarks=True)
    assert got == sequential(rows, remarks=True) and sum(v[1] == "near_duplicate" for v in got.values()) > 5
    assert dedupe.settle(dedupe.evidence(spark.createDataFrame([], SCHEMA)), remarks=True).count() == 0


def test_groups_too_large_for_a_task_are_settled_in_parts(spark, monkeypatch):
    """The same rows of one hot amount, in one part and in many; links joined in one task and by rounds."""
    rng = random.Random(9)
    rows = varied(rng, 120)
    wanted = sequential(rows)
    assert len({v[1] for v in wanted.values()}) == 5
    monkeypatch.setattr(dedupe, "GROUP_BYTES", 20_000)
    monkeypatch.setattr(links, "LOCAL_LINKS", 0)
    assert settled(spark, rows) == wanted


def test_a_chain_is_settled_in_one_part(spark):
    """Each row shares a key with the next only, so every second one is booked."""
    rows = [(i, f"f{i}", f"h{i // 2}", f"text {(i + 1) // 2}", "", "", "", "", "", True) for i in range(10_000)]
    got = dedupe.settle(dedupe.evidence(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    assert {r["seq"] for r in got.where("booked").collect()} == set(range(0, 10_000, 2))


def test_stars_reach_what_links_reach(spark):
    rng = random.Random(2)
    pairs = {tuple(sorted(rng.sample(range(400), 2), reverse=True)) for _ in range(300)} | {(i + 1, i) for i in range(1000, 1100)}
    frame = checkpointed(spark.createDataFrame(sorted(pairs), "a long, b long"))
    local = {(r["at"], r["group"]) for r in links.groups(frame).collect()}
    found = links._stars(frame)
    assert local == {(r["a"], r["b"]) for r in found.collect()} | {(r["b"], r["b"]) for r in found.select("b").distinct().collect()}


def test_texts_of_one_amount_give_the_pairs_of_brute_force(spark):
    rng = random.Random(12)
    texts = sorted({r[3] for r in varied(rng, 260)} | {" ".join(rng.choices(LONG.split(), k=rng.randint(1, 40))) for _ in range(60)} | {"a", "ab", "abc", "abcd", "abcde", "abcdef"})
    for least in (0.97, 0.92):
        rows = dedupe.evidence(spark.createDataFrame([(i, str(i), "", x, "", "", "", "EUR", "49.00", True) for i, x in enumerate(texts)], SCHEMA))
        form = {r["content_hash"]: r["form"] for r in rows.select("content_hash", "form").collect() if r["form"]}
        wanted = {(a, b) for a in form for b in form if a != b and 2 * min(len(form[a]), len(form[b])) >= least * (len(form[a]) + len(form[b]))
                  and SequenceMatcher(None, form[a], form[b]).ratio() >= least}
        got = [(r["content_hash"], r["p_hash"]) for r in dedupe.near_texts(rows, least).collect()]
        assert len(got) == len(set(got)) and set(got) == wanted and wanted


def test_no_pair_is_lost_to_the_bound_on_similarity(spark):
    """The edit distance bounds the ratio from above: what difflib finds near, the bound lets pass."""
    from pyspark.sql import functions as F

    from tallyward.functions import text as t

    rng = random.Random(4)
    base = "the total of the order is 1250.50 and zebras quit jumping, naïve café Ümläut 汉字"
    pairs = []
    for _ in range(300):
        a = "".join(rng.choices(base, k=rng.randint(0, 60)))
        b = "".join(c for c in a if rng.random() > 0.1) + "".join(rng.choices(base, k=rng.randint(0, 4)))
        pairs.append((a, b))
    rows = spark.createDataFrame(pairs, "a string, b string").select(t.similarity("a", "b").alias("score"), *[t.may_be_similar("a", "b", x).alias(f"at{i}") for i, x in enumerate((0.5, 0.82, 0.97))]).collect()
    shared = spark.createDataFrame(pairs, "a string, b string").select(t.similarity("a", "b").alias("score"), *[
        t.may_share(t.letters("a"), t.letters("b"), x).alias(f"at{i}") for i, x in enumerate((0.5, 0.82, 0.97))]).collect()
    assert all(r[f"at{i}"] for r in shared for i, x in enumerate((0.5, 0.82, 0.97)) if r["score"] >= x) and sum(not r["at2"] for r in shared) > 50
    assert all(r[f"at{i}"] for r in rows for i, x in enumerate((0.5, 0.82, 0.97)) if r["score"] >= x)
    assert sum(not r["at2"] for r in rows) > 100


def test_a_stream_in_batches_equals_the_sequence(spark, tmp_path):
    """Three deliveries of rows linked by all tiers, an empty one between, and the second run once more as after a lost driver."""
    rng = random.Random(11)
    rows = varied(rng, 150)
    wanted = sequential(rows)
    assert len({v[1] for v in wanted.values()}) == 5
    folder = f"file://{tmp_path}/settled"
    parts = [spark.createDataFrame(p, SCHEMA).repartition(2) for p in (rows[:40], rows[40:90], [], rows[90:])]
    for number in (0, 1, 1, 2, 3):
        duplicates.settle_batch(parts[number], folder, number)
    told = spark.read.parquet(f"{folder}/verdicts").collect()
    assert len(told) == len(rows) and {r["seq"]: (r["verdict"], r["method"], r["matched_against"], r["booked"]) for r in told} == wanted


def test_a_stream_goes_on_where_it_ended(spark, tmp_path):
    rows = varied(random.Random(12), 60)
    place, folder = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    for part in (rows[:25], rows[25:]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(place)
        duplicates.settled(spark.readStream.schema(SCHEMA).parquet(place), folder).awaitTermination()
    got = {r["seq"]: (r["verdict"], r["method"], r["matched_against"], r["booked"]) for r in spark.read.parquet(f"{folder}/verdicts").collect()}
    assert got == sequential(rows)


def test_tables_of_tokens_are_never_broadcast(spark, monkeypatch):
    """Each text gives dozens of tokens, which the size of the texts' files doesn't tell."""
    plans = []
    monkeypatch.setattr(near, "checkpointed", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or checkpointed(df))
    texts = checkpointed(spark.createDataFrame([(i, i, LONG + " " + str(i)) for i in range(30)], "id long, seq long, form string"))
    assert near.pairs(texts, texts, 0.92).count() == 30 * 29 // 2
    assert any("token" in p for p in plans) and not any("BroadcastHashJoin" in p for p in plans)


def test_near_texts_share_a_piece_in_its_place():
    rng = random.Random(3)
    counts = np.array([rng.randint(0, 9) for _ in range(256)] * (near.PLACES // 256))
    met = 0
    for least in (0.97, 0.92, 0.9, 0.82):
        for _ in range(400):
            a = "".join(rng.choices("abcdef0123456789 ", k=rng.choice([1, 2, 3, 5, 8, 13, 26, 39, 90, 150, 2500])))
            b = list(a)
            for _ in range(rng.randint(1, max(1, int(len(a) * (1 - least))))):
                i = rng.randrange(len(b) + 1)
                b[i : i + rng.randint(0, 1)] = rng.choice(["", "x"])
            b = "".join(b)
            if not b or a == b or SequenceMatcher(None, a, b).ratio() < least:
                continue
            x, y = sorted((a, b), key=len, reverse=True)
            q, (mine, at), (theirs, there) = near.piece_size(len(x), least), near.pivots(x, counts, least), near.stretches(y, least)
            assert len(at) >= near.pieces(len(x), least) and (np.diff(at) >= q).all() and at[-1] + q <= len(x)
            known = {}
            for token, place in zip(theirs.tolist(), there.tolist(), strict=True):
                known.setdefault(token, []).append(place)
            moved = len(x) - np.ceil(least / 2 * (len(x) + len(y)) - 1e-6)
            assert any(abs(i - j) <= moved for token, i in zip(mine.tolist(), at.tolist(), strict=True) for j in known.get(token, []))
            met += 1
    assert met > 500


def test_a_crowd_of_one_amount_moves_each_text_once(spark, monkeypatch):
    """More texts of an amount than meet as they are, in one task; the same pairs where a task holds none of it."""
    texts = [(f"order {i * 7919 % 1009:04d} of the customer who ordered goods by the dozen in the month of {x}{i * 31 % 97:02d} and paid", i) for i in range(60) for x in ("May", "May ")]
    rows = dedupe.evidence(spark.createDataFrame([(n, str(i), "", x, "", "", "", "EUR", "49.00", True) for n, (x, i) in enumerate(texts)], SCHEMA))
    pairs = lambda: sorted((r["seq"], r["p_hash"], r["score"]) for r in dedupe.near_texts(rows, holder="seq").collect())
    with monkeypatch.context() as m:
        m.setattr(near, "tokens", lambda *a: (_ for _ in ()).throw(AssertionError("moved by pieces")))
        got = pairs()
    monkeypatch.setattr(near, "TASK_BYTES", 0)
    assert got and got == pairs()


def test_rows_of_an_amount_are_no_links(spark, monkeypatch):
    """Only keys that span several amounts are links; others would be joined by rounds over all rows."""
    found = []
    monkeypatch.setattr(dedupe, "groups", lambda df: found.append(df.count()) or links.groups(df))
    rows = [(i, f"f{i}", "", f"text {i // 2}", "S", f"N{i // 2}", "D", "EUR", f"{i // 10}.00", True) for i in range(200)]
    assert settled(spark, rows) == sequential(rows) and not found
    assert settled(spark, [*rows, (200, "x", "", "text 0", "", "", "", "EUR", "7777.00", True)])[200][2] == "f0" and found == [1]


def test_a_stretch_less_is_told_without_the_matcher():
    from tallyward.functions import text as t

    rng = random.Random(5)
    for _ in range(4000):
        a = "".join(rng.choices(rng.choice(["ab", "abc", "abcdef0123456789 "]), k=rng.randint(0, rng.choice([6, 20, 60, 250]))))
        i = rng.randint(0, len(a))
        b = a[:i] + a[i + rng.randint(0, 3) :] + rng.choice(["", "", "", "x"])
        assert t.ratio(a, b) == SequenceMatcher(None, a, b).ratio() and t.ratio(b, a) == SequenceMatcher(None, b, a).ratio()


def test_few_texts_of_an_amount_are_bounded_before_they_are_compared(monkeypatch):
    """Invoices of one amount that differ in their numbers only aren't held against each other by the matcher, also where these are few."""
    import pyarrow as pa

    rows = []
    for g in range(40):
        for i in range(6):
            k = g * 160016 + i * 7919 * 16
            form = f"invoice invoice no: inv-{k:09d} supplier: supplier {k * 7} ltd vat no: ee{k * 31:011d} bill to: customer {k * 3} vat id: de{k * 17:010d} payment terms: net 30 qty unit price total: eur {g}.55"
            rows.append((g, f"f{k}", f"h{k}", f"c{k}", f"b{k}", form, "EUR", f"{g}.55", True))
    near_one = rows[0][:1] + ("last", "h", "c", "b", rows[0][5][:50] + rows[0][5][51:]) + rows[0][6:]
    rows = sorted([*rows, near_one], key=lambda r: (r[0], r[1]))
    names = ["group", "file", "file_hash", "content_hash", "business_key", "form", "currency", "gross_total", "bookable"]
    asked, ratio = [], dedupe.t.ratio
    monkeypatch.setattr(dedupe.t, "ratio", lambda a, b: asked.append(1) or ratio(a, b))
    told = dedupe._booked_in_turn(pa.table({n: [r[i] for r in rows] for i, n in enumerate(names)}))
    expected = {i for i, r in enumerate(rows) if any(s[0] == r[0] and SequenceMatcher(None, r[5], s[5]).ratio() >= dedupe.DECLINE for s in rows[:i])}
    assert {i for i, x in enumerate(told) if x[0] == "dup"} == expected and len(expected) == 1 and len(asked) < 20
