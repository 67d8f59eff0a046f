"""Licences, quality rules, personal data and decontamination against brute force and SQL."""

from __future__ import annotations

import hashlib
import re

import duckdb
import pytest

from tallyward.llm import decontam, license_scan, pii, quality_rules, queries

from . import licence_texts
from .helpers import DATA, awkward, clashing, documents, words


def duck(tables: dict, sql: str) -> list:
    con = duckdb.connect()
    for name, frame in tables.items():
        con.register(name, frame)
    return con.sql(sql).fetchall()


def same(spark_rows, sql_rows) -> bool:
    return sorted(map(repr, (tuple(r) for r in spark_rows))) == sorted(map(repr, sql_rows))


def test_quality_rules_match_sql_on_awkward_rows(spark):
    assert quality_rules.verdicts(documents(spark, awkward())).count() == len(awkward())
    texts = [*awkward(60), (20, "a b c a b c a b c"), (21, "x\nx\ny\n\n  \nx"), (22, "# * $ % & | < >" * 9), (23, "one two"), (24, "a a a")]
    docs = clashing(documents(spark, texts))
    frame = docs.select("doc_id", "text").toPandas()
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    assert same(quality_rules.verdicts(docs).collect(), duck({"documents": frame}, quality_rules.ORACLE))
    assert quality_rules.verdicts(documents(spark, [])).count() == 0


def test_quality_rules_are_native(spark):
    plan = quality_rules.verdicts(spark.read.parquet(f"{DATA}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_quality_rules_keep_good_prose(spark):
    out = queries.op3_quality_rules(spark, DATA).cache().join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id")
    assert out.where("quality = 1 and not base_failed and not kept").count() == 0
    assert out.where("quality = 0 and kept").count() <= 2


def test_licences(spark):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal. "
           "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
           "THE SOFTWARE IS PROVIDED “AS IS”, WITHOUT WARRANTY OF ANY KIND. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM.")
    texts = [(1, "word. Released under the MIT License.\nmore"), (2, mit), (3, "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License."), (4, "I like a licence plate."),
             (5, "Licensed under CC BY-NC 4.0."), (6, "This work is licensed under the GNU General Public License, version 3."), (7, "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
             (8, None), (None, ""), (9, "Released under the MIT License"), (9, "Released under the MIT License")]
    got = {r["doc_id"]: r["licenses"] for r in license_scan.scan(clashing(documents(spark, texts))).collect()}
    assert got == {1: "MIT", 2: "MIT", 3: "Apache-2.0,MIT", 4: "", 5: "CC-BY-NC-4.0", 6: "GPL-3.0-only", 7: "UNKNOWN", 8: "", None: "", 9: "MIT"}
    assert license_scan.scan(documents(spark, [])).count() == 0


FRAMES = (str, lambda t: "".join(f"# {x}\n" for x in t.splitlines()), lambda t: "".join(f"// {x}\n" for x in t.splitlines()), lambda t: "/*\n" + "".join(f" * {x}\n" for x in t.splitlines()) + " */\n",
          lambda t: " ".join(t.split()), lambda t: f"Some words before.\n\n{t}\nint main() {{ return 0; }}\n", lambda t: t.replace("\n", "\r\n"))


@pytest.mark.parametrize("name", licence_texts.EXPECTED)
def test_standard_texts_give_one_licence(name):
    """Plain, in comments, on one line, and within other text: nothing else is found, nothing is left unknown."""
    text, licence = licence_texts.EXPECTED[name]
    for frame in FRAMES:
        found = license_scan.recognise(license_scan.identify(frame(text)))
        assert ",".join(dict.fromkeys(n for n, _, _ in found)) == licence


@pytest.mark.parametrize("text", licence_texts.REFERENCES)
def test_licences_named_in_prose_and_by_identifier(text):
    found = license_scan.recognise(license_scan.identify(text))
    assert ",".join(dict.fromkeys(n for n, _, _ in found)) == licence_texts.REFERENCES[text]


@pytest.mark.parametrize(("text", "found"), [
    ("This project uses the Apache 2.0 license.", {"Apache-2.0"}), ("MIT License", {"MIT"}), ("GPLv3", {"GPL-3.0-only"}),
    ("You can redistribute it under the terms of the Eclipse Public License v2.0", {"EPL-2.0"}), ("Licensed under the SSPL 1.0.", {"SSPL-1.0"}),
    ("Released under the Business Source License 1.1.", {"BUSL-1.1"}), ("It is available under the Elastic License 2.0.", {"Elastic-2.0"}),
    ("Licensed under the Universal Permissive License v1.0", {"UPL-1.0"}), ("Code is licensed under MIT.", {"MIT"}), ("Offered under the MIT or Apache 2.0 license.", {"MIT", "Apache-2.0"}),
    ("The talk was available under the MIT dome.", set()), ("He studied at MIT", set()), ("The team uses the MIT campus.", set()), ("An artistic licence was taken by the author.", set()),
    ("The library is released under the Gpl cap of the hill.", {"GPL"})])
def test_notices_and_near_misses(text, found):
    assert {n for n, _, _ in license_scan.recognise(license_scan.identify(text))} == found


def test_a_known_sentence_with_a_long_gap_is_found_whole():
    filler = "word " * 3000
    for text in (f"To the extent possible under law, {filler}has waived all copyright", f"a heading\nTo the extent possible under law, {filler}has waived all copyright"):
        assert [n for n, _, _ in license_scan.recognise(license_scan.identify(text))] == ["CC0-1.0"]


def test_every_known_sentence_is_looked_up_by_its_first_word():
    """The index of first words loses no sentence: each is found that its pattern matches."""
    for text, _ in licence_texts.EXPECTED.values():
        low = license_scan.plain(text)
        for a, b in license_scan.sentences(low):
            plain = license_scan.normalise(low[a:b])
            matching = [n for n, p in license_scan._KNOWN if p.match(plain)]
            if matching and matching[0] != "GNUgrant":
                assert license_scan.look_up(plain)[0][0] == matching[0]


def test_several_licences_in_one_very_long_text(spark):
    filler = "Plain words of a plain sentence. " * 20_000
    parts = [licence_texts.MIT, filler, licence_texts.APACHE, filler, "SPDX-License-Identifier: Zlib\n"]
    rows = license_scan.scan(documents(spark, [(1, "\n\n".join(parts)), (2, "a" * 300_000), (3, ". " * 200_000), (4, "\n" * 200_000), (5, "license " * 50_000)])).collect()
    assert {r["doc_id"]: r["licenses"] for r in rows} == {1: "MIT,Apache-2.0,Zlib", 2: "", 3: "", 4: "", 5: ""}


def test_licences_on_whole_table(spark):
    """Each of the corpus's licence lines is found, and nothing else."""
    plain = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
             "Released under the MIT License.": "MIT"}
    for r in queries.op2_license_scan(spark, DATA).join(spark.read.parquet(f"{DATA}/documents.parquet"), "doc_id").collect():
        at = sorted((r["text"].find(s), n) for s, n in plain.items() if s in r["text"])
        assert r["licenses"] == ",".join(n for _, n in at)


# ---- personal data

PATTERNS = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def plain_spans(text):
    found = []
    for order, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                total = sum(sum(divmod(int(d) * 2, 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits)))
                if not 12 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((m.start(), order, m.end(), kind))
    return [(a, b, k) for a, _, b, k in sorted(found)]


TRICKY = ["a@b.c@d.e", "a@b@c.dd x", "@@a.b", "é x.y+z@q-r.example.co, 1.2.3.4.5.6.7.8 999.1.1.1 001.002.003.004", "4111 1111 1111 1111-4111-1111-1111-1111", "+1 (234) 555-0100. +44 20 7946 0958)",
          "1" * 300, "4111111111111111", "+12345678901234567", "x@y.z" * 50, "a.b" * 200 + "@" + "c." * 50 + "d", "-@-.-", "12-34-56-78-90-12-34"]


@pytest.mark.parametrize("text", TRICKY)
def test_base_spans_of_tricky_texts(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_personal_data_on_whole_table(spark):
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()}
    for r in queries.op5_pii(spark, DATA).collect():
        found = plain_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in found).encode()).hexdigest()
        assert [r[f"n_{k}"] for k, _ in PATTERNS] == [sum(s[2] == k for s in found) for k, _ in PATTERNS]
        assert set(f"{k}:{a}:{b}" for a, b, k in found) <= set(r["spans"].split(","))


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1" + " " * 300_000, "a@" * 100_000):
        pii.base_spans(text)


def test_licence_references_across_gaps_and_before_more_text():
    free = "This is free and unencumbered software released into the public{}domain."
    cc = "Available under a Creative{}Commons BY-SA 4.0"
    for gap in (" ", "  ", "\n", " \n "):
        assert [x[0] for x in license_scan.identify(free.format(gap))] == ["UNLICENSE"]
        assert [x[:2] for x in license_scan.identify(cc.format(gap))] == [("=CC", "CC-BY-SA-4.0")]
    gpl = "Released under the GNU General Public License, version 3."
    for text in (gpl, gpl + " More text follows here.", "Notes.\n" + gpl + " More text."):
        assert [x[:2] for x in license_scan.identify(text)] == [("=GNU", "GPL-3.0-only")]
    listed = "1. Redistributions of source code must retain the above copyright notice, and so on.\n2. Redistributions in binary form must reproduce the above copyright notice, too."
    assert [x[0] for x in license_scan.identify(listed)] == ["BSDsource", "BSDbinary"]


def test_disclosing_terms(spark):
    """A nickname that stands beside one address only is a span; common words are not."""
    common = words(11, 400)
    rows = [(i, " ".join(common[(i * 7) % 380 : (i * 7) % 380 + 20]) + " nothing here") for i in range(300)]
    rows += [(1000 + i, f"{common[i]} {common[i + 50]} the brightfox wrote from fox@mail.example.com to {common[i + 90]}") for i in range(6)]
    docs = clashing(documents(spark, rows))
    terms = {r["term"] for r in pii.disclosing(docs).collect()}
    assert "brightfox" in terms and not terms & set(common)
    spans = {r["doc_id"]: r["spans"] for r in pii.spans(docs).collect()}
    text = dict(rows)[1000]
    at = text.index("brightfox")
    assert (at, at + 9, "term") in [tuple(s) for s in spans[1000]] and spans[1] == []
    clean = {r["doc_id"]: r["text"] for r in pii.sanitised(docs).collect()}
    assert "brightfox" not in clean[1000] and "[WORD] [EMAIL]" in clean[1000] and clean[1] == dict(rows)[1]


def test_disclosing_terms_of_copied_documents(spark, monkeypatch):
    """Copies of every document change no term, nor its figures."""
    common = words(11, 400)
    rows = [(i, " ".join(common[(i * 7) % 380 : (i * 7) % 380 + 20]) + " nothing here") for i in range(300)]
    rows += [(1000 + i, f"{common[i]} {common[i + 50]} the brightfox wrote from fox@mail.example.com to {common[i + 90]}") for i in range(6)]
    found = lambda texts: sorted((r["entity"], r["term"], round(r["pmi"], 9), round(r["ic"], 9)) for r in pii.disclosing(documents(spark, texts)).collect())
    once, copied = found(rows), [(10_000 * k + i, t) for i, t in rows for k in range(100)]
    assert "brightfox" in {r[1] for r in once} and found(copied) == once
    only = [(i, t) for i, t in copied if i % 10_000 >= 1000] + rows[:300]
    assert found(only) == once
    monkeypatch.setattr(pii, "BROADCAST_BYTES", 0)
    assert found(only) == once


def test_disclosing_terms_by_shuffle(spark, monkeypatch):
    rows = [(i, f"w{i} padding text") for i in range(60)] + [(100 + i, f"see{i} brightfox at fox@mail.example.com") for i in range(5)]
    docs = documents(spark, rows)
    small = sorted((r["doc_id"], str(r["spans"])) for r in pii.spans(docs).collect())
    monkeypatch.setattr(pii, "BROADCAST_BYTES", 0)
    assert sorted((r["doc_id"], str(r["spans"])) for r in pii.spans(docs).collect()) == small
    assert "brightfox" not in "".join(r["text"] for r in pii.sanitised(docs).collect())


def words_around(text, spans, span):
    """Ten terms on either side of a span, read word by word from a text whose spans are blanked."""
    blank = list(text)
    for a, b, _ in spans:
        blank[a:b] = "\n" * (b - a)
    dense = lambda w: "\u3040" <= w[0] <= "\u30ff" or "\u3400" <= w[0] <= "\u9fff" or "\uac00" <= w[0] <= "\ud7af"
    words = [(m.start(), m[0].lower()) for m in re.finditer(r"[^\W_]+", "".join(blank)) if not m[0].isdigit() and (len(m[0]) > 2 or dense(m[0]))]
    return [w for at, w in words if at < span[0]][-10:], [w for at, w in words if at >= span[1]][:10]


def test_contexts_have_whole_words_of_any_length_and_script():
    long, mail = "x" * 450, "fox@mail.example.com"
    text = f"{long}a {long}b {mail} 王 伟 {long}c ab 12 tail +49 30 1234567 王小明"
    spans = pii.protected(text)
    assert len(spans) == 2 and pii._contexts(text, spans) == [words_around(text, spans, s) for s in spans]
    before, after = pii._contexts(text, spans)[0]
    assert before == [f"{long}a", f"{long}b"] and after == ["王", "伟", f"{long}c", "tail", "王小明"]
    crowd = " ".join(f"word{i} u{i}@mail.example.com" for i in range(5000))
    spans = pii.protected(crowd)
    assert len(pii._contexts(crowd, spans)) == 5000 and pii._contexts("", []) == []


def test_short_names_of_dense_scripts_disclose_values(spark):
    rows = [(i, f"第{i} 報告 padding text") for i in range(60)] + [(100 + i, f"see{i} 王伟 at fox@mail.example.com") for i in range(5)]
    docs = documents(spark, rows)
    assert "王伟" in {r["term"] for r in pii.disclosing(docs).collect()}
    assert "王伟" not in "".join(r["text"] for r in pii.sanitised(docs).collect())


def plain_disclosing(texts):
    """Entities by name, level and disclosing terms, counted over sets of plain Python."""
    import math
    from collections import defaultdict

    units, terms_of = defaultdict(set), defaultdict(set)
    for text in set(t or "" for t in texts):
        spans = pii.protected(text)
        for span in spans:
            before, after = words_around(text, spans, span)
            names = pii.generalisations(text, span)
            for level, (name, unit) in enumerate(zip(names, ((*before, "|", *after), names[0], names[0]), strict=True)):
                units[name, level].add(unit)
                for term in {*before, *after}:
                    terms_of[name, level, term].add(unit)
    n_t, total = defaultdict(int), len(set(t or "" for t in texts))
    for text in set(t or "" for t in texts):
        for term in set(pii._terms(text)):
            n_t[term] += 1
    out = set()
    for (name, level, term), found in terms_of.items():
        if len(found) < pii.LEAST[level]:
            continue
        n_e = min(len(units[name, level]), total)
        ic = math.log2(total / n_e)
        if ic > 0 and math.log2(min(len(found), n_t[term]) * total / (n_e * n_t[term])) >= pii.ALPHA * ic:
            out.add((name, level, term))
    return out


def plain_added(text, disclosed):
    """Secrets and terms of a text as the operator has to add them."""
    spans = pii.protected(text)
    names = {(n, level) for s in spans for level, n in enumerate(pii.generalisations(text, s))}
    given = {t for n, level, t in disclosed if (n, level) in names}
    out = [s for s in spans if s[2] == pii.SECRET]
    for m in re.finditer(r"[^\W_]+", text):
        if m[0].lower() in given and all(b <= m.start() or a >= m.end() for a, b, _ in spans):
            out.append((*m.span(), pii.TERM))
    return sorted(out)


def test_added_spans_on_whole_table(spark):
    """Secrets, and the words that give them away, equal brute force over all documents; there are some of both."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    texts = {r[0]: r[1] or "" for r in docs.select("doc_id", "text").collect()}
    disclosed = plain_disclosing(texts.values())
    got = {(r["entity"], r["level"], r["term"]) for r in pii.disclosing(docs).collect()}
    assert len(got) == len(disclosed) and {(level, t) for _, level, t in got} == {(level, t) for _, level, t in disclosed}
    assert "token" in {t for _, _, t in disclosed}
    added = {r["doc_id"]: sorted(tuple(s) for s in r["spans"] if s["kind"] not in pii.KINDS) for r in pii.spans(docs).collect()}
    assert added == {i: plain_added(t, disclosed) for i, t in texts.items()}
    assert sum(s[2] == pii.SECRET for x in added.values() for s in x) >= 10 and sum(s[2] == pii.TERM for x in added.values() for s in x) >= 5


def test_words_that_disclose_a_kind_are_removed(spark):
    """A cue beside many different secrets goes; where it stands beside none it is no span."""
    filler = words(31, 300)
    rows = [(i, " ".join(filler[(i * 5) % 280 : (i * 5) % 280 + 20])) for i in range(300)]
    rows += [(1000 + i, f"{filler[i]} passphrase=k3y{i}abc9def7ghi5jk {filler[i + 20]}") for i in range(8)]
    docs = documents(spark, rows)
    assert {("passphrase", pii.KIND)} <= {(r["term"], r["level"]) for r in pii.disclosing(docs).collect()}
    clean = {r["doc_id"]: r["text"] for r in pii.sanitised(docs).collect()}
    assert clean[1000] == f"{filler[0]} =[SECRET] {filler[20]}" and clean[5] == dict(rows)[5]


@pytest.mark.parametrize("text", ["1.2.3." + "0" * 5000 + "1", "1.2.3." + "9" * 5000, "0" * 6000 + ".1.1.1 " + "7" * 5000, "a1" * 3000, "+1 " + "2" * 6000])
def test_very_long_runs_of_digits(text):
    with_limit = [(a, b, k) for a, b, k in pii.protected(text) if k == "ip"]
    assert with_limit == ([(0, len(text), "ip")] if text.startswith("1.2.3.0") else [(0, 6006, "ip")] if text.startswith("0") else [])
    for span in pii.protected(text):
        assert len(pii.entities(text, span)) == 3


def test_personal_data_of_awkward_rows(spark):
    texts = awkward()
    assert pii.digests(clashing(documents(spark, texts))).count() == len(texts)
    assert pii.digests(documents(spark, [])).count() == 0


# ---- decontamination


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_decontamination_matches_sql_on_awkward_rows(spark):
    w = words(21, 60)
    bench = [(1, " ".join(w[:25])), (2, "Tiny item!"), (3, " ".join(w[20:30])), (4, None), (5, ""), (6, "Tiny item!"), (7, "Ünïcode wörds, here"), (None, " ".join(w[40:52]))]
    texts = [*awkward(60), (30, "x " + ", ".join(w[:12]).upper() + " y"), (31, "tiny,item"), (32, " ".join(w[18:33])), (33, " ".join(w[3:12])), (34, "Ünïcode wörds -- here"), (35, " ".join(w[40:52])), (36, "tiny items")]
    docs, benchmark = clashing(documents(spark, texts)), items(spark, bench)
    frames = {"documents": docs.select("doc_id", "text").toPandas(), "benchmark": benchmark.toPandas()}
    for f, c in ((frames["documents"], "doc_id"), (frames["benchmark"], "item_id")):
        f[c] = f[c].astype("Int64")
    expected = duck(frames, decontam.ORACLE)
    assert same(decontam.report(docs, benchmark).collect(), expected)
    for shard in (60, 200):  # several automata give the same
        a = sorted(map(repr, decontam.hits(docs, benchmark, shard_chars=shard).collect()))
        assert a == sorted(map(repr, decontam.hits(docs, benchmark).collect()))
    hit = {r[0] for r in expected if r[5]}
    kept = decontam.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == sum(i not in hit for i, _ in texts) and hit == {30, 31, 32, 34, 35}
    assert decontam.report(docs, items(spark, [])).where("contaminated").count() == 0
    assert decontam.report(documents(spark, []), benchmark).count() == 0


def test_offsets_point_into_the_original(spark):
    w = words(22, 12)
    text = "Ünï. " + "  ,".join(x.upper() for x in w) + "!  end"  # a dash beyond ASCII would belong to the word
    got = decontam.hits(documents(spark, [(1, text)]), items(spark, [(1, " ".join(w))])).first()
    (span,) = got["spans"]
    assert text[span["start"] : span["end"]] == "  ,".join(x.upper() for x in w)


def test_long_items_in_pieces_have_the_same_windows():
    w = words(23, 700)
    for most in (10, 11, 64, 699):
        found = [p for piece in decontam.pieces(" ".join(w), 10, most) for p in decontam.windows(piece)]
        assert set(found) == set(decontam.windows(" ".join(w))) and len(found) < 1.5 * len(w)
    assert decontam.pieces(None) == decontam.pieces(" -- ") == [] and decontam.pieces("Two words", 10, 1) == ["two words"]


def test_a_benchmark_of_many_shards(spark, monkeypatch):
    """Any size of benchmark gives what one automaton gives, also where its hits aren't broadcast."""
    w = words(24, 900)
    bench = items(spark, [(i, " ".join(w[i * 20 : i * 20 + 40])) for i in range(40)] + [(99, " ".join(w)), (None, "lone item here")])
    docs = clashing(documents(spark, [*awkward(200), *[(100 + i, " ".join([*words(500 + i, 30), *w[i * 13 : i * 13 + 5 + i], *words(900 + i, 9)])) for i in range(60)]]))
    rows = lambda **kw: sorted(map(repr, decontam.hits(docs, bench, **kw).collect()))
    kept = lambda **kw: sorted(str(r["doc_id"]) for r in decontam.drop_contaminated(docs, bench, **kw).collect())
    expected, stay = rows(), kept()
    assert len(stay) < docs.count()
    monkeypatch.setattr(decontam, "PIECE_WORDS", 50)
    for limit in (decontam.BROADCAST_BYTES, 0):
        monkeypatch.setattr(decontam, "BROADCAST_BYTES", limit)
        assert rows(shard_chars=2000) == expected and kept(shard_chars=2000) == stay
        assert decontam.drop_contaminated(docs, bench, shard_chars=2000).columns == docs.columns


def test_decontamination_of_a_very_long_text(spark):
    w = words(25, 12)
    long = " ".join(words(26, 400_000))
    got = decontam.hits(documents(spark, [(1, long + " " + " ".join(w) + " " + long)]), items(spark, [(1, " ".join(w))])).first()
    assert got["n_words"] == 800_012 and [tuple(r) for r in got["runs"]] == [(400_000, 400_012)]
