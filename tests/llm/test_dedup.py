"""SimHash groups and line dedup against brute force."""

from __future__ import annotations

import itertools
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tallyward.llm import bitslice, line_dedup, simhash
from tallyward.llm.components import connected_components

from .helpers import DATA, awkward, clashing, documents, words


def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def plain_components(rows):
    """Smallest id reachable over links of at most four bits."""
    n = len(rows)
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(n), 2):
        if (rows[i][1] ^ rows[j][1]).bit_count() <= 4:
            parent[root(j)] = root(i)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted(((doc, fp, least.get(root(i))) for i, (doc, fp) in enumerate(rows)), key=str)


def plain_kept(texts):
    """Ids that stay: of each group the least by id and hash of the text, once; and every row without an id."""
    n, prints = len(texts), [plain_fingerprint(t) for _, t in texts]
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(n), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 4:
            parent[root(j)] = root(i)
    best = {}
    for i, (doc, text) in enumerate(texts):
        if doc is not None:
            best.setdefault(root(i), set()).add((doc, (xxhash.xxh64_intdigest((text or "").encode(), 42) + (1 << 63)) % (1 << 64)))
    return [min(x)[0] for x in best.values()] + [None for doc, _ in texts if doc is None]


def test_rows_that_share_an_id(spark):
    """Different texts under one id are documents of their own; equal ones, and near copies under the kept id, leave one row."""
    base, other = words(61, 300), " ".join(words(62, 200))
    near = [*base]
    near[150] = "changed"
    texts = [(5, " ".join(base)), (5, " ".join(base)), (5, " ".join(near)), (5, other), (7, other), (9, " ".join(words(63, 90))), (None, other), (None, None), (8, None), (8, "")]
    kept = simhash.keep_one(clashing(documents(spark, texts)))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, plain_kept(texts))) == sorted(["5", "5", "9", "None", "None", "8"])


def test_bit_sliced_distances():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 5, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for k in rng.integers(0, 8, 400)], np.uint64)
    values = np.unique(base[rng.integers(0, 5, 400)] ^ flips)
    dist = np.bitwise_count(values[:, None] ^ values[None, :])
    for radius in range(6):
        bits = np.unpackbits(bitslice.adjacency(values, radius).view(np.uint8), axis=1, bitorder="little")[:, : len(values)]
        assert (bits.astype(bool) == (dist <= radius)).all()
        i, j = np.triu_indices(len(values), 1)
        assert (bitslice.near_pairs(values[i], values[j], radius) == (dist[i, j] <= radius)).all()
    member, root = bitslice.stars(values, 4)
    assert len(member) < len(values) and (root < member).all()


def test_fingerprints_take_the_engines_hash(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("naïve words are four"))).first()[0]
    assert got % (1 << 64) == xxhash.xxh64_intdigest("naïve words are four".encode(), 42)


def test_components_on_whole_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs.select("doc_id", "text").collect()]
    got = simhash.components(docs).collect()
    assert sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got), key=str) == plain_components(rows)


def test_components_of_awkward_rows_in_small_tiles(spark, monkeypatch):
    rng = random.Random(5)
    texts = awkward()
    base = words(1, 120)
    for i in range(60):  # one large group of near copies
        copy = list(base)
        copy[rng.randrange(120)] = f"changed{i}"
        texts.append((100 + i, " ".join(copy)))
    docs = clashing(documents(spark, texts))
    expected = plain_components([(i, plain_fingerprint(t)) for i, t in texts])
    nodes = simhash.fingerprints(docs).select("fp").distinct()
    few = connected_components(simhash.links(nodes, tile=4)).count()
    assert few == connected_components(simhash.links(nodes)).count()
    got = simhash.components(docs).collect()
    assert sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got), key=str) == expected
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, plain_kept(texts)))


def test_finer_buckets_find_the_same_links(spark):
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(x) for x in rng.choice(64, k, replace=False)) for b in base for k in (0, 1, 3, 4, 5)]
    nodes = spark.createDataFrame([((v + (1 << 63)) % (1 << 64) - (1 << 63),) for v in set(near)], "fp long")
    found = [sorted(connected_components(simhash.links(nodes, agree=agree)).collect()) for agree in (2, 3, 4)]
    assert found[0] and found[0] == found[1] == found[2]
    assert [simhash.blocks_to_agree(10**n) for n in (0, 6, 8, 10, 12)] == sorted(simhash.blocks_to_agree(10**n) for n in (0, 6, 8, 10, 12))
    assert simhash.blocks_to_agree(10**6) == 2 < simhash.blocks_to_agree(10**10)


def test_components_of_a_chain_and_a_hub(spark):
    links = [(i + 1, i) for i in range(10, 60)] + [(1000 + i, 999) for i in range(300)] + [(7, 7)]
    got = dict(connected_components(spark.createDataFrame(links, "u long, v long")).collect())
    assert got == {**{i: 10 for i in range(11, 61)}, **{1000 + i: 999 for i in range(300)}}


def test_empty_tables(spark):
    none = documents(spark, [])
    assert simhash.components(none).count() == 0 and simhash.keep_one(none).count() == 0
    assert line_dedup.report(none).count() == 0 and line_dedup.deduplicated(none).columns == none.columns


def plain_line_dedup(texts):
    """Words deleted: those in a stretch of 50 words, or in a physical line of two or more, that occurs earlier; documents in order."""
    key = lambda t: (xxhash.xxh64_intdigest(t.encode(), 42) + (1 << 63)) % (1 << 64)
    order = sorted((i, key(t), t) for i, t in set(texts) if i is not None and t is not None)
    seen, lines, out = set(), set(), {}
    for doc, _, text in order:
        w = text.split()
        hit = [False] * len(w)
        for a in range(len(w) - 49):
            gram = tuple(w[a : a + 50])
            if gram in seen:
                hit[a : a + 50] = [True] * 50
            seen.add(gram)
        at = 0
        for line in text.split("\n"):
            gram = tuple(line.split())
            if len(gram) >= line_dedup.LEAST_WORDS:
                if gram in lines:
                    hit[at : at + len(gram)] = [True] * len(gram)
                lines.add(gram)
            at += len(gram)
        out[doc, text] = sum(hit)
    return out


def planted():
    a, b = " ".join(words(2, 60)), " ".join(words(3, 51))
    short = " ".join(words(4, 49))
    noise = [" ".join(words(100 + i, 40)) for i in range(12)]
    return [(1, noise[0] + " " + a + "\n" + noise[1]), (2, noise[2] + "\n" + a.replace(" ", "\n", 3) + " " + noise[3]), (3, b + " " + noise[4]),
            (4, noise[5] + " mid " + b), (5, short + " " + noise[6]), (6, noise[7] + " " + short), (7, a + " " + b), (8, noise[8] + " é " + a + " ü " + noise[9]),
            (9, noise[10]), (9, noise[11])]


def test_planted_passages(spark):
    texts = planted() + awkward()[1:6]
    docs = clashing(documents(spark, texts))
    expected = plain_line_dedup(texts)
    got = line_dedup.report(docs).collect()
    assert len(got) == len(texts)
    removed = {r["doc_id"]: r["n_removed"] for r in got if r["doc_id"] in (1, 2, 3, 4, 5, 6, 7, 8, 9)}
    want = {}
    for (doc, text), n in expected.items():
        want.setdefault(doc, n)
    assert {k: removed[k] for k in (2, 3, 4, 5, 6, 7, 8)} == {k: want[k] for k in (2, 3, 4, 5, 6, 7, 8)}
    assert removed[7] == 111 and removed[5] == removed[6] == 0
    kept = line_dedup.deduplicated(docs)
    assert kept.columns == docs.columns and kept.count() == len(texts)
    text_of = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert text_of[7].strip() == "" and text_of[8].count("ü") == 1 and len(text_of[8].split()) == 82
    assert line_dedup.deduplicated(docs, drop_emptied=True).where("doc_id = 7").count() == 0


def test_line_dedup_by_shuffles(spark, monkeypatch):
    """The ways for tables too large to broadcast, each alone and all together, give the same."""
    texts = planted() + awkward()
    docs = clashing(documents(spark, texts))
    rows = lambda: sorted(map(repr, line_dedup.report(docs).collect()))
    whole = lambda: sorted(repr((r["doc_id"], r["text"])) for r in line_dedup.deduplicated(docs).collect())
    expected, left = rows(), whole()
    for limit in (0, 100, 3_000, 10_000):
        monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", limit)
        assert rows() == expected and whole() == left


def test_near_duplicates_by_shuffles(spark, monkeypatch):
    docs = clashing(documents(spark, awkward()))
    expected = sorted(repr((r["doc_id"], r["text"])) for r in simhash.keep_one(docs).collect())
    monkeypatch.setattr(simhash, "BROADCAST_BYTES", 0)
    assert sorted(repr((r["doc_id"], r["text"])) for r in simhash.keep_one(docs).collect()) == expected


def test_winnowing_guarantee():
    w = np.array([xxhash.xxh64_intdigest(x) for x in words(9, 400)], np.uint64)
    at, _ = line_dedup.winnow(w)
    assert np.diff(np.concatenate([[-1], at, [400 - line_dedup.LINE + 1]])).max() <= line_dedup.WINDOW
    same = np.full(300, w[0])
    at, hashes = line_dedup.winnow(same)
    assert len(set(hashes.tolist())) == 1 and np.diff(at).max() <= line_dedup.WINDOW


def removed_of(spark, texts):
    got = line_dedup.report(documents(spark, texts)).collect()
    return {r["doc_id"]: r["n_removed"] for r in got}


def test_repeats_behind_an_earlier_short_or_edited_one(spark):
    """The fingerprints' first places lie in repeats of under 50 words; whole ones follow among later documents."""
    texts, doc = [], 0
    for trial, n in enumerate((50, 55, 60, 80, 120) * 4):
        passage = words(5000 + trial, n)
        cut = trial % max(1, n - 45)
        edited = list(passage)
        for i in range(trial % 40, n, 40):
            edited[i] = f"edited{trial}x{i}"
        firsts = (passage[cut : cut + 45], edited)
        for part in (firsts[trial % 2], passage, passage, passage[:45] + words(7000 + trial, 9) + passage[3:]):
            doc += 1
            texts.append((doc, " ".join([*words(9000 + doc, 30), *part, *words(11000 + doc, 30)])))
    want = {d: n for (d, _), n in plain_line_dedup(texts).items()}
    assert sum(n > 0 for n in want.values()) >= 30
    assert removed_of(spark, texts) == want


def test_line_dedup_equals_brute_force_on_whole_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("doc_id is not null and text is not null")
    texts = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
    want = {doc: n for (doc, _), n in plain_line_dedup(texts).items()}
    got = {r["doc_id"]: r["n_removed"] for r in line_dedup.report(docs).collect()}
    assert {d: (want[d], got[d]) for d in want if want[d] != got[d]} == {}


def test_repeated_rows_with_a_repeated_passage(spark):
    """Equal rows that repeat an earlier passage stay as many rows."""
    passage = " ".join(words(71, 60))
    row = (2, " ".join(words(72, 30)) + " " + passage)
    texts = [(1, passage + " " + " ".join(words(73, 30))), row, row, row]
    docs = documents(spark, texts)
    got = sorted((r["doc_id"], r["n_removed"], r["n_runs"]) for r in line_dedup.report(docs).collect())
    assert got == [(1, 0, 0), (2, 60, 1), (2, 60, 1), (2, 60, 1)]
    assert sorted(r["doc_id"] for r in line_dedup.deduplicated(docs).collect()) == [1, 2, 2, 2]


def test_short_physical_lines(spark):
    """A line of two words or more goes where it occurs again, in the same document too; shorter ones stay."""
    line, brief = " ".join(words(81, 11)), "one"
    texts = [(1, f"a b\n{line}\n{brief}\nc"), (2, f"{line} \n{brief}\n d"), (3, f"start {line}\n{brief}\n  {line.replace(' ', '  ')}\r\n{line}"), (4, line), (5, "x\n" + line)]
    assert removed_of(spark, texts) == {1: 0, 2: 11, 3: 22, 4: 11, 5: 11} == {d: n for (d, _), n in plain_line_dedup(texts).items()}
    left = {r["doc_id"]: r["text"] for r in line_dedup.deduplicated(documents(spark, texts)).collect()}
    assert left[1] == texts[0][1] and left[2].split() == [*brief.split(), "d"] and left[5].split() == ["x"]


def test_recall_on_repeated_physical_lines(spark):
    """Of all later occurrences of lines in the test table, those deleted."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("doc_id is not null and text is not null").orderBy("doc_id")
    left = {r["doc_id"]: r["text"] for r in line_dedup.deduplicated(docs).collect()}
    seen, later, found = set(), 0, 0
    for r in docs.collect():
        lines = [" ".join(x.split()) for x in r["text"].split("\n")]
        own = [" ".join(x.split()) for x in left[r["doc_id"]].split("\n")]
        for x in lines:
            if len(x.split()) >= line_dedup.LEAST_WORDS:
                if x in seen:
                    later += 1
                    found += x not in own
                seen.add(x)
    assert later > 1000 and found / later >= 0.9


def test_passages_that_leave_their_first_copy_alike(spark):
    """Later documents share more with each other than with the first, on the left, on the right, and on both sides."""
    core, left, right = words(91, 30), words(92, 40), words(93, 40)
    shapes = [words(94, 40) + core + words(95, 40), left + core + words(96, 40), left + core + right, words(97, 40) + core + right, left[10:] + core + right[:25], core + right, left + core]
    texts = [(i + 1, " ".join(x)) for i, x in enumerate(shapes)]
    assert removed_of(spark, texts) == {d: n for (d, _), n in plain_line_dedup(texts).items()}
