"""Exact dedup, Merkle manifest and clustering: equal to SQL on whole tables, to brute force on awkward ones."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.llm import clustering, exact_dedup, merkle, queries
from tallyward.llm._shared import scratch_path, written

from .helpers import DATA, awkward, clashing, documents


def rows_of(df):
    return sorted(map(repr, map(tuple, df.collect())))


def duck(sql, frame, name):
    con = duckdb.connect()
    frame = frame.toPandas()
    for c in frame.columns:
        if c in ("doc_id", "vec_id", "n_chars"):
            frame[c] = frame[c].astype("Int64")
    con.register(name, frame)
    return sorted(map(repr, con.sql(sql).fetchall()))


@pytest.mark.parametrize(("query", "table"), [("op11_exact_dedup", "documents"), ("op12_merkle_manifest", "documents"), ("op13_clustering", "embeddings")])
def test_whole_tables_match_sql(spark, query, table):
    con = duckdb.connect()
    con.sql(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    got = queries.QUERIES[query](spark, DATA)
    wanted = con.sql(queries.ORACLE_SQL[query])
    assert got.columns == wanted.columns
    assert rows_of(got) == sorted(map(repr, wanted.fetchall()))


COPIES = [*awkward(), *[(100 + i, "Same TEXT" if i % 2 else "same text") for i in range(120)], (None, "same text"), (50, "É"), (51, "é"), (-3, "x"), (-9, "X")]


def test_exact_dedup_matches_sql_on_awkward_rows(spark):
    docs = clashing(documents(spark, COPIES))
    assert rows_of(exact_dedup.report(docs)) == duck(exact_dedup.ORACLE, docs.select("doc_id", "text"), "documents")
    assert exact_dedup.report(documents(spark, [])).count() == 0
    assert exact_dedup.report(documents(spark, [(None, None), (None, "")])).select("keep_id", "kept", "group_size").distinct().collect() == [(None, True, 2)]


def test_hot_digests_are_told_like_others(spark, monkeypatch):
    """With hot digests, without, and with more of them than are broadcast."""
    docs = documents(spark, [(i, f"t{i % 7}") for i in range(300)])
    wanted = rows_of(exact_dedup.report(docs))
    for hot in (3, 10**6):
        monkeypatch.setattr(exact_dedup, "HOT", hot)
        assert rows_of(exact_dedup.report(docs)) == wanted


def test_the_index_persists_and_dedups_batches(spark):
    path = scratch_path(spark, "index")
    first = clashing(documents(spark, [(1, "a"), (2, "A"), (2, "A"), (3, None), (4, "b")]))
    got = exact_dedup.deduplicated(first, exact_dedup.DigestIndex(spark, path, buckets=3))
    assert got.columns == first.columns
    assert sorted((r["doc_id"], r["text"]) for r in got.select("doc_id", "text").collect()) == [(2, "A"), (3, None), (4, "b")] or sorted(
        map(repr, got.select("doc_id", "text").collect())) == sorted(map(repr, [(2, "A"), (3, None), (4, "b")]))
    for name in ("entries", "arrivals"):  # as another session would find it
        spark.sql(f"DROP TABLE {getattr(exact_dedup.DigestIndex(spark, path), '_' + name)}")
    again = exact_dedup.DigestIndex(spark, path)
    assert again.buckets == 3
    later = exact_dedup.deduplicated(documents(spark, [(9, "a"), (10, "new"), (11, ""), (12, "NEW")]), again)
    assert [(r["doc_id"], r["text"]) for r in later.collect()] == [(12, "NEW")]
    assert again.entries.count() == 4 and again.sizes.agg(F.sum("n")).first()[0] == 9
    # The same batch once more: its own rows stay.
    assert [r["doc_id"] for r in exact_dedup.deduplicated(documents(spark, [(9, "a"), (12, "NEW")]), again).collect()] == [12]


def test_exact_dedup_is_native_and_its_anti_join_needs_no_exchange(spark):
    index = exact_dedup.DigestIndex(spark, scratch_path(spark, "index"))
    rows = exact_dedup.digests(documents(spark, COPIES))
    index.add(rows)
    came = spark.table(index._arrivals).select("digest", "keep_id").join(index.entries.hint("merge"), "digest", "left_anti")
    plan = came._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and "Exchange" not in plan
    assert not re.search("Python|Pandas|Arrow", index.told(rows)._jdf.queryExecution().executedPlan().toString())


# --- manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def leaf(doc, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc["doc_id"], doc["source"], doc["lang"], doc["n_chars"], text)))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        low = i // 16 * 16
        run = level[low : low + 16]
        out.append((i - low, run[: i - low] + run[i - low + 1 :]))
        i //= 16
    return out


def brute(docs):
    by = {}
    for d in docs:
        by.setdefault(d["source"], []).append((d, leaf(d, d["text"])))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for rows in by.values():
        rows.sort(key=lambda x: (x[0]["doc_id"] is not None, x[0]["doc_id"] or 0, x[1]))
    trees = {s: tree([x[1] for x in by[s]]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (d, own) in enumerate(by[s]):
            steps, end = path(trees[s], i) + path(top, k), own
            if d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0 and d["text"] is not None:
                end = leaf(d, d["text"].translate(LOWER))
            for at, others in steps:
                end = sha("".join([*others[:at], end, *others[at:]]))
            out.append((d["doc_id"], own, trees[s][-1][0], top[-1][0], sha("".join("".join(o) for _, o in steps)), end, end == top[-1][0]))
    return sorted(map(repr, out))


def sourced(spark, n, seed):
    rng = random.Random(seed)
    names = [None, "", "a", "é", "hot", "hot", "hot", "z"]
    rows = [(i, rng.choice(["Text", "text", None, "", f"No {i}"]), rng.choice([None, "de"]), rng.choice(names), rng.choice([None, 3])) for i in range(-5, n)]
    rows += [(None, "x", None, "hot", None), (None, "x", None, "hot", None), (None, "y", None, None, 1), (7, "twin", "de", "a", 1), (7, "other", "de", "a", 1), (10**12, "alone", None, "lone", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)


@pytest.mark.parametrize(("n", "depth"), [(0, 3), (700, 1), (700, 2)])
def test_manifest_equals_brute_force(spark, n, depth):
    """Trees of a lone leaf, ragged runs, and of several walks one above the other."""
    docs = sourced(spark, n, n + depth)
    assert rows_of(merkle.manifest(clashing(docs), depth=depth)) == brute([r.asDict() for r in docs.collect()])


def test_manifest_of_many_sources_and_of_odd_tables(spark):
    many = spark.range(100).selectExpr("id as doc_id", "'Text' as text", "'en' as lang", "concat('s', id % 90) as source", "4L as n_chars")
    assert rows_of(merkle.manifest(many, depth=1)) == brute([r.asDict() for r in many.collect()])
    assert merkle.manifest(documents(spark, [])).count() == 0
    assert merkle.manifest(documents(spark, awkward())).count() == len(awkward())
    bare = many.limit(20).select("doc_id", "text")
    assert rows_of(merkle.manifest(bare)) == brute([r.asDict() | dict.fromkeys(("lang", "source", "n_chars")) for r in bare.collect()])


def test_manifest_matches_sql_on_awkward_rows(spark):
    docs = sourced(spark, 200, 3)
    assert rows_of(merkle.manifest(docs)) == duck(merkle.ORACLE, docs, "documents")


# --- clustering


def lloyd(vectors, k=16, rounds=3):
    """In Python's integers."""
    kept = [(i, [int(np.floor(np.float64(v) * 64)) if abs(v) < 2**900 else int(v) * 64 for v in x]) for i, x in vectors if x is not None and len(x) == 64 and all(v is not None and np.isfinite(v) for v in x)]
    first = sorted(kept, key=lambda r: (r[0] is None, sha(f"1:{r[0]}"), r[1]))[:k]
    cs = [list(c) for _, c in first]

    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(cs))

    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(near(x)[1], []).append(x)
        for j, xs in groups.items():
            cs[j] = [sum(col) // len(xs) for col in zip(*xs, strict=True)]
    at = [(i, *near(x)) for i, x in kept]
    far = {j: sum(d for _, d, g in at if g == j) for j in range(len(cs))}
    cut = lambda v: min(v, 2**63 - 1)
    return sorted(repr((i, j, cut(d), cut(far[j]), cut(sum(far.values())), sha(",".join(map(str, cs[j]))))) for i, d, j in at)


@pytest.mark.parametrize("size", [1.0, 1e8, 3e30])
def test_clusters_are_exact_at_every_magnitude(spark, size):
    """In float64, in 64-bit integers, and beyond them; ties, repeated rows, shared and missing ids."""
    rng = np.random.default_rng(int(size % 97))
    rows = [(i, (rng.normal(size=64) * size).tolist()) for i in range(60)] + [(3, [size] * 64), (3, [size / 2] * 64), (None, [0.0] * 64), (70, [0.0] * 64), (70, [0.0] * 64), (71, [-0.25] * 64)]
    rows += [(80, None), (81, []), (82, [1.0] * 63), (83, [1.0] * 63 + [None]), (84, [1.0] * 63 + [float("nan")]), (85, [1.0] * 63 + [float("inf")])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    extra = frame.withColumns({c: F.lit("own") for c in ("x", "cluster", "lot", "n", "far")})
    assert rows_of(clustering.clusters(extra)) == lloyd(rows)


def test_few_vectors_and_none(spark):
    kind = "vec_id long, embedding array<float>"
    few = [(i, [float(i)] * 64) for i in range(5)]
    assert rows_of(clustering.clusters(spark.createDataFrame(few, kind))) == lloyd(few)
    assert clustering.clusters(spark.createDataFrame([], kind)).count() == 0
    assert clustering.clusters(spark.createDataFrame([(1, None)], kind)).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_guards_choose_the_numbers(spark):
    x = np.array([[2.0**26, 1.0]])
    for scale, kind in ((1, np.int64), (0.0001, np.float64), (2.0**20, object)):
        assert clustering.nearest(np.floor(x * scale), np.floor(x * scale))[1].dtype == kind
    kept = written(clustering.quantised(spark.createDataFrame([(1, [0.5] * 64), (2, [-0.01] * 64)], "vec_id long, embedding array<float>")), "v")
    assert sorted((r["vec_id"], r["x"][0]) for r in kept.collect()) == [(1, 32.0), (2, -1.0)]
