"""The two classifiers: held-out accuracy, bounds, and awkward rows."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.llm import fm, quality_model, queries, toxicity

from .helpers import awkward, clashing, documents

LARGE = "/root/testdata/sf0.1"


@pytest.mark.parametrize(("query", "label", "cutoff", "least"), [("op1_toxicity", "toxic", 0.5, 0.97), ("op8_quality", "quality", 0.3, 0.97)])
def test_held_out_accuracy(spark, query, label, cutoff, least):
    got = queries.QUERIES[query](spark, LARGE).cache()
    assert got.count() == spark.read.parquet(f"{LARGE}/documents.parquet").count()
    assert got.where(f"score < 0 or score > 1 or (score >= {cutoff}) <> (predicted = 1)").count() == 0
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got.select("doc_id", "held_out").take(500))
    truth = spark.read.parquet(f"{LARGE}/labels.parquet")
    out = got.where("held_out").join(truth, "doc_id").agg(F.avg((F.col("predicted") == F.col(label)).cast("double")), F.count(F.lit(1))).first()
    assert out[1] > 300 and out[0] >= least
    got.unpersist()


def test_scores_learn_nothing_from_held_out_rows(spark):
    docs = documents(spark, [(i, "bad bad word" if i % 2 else "fine good text") for i in range(400)])
    kept_out = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    honest = spark.createDataFrame([(i, i % 2, i % 2) for i in range(400)], "doc_id long, quality int, toxic int")
    turned = spark.createDataFrame([(i, (i + (i in kept_out)) % 2, (i + (i in kept_out)) % 2) for i in range(400)], "doc_id long, quality int, toxic int")
    a = sorted(toxicity.scores(docs, honest).collect())
    assert a == sorted(toxicity.scores(docs, turned).collect())


@pytest.mark.parametrize("model", [toxicity, quality_model])
def test_awkward_rows_and_labels(spark, model):
    texts = awkward()
    docs = clashing(documents(spark, texts))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(None, 1, 1), (1, None, None), (1, 1, 1), (1, 0, 0), (99, 1, 1), (6, 0, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, odd):
        rows = model.scores(docs, labels).collect()
        assert len(rows) == len(texts) and all(0 <= r["score"] <= 1 for r in rows)
    assert model.scores(documents(spark, []), odd).count() == 0
    kept = (toxicity.reject if model is toxicity else quality_model.keep)(docs, none)
    assert kept.columns == docs.columns


def test_linear_time_score_is_the_sum_over_pairs():
    rng = np.random.default_rng(3)
    keys, w, v = np.arange(20, dtype=np.uint32), rng.normal(size=20), rng.normal(size=(20, 4)) / 4
    machine = fm.FactorizationMachine(keys, 0.3, w, v)
    x = np.array([1, 4, 7, 19], np.uint32)
    z = 0.3 + w[x].sum() + sum(v[a] @ v[b] for i, a in enumerate(x) for b in x[i + 1 :])
    assert machine.score(x) == pytest.approx(1 / (1 + np.exp(-z)))


def test_interactions_are_learned():
    """An insult and a mention are each harmless; only both together are not."""
    rng = np.random.default_rng(1)
    rows, y = [], []
    for _ in range(1500):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append(np.unique(np.array([1] * a + [2] * b + rng.integers(10, 200, 5).tolist(), np.uint32)))
        y.append(float(a and b))
    m = fm.fit(rows, np.array(y))
    assert m.score(np.array([1, 2], np.uint32)) > 0.5 > max(m.score(np.array([1], np.uint32)), m.score(np.array([2], np.uint32)))


def mixed(rng, n, label):
    """Rows of two features among noise, labelled by both."""
    rows, y = [], []
    for _ in range(n):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append(np.unique(np.array([1] * a + [2] * b + rng.integers(10, 400, 12).tolist(), np.uint32)))
        y.append(float(label(a, b)))
    return rows, np.array(y)


def accuracy(model, rows, y):
    return np.mean([(model.score(r) >= 0.5) == (t > 0) for r, t in zip(rows, y, strict=True)])


def test_features_without_a_tie_of_their_own_are_learned_in_pairs():
    """Neither feature says anything alone; the machine beats a linear model, which is its rank 0."""
    rng = np.random.default_rng(5)
    train, test = mixed(rng, 6000, lambda a, b: a != b), mixed(rng, 800, lambda a, b: a != b)
    places = [fm.buckets_of(r) for r in train[0]]
    assert {1, 2} <= set(fm.select(places, train[1]).tolist())
    assert accuracy(fm.fit(*train), *test) > 0.95 and accuracy(fm.fit(*train, rank=0), *test) < 0.6


def test_pairs_that_add_up_are_no_interaction():
    """Independent evidence isn't taken for a pair."""
    rng = np.random.default_rng(6)
    rows, y = [], []
    for _ in range(4000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append(np.unique(np.array([1] * a + [2] * b + rng.integers(10, 300, 12).tolist(), np.uint32)))
        y.append(float(rng.random() < 1 / (1 + np.exp(1 - 0.6 * a - 0.6 * b))))
    places = [fm.buckets_of(r) for r in rows]
    assert set(fm.select(places, np.array(y)).tolist()) <= {1, 2}


def test_a_labelled_id_of_many_documents_counts_once(spark):
    docs = documents(spark, [(1, f"text number {i}") for i in range(300)] + [(2, "other words"), (3, "more words")])
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    rows, y = fm.sample(docs, labels, "toxic", toxicity.features)
    assert len(rows) == len(y) <= 3


def test_quality_reads_stated_lengths_and_stands_their_lack(spark):
    text = "Plain words of a plain text."
    assert set(quality_model.features(text, None)) != set(quality_model.features(text, len(text))) != set(quality_model.features(text, 9000))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    docs = documents(spark, [(i, text * (1 + i % 2)) for i in range(40)])
    assert quality_model.scores(docs.drop("n_chars"), labels).count() == 40
    assert quality_model.keep(docs.drop("n_chars"), labels).columns == docs.drop("n_chars").columns


def insults(seed, n):
    """Three insults of one, two and five rows in a hundred; toxic only next to the mention of a group."""
    rng = np.random.default_rng(seed)
    rows, y, which, mention = [], [], [], []
    for _ in range(n):
        said, group = [k for k, p in ((1, 0.01), (2, 0.02), (3, 0.05)) if rng.random() < p], rng.random() < 0.4
        rows.append(np.unique(np.array(said + [9] * group + rng.integers(100, 5000, 30).tolist(), np.uint32)))
        y.append(float(bool(said) and group))
        which.append(said)
        mention.append(group)
    return rows, np.array(y), which, np.array(mention)


def test_insults_are_toxic_only_next_to_a_group():
    """With default settings; a linear model, which is rank 0, calls insults alone toxic."""
    train, test = insults(1, 12_000), insults(2, 6000)
    alone = {}
    for rank in (fm.RANK, 0):
        machine = fm.fit(*train[:2], rank=rank)
        said = np.array([machine.score(r) >= 0.5 for r in test[0]])
        for k in (1, 2, 3):
            only = np.array([w == [k] for w in test[2]])
            alone[rank, k] = said[only & ~test[3]].mean()
            assert rank == 0 or said[only & test[3]].mean() > 0.95
    assert all(alone[fm.RANK, k] < 0.05 for k in (1, 2, 3)) and max(alone[0, k] for k in (1, 2, 3)) > 0.5


def test_a_rare_feature_that_matters_with_a_frequent_one_is_selected():
    rng = np.random.default_rng(5)
    rows, y = [], []
    for _ in range(12_000):
        rare, group = rng.random() < 215 / 12_000, rng.random() < 0.4
        rows.append(np.unique(np.array([1] * rare + [9] * group + rng.integers(100, 5000, 30).tolist(), np.uint32)))
        y.append(float(group) if rare else float(rng.random() < 0.5))
    got = fm.select([fm.buckets_of(r) for r in rows], np.array(y)).tolist()
    assert {1, 9} <= set(got) and len(got) < 40
