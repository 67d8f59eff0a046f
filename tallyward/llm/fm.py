"""Second-order factorisation machine over hashed features.

score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2))

The pairwise part costs time linear in the features of a document, by the
sum-of-squares identity, and learns that two features together mean more than
their weights.  Features are hashed into ``BUCKETS`` places of a fixed table.  The model
holds those that the training sample ties to the label, by themselves (chi-squared above
``MIN_CHI2``) or as one of a pair: where two features stand together, the label differs by ``MIN_PAIR``
standard deviations from what both say alone.  Pairs are counted exactly: of the ``PAIRED`` most frequent features with each
other, and with every rarer one of ``MIN_TOGETHER`` rows or more.
All others have no weight, and the model's size is bounded whatever the corpus.

Training runs on the driver over a bounded sample: about ``MAX_TRAIN_ROWS``
labelled documents, half of each class if there are so many, chosen by a hash of the
id, one row of each id, each as its distinct feature hashes.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import held_out, lacking, mapped

#: Bound of the training sample, in labelled documents.
MAX_TRAIN_ROWS = 12_000
#: Bounds of the model.
BUCKETS, MAX_FEATURES, RANK = 1 << 18, 16_384, 8
#: Association a feature needs; the chance of as much by accident is under one in a million.
MIN_CHI2, MIN_ROWS = 25.0, 4
#: Frequent features, rows in which a pair has to stand, and the deviation it needs; among some ten million pairs a few reach it by accident.
PAIRED, MIN_TOGETHER, MIN_PAIR = 2048, 20, 5.0
BATCH = 256

#: 32-bit hashes of a text, and of the metadata columns named beside it.
Features = Callable[..., np.ndarray]
Metadata = tuple[tuple[str, T.DataType | str], ...]


def buckets_of(hashes: np.ndarray) -> np.ndarray:
    """The distinct places of hashes in the table."""
    return np.unique(hashes & np.uint32(BUCKETS - 1))


class FactorizationMachine:
    """A trained model: a table from buckets to rows of weights and latent factors."""

    def __init__(self, buckets: np.ndarray, bias: float, weights: np.ndarray, factors: np.ndarray) -> None:
        self.bias, self.weights, self.factors = bias, weights.astype(np.float32), factors.astype(np.float32)
        self.row = np.full(BUCKETS, -1, np.int32)
        self.row[buckets] = np.arange(len(buckets))

    def score(self, features: np.ndarray) -> float:
        """Probability of label 1 from the hashes of one document, each of which counts once."""
        at = self.row[features & np.uint32(BUCKETS - 1)]
        at = np.unique(at[at >= 0])
        z = self.bias
        if len(at):
            v = self.factors[at]
            total = v.sum(0)
            z += float(self.weights[at].sum()) + 0.5 * float(total @ total - (v * v).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _step(value: np.ndarray, gradient: np.ndarray, squares: np.ndarray, rate: float) -> None:
    """Adagrad, in place."""
    squares += gradient * gradient
    value -= rate * gradient / np.sqrt(squares)


def _alone(seen: np.ndarray, hit: np.ndarray, n: int, ones: float) -> np.ndarray:
    """Chi-squared of each feature's presence against the label."""
    expected, spread = seen * ones / n, seen * (1 - seen / n) * (ones / n) * (1 - ones / n)
    return np.where(spread > 0, (hit - expected) ** 2 / np.maximum(spread, 1e-9), 0)


def _unlike(both: np.ndarray, both_hit: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """Where rows with two features have another share of label 1 than the sum of both features' log odds says."""
    share = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return (both >= MIN_TOGETHER) & (np.abs(both_hit - both * share) >= MIN_PAIR * np.sqrt(both * share * (1 - share) + 1))


def _paired(places: list[np.ndarray], labels: np.ndarray, seen: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """Features of a pair whose rows have another share of label 1 than both features' own shares add up to.

    Rows are columns of a dense table of the most frequent features, of bounded size; a rarer feature's rows are summed from it.
    """
    n, ones = len(labels), labels.sum()
    varied = np.minimum(seen, n - seen)
    chosen = np.sort(np.argsort(-varied, kind="stable")[:PAIRED])
    chosen = chosen[varied[chosen] >= MIN_TOGETHER]
    column = np.full(BUCKETS, -1, np.int32)
    column[chosen] = np.arange(len(chosen))
    table = np.zeros((n, len(chosen)), np.uint8)
    both, both_hit = (np.zeros((len(chosen), len(chosen)), np.float32) for _ in range(2))
    for begin in range(0, n, 1024):  # in parts, so that memory stays near the table's
        part = slice(begin, min(begin + 1024, n))
        for line in range(part.start, part.stop):
            at = column[places[line]]
            table[line, at[at >= 0]] = 1
        dense, hits = table[part].astype(np.float32), table[part][labels[part] > 0].astype(np.float32)
        both += dense.T @ dense
        both_hit += hits.T @ hits
    odds = lambda k, of: np.log((k + 0.5) / (of - k + 0.5)).astype(np.float32)
    own, base = odds(hit[chosen], seen[chosen]), odds(ones, n)
    kept = np.zeros(len(chosen), bool)
    for begin in range(0, len(chosen), 256):
        line = slice(begin, begin + 256)
        off = _unlike(both[line], both_hit[line], own[line, None] + own[None, :] - base)
        off[np.arange(off.shape[0]), np.arange(begin, begin + off.shape[0])] = False
        kept[line] |= off.any(1)
        kept |= off.any(0)
    del both, both_hit
    rarer = np.flatnonzero((seen >= MIN_TOGETHER) & (column < 0) & (varied >= MIN_TOGETHER))
    cell = np.full(BUCKETS, -1, np.int32)
    cell[rarer] = np.arange(len(rarer))
    found = [(c[c >= 0], line) for line, c in ((line, cell[row]) for line, row in enumerate(places))]
    which, lines = np.concatenate([c for c, _ in found]), np.repeat([line for _, line in found], [len(c) for c, _ in found])
    order = np.argsort(which, kind="stable")
    ends = np.searchsorted(which[order], np.arange(len(rarer) + 1))
    rare = []
    for i, feature in enumerate(rarer.tolist()):
        rows = lines[order[ends[i] : ends[i + 1]]]
        off = _unlike(table[rows].sum(0, dtype=np.float32), table[rows[labels[rows] > 0]].sum(0, dtype=np.float32), own + odds(hit[feature], seen[feature]) - base)
        if off.any():
            rare.append(feature)
            kept |= off
    return np.concatenate([chosen[kept], np.array(rare, np.int64)])


def select(places: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """The buckets that get weights, sorted."""
    n, ones = len(labels), float(labels.sum())
    seen = np.bincount(np.concatenate(places), minlength=BUCKETS)
    hit = np.bincount(np.concatenate([p for p, y in zip(places, labels, strict=True) if y > 0]), minlength=BUCKETS)
    chi2 = _alone(seen, hit, n, ones)
    good = np.flatnonzero((chi2 >= MIN_CHI2) & (seen >= MIN_ROWS))
    paired = _paired(places, labels, seen, hit)[: MAX_FEATURES // 2]
    best = good[np.argsort(-chi2[good], kind="stable")]
    best = best[~np.isin(best, paired)][: MAX_FEATURES - len(paired)]
    return np.sort(np.concatenate([best, paired]))


#: Shares of its features that a row may lose in training; which is best, rows decide that are kept out of a first fit.
DROPOUTS, KEPT_OUT = (0.0, 0.6), 5


def fit(rows: list[np.ndarray], labels: np.ndarray, rank: int = RANK, epochs: int = 40, rate: float = 0.08,
        decay: float = 2e-3, dropout: float | None = None, seed: int = 7) -> FactorizationMachine:
    """Adagrad on the logistic loss, classes weighted alike.

    Each row may lose a random share of its features in each epoch, up to ``dropout``, so that one insult alone has to weigh enough.  Where
    only two features together mean something, that would teach that one of them does; so whether rows lose any is decided
    by the loss on every fifth row, kept out of trial fits.

    No rows, or rows of one class, give a constant: the smoothed share of label 1.
    """
    labels = np.asarray(labels, np.float32)
    n, ones = len(labels), float(labels.sum())
    prior = (ones + 1) / (n + 2)
    constant = FactorizationMachine(np.zeros(0, np.int64), float(np.log(prior / (1 - prior))), np.zeros(0), np.zeros((0, rank)))
    if ones in (0, n):
        return constant
    places = [buckets_of(r) for r in rows]
    good = select(places, labels)
    if not len(good):
        return constant
    row = np.full(BUCKETS, -1, np.int32)
    row[good] = np.arange(len(good))
    at = [r[r >= 0] for r in (row[p] for p in places)]
    del places
    train = functools.partial(_train, good=good, rank=rank, epochs=epochs, rate=rate, decay=decay, seed=seed)
    if dropout is None:
        out = np.random.default_rng(seed).permutation(n) % KEPT_OUT == 0
        inside, outside = ([a for a, o in zip(at, out, strict=True) if o == want] for want in (False, True))
        losses = [_loss(train(inside, labels[~out], dropout=d), [good[a].astype(np.uint32) for a in outside], labels[out]) for d in DROPOUTS]
        dropout = DROPOUTS[int(np.argmin(losses))]
    return train(at, labels, dropout=dropout)


def _train(at: list[np.ndarray], labels: np.ndarray, good: np.ndarray, rank: int, epochs: int, rate: float, decay: float, dropout: float, seed: int) -> FactorizationMachine:
    """The machine over the buckets ``good``, from each row's places among them."""
    n, ones = len(labels), float(labels.sum())
    if ones in (0, n):
        prior = (ones + 1) / (n + 2)
        return FactorizationMachine(np.zeros(0, np.int64), float(np.log(prior / (1 - prior))), np.zeros(0), np.zeros((0, rank)))
    random = np.random.default_rng(seed)
    size = len(good)
    w, v = np.zeros(size, np.float32), random.normal(0, 0.02, (size, rank)).astype(np.float32)
    gw, gv = np.full(size, 1e-6, np.float32), np.full((size, rank), 1e-6, np.float32)
    bias, gb = 0.0, 1e-6
    cost = np.where(labels > 0, n / (2 * ones), n / (2 * (n - ones))).astype(np.float32)
    dense = np.zeros((BATCH, size), np.float32)
    for _ in range(epochs):
        order = random.permutation(n)
        for begin in range(0, n, BATCH):
            batch = order[begin : begin + BATCH]
            cells = [at[b] for b in batch]
            line, cols = np.repeat(np.arange(len(batch)), [len(c) for c in cells]), np.concatenate(cells)
            if dropout:
                stay = random.random(len(cols)) >= (dropout * random.random(len(batch)))[line]
                line, cols = line[stay], cols[stay]
            x = dense[: len(batch)]
            x[line, cols] = 1
            total = x @ v
            z = bias + x @ w + 0.5 * ((total * total).sum(1) - x @ (v * v).sum(1))
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[batch]) * cost[batch] / len(batch)
            down = error @ x
            share = decay * len(batch) / n
            slope = x.T @ (error[:, None] * total) - down[:, None] * v + share * v
            _step(w, down + share * w, gw, rate)
            _step(v, slope, gv, rate)
            gb += float(error.sum()) ** 2
            bias -= rate * float(error.sum()) / gb**0.5
            x[line, cols] = 0
    return FactorizationMachine(good, float(bias), w, v)


def _loss(model: FactorizationMachine, rows: list[np.ndarray], labels: np.ndarray) -> float:
    """Mean logistic loss, classes weighted alike."""
    p = np.clip([model.score(r) for r in rows], 1e-6, 1 - 1e-6)
    loss = -np.where(labels > 0, np.log(p), np.log(1 - p))
    return float(np.mean([loss[labels == y].mean() for y in (0, 1) if (labels == y).any()]))


def _inputs(docs: DataFrame, metadata: Metadata) -> DataFrame:
    """``doc_id, text`` and the metadata columns; those that ``docs`` lacks are null."""
    have = {c.lower() for c in docs.columns}
    for name, kind in metadata:
        if name.lower() not in have:
            docs = docs.withColumn(name, F.lit(None).cast(kind))
    return lacking(docs, [("doc_id", "long"), ("text", "string"), *metadata])


def _features_of(batch: pa.RecordBatch, features: Features, first: int) -> Iterator[np.ndarray]:
    """The features of each row; the text is column ``first``, metadata follow it."""
    more = [batch.column(i).to_pylist() for i in range(first + 1, batch.num_columns)]
    for at, text in enumerate(batch.column(first)):
        yield features(text.as_py() or "", *[m[at] for m in more])


def sample(docs: DataFrame, labels: DataFrame, label: str, features: Features, metadata: Metadata = (),
           max_rows: int = MAX_TRAIN_ROWS) -> tuple[list[np.ndarray], np.ndarray]:
    """The bounded training sample: feature hashes and labels, never of held-out rows.

    A document that several label rows name has the largest of their labels; rows
    with a null id or label teach nothing, and so do labels without a document.  Of
    documents that share an id one is taken, so the sample is bounded by the labels chosen.
    """
    known = (lacking(labels, [("doc_id", "long"), (label, "int")]).where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
             .groupBy("doc_id").agg((F.max(label) > 0).cast("int").alias("y")).where(~held_out("doc_id")))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    most = {0: max_rows - min(max_rows // 2, counts.get(1, 0)), 1: max_rows - min(max_rows // 2, counts.get(0, 0))}
    lot = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("training")), F.lit(1_000_000)).cast("double") / 1e6
    share = F.when(F.col("y") == 1, most[1] / max(counts.get(1, 0), 1)).otherwise(most[0] / max(counts.get(0, 0), 1))
    chosen = known.where(lot < share)  # at most about max_rows rows of 12 bytes: bounded, so it can be broadcast
    rows = _inputs(docs, metadata).join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "text", *[name for name, _ in metadata])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(x).tobytes() for x in _features_of(batch, features, 2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], ["doc_id", "y", "x"])

    one = mapped(rows, run, "doc_id long, y int, x binary").groupBy("doc_id").agg(F.min("y").alias("y"), F.min("x").alias("x"))
    got = sorted({(r["y"], bytes(r["x"])) for r in one.select("y", "x").toLocalIterator()})  # copies count once
    return [np.frombuffer(x, np.uint32) for _, x in got], np.array([y for y, _ in got], float)


def scorer(docs: DataFrame, model: FactorizationMachine, features: Features, cutoff: float, metadata: Metadata = ()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``, in one pass without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [shared.value.score(x) for x in _features_of(batch, features, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    scored = mapped(_inputs(docs, metadata), run, "doc_id long, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= F.lit(cutoff)).cast("int").alias("predicted"))


def keep_where(docs: DataFrame, model: FactorizationMachine, features: Features, kept: Callable[[float], bool], metadata: Metadata = ()) -> DataFrame:
    """The rows of ``docs`` whose score ``kept`` accepts, with all their columns, without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    places = {c.lower(): i for i, c in enumerate(docs.columns)}
    wanted = [places.get(name) for name in ("text", *[name for name, _ in metadata])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inputs = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows) if i is None else batch.column(i) for i in wanted], [str(i) for i in range(len(wanted))])
            yield batch.filter(pa.array([kept(shared.value.score(x)) for x in _features_of(inputs, features, 0)], pa.bool_()))

    return mapped(docs, run, docs.schema)
