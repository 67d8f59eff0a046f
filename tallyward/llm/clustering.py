"""Centroid clustering of integer vectors, exact: nearest centroids by a blocked matrix product.

Squared distances are expanded, |x|^2 - 2 x.c + |c|^2, so that those of a block of vectors to all centroids are one
matrix product in float64.  Components are whole numbers; as long as every term and every partial sum stays below
2^53, float64 holds them exactly, whatever order the product sums in.  Bounds on the
magnitudes of block and centroids guard that: beyond 2^53 a block is done in 64-bit integers, and
beyond 2^63 in integers of any size.  Sums over a cluster are guarded alike.

Each task reduces its blocks to sums and counts per cluster, and the tasks' sums are combined by ``treeAggregate``,
so the driver gets one set of sums however many tasks there are.  Rounds read the kept vectors from a table.

Defined results: vectors that are null, have another length, or a component that is null or not finite are left out (so
is one whose 64-fold is beyond float64).  With fewer vectors than centroids each is one; without any the result is empty.  Rows that
repeat, or share an id, count each; rows without an id are never a first centroid unless there are too few others.  Where
first centroids tie (a shared id), their components decide.  Distances and their
sums beyond a long's range, which needs components of some 10^8, are computed exactly and given as 2^63 - 1.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import lacking, mapped, written

DIMENSIONS, CLUSTERS, ROUNDS, SCALE = 64, 16, 3, 64
#: Vectors of a block: 2 MB of float64.
BLOCK = 4096
#: float64 holds all whole numbers below this; int64 those below its square root's double.
EXACT, LONG = 2**53, 2**63 - 1


def quantised(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``vec_id, x`` of the kept vectors: x are the whole numbers floor(scale * component), as doubles, which hold them exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column(1)
            whole = pc.fill_null(pc.equal(pc.list_value_length(cells), dimensions), False)
            batch, cells = batch.filter(whole), cells.filter(whole)
            values = cells.flatten()
            x = values.fill_null(float("nan")).to_numpy(zero_copy_only=False).reshape(-1, dimensions)
            with np.errstate(over="ignore"):
                x = np.floor(x * scale)
            good = np.isfinite(x).all(1)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(good)), _lists(x[good])], ["vec_id", "x"])

    return mapped(lacking(vectors, [("vec_id", "long"), ("embedding", "array<double>")]), run, "vec_id long, x array<double>")


def _lists(x: np.ndarray) -> pa.ListArray:
    ends = np.arange(0, x.size + 1, max(x.shape[1], 1), dtype=np.int32) if len(x) else np.zeros(1, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(x.ravel(), pa.float64()))


def _integers(x: np.ndarray) -> np.ndarray:
    """Whole numbers as integers of any size."""
    return np.array([int(v) for v in x.ravel()], object).reshape(x.shape)


def _largest(x: np.ndarray) -> int:
    return int(np.abs(x).max(initial=0))


def _whole(x: np.ndarray, bound: int) -> np.ndarray:
    """Whole numbers in the cheapest kind that is exact up to ``bound``."""
    if bound < EXACT:
        return x.astype(np.float64)
    return x.astype(np.int64) if bound <= LONG else _integers(x)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row, the smaller number at ties, and its squared distance; all exact.

    No term or partial sum of the expansion exceeds four times the dimensions times the largest square.
    """
    bound = 4 * x.shape[1] * max(_largest(x), _largest(centroids)) ** 2
    a, c = _whole(x, bound), _whole(centroids, bound)
    far = (a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)[None, :]
    best = far.argmin(1)
    return best, far[np.arange(len(x)), best]


@dataclass
class Sums:
    """Per cluster: vectors, the sum of their components, the sum of their squared distances; in integers of any size."""

    n: np.ndarray
    x: np.ndarray
    far: np.ndarray

    def plus(self, other: Sums) -> Sums:
        return Sums(self.n + other.n, self.x + other.x, self.far + other.far)


def _none(k: int, dimensions: int) -> Sums:
    return Sums(np.zeros(k, object), np.zeros((k, dimensions), object), np.zeros(k, object))


def block_sums(x: np.ndarray, centroids: np.ndarray) -> Sums:
    """Sums over the rows of a block by nearest centroid, as a product with their membership."""
    best, far = nearest(x, centroids)
    k = len(centroids)
    bound = len(x) * _largest(x)
    member = np.zeros((len(x), k))
    member[np.arange(len(x)), best] = 1
    total = _whole(member, bound).T @ _whole(x, bound)
    bound = len(x) * max((int(v) for v in far), default=0)
    return Sums(_integers(member.sum(0)), _integers(total), _integers(_whole(member, bound).T @ _whole(far, bound)))


def _blocks(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            yield part.column(0), part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def totals(vectors: DataFrame, centroids: np.ndarray) -> Sums:
    """The sums of all ``vectors (vec_id, x)``: a row a task, combined as a tree."""
    k, dimensions = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _none(k, dimensions)
        for _, x in _blocks(batches, dimensions):
            sums = sums.plus(block_sums(x, centroids))
        cells = [[str(v) for v in part.ravel()] for part in (sums.n, sums.x, sums.far)]
        yield pa.RecordBatch.from_arrays([pa.array([c], pa.list_(pa.string())) for c in cells], ["n", "x", "far"])

    rows: RDD = mapped(vectors, run, "n array<string>, x array<string>, far array<string>").rdd
    read = lambda cell: np.array([int(v) for v in cell], object)
    return rows.treeAggregate(
        _none(k, dimensions), lambda sums, row: sums.plus(Sums(read(row["n"]), read(row["x"]).reshape(k, dimensions), read(row["far"]))), lambda a, b: a.plus(b))


def first_centroids(vectors: DataFrame, clusters: int) -> np.ndarray:
    """The vectors whose hashed ids are smallest, in that order, as integers: at most ``clusters`` rows come to the driver."""
    lot = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.select(lot.alias("lot"), "x").orderBy(F.asc_nulls_last("lot"), "x").limit(clusters).collect()
    return _integers(np.array([r["x"] for r in rows], float)) if rows else np.zeros((0, 0), object)


def moved(centroids: np.ndarray, sums: Sums) -> np.ndarray:
    """Each centroid that has vectors at the floor of their mean."""
    return np.array([[v // n for v in x] if n else old for old, n, x in zip(centroids.tolist(), sums.n, sums.x, strict=True)], object)


def clusters(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept row of ``vectors (vec_id, embedding)``."""
    kept = written(quantised(vectors, dimensions, scale), "vectors")
    centroids = first_centroids(kept, k)
    kind = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], kind)
    for _ in range(rounds):
        centroids = moved(centroids, totals(kept, centroids))
    inertia = totals(kept, centroids).far
    told = [hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest() for c in centroids]
    long = lambda v: min(int(v), LONG)
    whole = long(sum(inertia))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _blocks(batches, dimensions):
            best, far = nearest(x, centroids)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(best, pa.int32()), pa.array([long(v) for v in far], pa.int64()), pa.array([long(inertia[b]) for b in best], pa.int64()),
                 pa.array([whole] * len(best), pa.int64()), pa.array([told[b] for b in best])],
                ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return mapped(kept, run, kind)


def _rounds(n: int) -> str:
    """SQL of rounds 1 to n."""
    far = "list_sum(list_transform(range(1, 65), lambda i: (q[i] - c[i]) * (q[i] - c[i])))"
    out = []
    for r in range(1, n + 2):
        out.append(f"""
a{r} as (
  select row_no, vec_id, q, arg_min(j, (d, j)) as j, min(d) as d
  from (select row_no, vec_id, q, j, {far} as d from v, c{r - 1}) group by all)""")
        if r <= n:
            out.append(f"""
s{r} as (
  select j, i, sum(q[i]) as s, count(*) as n from a{r}, (select unnest(range(1, 65)) as i) group by j, i),
m{r} as (
  select j, list((s - ((s % n) + n) % n) // n order by i) as c from s{r} group by j),
c{r} as (
  select j, coalesce(m{r}.c, c{r - 1}.c) as c from c{r - 1} left join m{r} using (j))""")
    return ",".join(out)


#: DuckDB's SQL for the registered query.
ORACLE = f"""
with v as materialized (
  select row_number() over () as row_no, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS HUGEINT)) as q
  from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
c0 as (
  select row_number() over (order by h nulls last, q) - 1 as j, q as c
  from (select sha256('1:' || vec_id) as h, q from v order by h nulls last, q limit 16)),{_rounds(ROUNDS)}
select vec_id, CAST(j AS INTEGER) as cluster, CAST(d AS BIGINT) as distance, CAST(sum(d) over (partition by j) AS BIGINT) as cluster_inertia,
       CAST(sum(d) over () AS BIGINT) as inertia, sha256(array_to_string(c{ROUNDS}.c, ',')) as centroid_sha256
from a{ROUNDS + 1} join c{ROUNDS} using (j)
"""
