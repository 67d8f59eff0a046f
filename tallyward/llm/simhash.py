"""SimHash near-duplicates with bit-sliced comparison.

Four-word shingles of a lower-cased text are hashed with XXH64; the sign of each
bit's majority gives a 64-bit fingerprint.  Fingerprints that differ in at most
``radius`` bits are linked, and a group is what links connect.

All links are found, without comparing all pairs: 64 bits are cut into
``radius + agree`` blocks, and two fingerprints within the radius agree on at
least ``agree`` of them.  ``agree`` grows with the counted fingerprints, so that buckets don't grow with them.  So each distinct fingerprint goes to one bucket per
choice of ``agree`` blocks, and only buckets are compared, by the bit-sliced
kernel of :mod:`.bitslice`.  A bucket above ``TILE`` members is dealt out as
pairs of chunks, so no task holds a whole hot bucket.  Tasks return spanning
stars, never all pairs.

Defined results: a null text and a text without words have fingerprint zero,
which is linked like any other.  Repeated ids keep their rows.  A group of rows
that all lack an id has a null component.  Extra columns are ignored by
``fingerprints`` and ``components`` and kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bitslice
from ._shared import BROADCAST_BYTES, few, lacking, mapped, own_name, written
from .components import connected_components

#: Bits that linked fingerprints may differ in.
RADIUS = 4
#: Fingerprints that a bucket holds on average, beyond which buckets are cut finer.
CROWD = 4
WORDS, SEED = 4, 42
#: Members of a bucket that one task compares at a time with as many others.
TILE = 2048
#: Buckets up to this size are compared together, pair by pair of lanes.
SMALL = 8


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The unsigned fingerprint of one text."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends, at = [], -1
    for word in found:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *[e + 1 for e in ends[:-1]]]
    spans = zip(starts, ends[words - 1 :], strict=False) if len(found) >= words else [(0, len(joined))]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 16):  # bounded memory on very long texts
        part = hashes[start : start + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def text_key(text: Column) -> Column:
    """Tells texts apart that stand under one id."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, key, fp)`` per row; fp is the fingerprint's bits as a signed long, key the text's :func:`text_key`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(values.view(np.int64))], ["doc_id", "key", "fp"])

    slim = lacking(docs, [("doc_id", "long"), ("text", "string")]).withColumn("key", text_key(F.col("text")))
    return mapped(slim, run, "doc_id long, key long, fp long")


def _bucket_keys(fp: Column, radius: int, agree: int) -> Column:
    """One key per choice of ``agree`` blocks: the choice's number and the blocks' bits."""
    count = radius + agree
    edges = [round(64 * i / count) for i in range(count + 1)]
    block = [F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:], strict=False)]
    return F.array(*[F.struct(F.lit(number).alias("choice"), F.xxhash64(F.lit(number), *[block[i] for i in chosen]).alias("key"))
                     for number, chosen in enumerate(combinations(range(count), agree))])


class _Forest:
    """Union-find whose roots are the smallest members."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, node: int) -> int:
        path = []
        while (up := self.parent.get(node, node)) != node:
            path.append(node)
            node = up
        for seen in path:
            self.parent[seen] = node
        return node

    def link(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def edges(self) -> tuple[list[int], list[int]]:
        nodes = list(self.parent)
        return nodes, [self.root(n) for n in nodes]


def _compare(radius: int):
    """Task: buckets in key order in, spanning stars of their links out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = _Forest()
        left: list[np.ndarray] = []
        right: list[np.ndarray] = []

        def flush() -> None:
            if left:
                a, b = np.concatenate(left), np.concatenate(right)
                for at in range(0, len(a), 1 << 16):
                    hit = bitslice.near_pairs(a[at : at + (1 << 16)], b[at : at + (1 << 16)], radius)
                    for x, y in zip(a[at : at + (1 << 16)][hit].tolist(), b[at : at + (1 << 16)][hit].tolist(), strict=True):
                        forest.link(x, y)
                left.clear()
                right.clear()

        def bucket(members: np.ndarray) -> None:
            members = np.unique(members)
            if len(members) > SMALL:
                for x, y in zip(*(v.tolist() for v in bitslice.stars(members, radius)), strict=True):
                    forest.link(x, y)
            elif len(members) > 1:
                i, j = np.triu_indices(len(members), 1)
                left.append(members[i])
                right.append(members[j])
                if len(left) >= 20_000:
                    flush()

        held: list[np.ndarray] = []
        last = None
        for batch in batches:
            key, tile, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            fp = fp.astype(np.int64).view(np.uint64)
            cuts = np.flatnonzero((key[1:] != key[:-1]) | (tile[1:] != tile[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(key)], strict=True):
                if a == b:
                    continue
                if (key[a], tile[a]) != last and held:
                    bucket(np.concatenate(held))
                    held = []
                last = (key[a], tile[a])
                held.append(fp[a:b])
        if held:
            bucket(np.concatenate(held))
        flush()
        nodes, roots = forest.edges()
        u, v = (np.array(x, np.uint64).view(np.int64) for x in (nodes, roots))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return run


def blocks_to_agree(count: int, radius: int = RADIUS) -> int:
    """Blocks that a bucket's fingerprints share, two at least: so many that ``count`` random ones would not crowd it."""
    agree = 2
    while agree < 6 and count > CROWD << (64 * agree // (radius + agree)):
        agree += 1
    return agree


def links(nodes: DataFrame, radius: int = RADIUS, agree: int = 2, tile: int = TILE) -> DataFrame:
    """Links ``(u, v)`` that connect what all pairs of ``nodes (fp)`` within ``radius`` connect."""
    dealt = nodes.select("fp", F.explode(_bucket_keys(F.col("fp"), radius, agree)).alias("b")).select("b.key", "fp")
    sizes = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # a bucket of c chunks becomes c * (c + 1) / 2 tiles, each of two chunks
    chunks = F.ceil(F.col("n") / F.lit(tile)).cast("int")
    mine = F.pmod(F.xxhash64(F.col("fp"), F.lit(7)), F.col("chunks")).cast("int")
    tiles = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1),
                        lambda other: F.least(F.col("chunk"), other) * F.col("chunks") + F.greatest(F.col("chunk"), other))
    rows = (dealt.join(sizes, "key").withColumn("chunks", chunks).withColumn("chunk", mine)
            .select("key", F.explode(tiles).alias("tile"), "fp"))
    return mapped(rows.repartition(F.col("key"), F.col("tile")).sortWithinPartitions("key", "tile"), _compare(radius), "u long, v long")


def _grouped(docs: DataFrame, radius: int) -> DataFrame:
    """``(doc_id, key, fp, root, component_id)`` per row of ``docs``; root: the same for all rows of a group."""
    marked = written(fingerprints(docs), "fingerprints")
    nodes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    roots = connected_components(links(nodes.select("fp"), radius, blocks_to_agree(nodes.count(), radius)))
    grouped = nodes.join(roots.withColumnRenamed("u", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = grouped.join(least, "root").select("fp", "root", "component_id")
    return marked.join(named, "fp").select("doc_id", "key", "fp", "root", "component_id")


def components(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(doc_id, key, fp, component_id)`` per row of ``docs``; component_id: the smallest doc_id reachable."""
    return _grouped(docs, radius).drop("root")


def as_hex(fp: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _within(docs: DataFrame, few_rows: DataFrame, how: str) -> DataFrame:
    """``docs`` joined with ``few_rows (doc_id, key)`` on id and text, broadcast if their counted size allows it."""
    name, key = own_name(docs, "one_id"), own_name(docs, "one_key")
    side = few_rows.select(F.col("doc_id").alias(name), F.col("key").alias(key))
    if few_rows.count() * 64 <= BROADCAST_BYTES:
        side = F.broadcast(side)
    return docs.join(side, (docs["doc_id"].cast("long") == side[name]) & (text_key(docs["text"]) == side[key]), how)


def keep_one(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One document of each group, the one with the smallest id, with all its columns.

    Rows that share an id are judged by their own texts; of those with the smallest id of their group the one with the least
    text key stays, and of rows alike in id and text any one.  Rows without an id can't be told apart from others of their
    group; they stay.
    """
    rows = written(_grouped(docs, radius).where("doc_id is not null").groupBy("root", "doc_id", "key").agg(F.count(F.lit(1)).alias("n")), "grouped")
    kept = rows.groupBy("root").agg(F.min(F.struct("doc_id", "key")).alias("kept"))
    judged = rows.join(kept, "root")
    gone = few(judged.where("struct(doc_id, key) <> kept").select("doc_id", "key").distinct(), docs, "gone")
    twice = few(judged.where("struct(doc_id, key) = kept and n > 1").select("doc_id", "key").distinct(), docs, "twice")
    left = _within(docs, gone, "left_anti")
    if twice.isEmpty():
        return left
    once, again = _within(left, twice, "left_anti"), _within(left, twice, "left_semi")
    name, key = own_name(docs, "one_id"), own_name(docs, "one_key")
    one = again.withColumn(name, F.col("doc_id").cast("long")).withColumn(key, text_key(F.col("text"))).dropDuplicates([name, key]).drop(name, key)
    return once.unionByName(one)
