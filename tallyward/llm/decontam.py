"""Benchmark decontamination with one Aho-Corasick automaton.

Every window of ten consecutive words of a benchmark item (an item of fewer words
is one window) becomes a pattern of one automaton over normalised text.  Each
document is normalised at byte level (A-Z lowered, every other ASCII character
that is no letter or digit taken for a gap), scanned once, and the hits' offsets
are mapped to words and back to characters of the original.

The benchmark is a stated query set of any size.  Its items, long ones in overlapping pieces, are dealt
into shards of about ``SHARD_CHARS`` characters, each broadcast by itself, so that a task builds one automaton of
bounded size, once.  One shard is the rule and takes one scan; of several, each takes a scan that yields
the texts with hits, which are then merged, so the result doesn't depend on the sharding.

Defined results: a null or empty text, of a document or an item, has no words and
no hits.  Items without an id are matched but not named.  Repeated items count
once.  Extra columns are ignored by ``hits`` and kept by ``drop_contaminated``.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import BROADCAST_BYTES, few, lacking, mapped, written

WINDOW = 10
#: Characters of benchmark text in one automaton, which takes some 500 bytes for each.
SHARD_CHARS = 400_000
#: Words of an item that stay in one piece.
PIECE_WORDS = 5_000

_GAPS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def normalised(text: str | None) -> bytes:
    """Lower-cased text with gaps as single spaces, and one at either end."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().translate(_GAPS).split()
    return b" " + b" ".join(words) + b" " if words else b""


def windows(text: str | None, size: int = WINDOW) -> list[str]:
    """The patterns of an item: its windows as single-byte characters."""
    words = normalised(text).split()
    spans = range(max(1, len(words) - size + 1)) if words else ()
    return [(b" " + b" ".join(words[i : i + size]) + b" ").decode("latin-1") for i in spans]


def pieces(text: str | None, size: int = WINDOW, most: int = PIECE_WORDS) -> list[str]:
    """The text in pieces of at most ``most`` words (``size`` at least) that together have its windows."""
    words = normalised(text).decode("utf-8", "surrogatepass").split(" ")[1:-1]
    if len(words) <= max(most, size):
        return [" ".join(words)] if words else []
    step = max(most, size) - size + 1
    return [" ".join(words[i : i + step + size - 1]) for i in range(0, len(words) - size + 1, step)]


@functools.lru_cache(maxsize=1)
def _automaton(items: tuple, size: int) -> ahocorasick.Automaton | None:
    """Patterns with their length in words and the items that hold them; kept for a worker's next task."""
    owners: dict[str, set[str]] = {}
    for item_id, text in items:
        for pattern in windows(text, size):
            owners.setdefault(pattern, set()).update(() if item_id is None else (str(item_id),))
    if not owners:
        return None
    machine = ahocorasick.Automaton()
    for pattern, ids in owners.items():
        machine.add_word(pattern, (pattern.count(" ") - 1, frozenset(ids)))
    machine.make_automaton()
    return machine


def scan(text: str | None, machine: ahocorasick.Automaton | None) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Words of a text, its hit runs of words [from, to), and the items found."""
    plain = normalised(text)
    count = plain.count(b" ") - 1 if plain else 0
    if not plain or machine is None:
        return count, [], set()
    found = list(machine.iter(plain.decode("latin-1")))
    if not found:
        return count, [], set()
    gaps = np.flatnonzero(np.frombuffer(plain, np.uint8) == 32)
    ends = np.searchsorted(gaps, [end for end, _ in found])  # the gap after word n is number n + 1
    items: set[str] = set()
    runs: list[tuple[int, int]] = []
    for start, end in sorted((int(e) - length, int(e)) for e, (_, (length, _)) in zip(ends, found, strict=True)):
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((start, end))
    for _, (_, ids) in found:
        items |= ids
    return count, runs, items


def original_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words as spans of characters of the original text."""
    raw = text.encode("utf-8", "surrogatepass")
    word = np.frombuffer(raw.lower().translate(_GAPS), np.uint8) != 32
    edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    characters = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [(int(characters[starts[a]]), int(characters[ends[b - 1]])) for a, b in runs]


_RUNS = "array<struct<start:long,end:long>>"
_SCHEMA = f"doc_id long, n_words long, runs {_RUNS}, items array<string>, spans {_RUNS}"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _pairs(runs: list[tuple[int, int]]) -> list[dict]:
    return [{"start": a, "end": b} for a, b in runs]


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching runs as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _query_set(benchmark: DataFrame, size: int, shard_chars: int) -> list:
    """The benchmark's shards as broadcasts, each of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, p) for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for p in pieces(text.as_py(), size)]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.string()) for k in range(2)], ["item_id", "text"])

    items = few(mapped(lacking(benchmark, [("item_id", "string"), ("text", "string")]), run, "item_id string, text string").distinct(), benchmark, "benchmark")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    number = max(1, -(-total // shard_chars))
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(number))
    context = benchmark.sparkSession.sparkContext
    return [context.broadcast(tuple(sorted((tuple(r) for r in items.where(shard == k).toLocalIterator()), key=str))) for k in range(number)]


def _text_key(text: Column) -> Column:
    return F.xxhash64(text.cast("string"))


def _hits_by_text(docs: DataFrame, groups: list, size: int) -> DataFrame:
    """``key, runs, items`` of the texts that any of several shards hits, a scan for each shard."""
    slim = lacking(docs, [("text", "string")]).where("text is not null").select(_text_key(F.col("text")).alias("key"), "text")

    def scanned(group) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            machine = _automaton(group.value, size)
            for batch in batches:
                found = [(key, runs, items) for key, (_, runs, items) in zip(batch.column(0).to_pylist(), (scan(t.as_py(), machine) for t in batch.column(1)), strict=True) if runs]
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _, _ in found], pa.int64()), pa.array([_pairs(r) for _, r, _ in found], _SPANS),
                                                  pa.array([sorted(i) for _, _, i in found], pa.list_(pa.string()))], ["key", "runs", "items"])

        return mapped(slim, run, f"key long, runs {_RUNS}, items array<string>")

    every = functools.reduce(DataFrame.unionByName, map(scanned, groups))
    one = lambda c: F.array_distinct(F.flatten(F.collect_set(c))).alias(c)
    return written(every.groupBy("key").agg(one("runs"), one("items")), "benchmark-hits")


def _by_key(docs: DataFrame, found: DataFrame, names: list[str], how: str) -> DataFrame:
    """``docs`` joined with ``found`` by text, which is broadcast if its counted size allows it."""
    size = found.agg(F.sum(F.size("runs") * 16 + F.size("items") * 64 + 80)).first()[0] or 0
    side = found.select(F.col("key").alias("hit_text_key"), *[F.col(n).alias(f"hit_{n}") for n in names])
    return docs.join(F.broadcast(side) if size <= BROADCAST_BYTES else side, _text_key(docs["text"]) == side["hit_text_key"], how)


def hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """Per document: doc_id, n_words, hit runs of words, items found, and spans of the original text.

    Overlapping and touching runs are merged.
    """
    groups = _query_set(benchmark, size, shard_chars)
    slim = lacking(docs, [("doc_id", "long"), ("text", "string")])

    def table(ids: pa.Array, texts: list[str | None], found: list[tuple[int, list[tuple[int, int]], list[str]]]) -> pa.RecordBatch:
        spans = [_pairs(original_spans(t, r)) if r else [] for t, (_, r, _) in zip(texts, found, strict=True)]
        return pa.RecordBatch.from_arrays(
            [ids, pa.array([n for n, _, _ in found], pa.int64()), pa.array([_pairs(r) for _, r, _ in found], _SPANS),
             pa.array([i for _, _, i in found], pa.list_(pa.string())), pa.array(spans, _SPANS)],
            ["doc_id", "n_words", "runs", "items", "spans"])

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(groups[0].value, size)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield table(batch.column(0), texts, [(n, runs, sorted(items)) for n, runs, items in (scan(t, machine) for t in texts)])

    def given(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            runs = [_merged([(x["start"], x["end"]) for x in r or ()]) for r in batch.column(2).to_pylist()]
            yield table(batch.column(0), texts, [(scan(t, None)[0], r, sorted(i or ())) for t, r, i in zip(texts, runs, batch.column(3).to_pylist(), strict=True)])

    if len(groups) == 1:
        return mapped(slim, scanned, _SCHEMA)
    joined = _by_key(slim, _hits_by_text(docs, groups, size), ["runs", "items"], "left").select("doc_id", "text", "hit_runs", "hit_items")
    return mapped(joined, given, _SCHEMA)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    found = hits(docs, benchmark)
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda total, r: total + r["end"] - r["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with all their columns; no shuffle with one shard."""
    groups = _query_set(benchmark, size, shard_chars)
    at = docs.columns.index("text")
    if len(groups) > 1:
        return _by_key(docs, _hits_by_text(docs, groups, size), [], "left_anti")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(groups[0].value, size)
        for batch in batches:
            yield batch.filter(pa.array([not scan(t.as_py(), machine)[1] for t in batch.column(at)], pa.bool_()))

    return mapped(docs, run, docs.schema)


#: The same in DuckDB's SQL, over the views ``documents`` and ``benchmark``.
ORACLE = f"""
WITH word AS (
  SELECT rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM (SELECT row_number() OVER () AS rid, doc_id, text FROM documents)),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
pattern AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' ') AS p
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - {WINDOW - 1}, 1))) AS i FROM item WHERE len(w) > 0)),
size AS (SELECT DISTINCT n FROM pattern),
spot AS (
  SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS p
  FROM (SELECT rid, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM word, size WHERE len(w) >= n)),
hit AS (SELECT rid, i, spot.n, item_id FROM spot JOIN pattern ON spot.p = pattern.p AND spot.n = pattern.n),
covered AS (SELECT rid, count(DISTINCT k) AS n_hit FROM (SELECT DISTINCT rid, unnest(generate_series(i, i + n - 1)) AS k FROM hit) GROUP BY rid),
found AS (
  SELECT rid, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS x FROM hit WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM word LEFT JOIN covered USING (rid) LEFT JOIN found USING (rid)
"""
