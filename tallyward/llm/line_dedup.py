"""Line dedup by winnowing: repeated passages are found across all documents and their later runs deleted.

Two kinds of lines are hashed.  A *physical line* of ``LEAST_WORDS`` words or more that occurs
earlier is deleted as it stands.  For passages that begin or end within physical lines, the
text is reflowed: a line is ``LINE`` consecutive words, and one begins at every
word.  These line hashes are winnowed: of each ``WINDOW`` consecutive ones
the least is a fingerprint.  Two texts that share ``LINE + WINDOW - 1`` words
(``MIN_WORDS``, 50) are thereby guaranteed to share a fingerprint.

Fingerprints are joined with the position where each occurs first, documents in
order of (doc_id, hash of the text).  Each such pair is extended both ways over the
words around it; runs that reach ``MIN_WORDS`` words are deleted, all but the first
occurrence.  Since a run holds a fingerprint in every window, extension never needs
more than ``WINDOW - 1`` words on either side, so what travels are blocks of word hashes
around first occurrences and not the text.

Two later places of a fingerprint may agree further with each other than with the first.
Then both leave the first place after equally many words, on the same side, with the same next word.
Places that share these three with another place are joined by the hashes of the stretches of ``MIN_WORDS`` words
that hold that word, and stretches that occur earlier are runs too.  Thereby all repeats are
found, whatever their earlier copies: the words deleted are exactly those in a stretch of ``MIN_WORDS`` words or
in a physical line that occurs earlier.

Only fingerprints and lines are shuffled for the search, about two in ``WINDOW + 1`` words at 20
bytes, first pre-aggregated.  Positions go back to their documents as one row per
document; the table of these is broadcast if the counted repeats allow it, and joined by
a shuffle if not.

Defined results: rows with a null doc_id or text pass unchanged and are nobody's
earlier copy.  Rows alike in doc_id and text count as one, so repeats within such
a pair of rows aren't deleted.  Lines of fewer than ``LEAST_WORDS`` words are never deleted by themselves.
Gaps don't matter for equality; words do, exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import BROADCAST_BYTES, dropped, few, lacking, mapped, own_name, written

MIN_WORDS, LINE = 50, 16
#: Words of a physical line that is deleted by itself; shorter ones recur by chance.
LEAST_WORDS = 2
WINDOW = MIN_WORDS - LINE + 1
#: Words kept on either side of a fingerprint's line.
REACH = WINDOW - 1
SPAN = LINE + 2 * REACH
#: First occurrences are looked up by blocks of so many words.
BLOCK = 128

_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
_P, _Q = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
_M1, _M2 = (np.uint64(x) for x in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53))


def _mix(x: np.ndarray) -> np.ndarray:
    """Bit finaliser, so that polynomial hashes order like random numbers."""
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


_kept_powers: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """The first ``n`` powers, kept for the next text."""
    kept = _kept_powers.get(int(base))
    if kept is None or len(kept) < n:
        out = np.full(max(n, 1 << 15), base, np.uint64)
        out[0] = 1
        kept = _kept_powers[int(base)] = np.multiply.accumulate(out)
    return kept[:n]


_P_BACK, _Q_BACK = (np.uint64(pow(int(x), -1, 1 << 64)) for x in (_P, _Q))


def edges_of(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and byte ends of the words of a text."""
    edge = np.diff(np.concatenate([[False], ~_GAP[np.frombuffer(raw, np.uint8)], [False]]).view(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def words_of(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts, byte ends and 64-bit hashes of the words of a text."""
    data = np.frombuffer(raw, np.uint8)
    starts, ends = edges_of(raw)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_P, len(data)), dtype=np.uint64)])
    back = _powers(_P_BACK, len(data) + 1)
    return starts, ends, _mix((sums[ends] - sums[starts]) * back[starts])


def _slide(values: np.ndarray, size: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of each ``size`` consecutive values, by doubling."""
    out, have = values, 1
    while have < size:
        step = min(have, size - have)
        out = pick(out[: len(out) - step], out[step:])
        have += step
    return out


def winnow(words: np.ndarray, ends: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the fingerprints of a text, or of texts strung together; ``ends``: where each word's text ends."""
    if len(words) < MIN_WORDS:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(words * _powers(_Q, len(words)), dtype=np.uint64)])
    n = len(words) - LINE + 1
    lines = _mix((sums[LINE:] - sums[:n]) * _powers(_Q_BACK, n))
    least = _slide(lines, WINDOW, np.minimum)
    if ends is not None:  # windows beyond a text's end choose none
        least = np.where(np.arange(len(least)) + MIN_WORDS <= ends[: len(least)], least, np.uint64(0))
    pad = np.zeros(WINDOW - 1, np.uint64)
    chosen = _slide(np.concatenate([pad, least, pad]), WINDOW, np.maximum) == lines
    at = np.flatnonzero(chosen)
    # in a stretch of equal lines one position in every half window is enough
    same = np.concatenate([[False], (np.diff(at) == 1) & (lines[at[1:]] == lines[at[:-1]])])
    if same.any():
        begin = np.maximum.accumulate(np.where(same, 0, np.arange(len(at))))
        last = np.concatenate([~same[1:], [True]])
        at = at[~same | last | ((np.arange(len(at)) - begin) % (WINDOW // 2) == 0)]
    return at, lines[at]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _raw(cell: pa.Scalar) -> bytes:
    return (cell.as_py() or "").encode("utf-8", "surrogatepass")


def physical_lines(raw: bytes, starts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word positions, sizes in words, and hashes of the lines of ``LEAST_WORDS`` words or more."""
    breaks = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10)
    edges = np.unique(np.concatenate([[0], np.searchsorted(starts, breaks), [len(words)]]))
    at, sizes = edges[:-1], np.diff(edges)
    at, sizes = at[sizes >= LEAST_WORDS], sizes[sizes >= LEAST_WORDS]
    sums = np.concatenate([[np.uint64(0)], np.cumsum(words * _powers(_Q, len(words)), dtype=np.uint64)])
    hashes = _mix((sums[at + sizes] - sums[at]) * _powers(_Q_BACK, len(words) + 1)[at] + sizes.astype(np.uint64) * _P)
    return at, sizes, hashes


#: Bytes of texts that are worked on at a time; at least one text.
STRUNG = 1 << 20


def _strung(texts: pa.Array) -> Iterator[tuple[slice, list[bytes]]]:
    """Rows whose texts are worked on together."""
    begin, held, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = _raw(text)
        if held and size + len(raw) > STRUNG:
            yield slice(begin, i), held
            begin, held, size = i, [], 0
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield slice(begin, begin + len(held)), held


def marks(docs: DataFrame) -> DataFrame:
    """``hash, doc, key, pos, size``: fingerprints (size 0) and physical lines (size in words) of each text; key: the hash of the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            for rows, raws in _strung(batch.column(2)):
                whole = b"\n".join(raws)
                starts, _, words = words_of(whole)
                # the first word of each text, and where the last one ends
                first = np.searchsorted(starts, np.concatenate([[0], np.cumsum([len(r) + 1 for r in raws])]))
                row = np.repeat(np.arange(len(raws)), np.diff(first))
                prints, hashes = winnow(words, np.repeat(first[1:], np.diff(first)))
                lines, sizes, of_lines = physical_lines(whole, starts, words)
                at = np.concatenate([prints, lines])
                own = row[at]
                yield pa.RecordBatch.from_arrays(
                    [_signed(np.concatenate([hashes, of_lines])), pa.array(ids[rows][own]), pa.array(keys[rows][own]), pa.array((at - first[own]).astype(np.int32)),
                     pa.array(np.concatenate([np.zeros(len(prints), np.int64), sizes]).astype(np.int32))], ["hash", "doc", "key", "pos", "size"])

    return mapped(_keyed(docs), run, "hash long, doc long, key long, pos int, size int")


def _text_key(text: Column | str) -> Column:
    return F.xxhash64(text)


def _keyed(docs: DataFrame) -> DataFrame:
    slim = lacking(docs, [("doc_id", "long"), ("text", "string")]).where("doc_id is not null and text is not null")
    return slim.select("doc_id", _text_key("text").alias("key"), "text")


def _at_documents(docs: DataFrame, lists: DataFrame, small: bool, run, schema: str, only: DataFrame | None = None) -> DataFrame:
    """``run`` over ``docs (doc_id, key, text)`` that have a row in ``lists (doc, key, cells)``.

    ``small``: lists may be broadcast.  ``only``: a table ``doc, key`` that may be
    broadcast, so that other texts aren't shuffled.
    """
    side = lists.select(F.col("doc").alias("list_doc"), F.col("key").alias("list_key"), "cells")
    keyed = _keyed(docs)
    if only is not None and not small:
        few = F.broadcast(only.select(F.col("doc").alias("only_doc"), F.col("key").alias("only_key")))
        keyed = keyed.join(few, F.expr("doc_id = only_doc and key = only_key"), "left_semi")
    joined = keyed.join(F.broadcast(side) if small else side, F.expr("doc_id = list_doc and key = list_key"))
    return mapped(joined.select("doc_id", "list_key", "text", "cells"), run, schema)


def _short(words: np.ndarray, most: int) -> np.ndarray:
    """32-bit word hashes, none zero, with zeros beyond the text's ends so that any stretch up to ``most`` can be cut."""
    short = np.maximum((words >> np.uint64(32)).astype(np.uint32), 1)
    return np.concatenate([np.zeros(REACH, np.uint32), short, np.zeros(most, np.uint32)])


def _contexts_around(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows of word hashes: ``REACH`` before each position, its line, and as many after."""
    return _short(words, REACH)[at[:, None] + np.arange(SPAN)]


def _give_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of word hashes of the documents that hold first occurrences."""
    for batch in batches:
        for doc, key, text, cells in zip(*(batch.column(i) for i in range(4)), strict=True):
            blocks = np.unique(np.array(cells.as_py(), np.int64))
            padded = _short(words_of(_raw(text))[2], BLOCK + SPAN)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(blocks), doc.as_py())), pa.array(np.full(len(blocks), key.as_py())), pa.array(blocks.astype(np.int32)),
                 pa.array([padded[b * BLOCK : b * BLOCK + BLOCK + SPAN].tobytes() for b in blocks], pa.binary())], ["c_doc", "c_key", "c_block", "around"])


def reached(own: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether each two contexts share their line, and the words they share before and after it."""
    same = (own == first) & (own != 0)
    stop = lambda differ: np.where(differ.any(1), differ.argmax(1), REACH)
    return same[:, REACH : REACH + LINE].all(1), stop(~same[:, :REACH][:, ::-1]), stop(~same[:, REACH + LINE :])


def merged(starts: np.ndarray, ends: np.ndarray, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping and touching ranges as one, within each group; in order of start without groups."""
    if not len(starts):
        return starts, ends
    if group is None:
        group = np.zeros(len(starts), np.int64)
    rank = np.unique(group, return_inverse=True)[1].astype(np.int64) * (int(ends.max()) + 2)
    a, b = starts + rank, ends + rank
    order = np.argsort(a, kind="stable")
    a, b, rank = a[order], np.maximum.accumulate(b[order]), rank[order]
    cut = np.flatnonzero(a[1:] > b[:-1])
    heads, tails = np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(a) - 1]])
    return a[heads] - rank[heads], b[tails] - rank[heads]


class _Lists:
    """Columns of lists of structs, filled row by row from arrays."""

    def __init__(self, **kinds: pa.DataType) -> None:
        self.kinds, self.parts, self.ends = kinds, [], [0]

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(columns)
        self.ends.append(self.ends[-1] + len(columns[0]))

    def array(self) -> pa.Array:
        columns = [np.concatenate(x) for x in zip(*self.parts, strict=True)] or [[] for _ in self.kinds]
        cells = [pa.array(c, kind) if len(c) else pa.array([], kind) for c, kind in zip(columns, self.kinds.values(), strict=True)]
        return pa.ListArray.from_arrays(pa.array(self.ends, pa.int32()), pa.StructArray.from_arrays(cells, list(self.kinds)))


def _ranges() -> _Lists:
    return _Lists(start=pa.int64(), end=pa.int64())


def _uncovered(at: np.ndarray, n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of the positions lie in a stretch of ``MIN_WORDS`` words that isn't within a run."""
    free = np.ones(max(n - MIN_WORDS + 1, 0), bool)
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        free[a : max(a, b - MIN_WORDS + 1)] = False
    sums = np.concatenate([[0], np.cumsum(free)])
    return sums[np.clip(at + 1, 0, len(free))] > sums[np.clip(at - (MIN_WORDS - LINE), 0, len(free))]


def _give_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs found against first places; and of each fingerprint how far it agrees with its first place, and the next word on either side.

    A next word of zero: nothing follows there, or nothing within a stretch that holds the line.  open: a stretch that
    holds the line isn't within a run.
    """
    wide = BLOCK + SPAN
    for batch in batches:
        runs, places = _ranges(), _Lists(hash=pa.int64(), pos=pa.int32(), left=pa.int32(), before=pa.int64(), right=pa.int32(), after=pa.int64(), open=pa.bool_())
        flat = batch.column(3).flatten()
        bounds = np.asarray(batch.column(3).offsets) - batch.column(3).offsets[0].as_py()
        c_doc, c_key, c_block = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
        at = flat.field(3)
        at_ends = np.concatenate([[0], np.cumsum(pc.list_value_length(at).to_numpy(zero_copy_only=False))]).astype(np.int64)
        hashes, positions, firsts = (at.flatten().field(i).to_numpy(zero_copy_only=False) for i in range(3))
        around = np.frombuffer(b"".join(flat.field(4).to_pylist()), np.uint32).reshape(-1, wide)
        for row, text in enumerate(batch.column(2)):
            words = words_of(_raw(text))[2]
            own = _short(words, SPAN)
            i, j = bounds[row], bounds[row + 1]
            cells = np.repeat(np.arange(i, j), np.diff(at_ends[i : j + 1]))
            part = slice(at_ends[i], at_ends[j])
            pos, c_pos, code = positions[part].astype(np.int64), firsts[part].astype(np.int64), hashes[part]
            found = []
            for begin in range(0, len(pos), 4096):  # bounded memory on very long texts
                some = slice(begin, begin + 4096)
                mine = own[pos[some, None] + np.arange(SPAN)]
                theirs = around[cells[some, None], (c_pos[some] - c_block[cells[some]].astype(np.int64) * BLOCK)[:, None] + np.arange(SPAN)]
                same, left, right = reached(mine, theirs)
                line = np.arange(len(same))
                before = np.where(left < REACH, mine[line, np.maximum(REACH - 1 - left, 0)], 0)
                after = np.where(right < REACH, mine[line, np.minimum(REACH + LINE + right, SPAN - 1)], 0)
                found.append((same, left, before, right, after))
            same, left, before, right, after = (np.concatenate(x) for x in zip(*found, strict=True))
            diagonal = _mix((c_doc[cells].astype(np.uint64) * _P + c_key[cells].astype(np.uint64)) * _Q + (pos - c_pos).astype(np.uint64)).view(np.int64)
            a, b = merged(pos[same] - left[same], pos[same] + LINE + right[same], diagonal[same])
            whole = b - a >= MIN_WORDS
            a, b = merged(a[whole], b[whole])
            runs.add(a, b)
            places.add(code[same], pos[same], left[same], before[same].astype(np.int64), right[same], after[same].astype(np.int64), _uncovered(pos[same], len(words), a, b))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), runs.array(), places.array()], ["doc", "key", "runs", "places"])


def _stretches(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashes of the ``MIN_WORDS`` words from each start."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(words * _powers(_Q, len(words)), dtype=np.uint64)])
    return _mix((sums[starts + MIN_WORDS] - sums[starts]) * _powers(_Q_BACK, len(words))[starts])


def _give_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the stretches that hold a fingerprint's line and a word at which it leaves its first place together with another.

    On a side where it leaves its first place alone, no stretch reaches beyond that.
    """
    for batch in batches:
        for doc, key, text, cells in zip(*(batch.column(i) for i in range(4)), strict=True):
            words = words_of(_raw(text))[2]
            wanted = np.zeros(max(len(words) - MIN_WORDS + 1, 0) + 1, np.int64)
            most: dict[int, list[int]] = {}
            for cell in cells.as_py():
                reach = most.setdefault(cell["pos"], [cell["left"], cell["right"], cell["left"], cell["right"]])
                reach[cell["side"]] = REACH
            for pos, (left, right, own_left, own_right) in most.items():
                low, high = max(pos - left, 0), min(pos + LINE + right, len(words)) - MIN_WORDS
                # those within what is shared with the first place are told already
                for a, b in ((low, min(high, pos - own_left - 1)), (max(low, pos - own_left, pos + LINE + own_right - MIN_WORDS + 1), high)):
                    if a <= b:
                        wanted[a] += 1
                        wanted[b + 1] -= 1
            starts = np.flatnonzero(np.cumsum(wanted)[:-1] > 0)
            if len(starts):
                yield pa.RecordBatch.from_arrays(
                    [_signed(_stretches(words, starts)), pa.array(np.full(len(starts), doc.as_py())), pa.array(np.full(len(starts), key.as_py())),
                     pa.array(starts.astype(np.int32))], ["hash", "doc", "key", "pos"])


def _fits(table: DataFrame, row_bytes: int | Column) -> bool:
    """Whether the rows of a written table may be broadcast."""
    size = table.agg(F.sum(F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes)).first()[0]
    return (size or 0) <= BROADCAST_BYTES


def _repeats(places: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    """``places (hash, doc, key, pos, …)`` whose hash occurs earlier, with the first place as ``c_doc, c_key, c_pos``.

    Hashes that occur once are most; they go by a count.  Counts and first places are tables of their own, broadcast if
    they are small, so that a hot hash's rows can be split where they are joined.
    """
    place = F.struct("doc", "key", "pos")
    twice = few(places.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash"), docs, name)
    repeated = written(places.join(F.broadcast(twice) if _fits(twice, 64) else twice, "hash"), f"{name}-all")
    first = few(repeated.groupBy("hash").agg(F.min(place).alias("c"), F.max(place).alias("other")).where("c <> other")
                .select("hash", F.col("c.doc").alias("c_doc"), F.col("c.key").alias("c_key"), F.col("c.pos").alias("c_pos")), docs, f"{name}-first")
    return repeated.join(F.broadcast(first) if _fits(first, 80) else first, "hash").where("doc <> c_doc or key <> c_key or pos <> c_pos")


def _union_of_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cells, runs = batch.column(2), _ranges()
        flat, bounds = cells.flatten(), np.asarray(cells.offsets) - cells.offsets[0].as_py()
        starts, ends = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(2))
        for i, j in zip(bounds[:-1], bounds[1:], strict=True):
            runs.add(*merged(starts[i:j], ends[i:j]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), runs.array()], ["doc", "key", "runs"])


_RUNS = "array<struct<start:long,end:long>>"


def repeated_runs(docs: DataFrame) -> tuple[DataFrame, bool]:
    """``doc, key, runs``: the word runs to delete from each document that has any; and whether they may be broadcast."""
    found_marks = written(marks(docs), "marks")
    every = written(_repeats(found_marks, docs, "repeats").select("hash", "doc", "key", "pos", "size", "c_doc", "c_key", "c_pos"), "pairs")
    dropped(found_marks)
    lines = every.where("size > 0")
    pairs = every.where("size = 0").withColumn("c_block", F.expr(f"c_pos div {BLOCK}").cast("int"))
    # blocks of words around first places, from the documents that hold these
    wanted = few(pairs.groupBy("c_doc", "c_key").agg(F.collect_set("c_block").alias("cells"))
                 .select(F.col("c_doc").alias("doc"), F.col("c_key").alias("key"), "cells"), docs, "wanted")
    contexts = _at_documents(docs, wanted, _fits(wanted, F.size("cells") * 4 + 80), _give_contexts, "c_doc long, c_key long, c_block int, around binary")
    at = pairs.groupBy("doc", "key", "c_doc", "c_key", "c_block").agg(F.collect_set(F.struct("hash", "pos", "c_pos")).alias("at"))
    cell = F.struct("c_doc", "c_key", "c_block", "at", "around")
    listed = at.join(contexts, ["c_doc", "c_key", "c_block"]).groupBy("doc", "key").agg(F.collect_list(cell).alias("cells"))
    # each pair brings at most its own block, so this bounds the size of the list, which is never written
    small = _fits(pairs.select("doc"), 4 * (BLOCK + SPAN) + 96)
    touched = None if small else few(pairs.select("doc", "key").distinct(), docs, "touched")
    only = touched if touched is not None and _fits(touched, 64) else None
    schema = f"doc long, key long, runs {_RUNS}, places array<struct<hash:long,pos:int,left:int,before:long,right:int,after:long,open:boolean>>"
    found = written(_at_documents(docs, listed, small, _give_runs, schema, only), "found")
    # places that leave their first place at the same spot with the same word
    side = lambda number, reach, word: F.struct(F.lit(number).alias("side"), F.col(f"p.{reach}").alias("reach"), F.col(f"p.{word}").alias("word"))
    sides = (found.select("doc", "key", F.explode("places").alias("p"))
             .select("doc", "key", "p.hash", "p.pos", "p.left", "p.right", "p.open", F.explode(F.array(side(0, "left", "before"), side(1, "right", "after"))).alias("s"))
             .select("hash", "s.side", "s.reach", "s.word", "doc", "key", "pos", "left", "right", "open").where("word <> 0"))
    spot = ["hash", "side", "reach", "word"]
    shared = few(sides.groupBy(*spot).agg(F.count(F.lit(1)).alias("n"), F.max("open").alias("open")).where("n > 1 and open").select(*spot), docs, "shared")
    spots = few(sides.join(F.broadcast(shared) if _fits(shared, 80) else shared, spot).groupBy("doc", "key")
                .agg(F.collect_set(F.struct("pos", "side", "left", "right")).alias("cells")), docs, "spots")
    stretches = written(_at_documents(docs, spots, _fits(spots, F.size("cells") * 32 + 80), _give_stretches, "hash long, doc long, key long, pos int"), "stretches")
    run = lambda size: F.struct(F.col("pos").cast("long").alias("start"), (F.col("pos") + size).cast("long").alias("end")).alias("run")
    all_runs = (found.select("doc", "key", F.explode("runs").alias("run"))
                .unionByName(_repeats(stretches, docs, "stretch-repeats").select("doc", "key", run(F.lit(MIN_WORDS))))
                .unionByName(lines.select("doc", "key", run(F.col("size")))))
    # rows alike in doc_id and text give the same runs, each once
    runs = few(mapped(all_runs.groupBy("doc", "key").agg(F.collect_set("run").alias("runs")), _union_of_runs, f"doc long, key long, runs {_RUNS}"), docs, "runs")
    return runs, _fits(runs, F.size("runs") * 16 + 80)


def without(text: str, runs: list[tuple[int, int]]) -> str:
    """The text without runs of words; what follows a run keeps the gap before it."""
    raw = text.encode("utf-8", "surrogatepass")
    starts, ends = edges_of(raw)
    out, done = [], 0
    for a, b in runs:
        out.append(raw[done : starts[a]])
        done = starts[b] if b < len(starts) else ends[b - 1]
    return b"".join([*out, raw[done:]]).decode("utf-8", "surrogatepass")


def deduplicated(docs: DataFrame, drop_emptied: bool = False) -> DataFrame:
    """``docs`` without later repeated runs, all columns kept.

    ``drop_emptied`` also drops documents of which no word is left, that is copies.
    """
    runs, small = repeated_runs(docs)
    names = docs.columns
    key, cells = own_name(docs, "run_key"), own_name(docs, "run_cells")
    doc = own_name(docs, "run_doc")
    side = runs.select(F.col("doc").alias(doc), F.col("key").alias(key), F.col("runs").alias(cells))
    if small:
        side = F.broadcast(side)
    joined = docs.join(side, (docs["doc_id"].cast("long") == side[doc]) & (_text_key(docs["text"].cast("string")) == side[key]), "left")
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, stays = [], []
            for text, cell in zip(batch.column(at), batch.column(len(names)), strict=True):
                found = cell.as_py()
                new = without(text.as_py(), [(r["start"], r["end"]) for r in found]) if found else text.as_py()
                texts.append(new)
                stays.append(not (drop_emptied and found and not new.strip()))
            columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(stays, pa.bool_()))

    return mapped(joined.select(*[docs[f"`{c}`"] for c in names], side[cells]), run, docs.schema)


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words before, n_removed words, n_runs, and the SHA-256 of the text that is left (null text: null)."""
    runs, small = repeated_runs(docs)
    side = runs.withColumnRenamed("key", "run_key")
    if small:
        side = F.broadcast(side)
    slim = lacking(docs, [("doc_id", "long"), ("text", "string")])
    joined = slim.join(side, (slim["doc_id"] == side["doc"]) & (_text_key(slim["text"]) == side["run_key"]), "left").select("doc_id", "text", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            rows = []
            for value, cell in zip(batch.column(1), batch.column(2), strict=True):
                text, found = value.as_py(), [(r["start"], r["end"]) for r in cell.as_py() or ()]
                left = without(text, found) if found else text
                count = len((text or "").encode("utf-8", "surrogatepass").split())
                rows.append((count, sum(b - a for a, b in found), len(found),
                             None if left is None else hashlib.sha256(left.encode("utf-8", "surrogatepass")).hexdigest()))
            columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
                                             ["doc_id", "n_words", "n_removed", "n_runs", "text_sha256"])

    return mapped(joined, run, "doc_id long, n_words long, n_removed long, n_runs long, text_sha256 string")
