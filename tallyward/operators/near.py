"""Near-equal texts without comparing all pairs, and without losing one.

The measure is the share r of matching blocks: of both texts' T characters, 2M >= rT are matched.  The T - 2M others are
deleted from one text or inserted by the other, and each breaks one of any disjoint pieces of a text at most.  So of

    (1 - r) T + 1 <= 2 (1 - r) l + 1

disjoint pieces of the longer text, of l characters, one stands whole in the other, moved by no more than the unmatched characters of one text.
The pieces are the rarest of their length that don't overlap; texts meet only by these, against all stretches of that length in texts that are no longer.

Rarity is counted in a table of fixed size, by a hash of the piece: it only orders, so collisions cost nothing but time.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as t
from .shared import checkpointed, tasks

#: Places of the table of counts, and characters of a text whose pieces are chosen together.
PLACES, STRETCH = 1 << 18, 2000
#: Bytes of texts that share what has to be equal, up to which one task compares them; and meetings of pieces that it looks at together.
TASK_BYTES, MEETINGS = 32 << 20, 2_000_000
#: Short texts asked for, and texts that these are held against, in a task; and texts or pairs that it looks at together.
ASKED, TILE, ROWS = 50_000, 100_000, 20_000
#: Characters of a text up to which its subsequences are bounded before it is compared.
WIDTH = 320
_MIX = np.uint64(0x9E3779B97F4A7C15)


def pieces(size: int, least: float) -> int:
    """Disjoint pieces of a text of so many characters of which a near text that is no longer has one at least."""
    return int(2 * (1 - least) * size + 1e-6) + 1


def piece_size(size: int, least: float) -> int:
    """Characters of a piece: two thirds of what would leave no choice, so that what all texts have can be left out."""
    return max(min(int(1 / (2 * (1 - least)) + 1e-6) * 2 // 3, size // pieces(size, least)), 1)


def hashes(cells: np.ndarray, q: int) -> np.ndarray:
    """64-bit hashes of grams, in place, of characters along the last axis."""
    size = cells.shape[-1] - q + 1
    out = np.zeros((*cells.shape[:-1], max(size, 0)), np.uint64)
    for i in range(q if size > 0 else 0):
        out = (out ^ cells[..., i : size + i]) * _MIX
        out ^= out >> np.uint64(29)
    return out


def grams(text: str, q: int) -> np.ndarray:
    """64-bit hashes of a text's grams, in place."""
    return hashes(codes(text).astype(np.uint64), q)


def place(found: np.ndarray) -> np.ndarray:
    """Where a gram is counted."""
    return (found >> np.uint64(20)).astype(np.int64) & (PLACES - 1)


def rarest(cost: np.ndarray, n: int, q: int) -> np.ndarray:
    """Where ``n`` stretches of ``q`` characters begin that don't overlap and have the least sum of costs, for each row of costs."""
    rows, size = cost.shape
    best, from_ = np.zeros((rows, size + q)), []
    for _ in range(n):
        taken = np.concatenate([np.full((rows, q), np.inf), best[:, :size] + cost], axis=1)
        best = np.minimum.accumulate(taken, axis=1)
        from_.append(np.maximum.accumulate(np.where(taken <= best, np.arange(size + q), 0), axis=1))
    out, end = [], np.full(rows, size + q - 1)
    for row in reversed(from_):
        end = row[np.arange(rows), end] - q
        out.append(end)
    return np.stack(out[::-1], axis=1).astype(np.int64) if out else np.zeros((rows, 0), np.int64)


def chosen(cost: np.ndarray, size: int, least: float) -> np.ndarray:
    """Where the pieces of texts of one size begin, a row each, by the costs of their grams."""
    n, q = pieces(size, least), piece_size(size, least)
    parts = max(min(size // STRETCH, n), 1)
    at: list[np.ndarray] = []
    for i in range(parts):
        begin, end = size * i // parts, size * (i + 1) // parts
        wanted = min(-(-n // parts), (end - begin) // q)
        at.append(begin + rarest(cost[:, begin : end - q + 1], wanted, q))
    found = np.concatenate(at, axis=1)
    return found if found.shape[1] >= n else np.tile(np.arange(n) * q, (len(cost), 1))


def pivots(text: str, counts: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of a text, as tokens, and where they begin."""
    found = grams(text, piece_size(len(text), least))
    at = chosen(counts[place(found)].astype(np.float64)[None, :], len(text), least)[0]
    return found[at].view(np.int64), at


@lru_cache(1 << 16)
def stretch_sizes(size: int, least: float) -> tuple[int, ...]:
    """Characters of the pieces of texts that can be near one of so many and are no shorter."""
    return tuple(sorted({piece_size(n, least) for n in range(size, int(size * (2 - least) / least + 1e-6) + 1)})) if size < 200 else (piece_size(size, least),)


def stretches(text: str, least: float) -> tuple[np.ndarray, np.ndarray]:
    """All stretches of a text that can be a piece of a near text that is no shorter, as tokens, and where they begin."""
    found = [grams(text, q) for q in stretch_sizes(len(text), least)]
    return np.concatenate(found).view(np.int64), np.concatenate([np.arange(len(f)) for f in found])


def rarity(texts: DataFrame, least: float, column: str = "form") -> np.ndarray:
    """How often each place's stretches stand in all texts; of fixed size, so each task and the driver can hold it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(PLACES, np.int64)
        for batch in batches:
            for text in batch[column]:
                some, n = np.unique(place(stretches(text, least)[0].view(np.uint64)), return_counts=True)
                total[some] += n
        some = np.flatnonzero(total)
        yield pd.DataFrame({"place": some, "n": total[some]})

    out = np.zeros(PLACES, np.int64)
    for row in texts.select(column).mapInPandas(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toLocalIterator():
        out[row["place"]] = row["n"]
    return out


def tokens(texts: DataFrame, least: float, counts: np.ndarray | None = None) -> DataFrame:
    """``texts (.., form)`` with a row for each ``token``, its ``place``, and the text's ``size`` and ``letters`` instead of the text: its pieces by ``counts``, or all stretches."""
    shared = texts.sparkSession.sparkContext.broadcast(counts)

    @F.pandas_udf("array<struct<token:long,place:int>>")
    def found(forms: pd.Series) -> pd.Series:
        cells = [stretches(form, least) if shared.value is None else pivots(form, shared.value, least) for form in forms]
        return pd.Series([[{"token": x, "place": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)] for a, b in cells])

    rest = [c for c in texts.columns if c != "form"]
    return texts.withColumn("found", found("form")).withColumn("letters", t.letters("form")).select(*rest, F.length("form").alias("size"), "letters", F.explode("found").alias("found")).select(
        *rest, "size", "letters", "found.token", "found.place")


def candidates(texts: list[str], group: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of different texts of one group that can be near, each pair once, the longer or later first; many groups at once.

    Texts meet as between tasks, by the pieces of the longer one, rare ones among these texts.  Then bounds on what both share leave out pairs.
    """
    size = np.array([len(x) for x in texts], np.int64)
    mix = (group.astype(np.uint64) + np.uint64(1)) * _MIX
    tokens, owners, places, cells = [], [], [], []
    counts = np.zeros(PLACES, np.int64)
    able = (size > 0) & (np.bincount(group)[group] > 1)  # a text alone in its group meets none
    for n in np.unique(size[able]).tolist():
        own = np.flatnonzero(able & (size == n))
        chars = np.frombuffer("".join([texts[i] for i in own.tolist()]).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(own), n).astype(np.uint64)
        cells.append((n, own, chars))
        for q in stretch_sizes(n, least):
            found = hashes(chars, q) ^ mix[own, None]
            tokens.append(found.ravel())
            owners.append(np.repeat(own, found.shape[1]))
            places.append(np.tile(np.arange(found.shape[1]), len(own)))
            counts += np.bincount(place(tokens[-1]), minlength=PLACES)
    none = np.zeros(0, np.int64)
    if not tokens:
        return none, none
    token, owner, where = np.concatenate(tokens), np.concatenate(owners), np.concatenate(places)
    order = np.argsort(token)
    token, owner, where = token[order], owner[order], where[order]
    codes_: list[np.ndarray] = []
    for n, own, chars in cells:
        found = hashes(chars, piece_size(n, least)) ^ mix[own, None]
        at = chosen(counts[place(found)].astype(np.float64), n, least)
        asked, mine, at = np.take_along_axis(found, at, 1).ravel(), np.repeat(own, at.shape[1]), at.ravel()
        first = np.searchsorted(token, asked)
        many = np.searchsorted(token, asked, "right") - first
        ends = np.cumsum(many)
        begin = 0
        while begin < len(asked):  # some millions of meetings at a time
            end = max(int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + MEETINGS, "right")), begin + 1)
            k = np.repeat(np.arange(begin, end), many[begin:end])
            j = first[k] + np.arange(len(k)) - np.repeat(ends[begin:end] - many[begin:end] - (ends[begin - 1] if begin else 0), many[begin:end])
            a, b = mine[k], owner[j]
            moved = n - np.ceil(least / 2 * (n + size[b]) - 1e-6)
            can = (group[a] == group[b]) & ((n > size[b]) | ((n == size[b]) & (a > b))) & (size[b] >= least / (2 - least) * n - 1e-6) & (np.abs(at[k] - where[j]) <= moved)
            codes_.append(np.unique(a[can] * len(texts) + b[can]))
            begin = end
    found = np.unique(np.concatenate(codes_))
    a, b = found // len(texts), found % len(texts)
    some, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    cells, sizes = _classes_of([texts[i] for i in some.tolist()], WIDTH), size[some]
    keep = _can_share(cells, cells, sizes, sizes, at[: len(a)], at[len(a) :], least)
    a, b = a[keep], b[keep]
    keep = np.ones(len(a), bool)
    edges = np.flatnonzero(np.diff(a, prepend=-1, append=-1))
    for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if end - begin > 8 and size[a[begin]] > WIDTH:
            mine = codes(texts[a[begin]])
            for x in range(begin, end, 512):
                others = b[x : min(x + 512, end)]
                total = len(mine) + size[others]
                need = np.ceil(least * total / 2 - 1e-6)
                back, ahead = (int(max((k - need).max(initial=0), 0)) for k in (len(mine), size[others]))
                keep[x : x + len(others)] = most_shared(mine, grid([texts[i] for i in others.tolist()]), back, ahead) >= need
    return a[keep], b[keep]


def unmatched(size: int, other: int, least: float) -> int:
    """Characters that two near texts of these sizes can leave unmatched at most; -1 if none so different are near."""
    most = int((1 - least) * (size + other) + 1e-6)
    most -= (most - size - other) % 2
    return most if most >= abs(size - other) else -1


def parts(size: int, others: list[int], least: float) -> tuple[int, int] | None:
    """How many parts of a text of so many characters, and of how many each, near texts of ``others`` sizes, none longer, have one at least of but for one character; null if none is near.

    Two unmatched characters spoil a part, one doesn't.  Parts are three quarters of what would leave no choice.
    """
    most = max((unmatched(size, other, least) for other in others), default=-1)
    n = most // 2 + 1
    return None if most < 0 or not size else (n, max(min(int(0.75 / (1 - least) + 1e-6), size // n), 1))


def _gapped(cells: np.ndarray, q: int, gap: int) -> np.ndarray:
    """As :func:`hashes`, of grams of ``q`` characters without the one that stands after the first ``gap``."""
    size = max(cells.shape[-1] - q, 0)
    out = np.zeros((*cells.shape[:-1], size), np.uint64)
    for i in range(q if size else 0):
        begin = i + (i >= gap)
        out = (out ^ cells[..., begin : begin + size]) * _MIX
        out ^= out >> np.uint64(29)
    return out


def _tag(gap: int) -> np.uint64:
    """Tells grams of the shorter text that leave out a character from those that don't."""
    return np.uint64(gap * 0xD6E8FEB86659FD93 % 2**64)


def _inserted(length: int) -> list[tuple[int, int]]:
    """For each place in a part where the shorter text may have one character more: the part's end that is left out (0 the last, 1 the first), and the characters before that place."""
    return [(0, i) if i <= length // 2 else (1, i - 1) for i in range(2, length - 1)]


def _by_size(texts: list[str]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """The numbers of texts of each size but 0, and their characters, a row each."""
    size = np.array([len(x) for x in texts], np.int64)
    out = {}
    for n in np.unique(size[size > 0]).tolist():
        own = np.flatnonzero(size == n)
        out[n] = own, np.frombuffer("".join([texts[i] for i in own.tolist()]).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(own), n)
    return out


def _met(longer: list[str], shorter: list[str], least: float, equal: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of texts that share a part of the longer one but for a character, some twice; ``equal``: also those of one size.

    A part that lost a character stands in the shorter text without it; one that got a character stands there, less its first or last one,
    around a gap.  Parts are the rarest among the shorter texts' grams.
    """
    xs, ys = _by_size(longer), _by_size(shorter)
    fits = lambda n, m: (m < n or (equal and m == n)) and unmatched(n, m, least) >= 0
    shapes = {n: shape for n in xs if (shape := parts(n, [m for m in ys if fits(n, m)], least))}
    tokens, owners, places = [], [], []
    for m, (own, chars) in ys.items():
        cells = chars.astype(np.uint64)
        for length in sorted({shapes[n][1] for n in shapes if fits(n, m)}):
            q = length - 1
            for found in (hashes(cells, q), *(_gapped(cells, q, gap) ^ _tag(gap) for gap in sorted({g for _, g in _inserted(length)}))):
                tokens.append(found.ravel())
                owners.append(np.repeat(own.astype(np.int32), found.shape[1]))
                places.append(np.tile(np.arange(found.shape[1], dtype=np.int32), len(own)))
    if not tokens:
        return
    token, owner, where = np.concatenate(tokens), np.concatenate(owners), np.concatenate(places)
    del tokens, owners, places
    counts = np.bincount(place(token), minlength=PLACES)
    bits = np.uint64(64 - min(len(token).bit_length() + 3, 26))
    seen = np.zeros(1 << int(64 - bits), bool)
    seen[token >> bits] = True
    # a token's upper bits and its number in one word, which sorts much faster than a token with a number beside it
    rest = np.uint64((1 << len(token).bit_length()) - 1)
    token = np.sort((token & ~rest) | np.arange(len(token), dtype=np.uint64))
    size = np.array([len(x) for x in shorter], np.int64)
    for n, (count, length) in shapes.items():
        own, chars = xs[n]
        lead = [0, 1] + [0] * (length - 2) + [end for end, _ in _inserted(length)]
        for begin in range(0, len(own), ROWS):
            cells = chars[begin : begin + ROWS].astype(np.uint64)
            solid, columns = hashes(cells, length - 1), n - length + 1
            found = [solid[:, :columns], solid[:, 1 : columns + 1]][: 2 if length > 1 else 1] + [_gapped(cells, length - 1, gap) for gap in range(1, length - 1)]
            found += [solid[:, end : columns + end] ^ _tag(gap) for end, gap in _inserted(length)]
            cost = np.zeros((len(cells), columns))
            for f in found:
                cost += counts[place(f)]
            at = rarest(cost, count, length) if n <= STRETCH else np.tile(np.arange(count) * length, (len(cells), 1))
            asked = np.stack([np.take_along_axis(f, at, 1) for f in found], 2)
            starts = at[:, :, None] + np.array(lead[: len(found)])
            row, part, kind = np.nonzero(seen[asked >> bits])
            asked = asked[row, part, kind] & ~rest
            order = np.argsort(asked)  # neighbours are looked up together
            asked, starts, mine = asked[order], starts[row, part, kind][order], own[begin + row[order]]
            first = np.searchsorted(token, asked)
            many = np.searchsorted(token, asked | rest, "right") - first
            ends = np.cumsum(many)
            low = 0
            while low < len(asked):  # some millions of meetings at a time
                done = ends[low - 1] if low else 0
                high = max(int(np.searchsorted(ends, done + MEETINGS, "right")), low + 1)
                k = np.repeat(np.arange(low, high), many[low:high])
                j = first[k] + np.arange(len(k)) - np.repeat(ends[low:high] - many[low:high] - done, many[low:high])
                j = (token[j] & rest).astype(np.int64)
                a, b = mine[k], owner[j].astype(np.int64)
                moved = n - np.ceil(least / 2 * (n + size[b]) - 1e-6)
                can = ((n >= size[b]) if equal else (n > size[b])) & (size[b] >= least / (2 - least) * n - 1e-6) & (np.abs(starts[k] - where[j]) <= moved)
                met = np.unique(a[can] * len(shorter) + b[can])
                yield met // len(shorter), met % len(shorter)
                low = high


def _classes_of(texts: list[str], width: int) -> np.ndarray:
    """Seven bits of each character of texts, a row each; 0 beyond a text's end, and for texts longer than ``width``."""
    found = {n: cell for n, cell in _by_size(texts).items() if n <= width}
    out = np.zeros((len(texts), max(found, default=0)), np.uint8)
    for n, (own, chars) in found.items():
        out[own, :n] = chars & 127
    return out


def _can_share(mine: np.ndarray, theirs: np.ndarray, sizes: np.ndarray, total: np.ndarray, a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Whether the longest common subsequence of texts ``a`` of :func:`_classes_of` and texts ``b`` allows the ratio, all pairs at once, as :func:`most_shared` tells it for one text; true of longer texts."""
    keep = (sizes[a] > mine.shape[1]) | (total[b] > theirs.shape[1])
    asked = np.flatnonzero(~keep)
    asked = asked[np.argsort(sizes[a[asked]], kind="stable")]
    needed = np.ceil(least * (sizes[a] + total[b]) / 2 - 1e-6).astype(np.int64)
    for begin in range(0, len(asked), ROWS):
        now = asked[begin : begin + ROWS]
        back, ahead = (int(max((k - needed[now]).max(initial=0), 0)) for k in (sizes[a[now]], total[b[now]]))
        some, x = np.unique(a[now], return_inverse=True)
        own, line = mine[some], theirs[b[now]].T.copy()
        shared, longest = np.zeros(len(x), np.int64), int(sizes[some].max())
        for start in range(0, longest, 64):
            masks = np.zeros((len(some), 128), np.uint64)
            for i in range(start, min(start + 64, longest)):
                has = np.flatnonzero(sizes[some] > i)
                masks[has, own[has, i]] |= np.uint64(1) << np.uint64(i - start)
            rest = np.full(len(x), np.uint64(2**64 - 1))
            for chars in line[max(start - back, 0) : start + 64 + ahead]:
                hit = rest & masks[x, chars]
                rest = (rest + hit) | (rest - hit)
            shared += 64 - np.bitwise_count(rest).astype(np.int64)
        keep[now] = shared >= needed[now]
    return keep


def across(new: list[str], prior: list[str], least: float) -> Iterator[tuple[int, int, float]]:
    """Numbers and score of each of ``new`` and each different text of ``prior`` that is near; texts of one side don't meet, however many are alike."""
    seen: list[np.ndarray] = []
    cells = [_classes_of(side, WIDTH) for side in (new, prior)]
    sizes = [np.array([len(x) for x in side], np.int64) for side in (new, prior)]
    for swapped, sides in ((False, (new, prior)), (True, (prior, new))):
        turn = slice(None, None, -1) if swapped else slice(None)
        for x, y in _met(*sides, least, not swapped):
            can = _can_share(*cells[turn], *sizes[turn], x, y, least)
            a, b = (y[can], x[can]) if swapped else (x[can], y[can])
            seen.append(a * len(prior) + b)
    for pair in np.unique(np.concatenate([np.zeros(0, np.int64), *seen])).tolist():
        a, b = divmod(pair, len(prior))
        if new[a] != prior[b] and (score := t.ratio(new[a], prior[b])) >= least:
            yield a, b, score


def _in_tiles(new: DataFrame, prior: DataFrame, least: float, same: tuple[str, ...]) -> DataFrame:
    """``*same, id, p_id, score`` as of :func:`pairs`: what shares ``same`` is dealt in tiles of some :data:`TILE` of ``prior`` and as many parts of ``new`` as take :data:`ASKED` each, by hash; each part meets each tile in a task."""
    schema = T.StructType([*[new.schema[c] for c in same], T.StructField("id", new.schema["id"].dataType), T.StructField("p_id", prior.schema["id"].dataType), T.StructField("score", T.DoubleType())])
    count = lambda df, name, size: df.groupBy(*same).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))
    dealt = checkpointed(count(new, "parts", ASKED).join(count(prior, "tiles", TILE), list(same)))
    deal = lambda df, one, other: (df.join(dealt, list(same)).withColumn(one, F.pmod(F.xxhash64("form"), F.col(f"{one}s")).cast("int"))
                                   .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1))).select(*same, "part", "tile", "id", "form"))
    at = [*same, "part", "tile"]
    met = lambda df: df.repartition(3 * tasks(new.sparkSession), *at).groupBy(*at)

    def run(ask: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        found = list(across(ask["form"].tolist(), own["form"].tolist(), least)) if len(ask) and len(own) else []
        a, b = [f[0] for f in found], [f[1] for f in found]
        cells = {c: ask[c].iloc[a].to_numpy() for c in (*same, "id")} | {"p_id": own["id"].iloc[b].to_numpy(), "score": [f[2] for f in found]}
        return pd.DataFrame(cells, columns=schema.names)

    return met(deal(new, "part", "tile")).cogroup(met(deal(prior, "tile", "part"))).applyInPandas(run, schema)


def whole(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows that come sorted, as tables of whole groups by ``keys``."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        if rest and any(rest[-1].column(k)[-1] != batch.column(k)[0] for k in keys):
            yield pa.Table.from_batches(rest)
            rest = []
        changed = np.zeros(len(batch), bool)
        for k in keys:
            column = batch.column(k)
            changed[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        begin = int(np.flatnonzero(changed)[-1]) if changed.any() else 0
        if begin:
            yield pa.Table.from_batches([*rest, batch.slice(0, begin)])
            rest = []
        rest.append(batch.slice(begin))
    if rest:
        yield pa.Table.from_batches(rest)


def _classes(table: pa.Table, same: tuple[str, ...]) -> tuple[list[str], np.ndarray, list[int]]:
    """Different texts of a task's rows ``(*same, form, ..)``, the number of each one's group, and the number of each row's text."""
    numbers: dict[tuple, int] = {}
    groups: dict[tuple, int] = {}
    forms, group, of = [], [], []
    for *key, form in zip(*[table[c].to_pylist() for c in (*same, "form")], strict=True):
        cell = tuple(key)
        n = numbers.setdefault((cell, form), len(forms))
        if n == len(forms):
            forms.append(form)
            group.append(groups.setdefault(cell, len(groups)))
        of.append(n)
    return forms, np.array(group, np.int64), of


def _within(rows: DataFrame, least: float, same: tuple[str, ...], ordered: bool) -> DataFrame:
    """``*same, id, p_id, score`` of ``rows (*same, id, seq, form, new)``, those ``new`` against the others; rows with equal ``same`` meet in one task."""
    kind = rows.schema["id"].dataType
    out = T.StructType([*[rows.schema[c] for c in same], T.StructField("id", kind), T.StructField("p_id", kind), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole(batches, list(same)):
            texts, group, of = _classes(table, same)
            news, seqs = table["new"].to_pylist(), table["seq"].to_pylist()
            members: list[tuple[list[int], list[int]]] = [([], []) for _ in texts]
            for i, n in enumerate(of):
                members[n][not news[i]].append(i)
            mine, theirs, scores = [], [], []
            for a, b in zip(*(x.tolist() for x in candidates(texts, group, least)), strict=True):
                for x, y in ((a, b), (b, a)):
                    met = [(i, j) for i in members[x][0] for j in members[y][1] if not ordered or seqs[j] < seqs[i]]
                    if met and (score := t.ratio(texts[x], texts[y])) >= least:
                        mine += [i for i, _ in met]
                        theirs += [j for _, j in met]
                        scores += [score] * len(met)
            left, right = table.select([*same, "id"]).take(pa.array(mine, pa.int64())), table.select(["id"]).take(pa.array(theirs, pa.int64()))
            yield from pa.Table.from_arrays([*left.columns, *right.columns, pa.chunked_array([pa.array(scores, pa.float64())])], names=[c.name for c in out]).to_batches()

    return rows.repartition(*same).sortWithinPartitions(*same).mapInArrow(run, out)


def _crowded(texts: DataFrame, same: tuple[str, ...]) -> DataFrame:
    """Values of ``same`` whose texts are more than a task compares."""
    return checkpointed(texts.groupBy(*same).agg(F.sum(200 + 4 * F.length("form").cast("long")).alias("bytes")).where(F.col("bytes") > TASK_BYTES).select(*same))


def among(texts: DataFrame, least: float, same: tuple[str, ...], holder: str) -> DataFrame:
    """``*same, holder, form, p_form, score`` for each holder of a text and each different text that is near, of ``texts (*same, holder, form)``; copies are compared once.

    Texts are moved once, to the task that has all with equal ``same``; where these are more than a task compares, as in :func:`pairs`.
    """
    names = [*same, holder, "form"]
    out = T.StructType([*[texts.schema[c] for c in names], T.StructField("p_form", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole(batches, list(same)):
            forms, group, of = _classes(table, same)
            holders: list[list[int]] = [[] for _ in forms]
            for i, n in enumerate(of):
                holders[n].append(i)
            rows, others, scores = [], [], []
            for a, b in zip(*(x.tolist() for x in candidates(forms, group, least)), strict=True):
                for x, y in ((a, b), (b, a)):
                    if (score := t.ratio(forms[x], forms[y])) >= least:
                        rows += holders[x]
                        others += [forms[y]] * len(holders[x])
                        scores += [score] * len(holders[x])
            mine = table.select(names).take(pa.array(rows, pa.int64()))
            yield from pa.Table.from_arrays([*mine.columns, pa.chunked_array([pa.array(others, pa.string())]), pa.chunked_array([pa.array(scores, pa.float64())])], names=[c.name for c in out]).to_batches()

    texts = texts.select(*names)
    met = lambda df: df.repartition(*same).sortWithinPartitions(*same).mapInArrow(run, out)
    crowded = _crowded(texts, same)
    if crowded.isEmpty():
        return met(texts)
    apart = lambda how: texts.join(F.broadcast(crowded), list(same), how)
    many = checkpointed(apart("left_semi"))
    once = checkpointed(many.groupBy(*same, F.sha2("form", 256).alias("id")).agg(F.min("form").alias("form"), F.lit(0).alias("seq")))
    told = (pairs(once, once, least, same, ordered=False).join(once.select(*same, F.col("id"), "form"), [*same, "id"])
            .join(once.select(*same, F.col("id").alias("p_id"), F.col("form").alias("p_form")), [*same, "p_id"]).join(many, [*same, "form"]))
    return met(apart("left_anti")).unionByName(told.select(*names, "p_form", "score"))


def pairs(new: DataFrame, prior: DataFrame, least: float, same: tuple[str, ...] = (), ordered: bool = True, short: bool = False) -> DataFrame:
    """``*same, id, p_id, score``: each of ``new (*same, id, seq, form)`` with each different text of ``prior`` that is near and, if ``ordered``, comes before it.

    ``same`` have to be equal; texts that share them meet in one task, each moved once, where they fit there (:data:`TASK_BYTES`).  Others meet over all
    tasks by the pieces of the longer one.  Both are written tables.
    With ``short``, texts of some dozens of characters, all of ``prior`` before all of ``new``, are dealt in tiles that meet by larger parts; see :func:`across`.
    What letters allow is asked where tokens meet, so texts are moved only for pairs that can be near.  Tables of tokens are sorted, never
    broadcast: Spark takes them for as small as the texts' files, while each text gives dozens of rows.
    """
    fits = lambda size, p_size: (p_size >= F.lit(least / (2 - least)) * size) & (size >= F.lit(least / (2 - least)) * p_size)
    turn = (F.col("p_seq") < F.col("seq")) if ordered else (F.col("id") != F.col("p_id"))
    renamed = lambda df: df.select(*same, F.col("id").alias("p_id"), F.col("seq").alias("p_seq"), F.col("form").alias("p_form"))
    new, prior = new.select(*same, "id", "seq", "form"), prior.select(*same, "id", "seq", "form")
    if short:
        return checkpointed(_in_tiles(new, prior, least, same))
    within = None
    if same:
        both = new.withColumn("new", F.lit(True)).unionByName(prior.withColumn("new", F.lit(False)))
        crowded = _crowded(both, same)
        apart = lambda df, how: df.join(F.broadcast(crowded), list(same), how)
        if crowded.isEmpty():
            return checkpointed(_within(both, least, same, ordered))
        within = _within(apart(both, "left_anti"), least, same, ordered)
        new, prior = checkpointed(apart(new, "left_semi")), checkpointed(apart(prior, "left_semi"))
    counts = rarity(new.select("form").unionByName(prior.select("form")), least)
    other = renamed(prior).withColumnRenamed("p_form", "form")
    moved = F.greatest("size", "p_size") - F.ceil(F.lit(least / 2) * (F.col("size") + F.col("p_size")) - F.lit(1e-6))
    can = turn & fits(F.col("size"), F.col("p_size")) & (F.abs(F.col("place") - F.col("p_place")) <= moved) & t.may_share(F.col("letters"), F.col("p_letters"), least)

    def meet(mine: DataFrame, theirs: DataFrame, longer: Column) -> DataFrame:
        theirs = theirs.withColumnsRenamed({"size": "p_size", "letters": "p_letters", "place": "p_place"})
        return mine.hint("merge").join(theirs.hint("merge"), [*same, "token"]).where(longer & can).select(*same, "id", "p_id")

    shared = (meet(tokens(new, least, counts), tokens(other, least), F.col("size") >= F.col("p_size"))
              .unionByName(meet(tokens(new, least), tokens(other, least, counts), F.col("size") < F.col("p_size"))).distinct())
    close = shared.hint("merge").join(new, [*same, "id"]).hint("merge").join(renamed(prior), [*same, "p_id"])
    close = close.where((F.col("form") != F.col("p_form")) & t.may_be_similar("form", "p_form", least))
    found = close.withColumn("score", t.similarity("form", "p_form")).where(F.col("score") >= least).select(*same, "id", "p_id", "score")
    return checkpointed(found if within is None else found.unionByName(within))


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def grid(texts: list[str]) -> np.ndarray:
    """The characters of texts, a column each; 0 beyond a text's end."""
    cells = [codes(x) for x in texts]
    out = np.zeros((max(map(len, cells), default=0), len(cells)), np.uint32)
    for i, c in enumerate(cells):
        out[: len(c), i] = c
    return out


def most_shared(text: np.ndarray, others: np.ndarray, back: int, ahead: int) -> np.ndarray:
    """No fewer characters than any order-keeping match of ``text`` with each column of the grid ``others`` holds.

    A matched character lies at most ``back`` before and ``ahead`` after its own place.  So each 64 characters are matched, at their best, within
    that reach: their longest common subsequence, with the 64 as bits of a word, for all others at once.
    """
    known, own = np.unique(text, return_inverse=True)
    if not len(known):
        return np.zeros(others.shape[1], np.int64)
    at = np.minimum(np.searchsorted(known, others), len(known) - 1)
    seen = np.where(known[at] == others, at + 1, 0)  # 0: no character of text
    shared = np.zeros(others.shape[1], np.int64)
    for begin in range(0, len(text), 64):
        size = min(64, len(text) - begin)
        masks = np.zeros(len(known) + 1, np.uint64)
        np.bitwise_or.at(masks, own[begin : begin + size] + 1, np.uint64(1) << np.arange(size, dtype=np.uint64))
        rest = np.full(others.shape[1], np.uint64(2**64 - 1))
        for line in seen[max(begin - back, 0) : begin + size + ahead]:
            hit = rest & masks[line]
            rest = (rest + hit) | (rest - hit)
        shared += size - np.bitwise_count(rest & np.uint64(2**size - 1)).astype(np.int64)
    return shared


class Names:
    """Names in one task, a tile of a master, asked for the two most like another, exactly and at any score.

    Names are tried in order of what they can reach at most, so that few are compared in full.
    """

    def __init__(self, names: list[str]) -> None:
        self.names, self.cells = names, grid(names)
        self.sizes = np.array([len(x) for x in names], np.int64)

    def best(self, name: str) -> list[tuple[float, int]]:
        """Scores and numbers of all that reach the second best score, at least."""
        total = self.sizes + len(name)
        most = np.where(total > 0, 2 * most_shared(codes(name), self.cells, len(name), len(self.cells)) / np.maximum(total, 1), 1.0)
        found: list[tuple[float, int]] = []
        top = [-1.0, -1.0]
        for i in np.argsort(-most, kind="stable").tolist():
            if most[i] < top[1] - 1e-9:
                break
            score = SequenceMatcher(None, name, self.names[i]).ratio()
            top = sorted([*top, score], reverse=True)[:2]
            found.append((score, i))
        return [(s, i) for s, i in found if s >= top[1]]
