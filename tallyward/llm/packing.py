"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

Lengths fall into reciprocal-capacity classes: class ``k`` takes pieces of at most
``capacity // k`` tokens and its bins hold exactly ``k`` of them.  A piece that
would leave more than ``SLACK`` tokens of its class's bin empty is cut: first to the
largest class size that fits, then what is left of it again.  What is left shrinks
with the square of the length, so three or four pieces are the rule.

Each worker fills its own bins in one pass over its rows, with a counter for each
class and no shuffle; a sequence's number is made of the worker's and its own count.
What stands in unfilled bins at a worker's end is strung together and cut at the
capacity, and the very last sequence at powers of two, which need no padding.

Defined results: a null or empty text is the end mark alone.  Rows with a null or
repeated id are packed like others, each by itself.  An empty table gives none.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ._shared import lacking, mapped

CAPACITY = 2048
END_MARK = 1
#: Tokens of a bin that a class may leave empty before its pieces are cut.
SLACK = 20
#: Tokens gathered before they are handed on.
OUT_TOKENS = 500_000
#: Vocabulary files, by name in the public tokenizers' folder: the same ids in two formats.
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


class Encoder:
    """Token ids of a text as the tokenizers library gives them.

    Texts of the Latin blocks take the rank file, which gives the same ids several
    times faster; all others, and texts that spell a special token, take the
    library itself, so that differences in Unicode tables can't show.
    """

    def __init__(self, tokenizer_path: str, ranks_path: str | None, pattern: str | None) -> None:
        import re

        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(tokenizer_path)
        self.fast = None
        if ranks_path:
            import base64

            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.other = re.compile("[^\\x20-\\x7e\\n\\xa1-\\u024f]|<\\|").search

    def __call__(self, text: str) -> list[int]:
        if self.fast is None or self.other(text):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


@functools.lru_cache(maxsize=2)
def encoder(tokenizer: str = TOKENIZER, ranks: str | None = RANKS) -> Encoder:
    """Loaded once per Python worker, from the folder of the public tokenizers."""
    import public_tokenizers

    return Encoder(public_tokenizers.path(tokenizer), public_tokenizers.path(ranks) if ranks else None, public_tokenizers.PATTERN)


@functools.lru_cache(maxsize=1 << 14)
def cut(length: int, capacity: int = CAPACITY, slack: int = SLACK) -> tuple[int, ...]:
    """The piece lengths of a document: full sequences first, then falling class sizes."""
    pieces = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        k = capacity // rest
        if capacity - k * rest <= slack:
            pieces.append(rest)
            break
        pieces.append(capacity // (k + 1))
        rest -= pieces[-1]
    return tuple(pieces)


class HarmonicPacker:
    """One worker's bins."""

    def __init__(self, worker: int, capacity: int = CAPACITY, slack: int = SLACK) -> None:
        self.capacity, self.slack = capacity, slack
        self.next_id = worker << 33
        #: class -> pieces waiting for their bin to fill: (row, start, length)
        self.open: dict[int, list[tuple]] = {}

    def _sequence(self, pieces: Iterable[tuple]) -> Iterator[tuple]:
        offset = 0
        for row, start, length in pieces:
            yield row, start, length, self.next_id, offset
            offset += length
        self.next_id += 1

    def add(self, row: object, length: int) -> Iterator[tuple]:
        """Pieces whose sequence is now complete: (row, start, length, sequence, offset)."""
        start = 0
        for size in cut(length, self.capacity, self.slack):
            k = self.capacity // size
            waiting = self.open.setdefault(k, [])
            waiting.append((row, start, size))
            start += size
            if len(waiting) == k:
                yield from self._sequence(waiting)
                self.open[k] = []

    def finish(self) -> Iterator[tuple]:
        """What stands in unfilled bins, strung together and cut again."""
        todo = [piece for k in sorted(self.open) for piece in self.open[k]]
        self.open = {}
        total = sum(p[2] for p in todo)
        sizes = [self.capacity] * (total // self.capacity)
        rest = total % self.capacity
        sizes += [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        at = 0
        todo.reverse()
        for size in sizes:
            taken = []
            while size:
                row, start, length = todo.pop()
                now = min(size, length)
                taken.append((row, start, now))
                size -= now
                if now < length:
                    todo.append((row, start + now, length - now))
                at += now
            yield from self._sequence(taken)


_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, ranks: str | None = RANKS,
         with_ids: bool = False) -> DataFrame:
    """One row per piece; ``with_ids`` adds its token ids as ``ids``.

    A piece waits with its ids until its bin is full.  What waits is bounded by the
    classes' bins, whatever the number of rows.
    """
    schema = _SCHEMA + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, ranks)
        context = TaskContext.get()
        packer = HarmonicPacker(context.partitionId() if context else 0, capacity)
        rows: list[tuple] = []
        held = [0]  # tokens in rows

        def take(pieces: Iterator[tuple]) -> None:
            for (doc_id, ids, total), start, length, sequence, offset in pieces:
                part = ids[start : start + length]
                rows.append((doc_id, start, length, zlib.crc32(part.tobytes()), total, sequence, offset) + ((part.astype(np.int32),) if with_ids else ()))
                held[0] += length

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
            if with_ids:
                arrays.append(pa.array(columns[7], pa.list_(pa.int32())))
            rows.clear()
            held[0] = 0
            return pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in schema.split(", ")])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or ""), END_MARK], "<u4")
                take(packer.add((doc_id, ids, len(ids)), len(ids)))
                if len(rows) >= 20_000 or held[0] >= OUT_TOKENS:
                    yield out()
        take(packer.finish())
        if rows:
            yield out()

    return mapped(lacking(docs, [("doc_id", "long"), ("text", "string")]), run, schema)
