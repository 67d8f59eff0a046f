"""Quality classifier: a factorisation machine over words, structure and metadata.

Features are the distinct lower-cased words, structure statistics as quantised
bins (length, share of symbols, of upper case, of digits, of repeated words and
lines, mean word and line length, stop marks), and as metadata the length that the
table states (``n_chars``: its bin, and whether it is the text's own).  Pairs of bins and words get their weight from the low-rank factors,
scored in linear time by the sum-of-squares identity; see :mod:`.fm`.

Defined results as for :mod:`.toxicity`: empty and null texts have the bins of an
empty text and get a score like any other.  A null or missing ``n_chars`` is a bin of its own.
"""

from __future__ import annotations

import functools
import zlib
from itertools import islice
from math import log2
from operator import eq

import numpy as np
from pyspark.sql import DataFrame

from . import fm
from .toxicity import words_of

CUTOFF = 0.3
METADATA: fm.Metadata = (("n_chars", "long"),)
_SYMBOLS, _DIGITS = b"#*$%&|<>~^_=+{}[]\\/@!", b"0123456789"


def statistics(text: str) -> dict[str, float]:
    """The structure statistics, each on a scale that a few bins cover."""
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    raw = text.encode("utf-8", "surrogatepass")
    size, n = max(len(text), 1), max(len(words), 1)
    symbols, digits = (len(raw) - len(raw.translate(None, which)) for which in (_SYMBOLS, _DIGITS))
    share = lambda part: 40 * part
    return {
        "length": 2 * log2(1 + len(text)),
        "words": 2 * log2(1 + len(words)),
        "word length": 2 * sum(map(len, words)) / n,
        "line words": 2 * log2(1 + len(words) / max(len(lines), 1)),
        "symbols": share(symbols / size),
        "symbols a word": share(symbols / n / 4),
        "digits": share(digits / size),
        "upper": share(sum(map(str.isupper, words)) / n),
        "repeated words": share(1 - len(set(words)) / n),
        "same as before": share(sum(map(eq, words, islice(words, 1, None))) / n),
        "repeated lines": share(1 - len(set(lines)) / max(len(lines), 1)),
        "full stops": share(min(1.0, raw.count(b".") / n)),
        "bars": share(min(1.0, raw.count(b"|") / n)),
    }


@functools.lru_cache(maxsize=1 << 12)
def _bin(name: str, place: int) -> int:
    return zlib.crc32(f"{name}:{place}".encode(), 1)


def metadata(text: str, n_chars: int | None) -> list[int]:
    """Hashes of the stated length's bin with its neighbours, and of how it compares with the text."""
    if n_chars is None:
        return [_bin("no stated length", 0)]
    place = int(2 * log2(1 + max(n_chars, 0)))
    return [_bin("stated length", place + d) for d in (-1, 0, 1)] + [_bin("stated against own", (n_chars > len(text)) - (n_chars < len(text)))]


def features(text: str, n_chars: int | None = None) -> np.ndarray:
    """32-bit hashes of distinct words, of (statistic, bin), each bin with its two neighbours, and of metadata."""
    hashed = list(map(zlib.crc32, words_of(text)))
    for name, value in statistics(text).items():
        hashed += [_bin(name, int(value) + d) for d in (-1, 0, 1)]
    return np.array(hashed + metadata(text, n_chars), np.uint32)


def train(docs: DataFrame, labels: DataFrame) -> fm.FactorizationMachine:
    """Fit on the labelled, not held-out rows of ``docs``."""
    return fm.fit(*fm.sample(docs, labels, "quality", features, METADATA))


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""
    return fm.scorer(docs, train(docs, labels), features, CUTOFF, METADATA)


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents of good quality, with all their columns."""
    return fm.keep_where(docs, train(docs, labels), features, lambda score: score >= CUTOFF, METADATA)
