"""Toxicity classifier: a factorisation machine over hashed terms.

Terms are the distinct lower-cased words of a whole text and their beginnings of
four to six letters, so that inflected and compounded insults share evidence.
Pairwise factors learn interactions, such as an insult next to the mention of a
group, that additive weights miss.  See :mod:`.fm` for model and training bounds.

Defined results: a null or empty text, and one without known terms, scores by the
bias alone.  Rows repeat as they come in; ids may be null.  Without labels, or with
labels of one class, every score is the smoothed share of label 1.
"""

from __future__ import annotations

import functools
import zlib
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from . import fm

CUTOFF = 0.5
PREFIXES = (4, 5, 6)
#: Bytes of a lower-cased text: letters, digits and all beyond ASCII stay.
GAPS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str) -> set[bytes]:
    """Distinct lower-cased words, in UTF-8."""
    return set(text.lower().encode("utf-8", "surrogatepass").translate(GAPS).split())


@functools.lru_cache(maxsize=1 << 16)
def _hashes(word: bytes) -> tuple[int, ...]:
    """Of a word and its beginnings."""
    if word.isascii():
        return zlib.crc32(word), *[zlib.crc32(word[:n], 1) for n in PREFIXES if len(word) >= n]
    letters = word.decode("utf-8", "surrogatepass")
    starts = [zlib.crc32(letters[:n].encode("utf-8", "surrogatepass"), 1) for n in PREFIXES if len(letters) >= n]
    return zlib.crc32(word), *starts


def features(text: str) -> np.ndarray:
    """32-bit hashes of distinct words and of their beginnings."""
    return np.fromiter(chain.from_iterable(map(_hashes, words_of(text))), np.uint32)


def train(docs: DataFrame, labels: DataFrame) -> fm.FactorizationMachine:
    """Fit on the labelled, not held-out rows of ``docs``."""
    return fm.fit(*fm.sample(docs, labels, "toxic", features))


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""
    return fm.scorer(docs, train(docs, labels), features, CUTOFF)


def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that aren't toxic, with all their columns."""
    return fm.keep_where(docs, train(docs, labels), features, lambda score: score < CUTOFF)
