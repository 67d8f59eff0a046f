"""Personal data: pattern spans, and sanitisation of terms that give entities away.

Base spans are e-mail addresses, IPv4 addresses, card numbers and telephone
numbers.  Beside these, secrets are protected: runs of letters and digits that look like
keys and tokens.  Removing a value alone may not hide it: a term that occurs nearly only
beside it still tells of it.  After information-theoretic sanitisation, the corpus gives

    PMI(e; t) = log2(n(e,t) * N / (n(e) * n(t)))     IC(e) = log2(N / n(e))

over N distinct texts.  A protected entity ``e`` is a value, or one of its generalisations:
its group (the address's domain, network, issuer, dialling code, or the secret's form), and
its kind.  Values are counted by distinct contexts (``REACH`` words on either side; copies of
a passage count once), groups and kinds by distinct values, and terms by distinct texts, so
that copies of a document count once everywhere.  A term with n(e,t) of at least
``LEAST[level]`` and PMI >= ``ALPHA`` * IC discloses the entity, and is a span in every
document that mentions the entity.  What discloses a value alone is generalised, what
discloses a group or kind is removed.

Counts cover all documents.  Only contexts of mentions are gathered, pre-aggregated
before each shuffle; of the corpus, hashes of texts are counted, and candidate terms
by how many documents have the same text.  The tables of candidates and of disclosing
terms are broadcast if their counted size allows it, and joined by a shuffle if not.

Defined results: a null or empty text has no spans.  Rows without an id and
repeated rows are treated like others.  Extra columns are ignored by ``spans`` and
kept by ``sanitised``.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import BROADCAST_BYTES, few, join_small, lacking, mapped, own_name

KINDS = ("email", "ip", "card", "phone")
#: Added kinds of spans.
SECRET, TERM = "secret", "term"
#: Levels of an entity, and the distinct contexts (of a value) or values (of a group or kind) that a term needs.
VALUE, GROUP, KIND = 0, 1, 2
LEAST = (3, 5, 5)
REACH, ALPHA = 10, 0.9
#: Characters of a term at least; in scripts that write words with few characters any number.
MIN_TERM_CHARS = 3
#: Characters of a secret at least, and changes between letters and digits in it.
SECRET_CHARS, SECRET_CHANGES = 16, 2

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W_]+")
_DENSE = re.compile("[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uac00-\ud7af\U00020000-\U0003134f]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_CODE = re.compile(rf"(?<![^\W_])[A-Za-z0-9]{{{SECRET_CHARS},}}(?![^\W_])")
_CHANGE = re.compile(r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])")


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def luhn(digits: str) -> bool:
    """The checksum of card numbers."""
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        if place % 2:
            digit = digit * 2 - 9 * (digit > 4)
        total += digit
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @ backwards, so that long runs cost linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text[start - 1]):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _octet(digits: str) -> bool:
    """A number of at most 255, however many zeros lead it."""
    bare = digits.lstrip("0")
    return len(bare) <= 3 and int(bare or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` in code points, by start and then kind as listed."""
    found = [(a, b, 0) for a, b in _emails(text)] if "@" in text else []
    found += [(*m.span(), 1) for m in _IP.finditer(text) if all(map(_octet, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _NOT_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((*m.span(), 2))
    if "+" in text:
        found += [(*m.span(), 3) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return [(a, b, KINDS[k]) for a, b, k in sorted(found, key=lambda x: (x[0], x[2]))]


def protected(text: str) -> list[tuple[int, int, str]]:
    """Base spans, and secrets where no base span is, in order."""
    spans = base_spans(text)
    codes = [m.span() for m in _CODE.finditer(text) if sum(1 for _ in _CHANGE.finditer(m[0])) >= SECRET_CHANGES]
    if not codes:
        return spans
    ends, starts = list(accumulate((s[1] for s in spans), max)), [s[0] for s in spans]
    for a, b in codes:
        before = bisect_left(starts, b)
        if not before or ends[before - 1] <= a:
            spans.append((a, b, SECRET))
    return sorted(spans, key=_place)


_ORDER = {kind: i for i, kind in enumerate((*KINDS, SECRET, TERM))}


def _place(span: tuple[int, int, str]) -> tuple[int, int]:
    return span[0], _ORDER[span[2]]


def generalisations(text: str, span: tuple[int, int, str]) -> tuple[str, str, str]:
    """The names of the value, however it is written, of its group, and of its kind."""
    start, end, kind = span
    value = text[start:end]
    if kind == "email":
        value = value.lower()
        group = value.rpartition("@")[2]
    elif kind == "ip":
        value = ".".join(p.lstrip("0") or "0" for p in value.split("."))
        group = ".".join(value.split(".")[:2])
    elif kind == SECRET:
        group = f"{len(value)}{'u' * (value != value.lower())}{'l' * (value != value.upper())}"
    else:
        value = _NOT_DIGIT.sub("", value)
        group = value[:6] if kind == "card" else value[:-7]
    return f"{kind}:{value}", f"{kind}/{group}", kind


def entities(text: str, span: tuple[int, int, str]) -> list[int]:
    """64-bit keys of the value, its group and its kind."""
    return [xxhash.xxh64_intdigest(name.encode(), level) - (1 << 63) for level, name in enumerate(generalisations(text, span))]


def _terms(text: str) -> list[str]:
    words = map(str.lower, _WORD.findall(text))
    return [w for w in words if (len(w) >= MIN_TERM_CHARS or _DENSE.match(w)) and not w.isdigit()]


def _contexts(text: str, spans: list[tuple[int, int, str]]) -> list[tuple[list[str], list[str]]]:
    """The ``REACH`` terms before and after each span, however far away, without words in any span."""
    if not spans:
        return []
    terms, starts, counts, at = [], [], [], 0
    for a, b, _ in [*sorted(spans), (len(text), len(text), "")]:
        if a > at:
            starts.append(at)
            counts.append(len(terms))
            terms += _terms(text[at:a])
        at = max(at, b)
    starts.append(len(text) + 1)
    counts.append(len(terms))
    # no stretch between spans overlaps one, so each lies wholly before or after it
    cut = [counts[bisect_left(starts, a)] for a, _, _ in spans]
    return [(terms[max(0, c - REACH) : c], terms[c : c + REACH]) for c in cut]


def mentions(docs: DataFrame) -> DataFrame:
    """``entity, level, unit, terms`` of every protected span and level.

    unit: what the entity is counted by; of a value the hash of the terms around it, of a group or kind the value.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, levels, units, terms = [], [], [], []
            for value in batch.column(0):
                text = value.as_py() or ""
                spans = protected(text)
                for span, (before, after) in zip(spans, _contexts(text, spans), strict=True):
                    context = xxhash.xxh64_intdigest("\x00".join([*before, "\x01", *after]).encode("utf-8", "surrogatepass")) - (1 << 63)
                    found = entities(text, span)
                    keys += found
                    levels += [VALUE, GROUP, KIND]
                    units += [context, found[VALUE], found[VALUE]]
                    terms += [sorted({*before, *after})] * 3
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(levels, pa.int32()), pa.array(units, pa.int64()), pa.array(terms, pa.list_(pa.string()))],
                                             ["entity", "level", "unit", "terms"])

    return mapped(lacking(docs, [("text", "string")]), run, "entity long, level int, unit long, terms array<string>")


def _text_counts(docs: DataFrame, copies: DataFrame, candidates: DataFrame) -> DataFrame:
    """``term, n_t``: distinct texts that contain each candidate term; ``copies (key, n)``: texts that n > 1 documents have.

    Documents are counted by term and by n; of a text that n documents have, each n make one.
    """
    small = candidates.count() * 256 <= BROADCAST_BYTES
    wanted = docs.sparkSession.sparkContext.broadcast(frozenset(r["term"] for r in candidates.toLocalIterator())) if small else None
    slim = lacking(docs, [("text", "string")]).withColumn("key", _text_key(F.col("text")))
    copied = join_small(slim, copies, ["key"], "left", 64).select("text", F.coalesce("n", F.lit(1)).alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, int], int] = {}
        for batch in batches:
            for value, n in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                terms = set(_terms(value.as_py() or ""))
                for term in terms if wanted is None else wanted.value.intersection(terms):
                    counts[term, n] = counts.get((term, n), 0) + 1
            if len(counts) > 100_000:
                yield table(counts)
                counts = {}
        yield table(counts)

    def table(counts: dict[tuple[str, int], int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([t for t, _ in counts], pa.string()), pa.array([n for _, n in counts], pa.int64()),
                                           pa.array(list(counts.values()), pa.int64())], ["term", "n", "docs"])

    seen = mapped(copied, run, "term string, n long, docs long")
    if not small:
        seen = seen.join(candidates, "term", "left_semi")
    each = seen.groupBy("term", "n").agg(F.sum("docs").alias("docs"))
    return each.groupBy("term").agg(F.sum(F.expr("docs div n")).alias("n_t"))


def disclosing(docs: DataFrame, least: tuple[int, int, int] = LEAST, alpha: float = ALPHA) -> DataFrame:
    """``entity, level, term, pmi, ic`` of the terms that disclose a protected entity."""
    seen = few(mentions(docs).distinct(), docs, "mentions")
    enough = F.element_at(F.array(*map(F.lit, least)), F.col("level") + 1)
    pairs = few(seen.select("entity", "level", "unit", F.explode("terms").alias("term")).distinct().groupBy("entity", "level", "term")
                .agg(F.count(F.lit(1)).alias("n_et")).where(F.col("n_et") >= enough), docs, "pairs")
    copies = few(lacking(docs, [("text", "string")]).groupBy(_text_key(F.col("text")).alias("key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), docs, "copies")
    of_term = _text_counts(docs, copies, pairs.select("term").distinct())
    of_entity = seen.select("entity", "unit").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    texts = docs.count() - (copies.agg(F.sum(F.col("n") - 1)).first()[0] or 0)
    total = F.lit(float(max(texts, 1)))
    # n_t counts texts and n_et contexts, of which a text may hold several
    shared = F.least(F.col("n_et"), F.col("n_t"))
    return few(
        pairs.join(of_term, "term").join(of_entity, "entity")
        .withColumn("ic", F.log2(total / F.least(F.col("n_e"), total)))
        .withColumn("pmi", F.log2(shared * total / (F.least(F.col("n_e"), total) * F.col("n_t"))))
        .where((F.col("pmi") >= alpha * F.col("ic")) & (F.col("ic") > 0)).select("entity", "level", "term", "pmi", "ic"), docs, "disclosing")


Known = dict[int, list[tuple[str, int]]]


def _mark(text: str, known: Known) -> list[tuple[int, int, str, str]]:
    """``start, end, kind, put``: protected spans, and those of terms that disclose an entity mentioned in the text; put: what stands in for it."""
    spans = protected(text)
    found = [(a, b, k, f"[{k.upper()}]") for a, b, k in spans]
    given: dict[str, int] = {}
    if known:
        for key in {key for s in spans for key in entities(text, s)}:
            for term, level in known.get(key, ()):
                given[term] = max(level, given.get(term, VALUE))
    if not given:
        return found
    ends, starts = list(accumulate((s[1] for s in spans), max)), [s[0] for s in spans]
    for m in _WORD.finditer(text):
        level = given.get(m[0].lower())
        if level is not None:
            before = bisect_left(starts, m.end())
            if not before or ends[before - 1] <= m.start():
                found.append((*m.span(), TERM, "" if level > VALUE else "[NAME]" if m[0][0].isupper() else "[WORD]"))
    return sorted(found, key=_place)


def _attach(docs: DataFrame, terms: DataFrame) -> tuple[DataFrame, str | None, object]:
    """``docs`` and the way to the disclosing terms: a broadcast, or a column joined on the id and the text."""
    spark = docs.sparkSession
    if terms.count() * 256 <= BROADCAST_BYTES:
        known: Known = {}
        for r in terms.toLocalIterator():
            known.setdefault(r["entity"], []).append((r["term"], r["level"]))
        return docs, None, spark.sparkContext.broadcast(known)
    column, key = own_name(docs, "disclosing_terms"), own_name(docs, "mentioned_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, found = [], []
            for text_key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = value.as_py() or ""
                for e in {e for s in protected(text) for e in entities(text, s)}:
                    keys.append(text_key)
                    found.append(e)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(found, pa.int64())], [key, "entity"])

    slim = lacking(docs, [("text", "string")]).select(_text_key(F.col("text")).alias("key"), "text")
    found = mapped(slim, run, f"{key} long, entity long").distinct()
    of_entity = terms.groupBy("entity").agg(F.collect_list(F.struct("term", "level")).alias("terms"))
    listed = found.join(of_entity, "entity").groupBy(key).agg(F.collect_list(F.struct("entity", "terms")).alias(column))
    return docs.join(listed, _text_key(docs["text"]) == listed[key], "left").drop(key), column, None


def _known(broadcast, cell) -> Known:
    if broadcast is not None:
        return broadcast.value
    return {x["entity"]: [(t["term"], t["level"]) for t in x["terms"]] for x in cell.as_py() or ()}


def spans(docs: DataFrame, least: tuple[int, int, int] = LEAST, alpha: float = ALPHA) -> DataFrame:
    """``doc_id, spans`` with spans as array of (start, end, kind) in code points."""
    joined, column, shared = _attach(lacking(docs, [("doc_id", "long"), ("text", "string")]), disclosing(docs, least, alpha))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column(2) if column else [None] * batch.num_rows
            rows = [[{"start": a, "end": b, "kind": k} for a, b, k, _ in _mark(text.as_py() or "", _known(shared, cell))]
                    for text, cell in zip(batch.column(1), cells, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], ["doc_id", "spans"])

    return mapped(joined, run, "doc_id long, spans array<struct<start:long,end:long,kind:string>>")


def sanitised(docs: DataFrame, least: tuple[int, int, int] = LEAST, alpha: float = ALPHA) -> DataFrame:
    """``docs`` with values generalised to their kind, as ``[EMAIL]``, terms that disclose a value to ``[NAME]`` or ``[WORD]``, and other disclosing terms removed."""
    joined, column, shared = _attach(docs, disclosing(docs, least, alpha))
    at = docs.columns.index("text")
    names = docs.columns

    def clean(text: str | None, known: dict[int, list[str]]) -> str | None:
        if not text:
            return text
        out, done = [], 0
        for start, end, _, put in _mark(text, known):
            if start >= done:
                out += [text[done:start], put]
            done = max(done, end)
        return "".join([*out, text[done:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column(len(names)) if column else [None] * batch.num_rows
            texts = [clean(t.as_py(), _known(shared, c)) for t, c in zip(batch.column(at), cells, strict=True)]
            columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return mapped(joined, run, docs.schema)


def digests(docs: DataFrame) -> DataFrame:
    """Per document the counts of each base kind, their digest, all spans in one string, and their number."""
    found = spans(docs)
    listed = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("spans", lambda x: x["kind"].isin(*KINDS))
    number = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[number(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def digest_of(found: list[tuple[int, int, str]]) -> str:
    """The digest of spans as ``digests`` makes it."""
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in found).encode()).hexdigest()
