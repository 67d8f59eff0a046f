"""Quality rules: a threshold table compiled into one Spark projection.

All of it is built-in column expressions, so a scan, one projection per level of
derived values and nothing else; no shuffle, no Python.  Repeated three-word
windows are found inside the row, by sorting (window, position) pairs and looking
at the neighbours, in time n log n of the text.

Defined results: a null text has no words (all counts zero, ``base_failed``).
Repeated rows repeat.  Extra columns are ignored by ``verdicts``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import lacking

# Frequent words of the four languages, written in lower case.
STOP_WORDS = (
    "the of and to in a is that it was for on are as with his they at be this from or by not "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an "
    "de la le et les des en un une du que est pour dans qui par sur il au "
    "el los las del y por con se una no su para lo como más pero"
).split()

#: name, value, least, most; a text passes where least <= value <= most.  None: no bound.
#: Ratios are per word, unless named otherwise.  Values are set so that plain prose
#: of any of the languages is well inside.
THRESHOLDS: tuple[tuple[str, float | None, float | None], ...] = (
    ("mean_word_chars", 2.0, 25.0),
    ("symbols_per_word", None, 0.3),
    ("stop_word_share", 0.01, None),
    ("distinct_stop_words", 2, None),
    ("duplicate_line_share", None, 0.5),
    ("bullet_line_share", None, 0.9),
    ("ellipsis_line_share", None, 0.5),
    ("words_without_letter_share", None, 0.5),
)
MIN_WORDS, REPEAT_PERCENT, WINDOW = 50, 50, 3

_SPACE = "[\\x20\\x09-\\x0D]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words covered by three-word windows that occur twice or more."""
    count = F.size(words) - (WINDOW - 1)
    pair = lambda i: F.struct(
        F.concat_ws(" ", *[F.get(words, i + k) for k in range(WINDOW)]).alias("w"), i.alias("i"))
    ordered = F.sort_array(F.transform(F.sequence(F.lit(0), count - 1), pair))

    def covered(pairs: Column) -> Column:
        same = lambda a, b: F.coalesce(F.get(pairs, a)["w"] == F.get(pairs, b)["w"], F.lit(False))
        twice = F.filter(pairs, lambda p, n: ((n > 0) & same(n - 1, n)) | same(n, n + 1))
        at = F.flatten(F.transform(twice, lambda p: F.sequence(p["i"], p["i"] + (WINDOW - 1))))
        return F.size(F.array_distinct(at))

    return F.when(count < 2, F.lit(0)).otherwise(let(ordered, covered)).cast("long")


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the base counts and ratios of each row."""
    text = lacking(docs, [("doc_id", "long"), ("text", "string")]).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    split = text.select(
        "doc_id", "text",
        F.filter(F.split("text", _SPACE + "+"), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"))
    words, lines = F.col("words"), F.col("lines")
    counted = split.select(
        "doc_id",
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        _repeat_words(words).alias("n_repeat_words"),
        F.size(lines).alias("n_lines"),
        F.filter(words, lambda w: F.lower(w).isin(*sorted(set(STOP_WORDS)))).alias("stops"),
        F.size(F.filter(words, lambda w: ~w.rlike("\\p{L}"))).alias("n_letterless"),
        F.size(F.filter(lines, lambda x: x.rlike("^\\s*[-*•]\\s"))).alias("n_bullets"),
        F.size(F.filter(lines, lambda x: x.rlike("(\\.\\.\\.|…)\\s*$"))).alias("n_ellipses"))
    per_word = lambda x: F.col(x) / F.greatest(F.col("n_words"), F.lit(1))
    per_line = lambda x: F.col(x) / F.greatest(F.col("n_lines"), F.lit(1))
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        per_word("word_chars").alias("mean_word_chars"),
        per_word("n_symbols").alias("symbols_per_word"),
        (F.size("stops") / F.greatest(F.col("n_words"), F.lit(1))).alias("stop_word_share"),
        F.size(F.array_distinct(F.transform("stops", F.lower))).alias("distinct_stop_words"),
        per_line("n_dup_lines").alias("duplicate_line_share"),
        per_line("n_bullets").alias("bullet_line_share"),
        per_line("n_ellipses").alias("ellipsis_line_share"),
        per_word("n_letterless").alias("words_without_letter_share"))


def passes(table: tuple[tuple[str, float | None, float | None], ...] = THRESHOLDS) -> Column:
    """The table compiled into one predicate over the columns of ``measures``."""
    out = F.lit(True)
    for name, least, most in table:
        if least is not None:
            out = out & (F.col(name) >= F.lit(least))
        if most is not None:
            out = out & (F.col(name) <= F.lit(most))
    return out


def verdicts(docs: DataFrame, table: tuple[tuple[str, float | None, float | None], ...] = THRESHOLDS) -> DataFrame:
    """Per document the base counts, ``base_failed`` and ``kept``."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return measures(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & passes(table)).alias("kept"))


#: The same in DuckDB's SQL, over the view ``documents``.
ORACLE = f"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
g AS (
  SELECT rid, i, array_to_string(words[i:i+2], ' ') AS w
  FROM (SELECT rid, words, unnest(generate_series(1, len(words) - 2)) AS i FROM t WHERE len(words) >= 3)),
d AS (SELECT rid, w FROM g GROUP BY rid, w HAVING count(*) > 1),
r AS (
  SELECT rid, count(DISTINCT p) AS n
  FROM (SELECT g.rid, unnest([g.i, g.i + 1, g.i + 2]) AS p FROM g JOIN d ON g.rid = d.rid AND g.w = d.w) GROUP BY rid),
m AS (
  SELECT t.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
         len(lines) AS n_lines,
         list_filter(words, lambda w: list_contains([{", ".join(repr(w) for w in sorted(set(STOP_WORDS)))}], lower(w))) AS stops,
         len(list_filter(words, lambda w: NOT regexp_matches(w, '\\pL'))) AS n_letterless,
         len(list_filter(lines, lambda x: regexp_matches(x, '^\\s*[-*•]\\s'))) AS n_bullets,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\\.\\.\\.|…)\\s*$'))) AS n_ellipses
  FROM t LEFT JOIN r ON t.rid = r.rid),
f AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed,
         word_chars / greatest(n_words, 1) AS mean_word_chars, n_symbols / greatest(n_words, 1) AS symbols_per_word,
         len(stops) / greatest(n_words, 1) AS stop_word_share, len(list_distinct(list_transform(stops, lambda w: lower(w)))) AS distinct_stop_words,
         n_dup_lines / greatest(n_lines, 1) AS duplicate_line_share, n_bullets / greatest(n_lines, 1) AS bullet_line_share,
         n_ellipses / greatest(n_lines, 1) AS ellipsis_line_share, n_letterless / greatest(n_words, 1) AS words_without_letter_share
  FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join([f"{n} >= {a}" for n, a, _ in THRESHOLDS if a is not None] + [f"{n} <= {b}" for n, _, b in THRESHOLDS if b is not None])} AS kept
FROM f
"""
