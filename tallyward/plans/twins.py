"""Pieces of DuckDB SQL that say what the column functions say."""

from __future__ import annotations


def money(x: str) -> str:
    """Half-up rounding on the shortest decimal form of a double."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,20)), 2) AS DOUBLE)"


def re2(pattern: str) -> str:
    """A pattern of the vocabulary for RE2, as an SQL literal: other flags, lookaheads replaced by what they amount to."""
    out = pattern.replace("(?-iU:(?![a-z]))", "(?:(?-i:[^a-z])|$)").replace("(?iU)", "(?i)").replace("(?U)", "")
    out = out.replace("(?![A-Za-z])", "").replace("++", "+").replace(r"(?!\s*%)", "")
    return "'" + out.replace("'", "''") + "'"


def hit(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, {re2(pattern)})"


def found(text: str, pattern: str, group: int = 1) -> str:
    return f"nullif(regexp_extract({text}, {re2(pattern)}, {group}), '')"


def every(text: str, pattern: str, group: int = 0) -> str:
    return f"regexp_extract_all({text}, {re2(pattern)}, {group})"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"
