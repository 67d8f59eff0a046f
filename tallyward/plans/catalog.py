"""Registered queries and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import catalog_match, catalog_money, catalog_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**catalog_money.QUERIES, **catalog_text.QUERIES, **catalog_match.QUERIES}
ORACLE_SQL: dict[str, str] = {**catalog_money.ORACLE_SQL, **catalog_text.ORACLE_SQL, **catalog_match.ORACLE_SQL}
