"""Connected groups of rows that share keys."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import checkpointed, dropped

#: Links up to which one task joins them: 32 MB.
LOCAL_LINKS = 2_000_000


def _joined(links: pd.DataFrame) -> pd.DataFrame:
    """Each node's smallest reachable node, by union and find."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in zip(links["a"].tolist(), links["b"].tolist(), strict=True):
        parent.setdefault(a, a)
        parent.setdefault(b, b)
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return pd.DataFrame({"at": list(parent), "group": [top(x) for x in parent]})


def _stars(links: DataFrame) -> DataFrame:
    """The same by rounds over all tasks: each node's larger neighbours, then its smaller ones, are linked to the smallest; until nothing changes."""
    links, seen = checkpointed(links.distinct()), None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = checkpointed(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
        found = checkpointed(small.select("x.a", "x.b").where("a <> b").distinct())
        told = found.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        dropped(links)
        dropped(large)
        if told == seen:
            return found
        links, seen = found, told


def groups(links: DataFrame) -> DataFrame:
    """``at, group`` for every node of ``links (a, b)``, a written table: the smallest node that links reach from it.

    Links that were counted to fit are joined in one task, more by rounds over all.
    """
    if links.count() <= LOCAL_LINKS:

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            parts = list(batches)
            yield _joined(pd.concat(parts)) if parts else pd.DataFrame({"at": pd.Series(dtype="int64"), "group": pd.Series(dtype="int64")})

        return links.coalesce(1).mapInPandas(run, "at long, group long")
    stars = _stars(links)
    return stars.select(F.col("a").alias("at"), F.col("b").alias("group")).unionByName(stars.select(F.col("b").alias("at"), F.col("b").alias("group")).distinct())
