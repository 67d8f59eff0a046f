"""Connected components of a link table, by alternating large-star and small-star steps.

Links stay distributed in every round.  The minimum of a node's neighbours is
pre-aggregated before the shuffle, so a hub with a third of all links costs one
partial row per task.  The minima are a table of their own, so that handing them back is
a broadcast where their counted size allows it, and else a plain equi-join of two tables, which
adaptive execution splits at hubs.  Each round ends in a table in the
shared folder, and deletes those of the round before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import dropped, few, join_small


def _with_least(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``links (u, v)``, a written table's, with ``m``, the least of u and its neighbours; and the table of these."""
    least = few(links.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), links, "least")
    return join_small(links, least, ["u"], "inner", 64), least


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def connected_components(links: DataFrame) -> DataFrame:
    """Rows ``(u, root)`` for each node of ``links (u, v)`` but the roots; root: the smallest node reachable.

    Self links and repeated links change nothing.  An empty table gives an empty one.
    """
    lower = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    current = few(lower, links, "links")
    state = _state(current)
    while state[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near, first = _with_least(both)
        large = few(near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), both, "large")
        near, second = _with_least(large)
        small = (near.select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                                               F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u <> v").distinct())
        old, current = current, few(small, large, "links")
        before, state = state, _state(current)
        for table in (old, first, large, second):
            dropped(table)
        if before == state:
            break
    return current.select("u", F.col("v").alias("root"))
