"""Small document tables with the awkward rows every operator must stand."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
DATA = "/root/testdata/sf0.01"


def documents(spark: SparkSession, texts: list[tuple[int | None, str | None]]) -> DataFrame:
    return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t)) for i, t in texts], SCHEMA).repartition(3)


def awkward(long: int = 9000) -> list[tuple[int | None, str | None]]:
    """Nulls, empties, ties, repeated rows and a very long text (``long`` sentences; SQL twins take quadratic time on it)."""
    prose = "The quick brown fox jumps over the lazy dog and runs away. "
    return [(1, prose * 3), (1, prose * 3), (2, None), (None, prose), (None, None), (3, ""), (4, " \n\t "), (5, "x"),
            (6, prose * long), (7, "naïve café " * 30), (2, prose * 3), (8, "É" * 2000)]


def words(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 8))) for _ in range(n)]


def clashing(docs: DataFrame) -> DataFrame:
    """With extra columns under names that the operators use themselves."""
    from pyspark.sql import functions as F

    out = docs
    for name in ("score", "key", "doc", "fp", "runs", "component_id", "gone_id", "hit_id", "run_key", "run_cells", "run_doc", "spans", "y", "kept", "words"):
        out = out.withColumn(name, F.lit("own"))
    return out
