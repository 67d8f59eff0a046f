"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and
returns a DataFrame, which is written as Parquet and read again as the next one's
documents.

Defined results, for all stages: an empty table gives an empty one, and extra columns of any name are kept up to the last
stage.  Null texts are scored like empty ones, have no lines and no benchmark passages, and are grouped with empty texts; of a
group one row with an id stays.  Rows without an id are never anybody's earlier copy: line dedup leaves them as they are, and
near-dedup can't tell them apart and keeps them.  Rows that share an id are judged by their own texts; rows alike in
id and text are one document to line dedup and leave one row to near-dedup.  Ties go to the smaller id, then to the
smaller hash of the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyward.llm import decontam, line_dedup, packing, simhash, toxicity
from tallyward.llm._shared import scratch_path


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return toxicity.reject(docs, _labels(spark, sf_dir))


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of passages of 50 words or more are cut out; documents left without a word go."""
    return line_dedup.deduplicated(docs, drop_emptied=True)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return simhash.keep_one(docs)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a benchmark item go."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces of token sequences with their ids."""
    return packing.pack(docs, with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", remove_toxic),
    ("line_dedup", remove_repeated_lines),
    ("simhash_near_dedup", remove_near_duplicates),
    ("benchmark_decontamination", remove_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, with a table in the shared folder between any two."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Trained scores, fingerprints and token ids are beyond SQL; the tests hold each stage against brute force.
ORACLE_SQL: str | None = None
