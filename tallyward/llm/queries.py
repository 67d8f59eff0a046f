"""The subpackage's registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import clustering, decontam, exact_dedup, license_scan, line_dedup, merkle, packing, pii, quality_model, quality_rules, simhash, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(_table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(_table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(found["fp"]).alias("fingerprint"), "component_id")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.report(_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf_dir, "documents"))


def op13_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.clusters(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_toxicity, op2_license_scan, op3_quality_rules, op4_warc, op5_pii, op6_packing, op7_simhash, op8_quality,
              op9_line_dedup, op10_decontamination, op11_exact_dedup, op12_merkle_manifest, op13_clustering)
}

#: Those that SQL can express; the others are held against brute force in the tests.
ORACLE_SQL: dict[str, str] = {
    "op3_quality_rules": quality_rules.ORACLE,
    "op4_warc": warc.ORACLE,
    "op10_decontamination": decontam.ORACLE,
    "op11_exact_dedup": exact_dedup.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
    "op13_clustering": clustering.ORACLE,
}
