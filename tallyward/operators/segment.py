"""Pages into documents: gaps and islands over one window per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions import vocabulary as v


def titles(top: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(top, F.lit(v.led(v.TITLES)), F.lit(0)), F.upper)))


def identities(top: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(top, F.lit(v.led(v.IDENTITY)), F.lit(0)), F.lower)))


def boundaries(pages: DataFrame, suggested: str | None = None) -> DataFrame:
    """``pages (doc_id, page_number, text)`` with ``opens``: whether a new document begins, and ``evidence`` for it.

    ``suggested`` names a boolean column of ``pages`` that decides instead where it isn't
    null, such as a language model's answer.

    A page opens one if a title stands at its top that the page before lacks, or a
    new identity beside any title.  The first page and pages without text never do.
    """
    order = Window.partitionBy("doc_id").orderBy("page_number")
    top = pages.withColumn("top", t.top_region("text"))
    found = top.withColumn("titles", titles(F.col("top"))).withColumn("ids", identities(F.col("top")))
    seen = (found.withColumn("titles_before", F.lag("titles").over(order)).withColumn("ids_before", F.lag("ids").over(order)))
    new_titles = F.array_except("titles", "titles_before")
    new_ids = F.array_except("ids", "ids_before")
    has = lambda x: F.size(x) > 0
    later = F.col("titles_before").isNotNull()
    opens = later & t.present("top") & (has(new_titles) | (has(new_ids) & has("titles")))
    if suggested:
        opens = later & F.coalesce(F.col(suggested), opens)
    listed = lambda label, x: F.when(has(x), F.concat(F.lit(label), F.array_join(x, ", ")))
    evidence = F.array_compact(F.array(listed("new title at page top: ", new_titles), listed("distinct identity at page top: ", new_ids)))
    return seen.select("doc_id", "page_number", "text", "titles", "ids", F.coalesce(opens, F.lit(False)).alias("opens"),
                       F.when(F.coalesce(opens, F.lit(False)), evidence).otherwise(F.array().cast("array<string>")).alias("evidence"))


def segments(pages: DataFrame, suggested: str | None = None) -> DataFrame:
    """One row per document found in each file: ``doc_id, seg_no, page_numbers, role_hint, confidence, evidence, text``.

    Each page is in exactly one.  The text joins the pages that have any, in page order.
    """
    order = Window.partitionBy("doc_id").orderBy("page_number")
    numbered = boundaries(pages, suggested).withColumn("seg_no", F.sum(F.col("opens").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)) + 1)
    whole = Window.partitionBy("doc_id")
    grouped = (numbered.groupBy("doc_id", "seg_no")
               .agg(F.array_sort(F.collect_list(F.struct("page_number", "text", "evidence"))).alias("p"))
               .withColumn("parts", F.max("seg_no").over(whole)))
    found = F.flatten(F.transform("p", lambda x: x["evidence"]))
    fallback = F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("structural fallback")))
    split = F.col("parts") > 1
    return grouped.select(
        "doc_id", "seg_no", F.transform("p", lambda x: x["page_number"]).alias("page_numbers"),
        F.when(split, F.lit("detected_segment")).otherwise(F.lit("whole_document")).alias("role_hint"),
        F.when(split, F.lit(0.6)).otherwise(F.lit(1.0)).alias("confidence"),
        F.when(split, fallback).otherwise(F.array(F.lit("no boundary found"))).alias("evidence"),
        segment_text(F.col("p")).alias("text"))


def segment_text(pages: Column) -> Column:
    """Texts of ``array<struct<page_number, text, ...>>`` that aren't empty, joined by line breaks."""
    return F.array_join(F.filter(F.transform(F.array_sort(pages), lambda x: x["text"]), lambda x: F.length(x) > 0), "\n")


def without_pages(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``segments`` completed by one segment of page 1 for each of ``docs (doc_id)`` that has no page at all."""
    missing = docs.select("doc_id").distinct().join(found.select("doc_id").distinct(), "doc_id", "left_anti")
    return found.unionByName(missing.select(
        "doc_id", F.lit(1).cast("long").alias("seg_no"), F.array(F.lit(1)).cast(dict(found.dtypes)["page_numbers"]).alias("page_numbers"),
        F.lit("whole_document").alias("role_hint"), F.lit(1.0).alias("confidence"), F.array(F.lit("no rendered pages available")).alias("evidence"), F.lit("").alias("text")))
