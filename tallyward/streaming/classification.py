"""A streaming variant of reading: classification and routing of texts as they arrive.

Both are stateless projections, so a stream gives what a batch gives.  Duplicates are
settled in booking order by the batch plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import classify, extract


def routed(texts: DataFrame) -> DataFrame:
    """``texts (…, text)`` with classification, route (extract or decline) and fields of payable ones."""
    pay = classify.payable(F.col("classification"))
    out = classify.classified(texts).withColumn("route", F.when(pay, F.lit("extract")).otherwise(F.lit("decline")))
    return extract.extracted(out, condition=pay)
