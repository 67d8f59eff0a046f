"""``python -m tallyward.erp_cli payable.json``: the gross that the books will carry, as one line of JSON."""

from __future__ import annotations

import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import erp, model

FIELDS = (f"invoice_type string, currency string, line_items array<{model.LINE}>, taxes array<{model.TAX}>, discount_amount string, freight_charges string, "
          "insurance_charges string, extra_charges string, excise_duties string, gross_total string")


def booked(spark: SparkSession, text: str) -> dict:
    """``will_book_gross`` and ``currency`` of a payable given as JSON; anything but an object is an error."""
    if not isinstance(json.loads(text), dict):
        raise ValueError("a payable is a JSON object")
    row = spark.createDataFrame([(text,)], "j string").select(F.from_json("j", FIELDS, {"primitivesAsString": "true"}).alias("p"))
    got = row.select(erp.gross(F.col("p")).alias("g"), F.coalesce("p.currency", F.lit("")).alias("c")).first()
    return {"will_book_gross": got["g"], "currency": got["c"]}


def main() -> int:
    spark = SparkSession.builder.master("local[1]").getOrCreate()
    with open(sys.argv[1], encoding="utf-8") as file:
        print(json.dumps(booked(spark, file.read())))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
