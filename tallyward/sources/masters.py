"""The five masters, read from JSON.  Load order is kept, since later rows outrank earlier ones of the same key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUPPLIERS = "suppliers array<struct<supplier_id:string,name:string,vat_id:string,country:string,email:string,address:string,bank_iban:string>>"
CHART = ("companies array<struct<company_code:string,company_name:string,business_units:array<struct<business_unit_code:string,business_unit_name:string,"
         "locations:array<struct<location_code:string,location_name:string,invoice_to_address:string>>>>>>")
TAXES = "taxes array<struct<code:string,country:string,tax_type:string,rate:double,name:string>>"
TERMS = "payment_terms array<struct<payment_term_id:string,days:int,text_aliases:array<string>>>"
ORDERS = ("purchase_orders array<struct<po_id:string,po_number:string,supplier_id:string,currency:string,"
          "po_lines:array<struct<line_id:string,description:string,quantity:int,uom:string,unit_price:string>>>>")


def load(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON document; a missing or malformed one is an error of the setup, so it fails here."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def suppliers(spark: SparkSession, path: str) -> DataFrame:
    return load(spark, path, SUPPLIERS).select(F.posexplode("suppliers").alias("load_order", "s")).select("load_order", "s.*")


def business_units(spark: SparkSession, path: str) -> DataFrame:
    """A row per location; the country is the letters before a unit code's digits."""
    companies = load(spark, path, CHART).select(F.posexplode("companies").alias("a", "c"))
    units = companies.select("a", "c.company_code", F.posexplode("c.business_units").alias("b", "u"))
    places = units.select("a", "b", "company_code", "u.business_unit_code", F.posexplode("u.locations").alias("d", "l"))
    return places.select("company_code", "business_unit_code", F.col("l.location_code").alias("location_code"),
                         F.nullif(F.regexp_extract("business_unit_code", r"^([A-Z]{2})\d+$", 1), F.lit("")).alias("country"), F.struct("a", "b", "d").alias("load_order"))


def taxes(spark: SparkSession, path: str) -> DataFrame:
    return load(spark, path, TAXES).select(F.inline("taxes"))


def term_aliases(spark: SparkSession, path: str) -> DataFrame:
    rows = load(spark, path, TERMS).select(F.posexplode("payment_terms").alias("a", "t"))
    return rows.select("a", "t.payment_term_id", F.posexplode("t.text_aliases").alias("b", "alias")).select("alias", "payment_term_id", F.struct("a", "b").alias("load_order"))


def term_days(spark: SparkSession, path: str) -> DataFrame:
    return load(spark, path, TERMS).select(F.inline("payment_terms")).where("days is not null").select("days", "payment_term_id")


def purchase_orders(spark: SparkSession, path: str) -> DataFrame:
    return load(spark, path, ORDERS).select(F.posexplode("purchase_orders").alias("load_order", "p")).select(
        "load_order", "p.po_id", "p.po_number", "p.supplier_id", "p.currency")
