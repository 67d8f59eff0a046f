"""Queries on the masters, on duplicates, and from pages to results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedupe, match, rules
from ..operators.shared import checkpointed, scratch_path, spread
from ..streaming import duplicates
from . import rendered
from .catalog_money import cents_text, table
from .catalog_text import READ, quote
from .pipeline import Masters, adjudicate
from .twins import collapse

_RESULT = ("status", "matched_id", "method")


def _flat(rows: DataFrame, key: str, struct: str, *more: str) -> DataFrame:
    return rows.select(F.col("probe_id").alias(key), *[F.col(f"{struct}.{x}").alias(x) for x in _RESULT], *more)


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The supplier table as a master."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("supplier_id"), F.col("s_name").alias("name"), F.concat(F.lit("EE"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0")).alias("vat_id"),
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("country"), F.col("s_suppkey").alias("load_order"))


def match_supplier_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known and unknown tax numbers, names in another spelling, unknown names, and nothing, by key."""
    k = F.col("s_suppkey") % 5
    vat = F.when(k == 0, F.concat(F.lit("ee "), F.lpad(F.col("s_suppkey").cast("string"), 9, "0"))).when(k == 1, F.lit("XX1")).otherwise(F.lit(""))
    name = F.when(k == 2, F.concat(F.lower("s_name"), F.lit(", "))).when(k == 3, F.lit("nobody")).when(k == 1, F.col("s_name")).otherwise(F.lit(""))
    probes = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("probe_id"), name.alias("name"), vat.alias("vat_id"), F.lit("").alias("country"))
    return _flat(match.supplier(probes, _suppliers(spark, sf_dir), fuzzy=False), "s_suppkey", "supplier")


def match_supplier_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer's company name with a letter lost, against a master of all of them: by key, names that are there once, twice in nearly the same spelling, and not at all.

    Names begin with digits of a hash, so that no two are similar by chance; even keys are looked up in their country, odd ones in the whole master.
    """
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    first = F.sha2(k.cast("string"), 224).substr(1, 28)
    name, country = F.concat_ws(" ", first, "c_mktsegment"), F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))
    row = lambda id_, text: (id_.alias("supplier_id"), text.alias("name"), F.lit("").alias("vat_id"), country.alias("country"), k.alias("load_order"))
    master = c.select(*row(k.cast("string"), name)).unionByName(c.where(k % 10 == 5).select(*row(F.concat(k.cast("string"), F.lit("b")), F.concat(name, F.lit("s")))))
    lost = F.concat_ws(" ", F.concat(first.substr(1, 5), first.substr(7, 22)), "c_mktsegment")
    asked = F.when(k % 10 == 3, F.concat(F.lit("zz zz yy yy "), F.reverse(F.lower("c_mktsegment")), F.lit(" qq"))).otherwise(lost)
    probes = c.select(k.alias("probe_id"), asked.alias("name"), F.lit("").alias("vat_id"), F.when(k % 2 == 0, country).otherwise(F.lit("ZZ")).alias("country"))
    done = match.supplier(probes, master)
    score = F.col("supplier.score")
    return _flat(done, "c_custkey", "supplier", F.round(F.when(score >= match.ACCEPT - match.MARGIN, score), 6).alias("score"))


def match_supplier_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier's name as parts are called, against all parts' brands, types and containers: nothing matches, so the two best scores are told."""
    part = table(spark, sf_dir, "part").select("p_type", "p_brand", "p_partkey")
    master = part.groupBy(F.concat_ws(" ", "p_brand", "p_type").alias("name")).agg(F.min("p_partkey").alias("load_order")).select(
        F.col("load_order").cast("string").alias("supplier_id"), "name", F.lit("").alias("vat_id"), F.concat(F.lit("N"), (F.length("name") % 3).cast("string")).alias("country"), "load_order")
    k = F.col("s_suppkey")
    asked = F.concat_ws(" ", F.lit("Brand"), (k % 57).cast("string"), F.element_at(F.array(*[F.lit(x) for x in ("COPPER PROMO", "LARGE STEEL", "tin small", "Zinc")]), (k % 4 + 1).cast("int")))
    probes = table(spark, sf_dir, "supplier").select(k.alias("probe_id"), asked.alias("name"), F.lit("").alias("vat_id"), F.when(k % 2 == 0, F.lit("N1")).otherwise(F.lit("")).alias("country"))
    done = match.supplier(probes, master)
    return _flat(done, "s_suppkey", "supplier", F.round("supplier.score", 6).alias("score"), F.col("supplier.candidate_count").alias("candidate_count"), F.col("supplier.reason").alias("reason"))


def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A unit per supplier; its country is its nation."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.lit("C1").alias("company_code"), F.concat(F.lit("B"), F.lpad(key.cast("string"), 5, "0")).alias("business_unit_code"), F.concat(F.lit("L"), key.cast("string")).alias("location_code"),
        F.concat(F.lit("N"), F.expr("char(65 + s_nationkey)")).alias("country"), key.alias("load_order"))


def match_bu_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unknown and known codes in another spelling, and countries of one unit, several, or none."""
    k = F.col("c_custkey")
    asked = F.when(k % 7 == 0, F.lit("XX999")).when(k % 7 == 1, F.concat(F.lit(" b"), F.lpad((k % 10 + 1).cast("string"), 5, "0"))).otherwise(F.lit(""))
    probes = table(spark, sf_dir, "customer").select(k.alias("probe_id"), F.concat(F.lit("n"), F.expr("char(97 + c_nationkey)")).alias("buyer_country"), asked.alias("bu_code"))
    return _flat(match.buyer(probes, _units(spark, sf_dir)), "c_custkey", "buyer", "company_code", "business_unit_code", "location_code")


_TAX_MASTER = """
SELECT concat('T', CAST(n_nationkey AS STRING), '-', CAST(r AS STRING), t) AS code, concat('C', CAST(n_nationkey AS STRING)) AS country, CASE WHEN t = 'G' THEN 'GST' ELSE 'VAT' END AS tax_type, CAST(r AS DOUBLE) AS rate
FROM {nation}, (SELECT 0 AS r UNION ALL SELECT 5 UNION ALL SELECT 7) x, (SELECT 'A' AS t UNION ALL SELECT 'B' UNION ALL SELECT 'G') y
WHERE t = 'A' OR (t = 'B' AND n_nationkey % 2 = 0 AND r = 5) OR (t = 'G' AND n_nationkey % 3 = 0 AND r > 0)
"""


def match_tax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explicit codes, and countries, types and rates, for every line."""
    master = spark.sql(_TAX_MASTER, nation=table(spark, sf_dir, "nation"))
    item = table(spark, sf_dir, "lineitem")
    kind = F.when(F.col("l_linenumber") % 3 == 0, F.lit("vat")).when(F.col("l_linenumber") % 3 == 1, F.lit("GST")).otherwise(F.lit(""))
    probes = item.select(F.col("l_orderkey").alias("probe_id"), "l_linenumber", F.concat(F.lit("c"), (F.col("l_suppkey") % 27).cast("string")).alias("country"), kind.alias("tax_type"),
                         F.round(F.col("l_tax") * 100).alias("rate"), F.when(F.col("l_linenumber") == 5, F.lit("T1-0A")).when(F.col("l_linenumber") == 6, F.lit("none")).otherwise(F.lit("")).alias("tax_code"))
    return _flat(match.tax(probes, master), "l_orderkey", "tax", "l_linenumber", F.col("tax.candidate_count").alias("candidate_count"))


def match_payment_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    aliases = spark.createDataFrame([("Net 30", "T30", 0), ("30 days", "T30", 1), ("Net 14", "T14", 2)], "alias string, payment_term_id string, load_order int")
    days = spark.createDataFrame([(30, "T30"), (14, "T14"), (0, "T0"), (0, "TX"), (7, "T7")], "days int, payment_term_id string")
    k = F.col("o_orderkey")
    text = F.when(k % 3 == 0, F.lit("net.  30")).when(k % 3 == 1, F.lit("")).otherwise(F.lit("whenever"))
    day = F.col("o_orderdate").cast("date")
    due = F.date_add(day, F.element_at(F.array(*[F.lit(x) for x in (0, 7, 10, 14, 30, -5)]), (F.floor(k / 3) % 6 + 1).cast("int")))
    probes = table(spark, sf_dir, "orders").select(k.alias("probe_id"), text.alias("term_text"), day.cast("string").alias("invoice_date"), due.cast("string").alias("due_date"))
    return _flat(match.payment_term(probes, aliases, days), "o_orderkey", "term")


def match_po(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    master = orders.where(k % 2 == 0).select(F.concat(F.lit("ID"), k.cast("string")).alias("po_id"), F.concat(F.lit("PO-"), k.cast("string")).alias("po_number"), F.concat(F.lit("s"), (k % 3).cast("string")).alias("supplier_id"),
                                             F.lit("EUR").alias("currency"), k.alias("load_order"))
    probes = orders.select(k.alias("probe_id"), F.when(k % 10 == 9, F.lit("")).otherwise(F.concat(F.lit(" po-"), k.cast("string"))).alias("po_number"), F.concat(F.lit("s"), (k % 2).cast("string")).alias("supplier_id"),
                           F.when(k % 5 == 0, F.lit("USD")).otherwise(F.lit("")).alias("currency"))
    return _flat(match.purchase_order(probes, master), "o_orderkey", "po", F.col("po.reason").alias("reason"))


def master_existence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each customer's nation is one of a supplier."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return match.exists(c, "c_nationkey", table(spark, sf_dir, "supplier").select(F.col("s_nationkey").cast("string").alias("n")), "n", "known")


def dup_content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", dedupe.content_hash("text").alias("content_hash"))


def dup_business_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each order's customer, number, date, currency and gross; every sixth number is blank."""
    k = F.col("o_orderkey")
    number = F.when(k % 6 == 0, F.lit(" ")).otherwise(F.concat(F.lit("INV-"), k.cast("string"), F.lit(" ")))
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    key = dedupe.business_key(F.concat(F.lit("S"), F.col("o_custkey").cast("string")), number, F.col("o_orderdate").cast("date").cast("string"), F.lit("EUR"), cents_text(cents))
    return table(spark, sf_dir, "orders").select("o_orderkey", key.alias("business_key"))


#: A text of an order that is like no other order's, in SQL of both engines.
_NEAR = "concat('order ', sha2(CAST(k AS STRING), 256), ' of the customer')"


def _registry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, each with a later copy under another file, in booking order; some rows can't be booked.

    Copies by key: of the file or the text, of the business key alone, of the text but for a letter, and a text labelled a copy.
    """
    k = F.col("k")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    text = F.expr(_NEAR)
    common = (F.lit("S").alias("supplier_identity"), k.cast("string").alias("invoice_number"), F.when(k % 4 == 2, F.lit("")).otherwise(F.lit("2024-01-01")).alias("invoice_date"), F.lit("EUR").alias("currency"))
    first = orders.select((k * 2).alias("seq"), F.concat(F.lit("f"), k.cast("string")).alias("file"), F.when(k % 8 == 0, F.sha2(text, 256)).otherwise(F.lit("")).alias("file_hash"),
                          text.alias("full_text"), *common, cents_text(F.col("cents")).alias("gross_total"), (k % 5 != 0).alias("bookable"))
    other = F.when(k % 4 == 0, text).when(k % 4 == 1, F.concat(F.lit("another text "), text.substr(1, 40))).when(k % 4 == 2, F.concat(text.substr(1, 30), text.substr(32, 200))).otherwise(F.concat(F.lit("Copy tax invoice "), k.cast("string")))
    copy = orders.select((k * 2 + 1).alias("seq"), F.concat(F.lit("g"), k.cast("string")).alias("file"), F.when(k % 8 == 0, F.sha2(text, 256)).otherwise(F.lit("")).alias("file_hash"),
                         other.alias("full_text"), *common, cents_text(F.col("cents") + F.when(k % 4 == 3, 1).otherwise(0)).alias("gross_total"), (k % 7 != 0).alias("bookable"))
    return first.unionByName(copy)


def dup_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and their later copies settled in booking order; see :func:`_registry_rows`."""
    return dedupe.settle(dedupe.evidence(_registry_rows(spark, sf_dir))).select("seq", "verdict", "method", "matched_against", "booked", F.round("score", 6).alias("score"))


def dup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as they arrive: three deliveries, cut between an order and its copy, each settled by a stream that goes on from the last."""
    rows = checkpointed(_registry_rows(spark, sf_dir))
    cuts = [(c // 2) * 2 + 1 for c in rows.approxQuantile("seq", [1 / 3, 2 / 3], 0.01)] or [0, 0]
    place, folder = scratch_path(spark, "deliveries"), scratch_path(spark, "stream")
    for part in (F.col("seq") < cuts[0], (F.col("seq") >= cuts[0]) & (F.col("seq") < cuts[1]), F.col("seq") >= cuts[1]):
        rows.where(part).write.mode("append").parquet(place)
        duplicates.settled(spark.readStream.schema(rows.schema).parquet(place), folder).awaitTermination()
    return spark.read.parquet(f"{folder}/verdicts").select("seq", "verdict", "method", "matched_against", "booked", F.round("score", 6).alias("score"))


def dup_advisories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers' texts, each with a later one under another amount that lost eight letters, too many, or none but says it is a copy; near texts are remarked, and copies of what wasn't booked are not."""
    k = F.col("k")
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k")).withColumn("text", F.expr(_NEAR))
    row = lambda seq, mark, text, cents, able: rows.select(
        seq.alias("seq"), F.concat(F.lit(mark), k.cast("string")).alias("file"), F.lit("").alias("file_hash"), text.alias("full_text"), *[F.lit("").alias(x) for x in ("supplier_identity", "invoice_number", "invoice_date")],
        F.lit("EUR").alias("currency"), cents_text(cents).alias("gross_total"), able.alias("bookable"))
    later = F.when(k % 3 == 0, F.concat(F.col("text").substr(1, 30), F.col("text").substr(39, 200))).when(k % 3 == 1, F.concat(F.col("text").substr(1, 20), F.col("text").substr(41, 200))).otherwise(
        F.concat(F.col("text").substr(1, 80), F.lit(" copy")))
    both = row(k * 2, "f", F.col("text"), k * 10, k % 5 != 0).unionByName(row(k * 2 + 1, "g", later, k * 10 + 1, F.lit(True)))
    return dedupe.settle(dedupe.evidence(both), remarks=True).select("seq", "verdict", "method", "matched_against", "booked", F.round("score", 6).alias("score"))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of an equal amount that are near-equal: an order's text, one with a letter lost, and one that lost too many, under the order's gross; with the orders that hold them."""
    k = F.col("k")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    text = F.expr(_NEAR)
    texts = orders.select("k", "cents", F.explode(F.array(text, F.concat(text.substr(1, 30), text.substr(32, 200)), F.concat(text.substr(1, 20), text.substr(41, 200)))).alias("full_text"))
    rows = texts.select(k.alias("seq"), k.cast("string").alias("file"), F.lit("").alias("file_hash"), "full_text", F.lit("").alias("supplier_identity"), F.lit("").alias("invoice_number"),
                        F.lit("").alias("invoice_date"), F.lit("EUR").alias("currency"), cents_text(F.col("cents")).alias("gross_total"), F.lit(True).alias("bookable"))
    near = dedupe.near_texts(dedupe.evidence(rows), holder="seq")
    return near.select(F.col("seq").alias("o_orderkey"), "currency", "gross_total", "content_hash", "p_hash", F.round("score", 6).alias("score"))


def masters(spark: SparkSession, sf_dir: str) -> Masters:
    """Masters for the rendered documents, from the harness tables."""
    s = table(spark, sf_dir, "supplier")
    suppliers = s.select(F.col("s_suppkey").cast("string").alias("supplier_id"), F.concat(F.lit("Supplier "), F.col("s_suppkey").cast("string"), F.lit(" Ltd")).alias("name"),
                         F.concat(F.lit("EE"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0")).alias("vat_id"), F.lit("EE").alias("country"), F.col("s_suppkey").alias("load_order"))
    units = spark.createDataFrame([("C1", "DE001", "L1", "DE", 0)], "company_code string, business_unit_code string, location_code string, country string, load_order int")
    taxes = spark.createDataFrame([("EE-VAT20", "EE", "VAT", 20.0), ("DE-VAT19", "DE", "VAT", 19.0)], "code string, country string, tax_type string, rate double")
    aliases = spark.createDataFrame([("Net 30", "T30", 0)], "alias string, payment_term_id string, load_order int")
    days = spark.createDataFrame([(0, "T0")], "days int, payment_term_id string")
    orders = table(spark, sf_dir, "orders").where("o_orderkey % 16 = 0").select(
        F.concat(F.lit("ID"), F.col("o_orderkey").cast("string")).alias("po_id"), F.concat(F.lit("PO-"), F.col("o_orderkey").cast("string")).alias("po_number"), F.lit("").alias("supplier_id"), F.lit("EUR").alias("currency"),
        F.col("o_orderkey").alias("load_order"))
    return Masters(suppliers, units, taxes, aliases, days, orders)


def end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered documents as one-page files, through every stage to one result per file."""
    docs = rendered.documents(spark, spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"), "o_orderkey"))
    name = F.concat(F.lit("doc-"), F.lpad(F.col("k").cast("string"), 9, "0"), F.lit(".pdf"))
    pages = docs.select(name.alias("doc_id"), F.lit(1).alias("page_number"), "text")
    files = docs.select(name.alias("file"), name.alias("sort_key"), F.sha2(F.col("k").cast("string"), 256).alias("file_hash"), F.lit(None).cast("string").alias("render_error"))
    done = adjudicate(pages, files, masters(spark, sf_dir))
    one = F.get("payables", F.lit(0))
    return done.select("file", F.size("payables").alias("n_payables"), F.size("declined").alias("n_declined"), F.coalesce(F.get("declined", F.lit(0))["doc_type"], F.lit("")).alias("decline_type"),
                       F.coalesce(F.get("declined", F.lit(0))["reason"], F.lit("")).alias("reason"),
                       F.coalesce(one["supplier"]["supplier_id"], F.lit("")).alias("supplier_id"), F.coalesce(one["buyer"]["business_unit_code"], F.lit("")).alias("business_unit_code"),
                       F.coalesce(F.get(one["taxes"], F.lit(0))["tax_type_code"], F.lit("")).alias("tax_code"), F.coalesce(one["payment_term_id"], F.lit("")).alias("payment_term_id"),
                       F.coalesce(one["po_id"], F.lit("")).alias("po_id"), F.coalesce(one["gross_total"], F.lit("")).alias("gross_total"))


QUERIES = {f.__name__: f for f in (
    match_supplier_exact, match_supplier_fuzzy, match_supplier_scores, match_bu_country, match_tax, match_payment_term, match_po, master_existence, dup_content_hash, dup_business_key, dup_registry, dup_stream, dup_advisories, near_duplicates, end_to_end)}

_NEAR_DUCK = "concat('order ', sha256(CAST(k AS VARCHAR)), ' of the customer')"
_TAX = rendered.duck_sql(_TAX_MASTER, nation="nation")


def _name_key(x: str) -> str:
    spaced = f"regexp_replace({x}, '[,.]', ' ', 'g')"
    return f"lower({collapse(spaced)})"


def _vat_key(x: str) -> str:
    return f"upper(regexp_replace({x}, '[\\s-]', '', 'g'))"


def _order_key(x: str) -> str:
    return f"upper({collapse(x)})"


_FORM = f"lower({collapse('coalesce(text, ' + repr('') + ')')})"
ORACLE_SQL = {
    "match_supplier_exact": f"""
WITH m AS (SELECT CAST(s_suppkey AS VARCHAR) AS id, s_suppkey AS o, {_vat_key("'EE' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0')")} AS v, {_name_key("s_name")} AS n FROM supplier),
p AS (
  SELECT s_suppkey, {_vat_key("CASE s_suppkey % 5 WHEN 0 THEN 'ee ' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') WHEN 1 THEN 'XX1' ELSE '' END")} AS v,
         {_name_key("CASE s_suppkey % 5 WHEN 1 THEN s_name WHEN 2 THEN lower(s_name) || ', ' WHEN 3 THEN 'nobody' ELSE '' END")} AS n FROM supplier),
r AS (
  SELECT s_suppkey, p.v, CASE WHEN p.v <> '' THEN a.id WHEN p.n <> '' THEN b.id END AS id
  FROM p LEFT JOIN (SELECT v, max_by(id, o) AS id FROM m GROUP BY 1) a ON a.v = p.v LEFT JOIN (SELECT n, max_by(id, o) AS id FROM m GROUP BY 1) b ON b.n = p.n)
SELECT s_suppkey, CASE WHEN id IS NULL THEN 'UNMATCHED' ELSE 'MATCHED' END AS status, coalesce(id, '') AS matched_id,
       CASE WHEN v <> '' THEN 'exact_vat_id' WHEN id IS NOT NULL THEN 'exact_normalized_name' ELSE '' END AS method FROM r""",
    "match_bu_country": """
WITH m AS (SELECT s_suppkey AS s, 'B' || lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS code, 'N' || chr(65 + s_nationkey) AS country FROM supplier),
u AS (SELECT country, count(DISTINCT code) AS n, min(code) AS code FROM m GROUP BY 1),
p AS (
  SELECT c_custkey, 'N' || chr(65 + c_nationkey) AS country, upper(trim(CASE c_custkey % 7 WHEN 0 THEN 'XX999' WHEN 1 THEN ' b' || lpad(CAST(c_custkey % 10 + 1 AS VARCHAR), 5, '0') ELSE '' END)) AS asked FROM customer),
r AS (SELECT c_custkey, asked, n, CASE WHEN asked <> '' THEN asked WHEN n = 1 THEN u.code END AS wanted FROM p LEFT JOIN u ON u.country = p.country)
SELECT c_custkey, CASE WHEN s IS NOT NULL THEN 'MATCHED' WHEN asked = '' AND n > 1 THEN 'AMBIGUOUS' ELSE 'UNMATCHED' END AS status, coalesce(code, '') AS matched_id,
       CASE WHEN s IS NULL THEN '' WHEN asked <> '' THEN 'exact_bu_code' ELSE 'country_unique_bu' END AS method,
       CASE WHEN s IS NULL THEN '' ELSE 'C1' END AS company_code, coalesce(code, '') AS business_unit_code, coalesce('L' || s, '') AS location_code
FROM r LEFT JOIN m ON m.code = wanted""",
    "match_tax": f"WITH m AS ({_TAX}), p AS (SELECT l_orderkey, l_linenumber, 'C' || (l_suppkey % 27) AS country, CASE l_linenumber % 3 WHEN 0 THEN 'VAT' WHEN 1 THEN 'GST' ELSE '' END AS kind, round(l_tax * 100) AS rate FROM lineitem), "
                 "d AS (SELECT DISTINCT country, kind, rate FROM p), "
                 "f AS (SELECT d.country, d.kind, d.rate, list_sort(list_distinct(list(m.code))) AS codes FROM d JOIN m ON m.country = d.country AND abs(m.rate - d.rate) <= 0.005::DOUBLE "
                 "AND (m.tax_type = d.kind OR NOT EXISTS (SELECT 1 FROM m z WHERE z.country = d.country AND z.tax_type = d.kind)) GROUP BY ALL) "
                 "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 5 THEN 'MATCHED' WHEN codes IS NULL THEN 'UNMATCHED' WHEN len(codes) > 1 THEN 'AMBIGUOUS' ELSE 'MATCHED' END AS status, "
                 "CASE WHEN l_linenumber = 5 THEN 'T1-0A' WHEN len(codes) = 1 THEN codes[1] ELSE '' END AS matched_id, "
                 "CASE WHEN l_linenumber = 5 THEN 'explicit_tax_code' WHEN len(codes) = 1 THEN CASE WHEN p.kind = '' THEN 'country_rate_only' ELSE 'country_type_rate' END ELSE '' END AS method, "
                 "CAST(CASE WHEN l_linenumber = 5 THEN 1 ELSE coalesce(len(codes), 0) END AS BIGINT) AS candidate_count FROM p LEFT JOIN f USING (country, kind, rate)",
    "match_payment_term": "WITH p AS (SELECT o_orderkey, o_orderkey % 3 = 0 AS named, [0, 7, 10, 14, 30, -5][o_orderkey // 3 % 6 + 1] AS d FROM orders) "
                          "SELECT o_orderkey, CASE WHEN named OR d IN (7, 14, 30) THEN 'MATCHED' WHEN d = 0 THEN 'AMBIGUOUS' ELSE 'UNMATCHED' END AS status, "
                          "CASE WHEN named THEN 'T30' WHEN d IN (7, 14, 30) THEN 'T' || d ELSE '' END AS matched_id, CASE WHEN named THEN 'exact_text_alias' WHEN d IN (7, 14, 30) THEN 'unique_day_count' ELSE '' END AS method FROM p",
    "match_po": f"""
WITH m AS (
  SELECT {_order_key("'PO-' || o_orderkey")} AS n, max_by({{'id': 'ID' || o_orderkey, 's': 's' || (o_orderkey % 3), 'c': 'EUR'}}, o_orderkey) AS o FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1),
p AS (
  SELECT o_orderkey, {_order_key("CASE WHEN o_orderkey % 10 = 9 THEN '' ELSE ' po-' || o_orderkey END")} AS n, 's' || (o_orderkey % 2) AS s, CASE WHEN o_orderkey % 5 = 0 THEN 'USD' ELSE '' END AS c FROM orders)
SELECT o_orderkey, CASE WHEN o IS NULL THEN 'UNMATCHED' ELSE 'MATCHED' END AS status, coalesce(o.id, '') AS matched_id, CASE WHEN o IS NULL THEN '' ELSE 'exact_po_number' END AS method,
       CASE WHEN p.n = '' THEN 'no order number' WHEN o IS NULL THEN 'order number not in the master'
            ELSE concat_ws('; ', CASE WHEN p.s <> o.s THEN 'another supplier in the master' END, CASE WHEN p.c <> '' AND p.c <> o.c THEN 'another currency in the master' END) END AS reason
FROM p LEFT JOIN m ON p.n = m.n""",
    "master_existence": "SELECT c_custkey, c_nationkey, c_nationkey IN (SELECT s_nationkey FROM supplier) AS known FROM customer",
    "dup_content_hash": f"SELECT doc_id, CASE WHEN {_FORM} = '' THEN '' ELSE sha256({_FORM}) END AS content_hash FROM documents",
    "dup_business_key": "WITH p AS (SELECT *, CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE 'inv-' || o_orderkey END AS number, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders) "
                        "SELECT o_orderkey, CASE WHEN number = '' THEN '' ELSE sha256(concat_ws('|', 's' || o_custkey, number, CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 'eur', "
                        "(c // 100) || '.' || lpad(CAST(c % 100 AS VARCHAR), 2, '0'))) END AS business_key FROM p",
    "dup_registry": "WITH g AS (SELECT o_orderkey AS k, o_orderkey % 5 <> 0 AS fb, o_orderkey % 7 <> 0 AS cb, CAST(o_orderkey % 4 AS INT) AS kind FROM orders), "
                    "c AS (SELECT *, fb AND kind <> 3 AS dup FROM g), "
                    "r AS (SELECT k * 2 AS seq, 'NONE' AS verdict, '' AS method, '' AS matched_against, fb AS booked, CAST(NULL AS DOUBLE) AS score FROM c UNION ALL "
                    "SELECT k * 2 + 1, CASE WHEN dup THEN 'DUPLICATE_OF_BOOKED_PAYABLE' WHEN kind = 3 THEN 'ADVISORY' ELSE 'NONE' END, "
                    "CASE WHEN dup THEN CASE WHEN k % 8 = 0 THEN 'file_hash' WHEN kind = 0 THEN 'content_hash' WHEN kind = 1 THEN 'business_key' ELSE 'high_confidence_near_duplicate' END "
                    "WHEN kind = 3 THEN 'copy_indicator' ELSE '' END, CASE WHEN dup THEN 'f' || k ELSE '' END, NOT dup AND cb, "
                    f"CASE WHEN dup AND kind = 2 THEN round(2.0::DOUBLE * (length({_NEAR_DUCK}) - 1) / (2 * length({_NEAR_DUCK}) - 1), 6) END FROM c) SELECT * FROM r",
    # what was planted: of 86 letters the later text has 78, 66, or 80 and a label; a text is remarked only after one that was booked
    "dup_advisories": "WITH g AS (SELECT s_suppkey AS k, s_suppkey % 5 <> 0 AS able, CAST(s_suppkey % 3 AS INT) AS kind FROM supplier) "
                      "SELECT k * 2 AS seq, 'NONE' AS verdict, '' AS method, '' AS matched_against, able AS booked, CAST(NULL AS DOUBLE) AS score FROM g UNION ALL "
                      "SELECT k * 2 + 1, CASE WHEN kind = 2 OR (kind = 0 AND able) THEN 'ADVISORY' ELSE 'NONE' END, CASE WHEN able AND kind <> 1 THEN 'near_duplicate' WHEN kind = 2 THEN 'copy_indicator' ELSE '' END, "
                      "CASE WHEN able AND kind <> 1 THEN 'f' || k ELSE '' END, true, CASE WHEN able AND kind = 0 THEN round(156.0::DOUBLE / 164, 6) WHEN able AND kind = 2 THEN round(2.0::DOUBLE * 81 / 171, 6) END FROM g",
    # what was planted: the text and the one that lost a letter are near, in both orders; their matching blocks hold all letters but one
    "near_duplicates": f"WITH t AS (SELECT o_orderkey, o_orderkey AS k, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders), "
                       f"p AS (SELECT *, {_NEAR_DUCK} AS a, substr({_NEAR_DUCK}, 1, 30) || substr({_NEAR_DUCK}, 32) AS b FROM t), q AS (SELECT * FROM p UNION ALL SELECT * REPLACE (b AS a, a AS b) FROM p) "
                       "SELECT o_orderkey, 'EUR' AS currency, CAST(c // 100 AS VARCHAR) || '.' || lpad(CAST(c % 100 AS VARCHAR), 2, '0') AS gross_total, sha256(a) AS content_hash, sha256(b) AS p_hash, "
                       "round(2.0::DOUBLE * least(length(a), length(b)) / (length(a) + length(b)), 6) AS score FROM q",
    # what was planted: the name that lost a letter is its own; a second spelling in the master makes it ambiguous
    "match_supplier_fuzzy": "WITH p AS (SELECT c_custkey, CAST(c_custkey % 10 AS INT) AS kind, 29 + length(c_mktsegment) AS n FROM customer) "
                            "SELECT c_custkey, CASE kind WHEN 3 THEN 'UNMATCHED' WHEN 5 THEN 'AMBIGUOUS' ELSE 'MATCHED' END AS status, CASE WHEN kind IN (3, 5) THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS matched_id, "
                            "'fuzzy_name_blocked_by_country' AS method, CASE WHEN kind <> 3 THEN round(2.0::DOUBLE * (n - 1) / (2 * n - 1), 6) END AS score FROM p",
    "end_to_end": f"""{READ},
a AS (
  SELECT *, reason = '' AS candidate, lower({collapse("text")}) AS form, 'doc-' || lpad(CAST(k AS VARCHAR), 9, '0') || '.pdf' AS file,
         CASE WHEN reason <> '' THEN reason
              WHEN invoice_number IS NULL AND supplier_name IS NULL AND invoice_date_raw IS NULL AND subtotal_raw IS NULL
                THEN {quote("INSUFFICIENT_EVIDENCE: evidence.minimum_corroboration: " + rules.BARE_TOTAL)}
              WHEN currency IS NULL THEN 'INSUFFICIENT_EVIDENCE: financial.missing_currency: currency is blank on a payable' ELSE '' END AS why FROM r),
b AS (SELECT *, min(CASE WHEN why = '' THEN file END) OVER (PARTITION BY candidate, form) AS first_file FROM a),
e AS (SELECT *, candidate AND coalesce(first_file < file, false) AS dup FROM b)
SELECT file, CAST(CASE WHEN why = '' AND NOT dup THEN 1 ELSE 0 END AS INT) AS n_payables, CAST(CASE WHEN why = '' AND NOT dup THEN 0 ELSE 1 END AS INT) AS n_declined,
       CASE WHEN dup THEN 'duplicate_payable' WHEN why <> '' THEN doc_type ELSE '' END AS decline_type,
       CASE WHEN dup THEN 'DUPLICATE_OF_BOOKED_PAYABLE: Content-identical (normalized text) to already-booked document ''' || first_file || '''.' ELSE why END AS reason,
       CASE WHEN why = '' AND NOT dup THEN coalesce(by_vat, by_name, '') ELSE '' END AS supplier_id,
       CASE WHEN why = '' AND NOT dup AND buyer_country = 'DE' THEN 'DE001' ELSE '' END AS business_unit_code,
       CASE WHEN why = '' AND NOT dup AND coalesce(supplier_country, buyer_country) = 'EE' AND upper(kinds[1]) = 'VAT' AND rates[1] = '20' AND structured THEN 'EE-VAT20' ELSE '' END AS tax_code,
       CASE WHEN why = '' AND NOT dup AND lower(payment_term_text) = 'net 30' THEN 'T30' ELSE '' END AS payment_term_id,
       CASE WHEN why = '' AND NOT dup AND po_number IN (SELECT 'PO-' || o_orderkey FROM orders WHERE o_orderkey % 16 = 0) THEN replace(po_number, 'PO-', 'ID') ELSE '' END AS po_id,
       CASE WHEN why = '' AND NOT dup THEN CAST(g AS VARCHAR) ELSE '' END AS gross_total
FROM e LEFT JOIN (SELECT 'EE' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS v, CAST(s_suppkey AS VARCHAR) AS by_vat FROM supplier) ON v = supplier_vat_id
LEFT JOIN (SELECT 'supplier ' || s_suppkey || ' ltd' AS n, CAST(s_suppkey AS VARCHAR) AS by_name FROM supplier) ON supplier_vat_id IS NULL AND n = lower(supplier_name)""",
}
ORACLE_SQL["dup_stream"] = ORACLE_SQL["dup_registry"]
