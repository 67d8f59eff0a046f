"""Resolution against the masters: an identifier is given only where evidence points to exactly one.

Each probe row keeps its place; masters are reduced to one row per key before the
join, so no join can multiply probes.  A master is broadcast only if its counted
rows are few; a larger one is joined by a shuffle.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from . import near
from .shared import checkpointed

MATCHED, UNMATCHED, AMBIGUOUS = "MATCHED", "UNMATCHED", "AMBIGUOUS"
# Acceptance of similar names, and what rates may differ by.
ACCEPT, MARGIN, RATE_SLACK = 0.90, 0.08, 0.005
#: Rows up to which a master is broadcast.
BROADCAST_ROWS = 200_000
RESULT = "struct<status:string,matched_id:string,method:string,score:double,candidate_count:long,reason:string>"


def sized(master: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``master`` marked for broadcast if it has at most ``limit`` rows (counting stops there)."""
    return F.broadcast(master) if master.limit(limit + 1).count() <= limit else master


def keyed_or_apart(key: str, by: str) -> Column:
    """``key`` where it isn't blank, else one that no master has and that differs from row to row, so that blanks don't meet in one task."""
    return F.when(t.present(key), F.col(key)).otherwise(F.concat(F.lit("\x00"), F.xxhash64(by).cast("string")))


def result(status: Column | str, matched: Column | None = None, method: Column | str = "", score: Column | float | None = None,
           count: Column | int = 0, reason: Column | str = "") -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(lit(status).alias("status"), (F.lit("") if matched is None else matched).alias("matched_id"), lit(method).alias("method"),
                    lit(score).cast("double").alias("score"), lit(count).cast("long").alias("candidate_count"), lit(reason).alias("reason")).cast(RESULT)


def one(found: Column, method: Column | str) -> Column:
    return result(MATCHED, found, method, 1.0, 1)


def id_or_blank(match: Column) -> Column:
    return F.when(match["status"] == MATCHED, match["matched_id"]).otherwise(F.lit(""))


def last_wins(master: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One row per key that isn't blank: the value that comes last in load order."""
    return master.where(t.present(key)).groupBy(key).agg(F.max_by(value, order).alias(value))


def unique_or_blank(master: DataFrame, key: str, value: str) -> DataFrame:
    """Per key the number of distinct values, their sorted list's text, and the value if there is one."""
    return (master.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.array_sort(F.collect_set(value)).alias("all")).select(
                key, F.size("all").alias("n"), F.array_join("all", ",").alias("listed"), F.when(F.size("all") == 1, F.get("all", F.lit(0))).alias("only")))


def supplier(probes: DataFrame, master: DataFrame, fuzzy: bool = True, unicode: bool = True, scores: bool = True) -> DataFrame:
    """``probes (probe_id, name, vat_id, country)`` with ``supplier``; ``master (supplier_id, name, vat_id, country, load_order)``.

    A tax number decides alone, found or not; then the name, then a similar name in
    the country's block, or in the whole master where the country is blank or has none.  Names that match nothing are told with their
    two best scores, for which they are held against their whole block; without ``scores`` they are only told to be unmatched.
    """
    keyed = master.select("supplier_id", "load_order", t.vat_key("vat_id", unicode).alias("m_vat"), t.name_key("name", unicode).alias("m_name"),
                          t.country_key("country", unicode).alias("m_country"))
    by_vat = last_wins(keyed, "m_vat", "supplier_id", "load_order").withColumnRenamed("supplier_id", "vat_match")
    by_name = last_wins(keyed, "m_name", "supplier_id", "load_order").withColumnRenamed("supplier_id", "name_match")
    p = probes.select("*", t.vat_key("vat_id", unicode).alias("p_vat"), t.name_key("name", unicode).alias("p_name"), t.country_key("country", unicode).alias("p_country"))
    p = p.join(sized(by_vat), keyed_or_apart("p_vat", "probe_id") == F.col("m_vat"), "left").drop("m_vat")
    p = p.join(sized(by_name), keyed_or_apart("p_name", "probe_id") == F.col("m_name"), "left").drop("m_name")
    exact = (F.when(t.present("p_vat") & F.col("vat_match").isNotNull(), one(F.col("vat_match"), "exact_vat_id"))
             .when(t.present("p_vat"), result(UNMATCHED, method="exact_vat_id", reason="tax number not in the master"))
             .when(t.present("p_name") & F.col("name_match").isNotNull(), one(F.col("name_match"), "exact_normalized_name"))
             .when(~t.present("p_name"), result(UNMATCHED, reason="neither a name nor a tax number")))
    decided = p.withColumn("supplier", exact).drop("vat_match", "name_match")
    if not fuzzy:
        return decided.withColumn("supplier", F.coalesce("supplier", result(UNMATCHED, reason="no exact match"))).drop("p_vat", "p_name", "p_country")
    open_ = decided.where(F.col("supplier").isNull()).select("probe_id", "p_name", "p_country").distinct()
    similar = _similar(open_, keyed, scores)
    out = decided.join(similar, "probe_id", "left")
    return out.withColumn("supplier", F.coalesce("supplier", "similar", result(UNMATCHED, reason="no candidates"))).drop("similar", "p_vat", "p_name", "p_country")


def _similar(probes: DataFrame, keyed: DataFrame, scores: bool = True) -> DataFrame:
    """``probe_id, similar``: the best name and its runner-up.

    Names within :data:`ACCEPT` of each other are found as near texts of a block, so not all pairs of a block meet; see :mod:`.near`.  The runner-up counts down to
    ``MARGIN`` below the best.  Where that is under :data:`ACCEPT`, candidates are joined on the block and a band of lengths: a ratio of r needs lengths of at least
    r / (2 - r), and names aren't compared whose letters or edit distance allow no more.  Names that find none to accept are asked for their two best at any
    score, if ``scores`` are wanted; see :func:`_best_two`.
    """
    blocks = keyed.groupBy("m_country").agg(F.count(F.lit(1)).alias("block_size"))
    whole = keyed.count()
    least = (ACCEPT - MARGIN) / (2 - (ACCEPT - MARGIN))
    known = probes.join(sized(blocks), F.col("p_country") == F.col("m_country"), "left").drop("m_country")
    inside = F.col("block_size").isNotNull() & t.present("p_country")
    known = known.withColumn("block", F.when(inside, F.col("p_country")).otherwise(F.lit("*"))).withColumn(
        "candidates", F.when(inside, F.col("block_size")).otherwise(F.lit(whole)))
    known = checkpointed(known.select("probe_id", "p_name", "block", "candidates"))
    copies = keyed.select("supplier_id", "load_order", "m_name", F.explode(F.array(F.col("m_country"), F.lit("*"))).alias("block"))
    # each spelling once on both sides: probes and rows of the master that share one share its scores
    asked = checkpointed(known.select("block", F.col("p_name").alias("form")).distinct().select("block", "form", F.monotonically_increasing_id().alias("id"), F.lit(1).alias("seq")))
    names = checkpointed(copies.join(sized(asked.select("block").distinct()), "block", "left_semi").groupBy("block", F.col("m_name").alias("form")).agg(
        F.min_by("supplier_id", "load_order").alias("supplier_id"), F.min("load_order").alias("load_order"), F.count(F.lit(1)).alias("times")).select("*", F.monotonically_increasing_id().alias("id"), F.lit(0).alias("seq")))
    found = near.pairs(asked, names, ACCEPT, ("block",), short=True)
    scored = found.select("id", "p_id", "score").join(names.select(F.col("id").alias("p_id"), "supplier_id", "load_order", "times"), "p_id")
    ranked = scored.groupBy("id").agg(F.slice(F.reverse(F.array_sort(F.collect_list(F.struct("score", -F.col("load_order"), "p_id", "supplier_id", "times")))), 1, 2).alias("two"))
    first, second = F.get("two", F.lit(0)), F.get("two", F.lit(1))
    top = checkpointed(ranked.select("id", first["p_id"].alias("p_id"), first["supplier_id"].alias("supplier_id"), first["score"].alias("score"), F.when(first["times"] > 1, first["score"]).otherwise(
        F.coalesce(second["score"], F.lit(0.0))).alias("next")).join(asked.select("id", F.col("form").alias("p_name"), "block"), "id"))
    short = top.where((F.col("next") == 0) & (F.col("score") - ACCEPT < MARGIN + 1e-9))
    size = F.length("p_name")
    reach = short.withColumn("letters", t.letters("p_name")).select("id", "p_id", "block", "p_name", "letters", F.explode(F.sequence(F.ceil(size * least).cast("int"), F.floor(size / least).cast("int"))).alias("size"))
    others = names.select("block", F.col("id").alias("other"), F.col("form").alias("m_name"), F.length("form").alias("size"), t.letters("form").alias("m_letters"))
    may = (F.col("other") != F.col("p_id")) & t.may_share(F.col("letters"), F.col("m_letters"), ACCEPT - MARGIN) & t.may_be_similar("p_name", "m_name", ACCEPT - MARGIN)
    lower = (reach.join(others, ["block", "size"]).where(may).withColumn("score", t.similarity("p_name", "m_name")).where(F.col("score") >= ACCEPT - MARGIN)
             .groupBy("id").agg(F.max("score").alias("lower")))
    top = top.join(lower, "id", "left").select("block", "p_name", "supplier_id", "score", F.greatest("next", F.coalesce("lower", F.lit(0.0))).alias("next"))
    decided = checkpointed(known.join(top, ["block", "p_name"], "left"))
    if not scores:
        low = decided.sparkSession.createDataFrame([], "p_name string, block string, low double, low_next double")
    else:
        low = _best_two(decided.where("score is null").select("p_name", "block").distinct(), keyed)
    all_ = decided.join(low, ["p_name", "block"], "left").select("probe_id", "candidates", "supplier_id", F.coalesce("score", "low").alias("score"), F.coalesce("next", "low_next").alias("next"))
    how = "fuzzy_name_blocked_by_country"
    clear = (F.col("score") >= ACCEPT) & (F.col("score") - F.col("next") >= MARGIN)
    # Fixed value: the words that tell both scores.
    told = F.format_string(f"best=%.3f runner_up=%.3f (threshold={ACCEPT}, margin={MARGIN})", F.bround("score", 3), F.bround("next", 3))
    return all_.select("probe_id", F.when(clear, result(MATCHED, F.col("supplier_id"), how, F.col("score"), F.col("candidates")))
                       .when(F.col("score") >= ACCEPT, result(AMBIGUOUS, None, how, F.col("score"), F.col("candidates"), told))
                       .when(F.col("score").isNotNull(), result(UNMATCHED, None, how, F.col("score"), F.col("candidates"), told))
                       .otherwise(result(UNMATCHED, reason="no candidates in country block")).alias("similar"))


#: Names of a master in a tile, and names asked for in a task.
TILE, ASKED = 4000, 2000


def _best_two(asked: DataFrame, keyed: DataFrame) -> DataFrame:
    """``p_name, block, low, low_next``: for each of ``asked (p_name, block)`` the best and the second best score in its block, whatever they are.

    A block is dealt in tiles of some :data:`TILE` names and a tile's questions in parts, by hash, so that no task holds a whole block or all that ask it;
    the best two of all tiles are the best two of their best.  A name that the master has twice is its own runner-up.
    """
    wanted = checkpointed(asked)
    n = wanted.groupBy("block").agg(F.count(F.lit(1)).alias("n")).select("block", F.ceil(F.col("n") / ASKED).cast("int").alias("parts"))
    copies = keyed.select("m_name", F.explode(F.array(F.col("m_country"), F.lit("*"))).alias("block")).join(sized(n.select("block")), "block", "left_semi")
    names = checkpointed(copies.groupBy("block", "m_name").agg(F.count(F.lit(1)).alias("times")))
    tiles = names.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    dealt = tiles.join(n, "block")
    deal = lambda df, c, count: df.withColumn(count, F.pmod(F.xxhash64(c), F.col(f"{count}s")).cast("int"))
    spread = lambda df, count: df.withColumn(count, F.explode(F.sequence(F.lit(0), F.col(f"{count}s") - 1)))
    master = spread(deal(names.join(dealt, "block"), "m_name", "tile"), "part").select("block", "tile", "part", "m_name", "times")
    probes = spread(deal(wanted.join(dealt, "block"), "p_name", "part"), "tile").select("block", "tile", "part", "p_name")

    def run(own: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        if own.empty or ask.empty:
            return pd.DataFrame({"p_name": [], "block": [], "scores": []})
        tile, times = near.Names(own["m_name"].tolist()), own["times"].tolist()
        rows = [(name, sorted((s for s, i in tile.best(name) for _ in range(min(times[i], 2))), reverse=True)[:2]) for name in ask["p_name"]]
        return pd.DataFrame({"p_name": [r[0] for r in rows], "block": ask["block"].iloc[0], "scores": [r[1] for r in rows]})

    at = ["block", "tile", "part"]
    found = master.groupBy(*at).cogroup(probes.groupBy(*at)).applyInPandas(run, "p_name string, block string, scores array<double>")
    best = found.groupBy("p_name", "block").agg(F.slice(F.reverse(F.array_sort(F.flatten(F.collect_list("scores")))), 1, 2).alias("top"))
    return best.select("p_name", "block", F.get("top", F.lit(0)).alias("low"), F.coalesce(F.get("top", F.lit(1)), F.lit(0.0)).alias("low_next"))


def buyer(probes: DataFrame, units: DataFrame, unicode: bool = True) -> DataFrame:
    """``probes (probe_id, buyer_country, bu_code)`` with ``buyer`` and the codes; ``units`` as :func:`sources.masters.business_units` gives them.

    A code given explicitly decides alone; else the country, if it has one unit.
    """
    by_code = (units.where(t.present("business_unit_code")).groupBy("business_unit_code")
               .agg(F.max_by(F.struct("company_code", "location_code"), "load_order").alias("rest")).withColumnRenamed("business_unit_code", "unit"))
    by_country = unique_or_blank(units.where(t.present("country")), "country", "business_unit_code").withColumnRenamed("country", "unit_country")
    p = probes.withColumn("p_code", F.upper(t.strip(F.coalesce("bu_code", F.lit(""))))).withColumn("p_country", t.country_key("buyer_country", unicode))
    p = p.join(sized(by_country), F.col("p_country") == F.col("unit_country"), "left")
    wanted = F.when(t.present("bu_code"), F.col("p_code")).otherwise(F.col("only"))
    p = p.withColumn("wanted", wanted).join(sized(by_code), F.col("wanted") == F.col("unit"), "left")
    match = (F.when(t.present("bu_code") & F.col("unit").isNotNull(), one(F.col("unit"), "exact_bu_code"))
             .when(t.present("bu_code"), result(UNMATCHED, reason="unit code not in the master"))
             .when(~t.present("p_country"), result(UNMATCHED, reason="no buyer country"))
             .when(F.col("n").isNull(), result(UNMATCHED, reason="no unit in the country"))
             .when(F.col("n") > 1, result(AMBIGUOUS, count=F.col("n"), reason=F.concat(F.lit("several units: "), "listed")))
             .otherwise(one(F.col("unit"), "country_unique_bu")))
    found = F.col("unit").isNotNull()
    code = lambda x: F.when(found, x).otherwise(F.lit(""))
    return p.select(*[probes[c] for c in probes.columns], match.alias("buyer"), code(F.col("rest.company_code")).alias("company_code"),
                    code(F.col("unit")).alias("business_unit_code"), code(F.col("rest.location_code")).alias("location_code"))


def tax(probes: DataFrame, master: DataFrame, unicode: bool = True) -> DataFrame:
    """``probes (probe_id, country, tax_type, rate, tax_code)`` with ``tax``; ``master (code, country, tax_type, rate)``.

    A known code decides; else country and rate, narrowed to the type if the country has
    any tax of it.  Rates meet by bands: a master's rate stands in one, a probe asks its own and both neighbours.
    """
    codes = master.where(t.present("code")).select(F.col("code").alias("known_code")).distinct()
    m = master.select("code", t.country_key("country", unicode).alias("m_country"), F.upper(t.strip(F.coalesce("tax_type", F.lit("")))).alias("m_type"),
                      F.col("rate").cast("double").alias("m_rate"))
    p = probes.withColumn("p_country", t.country_key("country", unicode)).withColumn("p_type", F.upper(t.strip(F.coalesce("tax_type", F.lit("")))))
    p = p.withColumn("p_code", t.strip(F.coalesce("tax_code", F.lit("")))).join(sized(codes), keyed_or_apart("p_code", "probe_id") == F.col("known_code"), "left")
    keys = p.where(F.col("known_code").isNull() & t.present("p_country") & F.col("rate").isNotNull()).select("p_country", "p_type", F.col("rate").alias("p_rate")).distinct()
    types = m.select("m_country", "m_type").distinct().withColumnRenamed("m_country", "t_country").withColumnRenamed("m_type", "t_type")
    narrowed = keys.join(sized(types), (F.col("p_country") == F.col("t_country")) & (F.col("p_type") == F.col("t_type")), "left")
    # rates beyond 1e15 share a band
    band = lambda rate: F.floor(F.least(F.greatest(rate, F.lit(-1e15)), F.lit(1e15)) / (2 * RATE_SLACK))
    asked = narrowed.withColumn("band", F.explode(F.sequence(band(F.col("p_rate")) - 1, band(F.col("p_rate")) + 1)))
    known = m.where(F.col("m_rate").isNotNull()).withColumn("m_band", band(F.col("m_rate")))
    near = asked.join(sized(known), (F.col("p_country") == F.col("m_country")) & (F.col("band") == F.col("m_band")) & (F.abs(F.col("m_rate") - F.col("p_rate")) <= RATE_SLACK)
                      & (F.col("t_type").isNull() | (F.col("m_type") == F.col("t_type"))))
    found = (near.groupBy("p_country", "p_type", "p_rate").agg(F.array_sort(F.collect_set("code")).alias("codes"))
             .select(F.col("p_country").alias("f_country"), F.col("p_type").alias("f_type"), F.col("p_rate").alias("f_rate"), "codes"))
    out = p.join(found, (F.col("p_country") == F.col("f_country")) & (F.col("p_type") == F.col("f_type")) & (F.col("rate") == F.col("f_rate")), "left")
    n = F.size("codes")
    how = F.when(t.present("p_type"), F.lit("country_type_rate")).otherwise(F.lit("country_rate_only"))
    match = (F.when(F.col("known_code").isNotNull(), one(F.col("known_code"), "explicit_tax_code"))
             .when(~t.present("p_country") | F.col("rate").isNull(), result(UNMATCHED, reason="country and rate are needed"))
             .when(F.col("codes").isNull(), result(UNMATCHED, reason="no tax of the country has the rate"))
             .when(n > 1, result(AMBIGUOUS, count=n, reason=F.concat(F.lit("several taxes: "), F.array_join("codes", ","))))
             .otherwise(one(F.get("codes", F.lit(0)), how)))
    return out.select(*[probes[c] for c in probes.columns], match.alias("tax"))


def payment_term(probes: DataFrame, aliases: DataFrame, days: DataFrame, unicode: bool = True) -> DataFrame:
    """``probes (probe_id, term_text, invoice_date, due_date)`` with ``term``; ``aliases (alias, payment_term_id, load_order)``, ``days (days, payment_term_id)``.

    Known wording decides; else the days between two valid dates, if one term has them.
    """
    by_alias = last_wins(aliases.select(t.term_key("alias", unicode).alias("m_alias"), "payment_term_id", "load_order"), "m_alias", "payment_term_id", "load_order")
    by_days = unique_or_blank(days, "days", "payment_term_id").withColumnRenamed("days", "m_days")
    valid = lambda c: F.when(F.col(c).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col(c).try_cast("date"))
    p = probes.withColumn("p_term", t.term_key("term_text", unicode)).withColumn("p_days", F.datediff(valid("due_date"), valid("invoice_date")))
    p = p.join(sized(by_alias), keyed_or_apart("p_term", "probe_id") == F.col("m_alias"), "left").join(sized(by_days), F.col("p_days") == F.col("m_days"), "left")
    match = (F.when(t.present("p_term") & F.col("payment_term_id").isNotNull(), one(F.col("payment_term_id"), "exact_text_alias"))
             .when(F.col("p_days").isNull(), result(UNMATCHED, reason="no known wording, nor two valid dates"))
             .when(F.col("p_days") < 0, result(UNMATCHED, reason="due before the invoice"))
             .when(F.col("n").isNull(), result(UNMATCHED, reason="no term has these days"))
             .when(F.col("n") > 1, result(AMBIGUOUS, count=F.col("n"), reason=F.concat(F.lit("several terms: "), "listed")))
             .otherwise(one(F.col("only"), "unique_day_count")))
    return p.select(*[probes[c] for c in probes.columns], match.alias("term"))


def purchase_order(probes: DataFrame, master: DataFrame, unicode: bool = True) -> DataFrame:
    """``probes (probe_id, po_number, supplier_id, currency)`` with ``po``; ``master (po_id, po_number, supplier_id, currency, load_order)``.

    Exact numbers only.  A differing supplier or currency is remarked on, not corrected.
    """
    m = (master.select(t.order_key("po_number", unicode).alias("m_number"), "load_order", F.struct("po_id", "supplier_id", "currency").alias("order"))
         .where(t.present("m_number")).groupBy("m_number").agg(F.max_by("order", "load_order").alias("order")))
    p = probes.withColumn("p_number", t.order_key("po_number", unicode)).join(sized(m), keyed_or_apart("p_number", "probe_id") == F.col("m_number"), "left")
    differs = lambda mine, theirs: t.present(mine) & t.present(theirs) & (mine != theirs)
    remarks = F.concat_ws("; ", F.when(differs(F.col("supplier_id"), F.col("order.supplier_id")), F.lit("another supplier in the master")),
                          F.when(differs(F.col("currency"), F.col("order.currency")), F.lit("another currency in the master")))
    match = (F.when(~t.present("p_number"), result(UNMATCHED, reason="no order number"))
             .when(F.col("order").isNull(), result(UNMATCHED, reason="order number not in the master"))
             .otherwise(result(MATCHED, F.col("order.po_id"), "exact_po_number", 1.0, 1, remarks)))
    return p.select(*[probes[c] for c in probes.columns], match.alias("po"))


def exists(probes: DataFrame, column: str, master: DataFrame, key: str, name: str) -> DataFrame:
    """``probes`` with boolean ``name``: whether the identifier is in the master; blank isn't."""
    known = master.where(t.present(key)).select(F.col(key).alias("__known")).distinct()
    by = next((c for c in ("seq", "probe_id") if c in probes.columns), column)
    joined = probes.join(sized(known), keyed_or_apart(column, by) == F.col("__known"), "left")
    return joined.select(*[probes[c] for c in probes.columns], F.col("__known").isNotNull().alias(name))
