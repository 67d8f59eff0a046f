"""The gross that the books will carry, recomputed from a payable's parts, as one column expression.

Arithmetic is in doubles from left to right in list order; money rounds half up on
the shortest decimal form of the double, which is what Spark's ``round`` does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import let, strip
from ..functions.values import DIGITS, to_double

CHARGES = ("freight_charges", "insurance_charges", "extra_charges", "excise_duties")


def amount(value: Column) -> Column:
    """A plain number's value; a leading currency symbol and percent signs don't count, anything unreadable is zero."""
    text = F.regexp_replace(F.replace(F.coalesce(value, F.lit("")), F.lit("%"), F.lit("")), r"(?U)^[€$£¥₹\s]+|\s+$", "")
    return F.when(F.coalesce(value, F.lit("")) == "", F.lit(0.0)).when(value.rlike(DIGITS), value.try_cast("double")).otherwise(F.coalesce(to_double(text), F.lit(0.0)))


def money(value: Column) -> Column:
    return F.round(value, 2)


def line_base(line: Column) -> Column:
    """Net of one line: quantity by price, less its discount; a percentage outranks an amount."""
    parts = F.struct(amount(line["quantity"]).alias("q"), amount(line["unit_price"]).alias("p"), F.abs(amount(line["discount_percentage"])).alias("percent"),
                     F.abs(amount(line["discount"])).alias("off"))

    def net(x: Column) -> Column:
        whole = x["q"] * x["p"]
        return (F.when(x["percent"] > 0, money(whole - whole * x["percent"] / 100.0))
                .when((x["off"] > 0) & (x["q"] != 0), money((x["p"] - x["off"] / F.abs(x["q"])) * x["q"]))
                .otherwise(money(whole)))

    return let(parts, net)


def tax_amount(tax: Column, base: Column) -> Column:
    """A tax's stated amount, or one derived from a positive rate on the base."""
    parts = F.struct(amount(tax["tax_amount"]).alias("stated"), amount(tax["tax_rate"]).alias("rate"), base.alias("base"))
    return let(parts, lambda x: F.when((x["stated"] == 0) & (x["rate"] > 0), money(x["base"] * x["rate"] / 100.0)).otherwise(x["stated"]))


def total_taxes(taxes: Column, base: Column) -> Column:
    return F.aggregate(F.coalesce(taxes, F.array()), F.lit(0.0), lambda sum_, tax: sum_ + F.coalesce(tax_amount(tax, base), F.lit(0.0)))


def line_taxes(line: Column, base: Column) -> Column:
    """Taxes of one line; its own rate and amount count only if it has no list of taxes."""
    listed = F.size(F.coalesce(line["taxes"], F.array())) > 0
    return F.when(listed, total_taxes(line["taxes"], base)).otherwise(tax_amount(line, base))


def gross(payable: Column) -> Column:
    """The recomputed gross of a payable struct."""
    lines = F.coalesce(payable["line_items"], F.array())
    zero = F.struct(F.lit(0.0).alias("net"), F.lit(0.0).alias("tax"))
    each = F.transform(lines, lambda line: let(line_base(line), lambda base: F.struct(base.alias("net"), line_taxes(line, base).alias("tax"))))
    sums = F.aggregate(each, zero, lambda sum_, x: F.struct((sum_["net"] + x["net"]).alias("net"), (sum_["tax"] + x["tax"]).alias("tax")))

    def whole(total: Column) -> Column:
        discount = F.abs(amount(payable["discount_amount"]))
        charges = amount(payable[CHARGES[0]])
        for name in CHARGES[1:]:
            charges = charges + amount(payable[name])
        header = total_taxes(payable["taxes"], total["net"] - discount)
        return money(total["net"] - discount + total["tax"] + header + charges)

    return let(sums, whole)


def as_decimal(value: Column) -> Column:
    return value.try_cast("decimal(38,20)")


def reconciles(recomputed: Column, stated: Column) -> Column:
    """Exact equality with the stated gross; false where that isn't a number."""
    exact = as_decimal(recomputed.cast("string")) == as_decimal(strip(F.coalesce(stated, F.lit(""))))
    return F.coalesce(exact, F.lit(False))
