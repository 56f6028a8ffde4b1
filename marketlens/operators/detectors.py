"""Defect detectors for order headers and lines, and a one-pass DQ scorecard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.constants import DQ_RATES, RECONCILIATION_TOLERANCE, REGION_CURRENCY
from marketlens.functions.scalars import lookup



def _tol():
    return F.lit(RECONCILIATION_TOLERANCE).cast("decimal(18,2)")


def expected_currency(region="region"):
    return lookup(region, REGION_CURRENCY)


def duplicate_orders(orders: DataFrame, key: str = "order_id") -> DataFrame:
    """Every row of a key that occurs more than once, with its copy count.

    Counting is a grouped aggregate (combined map-side); the duplicated keys
    are then joined back to report all copies, which may differ (adaptive
    execution splits a key with very many copies).
    """
    from marketlens.operators.joins import attach_by_key
    dup = (orders.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_copies"))
           .filter(F.col("n_copies") > 1))
    return attach_by_key(orders, dup, [key], ["n_copies"], how="inner")


def null_customer(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("customer_id").isNull())


def negative_revenue(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("total_amount") < 0)


def line_totals(items: DataFrame, key: str = "order_id", amount: str = "amount") -> DataFrame:
    return items.groupBy(key).agg(F.sum(amount).alias("items_total"), F.count(F.lit(1)).alias("n_lines"))


def revenue_mismatch(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Non-negative headers whose total differs from the sum of their lines by more than 0.01.

    Lines are pre-aggregated per order before the join, so duplicated headers
    do not multiply line sums. ``header_to_lines`` is the inflation ratio.
    """
    j = orders.filter(F.col("total_amount") >= 0).join(line_totals(items), "order_id")
    return j.filter(F.abs(F.col("total_amount") - F.col("items_total")) > _tol()).withColumn(
        "header_to_lines", F.try_divide(F.col("total_amount").cast("double"), F.col("items_total").cast("double")))


def orphan_orders(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders without any line (anti join against the distinct ordered keys)."""
    from marketlens.operators.checks import orphans
    return orphans(orders, items, "order_id")


def invalid_currency(orders: DataFrame) -> DataFrame:
    """Rows whose currency is not the region's trading currency (fixed map, evaluated inline)."""
    exp = expected_currency()
    return orders.filter(exp.isNull() | (F.col("currency").isNull()) | (F.col("currency") != exp)).withColumn(
        "expected_currency", exp)


def order_level_flags(orders: DataFrame, items: DataFrame) -> DataFrame:
    """One row per order id with every defect flag (both sides grouped by order id, then joined)."""
    per_order = orders.filter(F.col("order_id").isNotNull()).groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_copies"),
        F.max(F.col("customer_id").isNull()).alias("null_customer"),
        F.min("total_amount").alias("min_total"),
        F.min(F.when(F.col("total_amount") >= 0, F.col("total_amount"))).alias("least"),
        F.max(F.when(F.col("total_amount") >= 0, F.col("total_amount"))).alias("most"),
        F.max(expected_currency().isNull() | F.col("currency").isNull()
              | (F.col("currency") != expected_currency())).alias("bad_currency"),
    )
    j = per_order.join(line_totals(items), "order_id", "left")
    return j.select(
        "order_id",
        (F.col("n_copies") > 1).alias("duplicate"),
        "null_customer",
        (F.col("min_total") < 0).alias("negative"),
        # some copy with a total >= 0 differs from the lines: the least or the greatest does
        F.coalesce((F.abs(F.col("most") - F.col("items_total")) > _tol())
                   | (F.abs(F.col("least") - F.col("items_total")) > _tol()), F.lit(False)).alias("mismatch"),
        F.col("items_total").isNull().alias("orphan"),
        "bad_currency",
    )


SCORECARD_ISSUES = [
    ("duplicate_order_rate", "duplicate"),
    ("null_customer_rate", "null_customer"),
    ("negative_revenue_rate", "negative"),
    ("revenue_mismatch_rate", "mismatch"),
    ("orphaned_items_rate", "orphan"),
    ("invalid_currency_rate", "bad_currency"),
]


def dq_scorecard(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Issue -> affected orders, observed rate (NULL without orders) and configured rate, from one aggregation pass."""
    f = order_level_flags(orders, items)
    agg = f.agg(F.count(F.lit(1)).alias("n_orders"),
                *[F.count_if(F.col(flag)).alias(f"_{flag}") for _, flag in SCORECARD_ISSUES])
    stack = "stack({n}, {rows}) as (issue, n_affected, configured_rate)".format(
        n=len(SCORECARD_ISSUES),
        rows=", ".join(f"'{issue}', _{flag}, CAST({DQ_RATES[issue]!r} AS DOUBLE)" for issue, flag in SCORECARD_ISSUES))
    return agg.select(F.expr(stack), "n_orders").select(
        "issue", "n_affected", "n_orders",
        F.try_divide("n_affected", "n_orders").alias("observed_rate"), "configured_rate")
