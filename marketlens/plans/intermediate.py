"""Intermediate models: enrichment joins and the regional daily aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.scalars import safe_divide, surrogate_key
from marketlens.operators.joins import left_lookup
from marketlens.operators.windows import with_share_of_group


ORDERS_ENRICHED = ("order_id", "customer_id", "region", "created_at", "order_date", "order_hour", "status", "currency",
                   "promo_code", "total_amount", "has_promo", "_loaded_at", "_source_file", "customer_email",
                   "customer_tier", "continent", "timezone_offset")
ITEMS_ENRICHED = ("item_id", "order_id", "product_id", "quantity", "unit_price", "amount", "_loaded_at", "product_name",
                  "category", "revenue_contribution")


def orders_with_customer(orders: DataFrame, customers: DataFrame, regions: DataFrame) -> DataFrame:
    """Orders + customer email/tier/key + region continent/offset (left joins): one customer lookup for
    the enriched orders and the order fact.

    ``customers`` is joined as given: pass deduplicated customers to avoid the
    fan-out an append-only customer history would cause. ``regions`` is the
    region seed; the planner broadcasts it while it is small.
    """
    c = customers.select("customer_id", F.col("email").alias("customer_email"), F.col("tier").alias("customer_tier"),
                         surrogate_key("customer_id").alias("customer_key"))
    o = left_lookup(orders, c, "customer_id", ["customer_email", "customer_tier", "customer_key"])
    o = o.join(regions.select("region", "continent", "timezone_offset"), "region", "left")
    return o.withColumns({"order_date": F.to_date("created_at"), "order_hour": F.hour("created_at")}).select(
        *ORDERS_ENRICHED, "customer_key")


def int_orders_enriched(orders: DataFrame, customers: DataFrame, regions: DataFrame) -> DataFrame:
    return orders_with_customer(orders, customers, regions).select(*ORDERS_ENRICHED)


def items_with_product(items: DataFrame, products: DataFrame, small_orders: bool = False) -> DataFrame:
    """Items + product name/category/key of active products, and each line's share of its order's amount.

    One product lookup for the enriched items and the item fact. The share is evaluated after it (as in the source
    model), so duplicate product rows would dilute it; pass deduplicated products. The key, 32 characters that no shuffle
    compresses, is made of the line's own product id after the shuffles; a flag goes through them in its place.
    ``small_orders``: see ``with_share_of_group``.
    """
    active = F.col("is_active") if "is_active" in products.columns else F.lit(None)
    p = products.select("product_id", F.col("name").alias("product_name"), "category", active.cast("boolean").alias("_active"))
    j = left_lookup(items, p, "product_id", ["product_name", "category", "_active"])
    # staging guarantees non-null order ids, so the share join is a plain equi-join
    return with_share_of_group(j, "amount", ["order_id"], "revenue_contribution", keys_nullable=False, small_groups=small_orders).select(
        *ITEMS_ENRICHED, F.when(F.col("_active"), surrogate_key("product_id")).alias("product_key"))


def int_order_items_enriched(items: DataFrame, products: DataFrame) -> DataFrame:
    return items_with_product(items, products).select(*ITEMS_ENRICHED)


def orders_daily_agg(orders_enriched: DataFrame) -> DataFrame:
    return orders_enriched.groupBy("region", "order_date").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("total_amount").alias("gross_revenue"),
        F.avg("total_amount").alias("avg_order_value"),
        F.count_if(F.col("status") == "returned").alias("returned_orders"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )


def marketing_daily_agg(events: DataFrame) -> DataFrame:
    """Pivot of event types into columns via conditional counts (one pass, no pivot discovery job)."""
    return events.groupBy("region", "event_date").agg(
        F.count_if(F.col("event_type") == "impression").alias("impressions"),
        F.count_if(F.col("event_type") == "click").alias("clicks"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
    )


def int_regional_daily(orders_enriched: DataFrame, events: DataFrame) -> DataFrame:
    """Orders and marketing pre-aggregated per (region, day), then left-joined.

    Both inputs are reduced to one row per region-day before the join, so the
    join is between two small aggregates; marketing-only days are dropped.
    """
    o = orders_daily_agg(orders_enriched)
    m = marketing_daily_agg(events).withColumnRenamed("region", "m_region")
    j = o.join(m, (o.region == m.m_region) & (o.order_date == m.event_date), "left")
    return j.select(
        "region", "order_date", "total_orders", "gross_revenue", "avg_order_value", "unique_customers",
        "returned_orders",
        safe_divide("returned_orders", "total_orders").alias("return_rate"),
        F.coalesce("impressions", F.lit(0)).alias("impressions"),
        F.coalesce("clicks", F.lit(0)).alias("clicks"),
        F.coalesce("purchases", F.lit(0)).alias("purchases"),
    )
