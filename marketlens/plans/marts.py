"""Star schema: dimensions with surrogate keys, order and item facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.scalars import surrogate_key
from marketlens.operators.dedupe import latest_by_key
from marketlens.operators.joins import left_lookup


def dim_customers(stg_customers: DataFrame) -> DataFrame:
    d = latest_by_key(stg_customers, ["customer_id"], ["_loaded_at"])
    return d.select(
        surrogate_key("customer_id").alias("customer_key"),
        "customer_id", "name", "email", "region", "tier", "created_at", "_loaded_at",
        F.lit(True).alias("is_current"),
    )


def dim_products(products: DataFrame) -> DataFrame:
    """Active products, one row per row of ``products``: pass the latest load per product, or every load as loaded."""
    return products.filter(F.col("is_active")).select(
        surrogate_key("product_id").alias("product_key"),
        "product_id", "name", "category", "unit_price", "is_active", "_loaded_at",
    )


FACT_ORDERS = ("order_id", "customer_id", "customer_key", "region", "order_date", "order_hour", "status", "currency",
               "promo_code", "has_promo", "total_amount", "continent", "tier")


def fact_orders(orders: DataFrame) -> DataFrame:
    """The order fact from ``intermediate.orders_with_customer``, which has the customer's key already."""
    return orders.withColumnRenamed("customer_tier", "tier").select(surrogate_key("order_id").alias("order_key"), *FACT_ORDERS)


def fact_orders_as_loaded(orders_enriched: DataFrame, dim_cust: DataFrame) -> DataFrame:
    """The order fact with its own lookup of the current customer, for orders joined to every customer load."""
    return fact_orders(left_lookup(orders_enriched, dim_cust, "customer_id", ["customer_key"]))


FACT_ITEMS = ("item_id", "order_id", "order_key", "product_id", "product_key", "quantity", "unit_price", "amount",
              "revenue_contribution", "product_name", "category")


def fact_order_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """The item fact from ``intermediate.items_with_product``, which has the product's key already.

    ``orders`` are the order headers (order_id). As in the source model a header that landed n times gives each of its lines n
    times: ``check_unique`` on the item key reports them. Only the headers' ids are shuffled; their key is made after the join.
    """
    o = orders.filter(F.col("order_id").isNotNull()).select(F.col("order_id").alias("_header"))
    key = F.when(F.col("_header").isNotNull(), surrogate_key("order_id"))
    return items.join(o, F.col("order_id") == F.col("_header"), "left").withColumn("order_key", key).select(
        surrogate_key("item_id").alias("item_key"), *FACT_ITEMS)


def fact_order_items_as_loaded(items_enriched: DataFrame, orders: DataFrame, dim_prod: DataFrame) -> DataFrame:
    """The item fact joined to every active product load, fan-out included."""
    j = items_enriched.join(dim_prod.select("product_id", "product_key"), "product_id", "left")
    return fact_order_items(j, orders)
