"""Staging models: key filters, explicit types, light normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def whole(c: Column) -> Column:
    """An integer, fractions rounded half away from zero as the source's warehouse casts them."""
    return F.round(c.cast("decimal(38,10)"), 0).cast("int")


def stg_orders(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("order_id").isNotNull()).select(
        "order_id", "customer_id", "region",
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        "status", "currency", "promo_code",
        F.col("total_amount").cast(MONEY).alias("total_amount"),
        F.col("promo_code").isNotNull().alias("has_promo"),
        "_loaded_at", "_source_file",
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("item_id").isNotNull() & F.col("order_id").isNotNull()).select(
        "item_id", "order_id", "product_id",
        whole(F.col("quantity")).alias("quantity"),
        F.col("unit_price").cast(MONEY).alias("unit_price"),
        F.col("amount").cast(MONEY).alias("amount"),
        "_loaded_at",
    )


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("customer_id").isNotNull()).select(
        "customer_id", "name", "email",
        F.lower("region").alias("region"),
        F.lower("tier").alias("tier"),
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        "_loaded_at",
    )


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("product_id").isNotNull()).select(
        "product_id", "name", "category",
        F.col("unit_price").cast(MONEY).alias("unit_price"),
        F.col("is_active").cast("boolean").alias("is_active"),
        "_loaded_at",
    )


def stg_marketing_events(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("event_id").isNotNull()).select(
        "event_id", "customer_id", "region",
        F.lower("event_type").alias("event_type"),
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        F.to_date("created_at").alias("event_date"),
        "_loaded_at",
    )
