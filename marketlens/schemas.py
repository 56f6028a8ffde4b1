"""Declared schemas per entity (landing types and staged types)."""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DateType, DoubleType, IntegerType, StringType,
                               StructField, StructType, TimestampNTZType)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# landing files (what the hourly generator writes), one per entity
LANDING = {
    "orders": _s(("order_id", StringType()), ("customer_id", StringType()), ("region", StringType()),
                 ("created_at", TimestampNTZType()), ("status", StringType()), ("currency", StringType()),
                 ("promo_code", StringType()), ("total_amount", DoubleType())),
    "order_items": _s(("item_id", StringType()), ("order_id", StringType()), ("product_id", StringType()),
                      ("quantity", IntegerType()), ("unit_price", DoubleType()), ("amount", DoubleType())),
    "customers": _s(("customer_id", StringType()), ("name", StringType()), ("email", StringType()),
                    ("region", StringType()), ("tier", StringType()), ("created_at", TimestampNTZType())),
    "products": _s(("product_id", StringType()), ("name", StringType()), ("category", StringType()),
                   ("unit_price", DoubleType()), ("is_active", BooleanType())),
    "marketing_events": _s(("event_id", StringType()), ("customer_id", StringType()), ("region", StringType()),
                           ("event_type", StringType()), ("created_at", TimestampNTZType())),
}

# Hive-style partition columns of the landing layout, kept as strings
PARTITION_COLUMNS = ("region", "date", "hour")
PARTITION_SCHEMA = _s(("date", StringType()), ("hour", StringType()))

LOAD_AUDIT = _s(("dag_run_id", StringType()), ("load_date", DateType()), ("region", StringType()),
                ("entity", StringType()), ("s3_expected_rows", IntegerType()), ("sf_actual_rows", IntegerType()))


def landing_with_partitions(entity: str) -> StructType:
    """Landing schema plus the path partition columns (region is already a data column where present)."""
    s = LANDING[entity]
    names = set(s.fieldNames())
    extra = [f for f in (StructField("region", StringType(), True), *PARTITION_SCHEMA.fields)
             if f.name not in names]
    return StructType(list(s.fields) + extra)
