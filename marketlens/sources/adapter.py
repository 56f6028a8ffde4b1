"""Adapter: driver test tables -> the five raw retail tables.

The driver ships TPC-H-shaped tables; the library works on retail raw tables
(orders, order items, customers, products, marketing events). This module maps
one onto the other with deterministic column rules so an independent SQL
engine can derive the same rows. Defects of the kinds the source business
pipeline lands (duplicate headers, null customer, negative and inflated
totals, invalid currency) are placed by key arithmetic, so
the quality operators have real findings to detect.

Mapping rules (k = order key):
  region         REGIONS[nation_key % 6]
  created_at     2024-01-01 + (k % 30) days, hour (k div 30) % 24, minute (k div 720) % 60
  status         F -> delivered, P -> returned, O -> pending/confirmed/shipped by k % 3
  promo_code     'PROMO<k % 10>' for '1-URGENT' priority, else NULL
  item amount    extended price; unit price = floor(amount cents / quantity) / 100
  header total   sum of the order's line amounts (its own total price when it has no lines)
  defects        duplicate k % 50 = 0, null customer k % 100 = 7, negative total k % 200 = 3,
                 total x1.15 k % 100 = 11, currency 'XXX' k % 300 = 13 (orders without lines are in the data)
  customers      one load on 2024-01-01, a re-load of c_custkey % 5 = 0 on 2024-01-15
  products       one load on 2024-01-01, a re-load of p_partkey % 4 = 0 on 2024-01-15, which renames them and
                 retires p_partkey % 40 = 8
  events         view -> IMPRESSION, others upper-cased
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.constants import REGION_CURRENCY, REGIONS
from marketlens.functions.scalars import hour_floor, lookup
from marketlens.schemas import landing_with_partitions

ADAPTER_VERSION = "3"
FIRST_LOAD = "2024-01-01 00:00:00"
RELOAD = "2024-01-15 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def region_of(nation_key) -> Column:
    return F.try_element_at(F.array(*[F.lit(r) for r in REGIONS]), (F.col(nation_key) % 6 + 1).cast("int"))


def _ntz(s: str) -> Column:
    return F.lit(s).cast("timestamp_ntz")


def _hour_after(ts: Column) -> Column:
    return hour_floor(ts) + F.expr("INTERVAL 1 HOUR")


def _partition_path(region: Column, ts: Column) -> Column:
    return F.concat(F.lit("region="), region, F.lit("/date="), F.date_format(ts, "yyyy-MM-dd"),
                    F.lit("/hour="), F.date_format(ts, "HH"))


def order_created_at(k: Column) -> Column:
    return F.make_timestamp_ntz(F.lit(2024), F.lit(1), (F.lit(1) + k % 30).cast("int"),
                                (F.floor(k / 30) % 24).cast("int"), (F.floor(k / 720) % 60).cast("int"),
                                F.lit(0))


def _customer_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")


def raw_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer load history: every customer on the first load, a re-load of some later.

    One scan: each customer row expands into its load rows with ``explode``.
    """
    c = table(spark, sf_dir, "customer")
    region = region_of("c_nationkey")
    bal = F.col("c_acctbal")
    first = F.struct(
        F.when(bal >= 8000, "Gold").when(bal >= 4000, "Silver").otherwise("Bronze").alias("tier"),
        _ntz(FIRST_LOAD).alias("_loaded_at"), F.lit("2024-01-01").alias("load_date"))
    reload = F.struct(
        F.when(bal >= 6000, "GOLD").when(bal >= 2000, "SILVER").otherwise("BRONZE").alias("tier"),
        _ntz(RELOAD).alias("_loaded_at"), F.lit("2024-01-15").alias("load_date"))
    loads = F.when(F.col("c_custkey") % 5 == 0, F.array(first, reload)).otherwise(F.array(first))
    e = c.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("customer"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
        region.alias("region"),
        F.date_add(F.lit("2023-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int"))
        .cast("timestamp_ntz").alias("created_at"),
        F.explode(loads).alias("load"),
    )
    return e.select(
        "customer_id", "name", "email", "region", F.col("load.tier").alias("tier"), "created_at",
        F.col("load._loaded_at").alias("_loaded_at"),
        F.concat(F.lit("region="), F.col("region"), F.lit("/date="), F.col("load.load_date"), F.lit("/hour=00"))
        .alias("_source_file"),
    )


def raw_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product load history: every product on the first load, a re-load of some later."""
    k = F.col("p_partkey")
    first = F.struct(F.col("p_name").alias("name"), (k % 10 != 0).alias("is_active"),
                     _ntz(FIRST_LOAD).alias("_loaded_at"), F.lit("2024-01-01").alias("load_date"))
    reload = F.struct(F.concat(F.col("p_name"), F.lit(" v2")).alias("name"), ((k % 10 != 0) & (k % 40 != 8)).alias("is_active"),
                      _ntz(RELOAD).alias("_loaded_at"), F.lit("2024-01-15").alias("load_date"))
    p = table(spark, sf_dir, "part").select(
        k.cast("string").alias("product_id"), F.col("p_type").alias("category"), F.col("p_retailprice").alias("unit_price"),
        F.explode(F.when(k % 4 == 0, F.array(first, reload)).otherwise(F.array(first))).alias("load"))
    return p.select("product_id", "load.name", "category", "unit_price", "load.is_active", "load._loaded_at",
                    F.concat(F.lit("date="), F.col("load.load_date"), F.lit("/hour=00")).alias("_source_file"))


def _line_cents(li: DataFrame) -> DataFrame:
    return li.withColumn("amount_cents", F.round(F.col("l_extendedprice") * 100).cast("bigint"))


def landing_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order headers as they land (no audit columns), defects included."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                               "o_totalprice", "o_orderpriority")
    # header total = sum of line cents, pre-aggregated per order before the join
    lines = (_line_cents(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice"))
             .groupBy("l_orderkey").agg(F.sum("amount_cents").alias("line_cents")))
    cust = _customer_nation(spark, sf_dir)
    k = F.col("o_orderkey")
    j = (o.join(cust, o.o_custkey == cust.c_custkey, "left")
         .join(lines, o.o_orderkey == lines.l_orderkey, "left"))
    region = region_of("c_nationkey")
    cents = F.coalesce(F.col("line_cents"), F.round(F.col("o_totalprice") * 100).cast("bigint"))
    created = order_created_at(k)
    out = j.select(
        k.cast("string").alias("order_id"),
        F.when(k % 100 == 7, F.lit(None).cast("string")).otherwise(F.col("o_custkey").cast("string"))
        .alias("customer_id"),
        region.alias("region"),
        created.alias("created_at"),
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "P", "returned")
        .when(k % 3 == 0, "pending").when(k % 3 == 1, "confirmed").otherwise("shipped").alias("status"),
        F.when(k % 300 == 13, F.lit("XXX")).otherwise(lookup(region, REGION_CURRENCY)).alias("currency"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("PROMO"), (k % 10).cast("string")))
        .alias("promo_code"),
        F.when(k % 200 == 3, -F.abs(cents) / 100.0)
        .when(k % 100 == 11, F.floor((cents * 115 + 50) / 100) / 100.0)
        .otherwise(cents / 100.0).alias("total_amount"),
        # duplicated headers land twice, verbatim: one scan, expanded in place
        F.explode(F.when(k % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
    )
    return out.drop("_copy")


def raw_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = landing_orders(spark, sf_dir)
    return o.select(
        "*",
        _hour_after(F.col("created_at")).alias("_loaded_at"),
        _partition_path(F.col("region"), F.col("created_at")).alias("_source_file"),
    )


def raw_order_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                                 "l_quantity", "l_extendedprice")
    li = _line_cents(li)
    k = F.col("l_orderkey")
    return li.select(
        F.concat_ws("-", k.cast("string"), F.col("l_linenumber").cast("string"),
                    F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("item_id"),
        k.cast("string").alias("order_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.floor(F.col("amount_cents") / F.col("l_quantity").cast("bigint")) / 100.0).alias("unit_price"),
        (F.col("amount_cents") / 100.0).alias("amount"),
        _hour_after(order_created_at(k)).alias("_loaded_at"),
    )


def landing_entity(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """Rows of an entity as they land: its declared columns and the region, date and hour of its file.

    Orders and events land in the hour in which they were made, the others in the hour of their load; lines and
    products, which have no region, in the folder of the first region.
    """
    raw = {"orders": landing_orders, "order_items": raw_order_item, "customers": raw_customer, "products": raw_product,
           "marketing_events": raw_marketing_event}[entity](spark, sf_dir)
    if "region" not in raw.columns:
        raw = raw.withColumn("region", F.lit(REGIONS[0]))
    at = F.col("created_at" if entity in ("orders", "marketing_events") else "_loaded_at")
    raw = raw.withColumns({"date": F.date_format(at, "yyyy-MM-dd"), "hour": F.date_format(at, "HH")})
    return raw.select(*landing_with_partitions(entity).fieldNames())


def raw_marketing_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    cust = _customer_nation(spark, sf_dir)
    j = e.join(cust, e.user_id == cust.c_custkey, "left")
    created = F.date_trunc("second", "ts").cast("timestamp_ntz")
    region = region_of("c_nationkey")
    return j.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        region.alias("region"),
        F.when(F.col("event_type") == "view", "IMPRESSION").otherwise(F.upper("event_type")).alias("event_type"),
        created.alias("created_at"),
        _hour_after(F.col("ts")).alias("_loaded_at"),
        _partition_path(region, F.col("ts")).alias("_source_file"),
    )


@dataclass
class RawTables:
    """Lazy handles on the five raw tables."""

    orders: DataFrame
    order_items: DataFrame
    customers: DataFrame
    products: DataFrame
    marketing_events: DataFrame


RAW_ENTITIES = ("orders", "order_items", "customers", "products", "marketing_events")


def read_raw_tables(spark: SparkSession, base: str) -> RawTables:
    """The five raw tables as written by the ingest, ``{base}/{entity}``: published tables, or plain Parquet (partitioned or not).

    This is how the model graph runs on real loads instead of the test adapter.
    """
    from marketlens.sources.publish import read_table

    base = base.rstrip("/")
    return RawTables(**{e: read_table(spark, f"{base}/{e}") for e in RAW_ENTITIES})


def write_raw_tables(raw: RawTables, base: str) -> None:
    """Write raw tables to ``{base}/{entity}`` (full overwrite), e.g. to snapshot a test set."""
    base = base.rstrip("/")
    for e in RAW_ENTITIES:
        getattr(raw, e).write.mode("overwrite").parquet(f"{base}/{e}")


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    return RawTables(
        orders=raw_order(spark, sf_dir),
        order_items=raw_order_item(spark, sf_dir),
        customers=raw_customer(spark, sf_dir),
        products=raw_product(spark, sf_dir),
        marketing_events=raw_marketing_event(spark, sf_dir),
    )
