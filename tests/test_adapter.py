"""The adapter places each defect kind exactly where its key rule says (like the source generator tests)."""

from pyspark.sql import functions as F

from marketlens.sources import adapter


def test_defect_counts_follow_key_rules(spark, smoke_dir):
    o = adapter.table(spark, smoke_dir, "orders")
    k = F.col("o_orderkey")
    expect = o.agg(F.count_if(k % 50 == 0).alias("dup"), F.count_if(k % 100 == 7).alias("null"),
                   F.count_if(k % 200 == 3).alias("neg"), F.count_if(k % 300 == 13).alias("ccy"),
                   F.count(F.lit(1)).alias("n")).collect()[0]
    raw = adapter.raw_order(spark, smoke_dir)
    got = raw.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("order_id").alias("ids"),
                  F.count_if(F.col("customer_id").isNull()).alias("null"),
                  F.count_if(F.col("total_amount") < 0).alias("neg"),
                  F.count_if(F.col("currency") == "XXX").alias("ccy")).collect()[0]
    assert got.rows == expect.n + expect.dup and got.ids == expect.n
    assert (got.null, got.neg, got.ccy) == (expect.null, expect.neg, expect.ccy)


def test_all_rows_reach_the_raw_tables(spark, smoke_dir):
    n = lambda t: adapter.table(spark, smoke_dir, t).count()
    orders = adapter.raw_order(spark, smoke_dir).select("order_id").distinct()
    items = adapter.raw_order_item(spark, smoke_dir)
    assert items.join(orders, "order_id", "left_anti").count() == 0
    assert items.count() == n("lineitem") and adapter.raw_marketing_event(spark, smoke_dir).count() == n("events")
    assert adapter.raw_product(spark, smoke_dir).select("product_id").distinct().count() == n("part")


def test_a_second_product_load_does_not_multiply_lines(spark, smoke_dir):
    from marketlens.plans.warehouse import Models
    from marketlens.sources.landing import seed_regions
    raw = adapter.raw_tables(spark, smoke_dir)
    once = Models(adapter.RawTables(raw.orders, raw.order_items, raw.customers, raw.products.filter("_loaded_at < '2024-01-10'"),
                                    raw.marketing_events), seed_regions(spark))
    assert once.fact_order_items.count() == Models(raw, seed_regions(spark)).fact_order_items.count()
    assert Models(raw, seed_regions(spark)).dim_products.groupBy("product_id").count().filter("count > 1").count() == 0


def test_adapter_is_deterministic(spark, smoke_dir):
    a = adapter.raw_order(spark, smoke_dir).orderBy("order_id", "total_amount").collect()
    b = adapter.raw_order(spark, smoke_dir).repartition(5).orderBy("order_id", "total_amount").collect()
    assert a == b


def test_every_region_has_orders(spark, smoke_dir):
    regions = {r.region for r in adapter.raw_order(spark, smoke_dir).select("region").distinct().collect()}
    assert regions == {"us-east", "us-west", "eu-west", "eu-central", "apac-au", "apac-jp"}


def test_models_run_on_written_raw_tables(spark, smoke_dir):
    """The model graph over raw tables read back from Parquet equals the in-memory graph."""
    from marketlens.plans.warehouse import Models
    from marketlens.registry import conform
    from marketlens.session import local_scratch
    from marketlens.sources.landing import seed_regions

    base = local_scratch()
    adapter.write_raw_tables(adapter.raw_tables(spark, smoke_dir), base)
    from_files = Models(adapter.read_raw_tables(spark, base), seed_regions(spark)).rpt_daily_kpis
    direct = Models.from_test_tables(spark, smoke_dir).rpt_daily_kpis
    key = lambda r: tuple((x is None, repr(x)) for x in r)
    assert sorted(conform(from_files).collect(), key=key) == sorted(conform(direct).collect(), key=key)
