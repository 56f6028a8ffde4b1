"""Plan-shape assertions: the scale properties the operators are designed for."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from marketlens.operators.dedupe import latest_by_key
from marketlens.plans.warehouse import Models


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return re.sub(r"#\d+L?", "", buf.getvalue())  # drop expression ids


@pytest.fixture()
def no_auto_broadcast(spark):
    """Plans as they would be for large inputs: no size-based broadcast of the big sides."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_kpi_table_reads_orders_once_with_hash_aggregation(spark, smoke_dir, no_auto_broadcast):
    m = Models.from_test_tables(spark, smoke_dir)
    p = plan(m.rpt_daily_kpis)
    schemas = [ln.split("ReadSchema: ")[1] for ln in p.splitlines()
               if "ReadSchema: struct<o_orderkey" in ln]
    full = [s_ for s_ in schemas if "o_orderstatus" in s_]
    assert len(full) == len(schemas) == 1
    agg_lines = [ln for ln in plan(m.rpt_daily_kpis, "simple").splitlines() if "Aggregate" in ln and "order_date" in ln]
    assert agg_lines and all("HashAggregate" in ln for ln in agg_lines)


@pytest.fixture()
def small_skew(spark):
    """Skew handling and coalescing as on large inputs, at test size."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.forceOptimizeSkewedJoin": "true", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("copies", [False, True])
def test_hot_key_is_spread_over_several_tasks(spark, small_skew, copies):
    """A key with a third of the rows, identical copies too, joined to its aggregate: split, and nothing random in the plan."""
    from marketlens.operators.joins import attach_by_key
    df = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 1000).cast("string")).alias("k"),
        (F.lit(1) if copies else F.col("id")).alias("v"))
    stats = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = attach_by_key(df, stats, ["k"], ["n"])
    assert "rand(" not in plan(out)
    tasks = out.withColumn("p", F.spark_partition_id()).filter("k = 'hot'").groupBy("p").count().collect()
    assert sum(r["count"] for r in tasks) == 20000 and len(tasks) >= 3 and max(r["count"] for r in tasks) <= 10000
    assert out.filter("k = 'hot' AND n = 20000").count() == 20000 and out.count() == 60000


def test_latest_by_key_is_an_aggregate_not_a_window(spark, smoke_dir):
    p = plan(latest_by_key(Models.from_test_tables(spark, smoke_dir).stg_customers, ["customer_id"]), "simple")
    assert "Window" not in p and "partial_max" in p


def test_item_share_join_is_a_plain_equi_join_on_order_id(spark, smoke_dir, no_auto_broadcast):
    p = plan(Models.from_test_tables(spark, smoke_dir).int_order_items_enriched, "simple")
    assert "coalesce(order_id" not in p
    joins = [ln for ln in p.splitlines() if "SortMergeJoin [order_id], [_sk0]" in ln]
    assert joins, p


def test_facts_look_each_dimension_up_once(spark, smoke_dir, no_auto_broadcast):
    m = Models.from_test_tables(spark, smoke_dir)
    orders, items = plan(m.fact_orders, "simple"), plan(m.fact_order_items, "simple")
    assert sum("SortMergeJoin [customer_id" in ln for ln in orders.splitlines()) == 1
    assert sum("SortMergeJoin [product_id" in ln for ln in items.splitlines()) == 1
    assert items.count("FileScan parquet [p_partkey") == 1 and "FileScan parquet [c_custkey,c_name" not in items


def test_load_counts_are_one_scan(spark, smoke_dir):
    from marketlens.registry import QUERIES
    assert plan(QUERIES["load_audit"](spark, smoke_dir), "simple").count("FileScan parquet") == 1
    # each entity's own tables once: orders with lines and customers, lines, customers, products, events with customers
    assert plan(QUERIES["copy_load_entities"](spark, smoke_dir), "simple").count("FileScan parquet") == 8


def test_staging_scans_prune_columns_and_push_filters(spark, smoke_dir):
    p = plan(Models.from_test_tables(spark, smoke_dir).stg_order_items.select("order_id", "amount"))
    scan = p[p.index("Scan parquet"):]
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in scan
    assert "IsNotNull(l_orderkey)" in scan


def test_nothing_is_broadcast_unless_the_planner_finds_it_small(spark, smoke_dir, no_auto_broadcast):
    m = Models.from_test_tables(spark, smoke_dir)
    for df in (m.fact_order_items, m.fact_orders, m.rpt_daily_kpis):
        assert "BroadcastExchange" not in plan(df, "simple")


def test_reconciliation_does_not_join_line_rows_to_header_rows(spark, smoke_dir, no_auto_broadcast):
    from marketlens.operators.checks import reconcile_join_then_sum
    m = Models.from_test_tables(spark, smoke_dir)
    p = plan(reconcile_join_then_sum(m.fact_orders, m.fact_order_items, "order_id", "total_amount", "amount"),
             "simple")
    join_lines = [ln for ln in p.splitlines() if "Join" in ln and "[order_id]" in ln]
    assert join_lines
    # both inputs of the reconciliation join are per-key aggregates
    assert p.count("HashAggregate(keys=[order_id") >= 2 or p.count("keys=[order_id") >= 2


def test_null_keys_never_match(spark):
    from marketlens.operators.joins import left_lookup
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(
        (F.col("id") % 7).cast("string")).alias("k"), "id")
    right = spark.createDataFrame([(str(i), f"v{i}") for i in range(7)], "k string, v string")
    out = left_lookup(left, right, "k", ["v"])
    rows = out.collect()
    assert len(rows) == 3000
    assert all((r.k is None) == (r.v is None) for r in rows)


def test_test_runs_write_nothing(spark, smoke_dir):
    from marketlens.registry import QUERIES
    for name in ("data_tests", "check_unique", "check_not_null"):
        p = plan(QUERIES[name](spark, smoke_dir), "simple")
        assert "Scan ExistingRDD" not in p.replace("Scan ExistingRDD[region", ""), name


def test_shuffle_partitions_are_joined_to_a_task_s_size_unless_the_session_says(spark):
    from marketlens.session import TASK_BYTES, apply_defaults
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        apply_defaults(spark)
        assert spark.conf.get(key) == TASK_BYTES
        spark.conf.set(key, "7m")
        apply_defaults(spark)
        assert spark.conf.get(key) == "7m"
    finally:
        spark.conf.set(key, old) if old else spark.conf.unset(key)
