"""Executive KPI table: one row per region and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.scalars import div_nullif_zero, safe_divide
from marketlens.operators.windows import rolling_avg


def order_mix_daily(fact_ord: DataFrame) -> DataFrame:
    return fact_ord.groupBy("region", "order_date").agg(
        F.max("continent").alias("continent"),
        F.count_if(F.col("tier") == "gold").alias("gold_customer_orders"),
        safe_divide(F.count_if("has_promo"), F.count("order_id")).alias("promo_order_pct"),
    )


def rpt_daily_kpis(regional_daily: DataFrame, fact_ord: DataFrame, with_updated_at: bool = False) -> DataFrame:
    rd = regional_daily
    oa = order_mix_daily(fact_ord).withColumnRenamed("region", "oa_region").withColumnRenamed(
        "order_date", "oa_date")
    j = rd.join(oa, (rd.region == oa.oa_region) & (rd.order_date == oa.oa_date), "left").select(
        F.col("order_date").alias("report_date"), "region", "continent",
        "total_orders", "gross_revenue", "avg_order_value", "unique_customers",
        "returned_orders", "return_rate",
        "impressions", "clicks", "purchases",
        div_nullif_zero("clicks", "impressions").alias("ctr"),
        div_nullif_zero("purchases", "clicks").alias("conversion_rate"),
        div_nullif_zero("gross_revenue", "impressions").alias("revenue_per_impression"),
        "gold_customer_orders", "promo_order_pct",
    )
    out = j.select(
        "*",
        rolling_avg("avg_order_value", ["region"], "report_date").alias("avg_order_value_7d_avg"),
        rolling_avg("gross_revenue", ["region"], "report_date").alias("gross_revenue_7d_avg"),
    )
    if with_updated_at:
        out = out.withColumn("_dbt_updated_at", F.current_timestamp())
    return out


def daily_order_metrics(orders_enriched: DataFrame, regions: DataFrame) -> DataFrame:
    """Every per-(region, day) order metric of the KPI table from one aggregation pass.

    Equivalent to ``orders_daily_agg`` plus ``order_mix_daily`` over the order
    fact: the fact is 1:1 with the enriched orders (the customer dimension is
    unique per key), and its ``tier`` is the enriched ``customer_tier``.
    ``max(continent)`` over a region's rows is the seed continent of that
    region (every row got it from the same seed lookup), so it is attached
    after the aggregation from the six-row seed: a string ``max`` would force
    a sort-based aggregate over all order rows. The order-mix columns are NULL
    where region or day is NULL, as the equality join of the two-aggregate
    form would leave them.
    """
    g = orders_enriched.groupBy("region", "order_date").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("total_amount").alias("gross_revenue"),
        F.avg("total_amount").alias("avg_order_value"),
        F.count_if(F.col("status") == "returned").alias("returned_orders"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_if(F.col("customer_tier") == "gold").alias("_gold"),
        F.count_if("has_promo").alias("_promo"),
    )
    seed = regions.select(F.col("region").alias("_seed_region"), F.col("continent").alias("_continent"))
    j = g.join(seed, g.region == seed._seed_region, "left")
    keyed = F.col("region").isNotNull() & F.col("order_date").isNotNull()
    return j.select(
        "region", "order_date", "total_orders", "gross_revenue", "avg_order_value", "returned_orders",
        "unique_customers",
        F.when(keyed, F.col("_continent")).alias("continent"),
        F.when(keyed, F.col("_gold")).alias("gold_customer_orders"),
        F.when(keyed, safe_divide("_promo", "total_orders")).alias("promo_order_pct"),
    )


def rpt_daily_kpis_single_pass(orders_enriched: DataFrame, events: DataFrame, regions: DataFrame,
                               with_updated_at: bool = False) -> DataFrame:
    """The KPI table with one scan and one aggregation of the orders.

    Orders and marketing events are each reduced to one row per region-day,
    the two small aggregates are joined, and the rolling windows run over
    region partitions of daily rows (small whatever the input size).
    """
    from marketlens.plans.intermediate import marketing_daily_agg

    o = daily_order_metrics(orders_enriched, regions)
    m = marketing_daily_agg(events).withColumnRenamed("region", "m_region")
    j = o.join(m, (o.region == m.m_region) & (o.order_date == m.event_date), "left")
    imp, clk, pur = (F.coalesce(c, F.lit(0)) for c in ("impressions", "clicks", "purchases"))
    k = j.select(
        F.col("order_date").alias("report_date"), "region", "continent",
        "total_orders", "gross_revenue", "avg_order_value", "unique_customers", "returned_orders",
        safe_divide("returned_orders", "total_orders").alias("return_rate"),
        imp.alias("impressions"), clk.alias("clicks"), pur.alias("purchases"),
        div_nullif_zero(clk, imp).alias("ctr"),
        div_nullif_zero(pur, clk).alias("conversion_rate"),
        div_nullif_zero("gross_revenue", imp).alias("revenue_per_impression"),
        "gold_customer_orders", "promo_order_pct",
    )
    out = k.select(
        "*",
        rolling_avg("avg_order_value", ["region"], "report_date").alias("avg_order_value_7d_avg"),
        rolling_avg("gross_revenue", ["region"], "report_date").alias("gross_revenue_7d_avg"),
    )
    if with_updated_at:
        out = out.withColumn("_dbt_updated_at", F.current_timestamp())
    return out
