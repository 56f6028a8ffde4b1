"""The declared data tests of the model graph, run as one Spark job.

Column tests (not_null, unique, accepted_values), model-level tests
(fact-vs-staging revenue total, non-negative KPI revenue) and the singular
tests (funnel monotonicity, orphaned orders, header-vs-lines reconciliation).
Each test's failure count is a global aggregate over what the test returns.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.constants import CUSTOMER_TIERS, EVENT_TYPES, ORDER_STATUSES
from marketlens.operators import checks

NOT_NULL_TESTS = {
    "dim_customers": ["customer_key", "customer_id"],
    "dim_products": ["product_key", "product_id"],
    "fact_orders": ["order_key", "order_id", "customer_id", "customer_key"],
    "fact_order_items": ["item_key", "order_key", "product_key"],
    "rpt_daily_kpis": ["report_date", "region"],
    "stg_customers": ["customer_id"],
    "stg_orders": ["order_id"],
    "stg_products": ["product_id"],
    "stg_marketing_events": ["event_id"],
}
UNIQUE_TESTS = [("dim_customers", "customer_key"), ("dim_products", "product_key"), ("fact_orders", "order_key"),
                ("fact_order_items", "item_key"), ("stg_customers", "customer_id"), ("stg_orders", "order_id"),
                ("stg_products", "product_id"), ("stg_marketing_events", "event_id")]
ACCEPTED_TESTS = [("stg_customers", "tier", CUSTOMER_TIERS), ("stg_orders", "status", ORDER_STATUSES),
                  ("stg_marketing_events", "event_type", EVENT_TYPES)]
MODELS = tuple(NOT_NULL_TESTS)


def models_of(source) -> dict[str, DataFrame]:
    """The tested models from a ``Models`` graph or any mapping of model name -> DataFrame."""
    if isinstance(source, Mapping):
        return {m: source[m] for m in MODELS}
    return {m: getattr(source, m) for m in MODELS}


def _union(dfs):
    return reduce(lambda a, b: a.unionByName(b), dfs)


def _counted(test_id, kind, model, column, df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(test_id).alias("test_id"), F.lit(kind).alias("kind"), F.lit(model).alias("model"),
        F.lit(column).cast("string").alias("column_name"), "failures")


#: Row conditions of model-level and singular tests that a single pass over the model counts: test id, kind, column, condition.
ROW_TESTS = {"rpt_daily_kpis": [
    ("gross_revenue_not_negative.rpt_daily_kpis", "model", "gross_revenue", "gross_revenue < 0"),
    ("test_funnel_monotonicity", "singular", None, "clicks > impressions OR purchases > clicks")]}


def write_metrics(model: str) -> list[Column]:
    """What can be counted of a model while it is written: its null tests and row tests, named by test id."""
    nulls = [F.count_if(F.col(c).isNull()).alias(f"not_null.{model}.{c}") for c in NOT_NULL_TESTS.get(model, [])]
    return nulls + [F.count_if(F.expr(cond)).alias(test_id) for test_id, _, _, cond in ROW_TESTS.get(model, [])]


def _known(spark: SparkSession, counted: Mapping[str, int]) -> DataFrame:
    """Rows of the tests that were counted on the way."""
    rows = [(f"not_null.{m}.{c}", "not_null", m, c) for m, cols in NOT_NULL_TESTS.items() for c in cols]
    rows += [(test_id, kind, m, c) for m, tests in ROW_TESTS.items() for test_id, kind, c, _ in tests]
    return spark.createDataFrame([(*r, int(counted[r[0]])) for r in rows if r[0] in counted],
                                 "test_id string, kind string, model string, column_name string, failures bigint")


def run_data_tests(source, counted: Mapping[str, int] | None = None) -> DataFrame:
    """One row per declared test: test_id, kind, model, column_name, failures, status.

    Failures count what each test returns: NULL rows (not_null), repeated
    values (unique), distinct values outside the list (accepted_values),
    returned rows (model-level and singular tests). ``counted``: failures by test id that were counted while the models were
    written (:func:`write_metrics`); nothing is read again for these.
    """
    ms, counted = models_of(source), dict(counted or {})
    parts = [_known(next(iter(ms.values())).sparkSession, counted)] if counted else []
    for model, cols in NOT_NULL_TESTS.items():
        cols = [c for c in cols if f"not_null.{model}.{c}" not in counted]
        if not cols:
            continue
        nn = checks.not_null_counts(ms[model], cols, model)
        parts.append(nn.select(F.concat(F.lit("not_null."), F.lit(model), F.lit("."), F.col("column_name"))
                               .alias("test_id"), F.lit("not_null").alias("kind"), "model", "column_name",
                               F.col("n_null").alias("failures")))
    for model, col in UNIQUE_TESTS:
        parts.append(_counted(f"unique.{model}.{col}", "unique", model, col, checks.unique(ms[model], col, model)))
    for model, col, vals in ACCEPTED_TESTS:
        parts.append(_counted(f"accepted_values.{model}.{col}", "accepted_values", model, col,
                              checks.accepted_values(ms[model], col, vals, model)))
    fo, foi = ms["fact_orders"], ms["fact_order_items"]
    parts.append(_counted("revenue_reconciliation.fact_orders", "model", "fact_orders", "total_amount",
                          checks.total_reconcile(fo, "total_amount", ms["stg_orders"], "total_amount")
                          .filter(~F.col("passed"))))
    for model, tests in ROW_TESTS.items():
        parts += [_counted(test_id, kind, model, col, ms[model].filter(cond)) for test_id, kind, col, cond in tests if test_id not in counted]
    parts.append(_counted("test_no_orphaned_orders", "singular", "fact_orders", None,
                          checks.orphans(fo.select("order_id"), foi, "order_id")))
    parts.append(_counted("test_revenue_reconciliation", "singular", "fact_orders", None,
                          checks.reconcile_join_then_sum(fo, foi, "order_id", "total_amount", "amount")))
    return _union(parts).withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))
