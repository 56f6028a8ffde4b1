"""Compose the model graph from the five raw tables.

Every attribute is a lazy DataFrame; nothing runs until an action or write,
and Catalyst plans each requested model with its full lineage (pruning the
columns and joins it does not need). Customers and products are reduced to
their latest load per key before they are joined, so an append-only load
history cannot fan out the order and item rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property, partial

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession

from marketlens.operators.dedupe import latest_by_key
from marketlens.operators.windows import rows_of_a_group_at_most
from marketlens.plans import intermediate, marts, reporting, staging
from marketlens.session import at_once, shuffles_removed, unique_path
from marketlens.sources.adapter import RawTables, raw_tables
from marketlens.sources.landing import _fs_path, seed_regions
from marketlens.sources.publish import PublishedTable, codec


class Models:
    """The model graph over five raw tables and the region seed.

    ``dedupe_dimensions=False`` joins customers and products exactly as
    loaded (every load row), reproducing the source SQL's numbers on an
    append-only history, fan-out included; the default joins their latest
    load per key.
    """

    # models read by several downstream models and checks (the hubs of the graph)
    SHARED = frozenset({"stg_orders", "stg_customers", "orders_with_customer", "fact_orders", "fact_order_items",
                        "rpt_daily_kpis"})
    #: Whether the lines of every order are known to fit a task.
    small_orders = False

    def __init__(self, raw: RawTables, regions: DataFrame, dedupe_dimensions: bool = True,
                 reuse: str | None = None, reuse_models=SHARED):
        self.raw = raw
        self.regions = regions
        self.dedupe_dimensions = dedupe_dimensions
        if reuse not in (None, "persist"):
            raise ValueError(f"reuse must be None or 'persist', not {reuse!r}")
        self.reuse = reuse
        self.reuse_models = frozenset(reuse_models)

    @classmethod
    def from_test_tables(cls, spark: SparkSession, sf_dir: str, dedupe_dimensions: bool = True,
                         reuse: str | None = None) -> "Models":
        return cls(raw_tables(spark, sf_dir), seed_regions(spark), dedupe_dimensions, reuse)

    def _done(self, df: DataFrame, name: str | None = None) -> DataFrame:
        """How a model is shared by everything downstream of it (later models, checks).

        ``None``: lazily inlined (each consumer plans the whole lineage; right
        for a single output). ``"persist"``: computed once per job and kept
        (memory, spilling to disk) for every consumer; recomputed from lineage
        if an executor is lost. To share models across jobs, write them as
        Parquet (:func:`materialise`), which readers prune by column. Only models in ``reuse_models`` (by default the hubs read by several
        consumers) are shared this way; the rest stay inlined.
        """
        if name is not None and name not in self.reuse_models:
            return df
        if self.reuse == "persist":
            return df.persist(StorageLevel.MEMORY_AND_DISK)
        return df

    # staging
    @cached_property
    def stg_orders(self) -> DataFrame:
        return self._done(staging.stg_orders(self.raw.orders), "stg_orders")

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return self._done(staging.stg_order_items(self.raw.order_items), "stg_order_items")

    @cached_property
    def stg_customers(self) -> DataFrame:
        return self._done(staging.stg_customers(self.raw.customers), "stg_customers")

    @cached_property
    def stg_products(self) -> DataFrame:
        return self._done(staging.stg_products(self.raw.products), "stg_products")

    @cached_property
    def stg_marketing_events(self) -> DataFrame:
        return self._done(staging.stg_marketing_events(self.raw.marketing_events),
                          "stg_marketing_events")

    # current rows of the append-only dimensions
    @cached_property
    def customers_current(self) -> DataFrame:
        if not self.dedupe_dimensions:
            return self.stg_customers
        return self._done(latest_by_key(self.stg_customers, ["customer_id"], ["_loaded_at"]),
                          "customers_current")

    @cached_property
    def products_current(self) -> DataFrame:
        if not self.dedupe_dimensions:
            return self.stg_products
        return self._done(latest_by_key(self.stg_products, ["product_id"], ["_loaded_at"]), "products_current")

    # intermediate
    @cached_property
    def orders_with_customer(self) -> DataFrame:
        return self._done(intermediate.orders_with_customer(self.stg_orders, self.customers_current, self.regions),
                          "orders_with_customer")

    @cached_property
    def items_with_product(self) -> DataFrame:
        return self._done(intermediate.items_with_product(self.stg_order_items, self.products_current, self.small_orders),
                          "items_with_product")

    @cached_property
    def int_orders_enriched(self) -> DataFrame:
        return self.orders_with_customer.select(*intermediate.ORDERS_ENRICHED)

    @cached_property
    def int_order_items_enriched(self) -> DataFrame:
        return self.items_with_product.select(*intermediate.ITEMS_ENRICHED)

    @cached_property
    def int_regional_daily(self) -> DataFrame:
        return self._done(intermediate.int_regional_daily(self.int_orders_enriched, self.stg_marketing_events),
                          "int_regional_daily")

    # marts
    @cached_property
    def dim_customers(self) -> DataFrame:
        return self._done(marts.dim_customers(self.stg_customers), "dim_customers")

    @cached_property
    def dim_products(self) -> DataFrame:
        return self._done(marts.dim_products(self.products_current), "dim_products")

    @cached_property
    def fact_orders(self) -> DataFrame:
        if not self.dedupe_dimensions:
            return self._done(marts.fact_orders_as_loaded(self.int_orders_enriched, self.dim_customers), "fact_orders")
        return self._done(marts.fact_orders(self.orders_with_customer), "fact_orders")

    @cached_property
    def fact_order_items(self) -> DataFrame:
        if not self.dedupe_dimensions:
            f = marts.fact_order_items_as_loaded(self.int_order_items_enriched, self.fact_orders, self.dim_products)
        else:  # the headers themselves: their customer and region lookups add nothing to a line
            f = marts.fact_order_items(self.items_with_product, self.stg_orders)
        return self._done(f, "fact_order_items")

    # reporting
    @cached_property
    def rpt_daily_kpis(self) -> DataFrame:
        """Single pass over the orders (same rows as the regional-daily x order-fact join form)."""
        return self._done(reporting.rpt_daily_kpis_single_pass(self.int_orders_enriched, self.stg_marketing_events,
                                                               self.regions), "rpt_daily_kpis")

    @cached_property
    def rpt_daily_kpis_two_pass(self) -> DataFrame:
        """The source model's shape: regional daily joined with an aggregate of the order fact."""
        return self._done(reporting.rpt_daily_kpis(self.int_regional_daily, self.fact_orders),
                          "rpt_daily_kpis_two_pass")


MODEL_NAMES = ("stg_orders", "stg_order_items", "stg_customers", "stg_products", "stg_marketing_events", "int_orders_enriched",
               "int_order_items_enriched", "int_regional_daily", "dim_customers", "dim_products", "fact_orders", "fact_order_items", "rpt_daily_kpis")
MART_TABLES = ("dim_customers", "dim_products", "fact_orders", "fact_order_items", "rpt_daily_kpis")
#: Marts written at the same time, where dimensions are deduplicated: the KPI table reads the order fact, and the item fact, whose shuffles
#: are the largest, is written when those of the first marts are gone.
WAVES = (("dim_customers", "dim_products", "fact_orders"), ("fact_order_items", "rpt_daily_kpis"))
#: Lines of an order that a task takes in its stride, as it spills them.
SMALL_ORDER = 1 << 20


def materialise(models: Models, base: str, tables=MART_TABLES, observe: Mapping[str, tuple[Observation, list]] | None = None,
                staged: str | None = None) -> dict[str, DataFrame]:
    """Rebuild mart and reporting tables as published tables under ``base``; returns DataFrames over the new versions.

    Each table changes in one step, and readers of the old version keep it (``sources.publish``). Only what ``tables`` asks for
    is built. Later tables read the written ones they need: the KPI table reads the order fact, which has a row for each enriched
    order and all that the KPIs need of it. Marts that don't need one another are written at the same time, and a mart's shuffle
    files are removed when it is written. ``observe`` has metrics to take of a table's rows while they are written. ``staged``: a new
    folder for the staged orders, which are then computed once, for the marts and for what the caller does with them.
    """
    spark = models.raw.orders.sparkSession
    base = base.rstrip("/")
    m = Models(models.raw, models.regions, models.dedupe_dimensions, models.reuse, models.reuse_models)
    out: dict[str, DataFrame] = {}

    def rows(name: str) -> DataFrame:
        if name == "rpt_daily_kpis" and "fact_orders" in out:
            return reporting.rpt_daily_kpis_single_pass(out["fact_orders"].withColumnRenamed("tier", "customer_tier"),
                                                        m.stg_marketing_events, m.regions)
        return getattr(m, name)

    def publish(name: str, df: DataFrame) -> DataFrame:
        table = PublishedTable(spark, f"{base}/{name}")
        table.publish(df, observe=(observe or {}).get(name))
        return table.read()

    names = list(dict.fromkeys(tables))
    waves = [[name for name in wave if name in names] for wave in WAVES] if models.dedupe_dimensions else []
    waves += [[name] for name in names if not any(name in wave for wave in waves)]
    known = models.dedupe_dimensions and "fact_order_items" in names  # as loaded, an order has its lines once for each load of a product

    def count_lines() -> None:
        m.small_orders = known and rows_of_a_group_at_most(m.stg_order_items, ["order_id"]) <= SMALL_ORDER

    def stage() -> None:
        if staged:
            m.stg_orders.write.options(**codec(spark)).parquet(staged)
            m.__dict__["stg_orders"] = spark.read.schema(m.stg_orders.schema).parquet(staged)

    with shuffles_removed(spark):
        at_once(spark, [count_lines, stage])
        for wave in filter(None, waves):
            written = at_once(spark, [partial(publish, name, rows(name)) for name in wave])
            for name, df in zip(wave, written, strict=True):
                out[name] = m.__dict__[name] = df
    return {name: out[name] for name in names}


def register_views(models: Models, names=MODEL_NAMES, prefix: str = "") -> list[str]:
    """Register models as views of the session, so that SQL can query them by name; returns the views' names.

    A view holds a model's plan, not its rows: a query over several of them is planned as a whole, and reads the columns it needs.
    """
    views = []
    for name in names:
        getattr(models, name).createOrReplaceTempView(prefix + name)
        views.append(prefix + name)
    return views


def build_and_test(models: Models, base: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Publish the marts and KPI table, then run the declared tests against the new versions.

    Null tests and row tests of the written tables are counted while they are written. The others read the written tables, the
    columns they need, the staged orders, written for the run, and the other staging models, evaluated lazily; so each mart and the
    staged orders are computed once for both the build and the tests. The report holds the tests' counts, not their plans.
    """
    from marketlens.plans.data_tests import run_data_tests, write_metrics

    spark = models.raw.orders.sparkSession
    observe = {name: (Observation(f"tests_{name}"), write_metrics(name)) for name in MART_TABLES}
    staged = unique_path(spark, "staged_orders")
    try:
        tables = materialise(models, base, observe=observe, staged=staged)
        counted = {test: n for obs, _ in observe.values() for test, n in obs.get.items()}
        tested = {m: getattr(models, m) for m in ("stg_customers", "stg_products", "stg_marketing_events")}
        tested["stg_orders"] = spark.read.schema(models.stg_orders.schema).parquet(staged)
        tested.update(tables)
        report = run_data_tests(tested, counted)
        with shuffles_removed(spark):
            counts = report.collect()
    finally:
        p, fs = _fs_path(spark, staged)
        fs.delete(p, True)
    return tables, spark.createDataFrame(counts, report.schema)
