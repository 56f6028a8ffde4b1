"""Named queries over the driver test tables: (spark, sf_dir) -> DataFrame.

Each entry builds the raw retail tables from the test tables (see
``sources.adapter``), runs one operator or model over the whole tables, and
conforms the output for comparison with an independent SQL engine: decimals
become doubles, fractional values are rounded to 6 places, integers become
bigint. The library functions themselves keep exact decimal money.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DecimalType, DoubleType, FloatType, IntegerType, LongType,
                               ShortType)

from marketlens.constants import DQ_RATES, RECENT_ROWS_WINDOW_HOURS, REGIONS
from marketlens.functions.scalars import div_nullif_zero, line_amount, safe_divide, surrogate_key
from marketlens.operators import checks, detectors, gates, volume
from marketlens.operators.dedupe import deterministic_sample, latest_by_key
from marketlens.operators.windows import rolling_avg, with_share_of_group
from marketlens.plans.intermediate import marketing_daily_agg, orders_daily_agg
from marketlens.plans.reporting import order_mix_daily
from marketlens.plans.data_tests import ACCEPTED_TESTS, NOT_NULL_TESTS, UNIQUE_TESTS, models_of, run_data_tests
from marketlens.plans.warehouse import Models, build_and_test, materialise, register_views
from marketlens.schemas import LANDING
from marketlens.session import apply_defaults, at_once, shared_path, unique_path
from marketlens.sources import adapter
from marketlens.sources.footers import landing_manifest
from marketlens.sources.ingest import append_audit, ingest_history, ingest_hour
from marketlens.sources.landing import (_fs_path, flagged_load, load_audit, mark_complete, nanos_to_timestamp, partition_dir,
                                        path_complete, read_landing, seed_regions, typed_load, with_audit, write_hour)
from marketlens.sources.publish import PublishedTable
from marketlens.sources.relanding import ingest_changes
from marketlens.streaming.ingest import ingested_schema, run_ingest

# injected clock for freshness gates (the data's last day ends at this instant)
NOW = "2024-01-31 00:00:00"
RUN_LOADED_AT = "2024-01-31 00:00:00"
RUN_ID = "run-2024-01-31"
SAMPLE_SEED = 42
HOURS = ("2024-01-01 00", "2024-01-31 00")  # asked of the landing gates: the data's days and one hour more
TABLES = ("customer", "orders", "lineitem", "part", "events")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def conform(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (DecimalType, DoubleType, FloatType)):
            c = F.round(c.cast("double"), 6)
        elif isinstance(t, (ByteType, ShortType, IntegerType, LongType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_defaults(spark)
            return conform(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


def _models(spark, sf_dir, reuse: str | None = None) -> Models:
    return Models.from_test_tables(spark, sf_dir, reuse=reuse)


# ---------------------------------------------------------------- landing
def _input_key(spark: SparkSession, sf_dir: str) -> str:
    """Names the input by its files' paths, sizes and modification times, so that changed input isn't taken for old."""
    seen = [adapter.ADAPTER_VERSION]
    for t in TABLES:
        p, fs = _fs_path(spark, f"{sf_dir.rstrip('/')}/{t}.parquet")
        for s in ([fs.getFileStatus(p)] if fs.getFileStatus(p).isFile() else fs.listStatus(p)):
            seen.append(f"{s.getPath()}|{s.getLen()}|{s.getModificationTime()}")
    return hashlib.md5("\n".join(sorted(seen)).encode()).hexdigest()[:12]


def ensure_landing(spark: SparkSession, sf_dir: str, entity: str = "orders") -> str:
    """Write an entity of the test data once as hourly landing files; return the landing base.

    Written under the shared checkpoint folder; the write is an idempotent
    dynamic partition overwrite, so a concurrent or repeated call is harmless.
    """
    base = shared_path(spark, "landing", _input_key(spark, sf_dir))
    if not path_complete(spark, f"{base}/{entity}"):
        write_hour(adapter.landing_entity(spark, sf_dir, entity), f"{base}/{entity}")
        mark_complete(spark, f"{base}/{entity}")
    return base


@query("landing_scan")
def q_landing_scan(spark, sf_dir):
    """One partition-discovered scan of every region file of every (date, hour)."""
    base = ensure_landing(spark, sf_dir)
    return read_landing(spark, base, "orders")


@query("audit_columns")
def q_audit_columns(spark, sf_dir):
    """A2/A3: _source_file from file metadata, one _loaded_at per run."""
    base = ensure_landing(spark, sf_dir)
    df = with_audit(read_landing(spark, base, "orders"), RUN_LOADED_AT)
    # the path up to the region folder and the part file's name differ from run to run
    whole = F.col("_source_file").contains("/".join(base.split("/")[-3:])) & F.col("_source_file").endswith(".parquet")
    return df.select("order_id", "region", "date", "hour", partition_dir().alias("_source_file"), whole.alias("whole_path"), "_loaded_at")


def _landed(entity):
    @query(f"landing_{entity}")
    def q(spark, sf_dir):
        return read_landing(spark, ensure_landing(spark, sf_dir, entity), entity)
    q.__doc__ = f"A1/A8: the landing scan of {entity}, typed as declared."
    return q


for _e in adapter.RAW_ENTITIES[1:]:
    _landed(_e)


@query("landing_one_hour")
def q_one_hour(spark, sf_dir):
    """One (date, hour) of every region, by path."""
    return read_landing(spark, ensure_landing(spark, sf_dir), "orders", "2024-01-15", "07")


@query("landing_hour_rerun")
def q_hour_rerun(spark, sf_dir):
    """An hour ingested twice, and another once: the rerun replaces its own hour."""
    base, run = ensure_landing(spark, sf_dir), unique_path(spark, "rerun")
    for hour, loaded in (("07", "2024-01-15 08:00:00"), ("08", "2024-01-15 09:00:00"), ("07", "2024-01-15 10:00:00")):
        ingest_hour(spark, base, run, "orders", "2024-01-15", hour, RUN_ID, loaded)
    return PublishedTable(spark, run).read().select("order_id", "region", "total_amount", "_loaded_at", "date", "hour")


def _daily_orders(spark, sf_dir):
    """The landed orders as one file a day and region would hold them."""
    return adapter.landing_entity(spark, sf_dir, "orders").withColumn("hour", F.lit("00"))


@query("relanded_hours")
def q_relanded(spark, sf_dir):
    """A second run after a batch was landed again with other rows and one was withdrawn: only these are replaced."""
    run = unique_path(spark, "relanded")
    base, table = f"{run}/landing", f"{run}/raw_order"
    write_hour(_daily_orders(spark, sf_dir), f"{base}/orders")
    ingest_changes(spark, base, "orders", table, "2024-01-31 00:00:00")
    again = read_landing(spark, base, "orders", "2024-01-15", "00").withColumn("total_amount", F.col("total_amount") * 2)
    moved = unique_path(spark, "relanded")  # a table can't be overwritten by what is read from it
    again.write.parquet(moved)
    write_hour(spark.read.parquet(moved), f"{base}/orders")
    p, fs = _fs_path(spark, f"{base}/orders/region={REGIONS[0]}/date=2024-01-20")
    fs.delete(p, True)
    ingest_changes(spark, base, "orders", table, "2024-01-31 01:00:00")
    return PublishedTable(spark, table).read().select("order_id", "region", "total_amount", "date", "hour", "_loaded_at")


def _write_foreign(rows, base: str) -> DataFrame:
    """Each batch's rows as a file of pandas: in turn nanosecond times, a column without any value, and wide strings."""
    def write(key, pdf):
        import pyarrow as pa
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq
        region, date, hour = key
        t = pa.Table.from_pandas(pdf[LANDING["orders"].fieldNames()].drop(columns="region"), preserve_index=False)
        variant = int(date[-2:]) % 3
        for i, f in enumerate(t.schema):
            if f.name == "created_at":
                t = t.set_column(i, f.name, t.column(i).cast(pa.timestamp("ns" if variant == 0 else "us")))
            elif f.name == "promo_code" and variant == 1:
                t = t.set_column(i, f.name, pa.nulls(len(t)))
            elif f.name != "total_amount":
                t = t.set_column(i, f.name, t.column(i).cast(pa.large_string() if variant == 2 else pa.string()))
        fs, root = pafs.FileSystem.from_uri(base)
        folder = f"{root}/region={region}/date={date}/hour={hour}"
        fs.create_dir(folder, recursive=True)
        with fs.open_output_stream(f"{folder}/orders.parquet") as out:
            pq.write_table(t, out)
        return pdf.head(1)[["order_id"]]
    return rows.groupBy("region", "date", "hour").applyInPandas(write, "order_id string")


@query("foreign_backfill")
def q_foreign_backfill(spark, sf_dir):
    """A history of foreign files, with three different schemas and a seventh region, ingested by one scan per schema."""
    run = unique_path(spark, "foreign")
    run = run if "://" in run else f"file://{run}"
    rows = _daily_orders(spark, sf_dir).filter("region IS NOT NULL").withColumn(
        "region", F.when(F.col("order_id").cast("bigint") % 11 == 0, "lunar-1").otherwise(F.col("region")))
    _write_foreign(rows, f"{run}/landing").write.format("noop").mode("overwrite").save()
    ingest_history(spark, f"{run}/landing", f"{run}/raw", ["orders"], foreign=True)
    return PublishedTable(spark, f"{run}/raw/orders").read().select(
        "order_id", "customer_id", "region", "created_at", "status", "currency", "promo_code", "total_amount", "date", "_loaded_at")


@query("audit_history")
def q_audit_history(spark, sf_dir):
    """A10: audit rows kept over runs: an hour twice under one run id, once under another, and a second hour."""
    base, run = ensure_landing(spark, sf_dir), unique_path(spark, "audit")
    for run_id, hour in (("run-a", "07"), ("run-a", "08"), ("run-b", "07"), ("run-a", "07")):
        _, audit = ingest_hour(spark, base, f"{run}/raw", "orders", "2024-01-15", hour, run_id, f"2024-01-15 {int(hour) + 1:02d}:00:00")
        append_audit(spark, f"{run}/audit", audit, "orders", "2024-01-15", hour, run_id)
    return PublishedTable(spark, f"{run}/audit").read().drop("load_id", "loaded_at")


@query("unpublished_attempt")
def q_unpublished(spark, sf_dir):
    """Readers see the last published version: an attempt that was written but not published changes nothing."""
    daily = _models(spark, sf_dir).int_regional_daily
    table = PublishedTable(spark, unique_path(spark, "published"))
    table.publish(daily, ["region"])
    table.write_attempt(daily.withColumn("total_orders", F.col("total_orders") * 2), ["region"])
    table.publish(daily.filter(F.col("region") == REGIONS[1]).withColumn("total_orders", F.lit(0).cast("bigint")), ["region"])
    table.write_attempt(daily.limit(0), ["region"])
    return table.read(1).withColumn("version", F.lit(1)).unionByName(table.read().withColumn("version", F.lit(2))).select(
        "version", "region", "order_date", "total_orders")


@query("footer_gates")
def q_footer_gates(spark, sf_dir):
    """Rows and newest load of every raw table as stored, told by the files' footers."""
    run = unique_path(spark, "stored")
    adapter.write_raw_tables(adapter.raw_tables(spark, sf_dir), run)
    stored = adapter.read_raw_tables(spark, run)
    return gates.gates_from_footers({"raw_order": stored.orders, "raw_order_item": stored.order_items, "raw_customer": stored.customers,
                                     "raw_product": stored.products, "raw_marketing_event": stored.marketing_events}, NOW)


@query("file_manifest")
def q_file_manifest(spark, sf_dir):
    """Regions that landed a file, for every hour asked for; a file without rows counts, a folder without files doesn't."""
    run = unique_path(spark, "manifest")
    daily = _daily_orders(spark, sf_dir)
    write_hour(daily.filter("date < '2024-01-29'"), f"{run}/orders")
    empty = spark.createDataFrame([], LANDING["orders"]).drop("region")
    empty.coalesce(1).write.parquet(f"{run}/orders/region={REGIONS[2]}/date=2024-01-29/hour=00")
    p, fs = _fs_path(spark, f"{run}/orders/region={REGIONS[3]}/date=2024-01-29/hour=00")
    fs.mkdirs(p)
    days = gates.file_manifest(landing_manifest(spark, run, "orders"), since="2024-01-01 00", until="2024-01-30 00").filter("hour = '00'")
    return days.select("date", "region", "present", "expected", ((F.col("n_bytes") > 0) == F.col("present")).alias("has_bytes"))


@query("lines_without_header")
def q_lines_without_header(spark, sf_dir):
    """Lines whose order isn't among the loaded orders (those that the typed load rejects are missing)."""
    good, _ = typed_load(_text_orders(spark, sf_dir), LANDING["orders"])
    items = read_landing(spark, ensure_landing(spark, sf_dir, "order_items"), "order_items")
    return checks.orphans(items.select("order_id", "item_id"), good, "order_id")


@query("model_views")
def q_model_views(spark, sf_dir):
    """Models as views, queried by SQL: each region's best day next to its orders of that day."""
    register_views(_models(spark, sf_dir), prefix="ml_")
    return spark.sql("""
        SELECT k.region, k.report_date, k.gross_revenue, count(o.order_key) AS n_orders, max(o.total_amount) AS largest_order
        FROM ml_rpt_daily_kpis k JOIN ml_fact_orders o ON o.region = k.region AND o.order_date = k.report_date
        WHERE k.total_orders > 0 GROUP BY k.region, k.report_date, k.gross_revenue""")


@query("nanos_to_timestamp")
def q_nanos(spark, sf_dir):
    """Nanosecond timestamps cut to microseconds (every event a few hundred nanoseconds past its time)."""
    e = adapter.table(spark, sf_dir, "events")
    nanos = F.unix_micros(F.col("ts").cast("timestamp")) * 1000 + F.col("event_id") % 1000
    return e.select("event_id", nanos.alias("nanos")).select("event_id", "nanos", nanos_to_timestamp(F.col("nanos")).alias("ts"))


@query("rpt_daily_kpis_from_landing")
def q_kpis_from_landing(spark, sf_dir):
    """All five entities from landing files through the ingest and the models to the KPI table."""
    raw = unique_path(spark, "raw")
    at_once(spark, [lambda e=e: ingest_history(spark, ensure_landing(spark, sf_dir, e), raw, [e]) for e in adapter.RAW_ENTITIES])
    return Models(adapter.read_raw_tables(spark, raw), seed_regions(spark)).rpt_daily_kpis


@query("union_regions")
def q_union_regions(spark, sf_dir):
    """Per-region scans concatenated by name, summarised per landing batch."""
    base = ensure_landing(spark, sf_dir)
    parts = [read_landing(spark, base, "orders", regions=[r]) for r in REGIONS]
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return u.groupBy("region", "date", "hour").agg(F.count(F.lit(1)).alias("n_rows"),
                                                   F.sum("total_amount").alias("total_amount"))


@query("copy_load_projection")
def q_copy_load(spark, sf_dir):
    """Projection + try_cast to the declared types, lineage column kept."""
    base = ensure_landing(spark, sf_dir)
    df = read_landing(spark, base, "orders")
    # columns arrive upper-cased, as from a foreign writer: the load matches names case-insensitively
    df = df.select(*[F.col(c).alias(c.upper()) for c in LANDING["orders"].fieldNames()],
                   partition_dir(F.col("_metadata.file_path")).alias("_source_file"))
    good, _ = typed_load(df, LANDING["orders"])
    return good


def _text_orders(spark, sf_dir):
    """The landed orders as a foreign writer's text, some of it not what it should be."""
    df = read_landing(spark, ensure_landing(spark, sf_dir), "orders")
    k = F.col("order_id").cast("bigint")
    return df.select("order_id", "customer_id", "region",
                     F.when(k % 40 == 2, "yesterday").otherwise(F.col("created_at").cast("string")).alias("created_at"),
                     "status", "currency", "promo_code",
                     F.when(k % 40 == 1, "n/a").otherwise(F.col("total_amount").cast("decimal(18,2)").cast("string")).alias("total_amount"),
                     "date", "hour")


@query("copy_load_entities")
def q_copy_load_entities(spark, sf_dir):
    """A8 x5: every raw entity through the typed load into its declared schema; loaded vs rejected rows, one scan each.

    Amounts and quantities arrive as text here, with a few that don't convert.
    """
    r = adapter.raw_tables(spark, sf_dir)
    amount = {"orders": "total_amount", "order_items": "quantity", "customers": "created_at", "products": "unit_price",
              "marketing_events": "created_at"}
    parts = []
    for entity in adapter.RAW_ENTITIES:
        df, c, key = getattr(r, entity), amount[entity], LANDING[entity].fieldNames()[0]
        df = df.withColumn(c, F.when(F.col(key).endswith("77"), "n/a").otherwise(F.col(c).cast("string")))
        n = flagged_load(df, LANDING[entity]).agg(F.count_if(~F.col("_rejected")).alias("loaded"), F.count_if("_rejected").alias("rejected"))
        parts.append(n.select(F.lit(entity).alias("entity"), F.expr("stack(2, 'loaded', loaded, 'rejected', rejected) as (outcome, n_rows)")))
    return _union(parts)


@query("load_rejects")
def q_load_rejects(spark, sf_dir):
    """Rows that do not convert to the declared types, as they came."""
    _, rejects = typed_load(_text_orders(spark, sf_dir), LANDING["orders"])
    return rejects


@query("load_audit")
def q_load_audit(spark, sf_dir):
    """Expected (landed) vs loaded rows per load date and region."""
    return load_audit(flagged_load(_text_orders(spark, sf_dir), LANDING["orders"]), RUN_ID, "orders")


@query("seed_regions")
def q_seed_regions(spark, sf_dir):
    """The region seed with the orders and current customers each region has in the data."""
    m = _models(spark, sf_dir)
    return checks.seed_coverage(m.regions, "region", {"n_orders": m.stg_orders.select("region"),
                                                       "n_customers": m.customers_current.select("region")})


@query("row_count_by_load_date")
def q_row_count(spark, sf_dir):
    """Rows per raw table and load date."""
    r = adapter.raw_tables(spark, sf_dir)
    return gates.rows_by_load_date({"raw_order": r.orders, "raw_order_item": r.order_items,
                                    "raw_customer": r.customers, "raw_product": r.products,
                                    "raw_marketing_event": r.marketing_events})


@query("freshness_check")
def q_freshness_check(spark, sf_dir):
    """Raw orders loaded in the 2 hours before the injected clock."""
    return gates.recent_rows(adapter.raw_order(spark, sf_dir), NOW, RECENT_ROWS_WINDOW_HOURS)


@query("source_freshness")
def q_source_freshness(spark, sf_dir):
    """H9: newest load per raw source, warn after 2 h, error after 6 h."""
    r = adapter.raw_tables(spark, sf_dir)
    return gates.freshness({"raw_order": r.orders, "raw_order_item": r.order_items, "raw_customer": r.customers,
                            "raw_product": r.products, "raw_marketing_event": r.marketing_events}, NOW)


# ---------------------------------------------------------------- scalar functions
@query("safe_divide")
def q_safe_divide(spark, sf_dir):
    """Zero-safe ratio and nullif-guarded ratio per region and day."""
    o = _models(spark, sf_dir).int_orders_enriched
    g = o.groupBy("region", "order_date").agg(
        F.count("order_id").alias("total_orders"),
        F.count_if(F.col("status") == "returned").alias("returned_orders"),
        F.count_if("has_promo").alias("promo_orders"),
        F.count_if(F.col("customer_tier") == "gold").alias("gold_orders"))
    return g.select("region", "order_date", "total_orders", "returned_orders", "promo_orders", "gold_orders",
                    safe_divide("returned_orders", "total_orders").alias("return_rate"),
                    safe_divide("promo_orders", "gold_orders").alias("promo_per_gold"),
                    div_nullif_zero("returned_orders", "gold_orders").alias("returns_per_gold"))


@query("funnel_rates")
def q_funnel_rates(spark, sf_dir):
    """Click-through and conversion; NULL where the divisor is 0."""
    m = marketing_daily_agg(_models(spark, sf_dir).stg_marketing_events)
    return m.select("region", "event_date", "impressions", "clicks", "purchases",
                    div_nullif_zero("clicks", "impressions").alias("ctr"),
                    div_nullif_zero("purchases", "clicks").alias("conversion_rate"))


@query("surrogate_key")
def q_surrogate_key(spark, sf_dir):
    """md5 surrogate keys over one and two key columns (NULL-safe)."""
    o = _models(spark, sf_dir).stg_orders
    return o.select("order_id", "customer_id", surrogate_key("order_id").alias("order_key"),
                    surrogate_key("order_id", "customer_id").alias("order_customer_key"))


@query("line_amount_check")
def q_line_amount(spark, sf_dir):
    """Lines whose amount differs from round(quantity * unit_price, 2) by more than 0.01."""
    i = _models(spark, sf_dir).stg_order_items
    exp = line_amount("quantity", "unit_price")
    return i.select("item_id", "order_id", "quantity", "unit_price", "amount", exp.alias("expected_amount"),
                    (F.col("amount") - exp).alias("difference")).filter(
        F.abs(F.col("difference")) > F.lit(0.01).cast("decimal(18,2)"))


# ---------------------------------------------------------------- models
def _model(name):
    @query(name)
    def q(spark, sf_dir):
        return getattr(_models(spark, sf_dir), name)
    q.__doc__ = f"Model {name}."
    return q


for _n in ["stg_orders", "stg_order_items", "stg_customers", "stg_products", "stg_marketing_events",
           "int_orders_enriched", "int_order_items_enriched", "int_regional_daily", "dim_customers",
           "dim_products", "fact_orders", "fact_order_items", "rpt_daily_kpis"]:
    _model(_n)


@query("int_orders_enriched_as_loaded")
def q_int_orders_as_loaded(spark, sf_dir):
    """G6 exactly as the source SQL on the customer load history (one row per order and customer load)."""
    return Models.from_test_tables(spark, sf_dir, dedupe_dimensions=False).int_orders_enriched


@query("fact_order_items_as_loaded")
def q_items_as_loaded(spark, sf_dir):
    """G12 exactly as the source SQL on the product load history (a line per product load and active product load)."""
    return Models.from_test_tables(spark, sf_dir, dedupe_dimensions=False).fact_order_items


@query("rpt_daily_kpis_as_loaded")
def q_kpis_as_loaded(spark, sf_dir):
    """G13 exactly as the source SQL on the load history (order counts include the customer fan-out)."""
    return Models.from_test_tables(spark, sf_dir, dedupe_dimensions=False).rpt_daily_kpis


@query("orders_daily_agg")
def q_orders_daily(spark, sf_dir):
    """Per region and day counts, sums, average and distinct customers."""
    return orders_daily_agg(_models(spark, sf_dir).int_orders_enriched)


@query("marketing_daily_agg")
def q_marketing_daily(spark, sf_dir):
    """Event types pivoted into conditional counts."""
    return marketing_daily_agg(_models(spark, sf_dir).stg_marketing_events)


@query("order_mix_daily")
def q_order_mix(spark, sf_dir):
    """Continent, gold orders and promo share per region and day."""
    return order_mix_daily(_models(spark, sf_dir).fact_orders)


@query("order_totals_from_items")
def q_order_totals(spark, sf_dir):
    """Order total as the sum of its lines."""
    return detectors.line_totals(_models(spark, sf_dir).stg_order_items)


# ---------------------------------------------------------------- windows / dedup / sampling
@query("latest_by_key")
def q_latest_by_key(spark, sf_dir):
    """Latest customer row per key over the append-only load history."""
    return latest_by_key(adapter.raw_customer(spark, sf_dir), ["customer_id"], ["_loaded_at"])


@query("revenue_contribution")
def q_revenue_contribution(spark, sf_dir):
    """Each line's share of its order's amount."""
    i = _models(spark, sf_dir).stg_order_items.select("item_id", "order_id", "amount")
    return with_share_of_group(i, "amount", ["order_id"], "revenue_contribution", keys_nullable=False)


@query("rolling_7row_avg")
def q_rolling(spark, sf_dir):
    """Seven-row rolling means per region (row frame, gaps not filled)."""
    d = _models(spark, sf_dir).int_regional_daily
    return d.select("region", "order_date", "avg_order_value", "gross_revenue",
                    rolling_avg("avg_order_value", ["region"], "order_date").alias("avg_order_value_7d_avg"),
                    rolling_avg("gross_revenue", ["region"], "order_date").alias("gross_revenue_7d_avg"))


@query("deterministic_sample")
def q_sample(spark, sf_dir):
    """seeded fixed-size 2% sample of each landing batch."""
    o = _models(spark, sf_dir).stg_orders
    s = deterministic_sample(o, "order_id", DQ_RATES["duplicate_order_rate"], SAMPLE_SEED,
                             group_by=["_source_file"])
    return s.select("_source_file", "order_id", "customer_id", "region", "total_amount")


# ---------------------------------------------------------------- checks
def _union(dfs):
    return reduce(lambda a, b: a.unionByName(b), dfs)


@query("check_not_null")
def q_not_null(spark, sf_dir):
    """H1: the 17 declared not-null tests, one aggregation pass per model."""
    ms = models_of(_models(spark, sf_dir))
    r = _union([checks.not_null_counts(ms[m], cols, m) for m, cols in NOT_NULL_TESTS.items()])
    return r.withColumn("passed", F.col("n_null") == 0)


@query("check_unique")
def q_unique(spark, sf_dir):
    """H2: values violating the 8 declared unique tests."""
    ms = models_of(_models(spark, sf_dir))
    return _union([checks.unique(ms[m], c, m) for m, c in UNIQUE_TESTS])


@query("check_accepted_values")
def q_accepted(spark, sf_dir):
    """H3: values outside the 3 declared accepted-value lists."""
    ms = models_of(_models(spark, sf_dir))
    return _union([checks.accepted_values(ms[m], c, v, m) for m, c, v in ACCEPTED_TESTS])


@query("check_funnel_monotonicity")
def q_funnel_mono(spark, sf_dir):
    """H4: KPI rows with more clicks than impressions or more purchases than clicks."""
    return checks.funnel_monotonicity(_models(spark, sf_dir).rpt_daily_kpis)


@query("check_no_orphaned_orders")
def q_no_orphans(spark, sf_dir):
    """H5: order facts without item facts."""
    m = _models(spark, sf_dir)
    return checks.orphans(m.fact_orders.select("order_id"), m.fact_order_items, "order_id")


@query("check_revenue_reconciliation")
def q_reconciliation(spark, sf_dir):
    """H6: header vs joined line sum, tolerance 0.01 (join-then-sum shape)."""
    m = _models(spark, sf_dir)
    return checks.reconcile_join_then_sum(m.fact_orders, m.fact_order_items, "order_id", "total_amount", "amount")


@query("check_total_reconciliation")
def q_total_reconciliation(spark, sf_dir):
    """H7: fact_orders.total_amount grand total vs stg_orders.total_amount."""
    m = _models(spark, sf_dir)
    return checks.total_reconcile(m.fact_orders, "total_amount", m.stg_orders, "total_amount")


@query("check_revenue_not_negative")
def q_not_negative(spark, sf_dir):
    """H8: KPI rows with negative gross revenue, and the order headers with a negative total behind them."""
    m = _models(spark, sf_dir)
    k = checks.not_negative(m.rpt_daily_kpis, "gross_revenue").select(
        F.lit("rpt_daily_kpis").alias("model"), F.col("report_date").alias("day"), "region", F.lit(None).cast("string").alias("order_id"),
        F.col("gross_revenue").cast("decimal(38,2)").alias("revenue"))
    o = checks.not_negative(m.fact_orders, "total_amount").select(
        F.lit("fact_orders").alias("model"), F.col("order_date").alias("day"), "region", "order_id",
        F.col("total_amount").cast("decimal(38,2)").alias("revenue"))
    return k.unionByName(o)


@query("data_tests")
def q_data_tests(spark, sf_dir):
    """H1-H8 as a test run: one row per declared test with its failure count and status."""
    return run_data_tests(_models(spark, sf_dir))


@query("tests_while_writing")
def q_tests_while_writing(spark, sf_dir):
    """H1-H8 while the marts are published: the same report as ``data_tests``, null and row tests of marts counted during the write."""
    return build_and_test(_models(spark, sf_dir), unique_path(spark, "marts"))[1]


def _batches(spark, sf_dir):
    """Region, date and hour of the landed rows, from the files' paths."""
    return read_landing(spark, ensure_landing(spark, sf_dir), "orders").select("region", "date", "hour")


@query("region_manifest")
def q_manifest(spark, sf_dir):
    """Rows landed per region for every hour asked for, hours without any included."""
    return gates.region_manifest(_batches(spark, sf_dir), since=HOURS[0], until=HOURS[1])


@query("hour_completeness")
def q_completeness(spark, sf_dir):
    """Regions landed per hour asked for, complete flag, missing and unexpected regions."""
    return gates.hour_completeness(_batches(spark, sf_dir), since=HOURS[0], until=HOURS[1])


@query("non_empty_load")
def q_non_empty(spark, sf_dir):
    """Rows loaded into each raw table on one day, 0 and not passed where nothing was."""
    r = adapter.raw_tables(spark, sf_dir)
    return gates.non_empty_load({"raw_order": r.orders, "raw_order_item": r.order_items, "raw_customer": r.customers,
                                 "raw_product": r.products, "raw_marketing_event": r.marketing_events}, "2024-01-15")


@query("referential_subset")
def q_ref_subset(spark, sf_dir):
    """Item rows whose product isn't among the active products (latest load)."""
    m = _models(spark, sf_dir)
    return checks.orphans(m.stg_order_items.select("item_id", "product_id"), m.dim_products, "product_id")


# ---------------------------------------------------------------- detectors
@query("dq_duplicate_orders")
def q_dq_dup(spark, sf_dir):
    o = _models(spark, sf_dir).stg_orders
    return detectors.duplicate_orders(o).select("order_id", "n_copies", "customer_id", "region", "total_amount")


@query("dq_null_customer")
def q_dq_null(spark, sf_dir):
    return detectors.null_customer(_models(spark, sf_dir).stg_orders).select("order_id", "region", "total_amount")


@query("dq_negative_revenue")
def q_dq_neg(spark, sf_dir):
    return detectors.negative_revenue(_models(spark, sf_dir).stg_orders).select("order_id", "region",
                                                                                 "total_amount")


@query("dq_revenue_mismatch")
def q_dq_mismatch(spark, sf_dir):
    m = _models(spark, sf_dir)
    return detectors.revenue_mismatch(m.stg_orders, m.stg_order_items).select(
        "order_id", "total_amount", "items_total", "n_lines", "header_to_lines")


@query("dq_orphan_orders")
def q_dq_orphan(spark, sf_dir):
    m = _models(spark, sf_dir)
    return detectors.orphan_orders(m.stg_orders, m.stg_order_items).select("order_id", "region", "total_amount")


@query("dq_invalid_currency")
def q_dq_currency(spark, sf_dir):
    o = _models(spark, sf_dir).stg_orders
    return detectors.invalid_currency(o).select("order_id", "region", "currency", "expected_currency")


@query("dq_scorecard")
def q_dq_scorecard(spark, sf_dir):
    """One pass over orders and lines -> affected orders, observed and configured rates."""
    m = _models(spark, sf_dir)
    return detectors.dq_scorecard(m.stg_orders, m.stg_order_items)


# ---------------------------------------------------------------- volume
@query("local_time_orders")
def q_local_time(spark, sf_dir):
    o = _models(spark, sf_dir).stg_orders.select("order_id", "region", "created_at")
    return volume.with_local_time(o)


def _calendar(orders):
    return volume.holiday_calendar(volume.years_of(orders))


@query("holiday_calendar")
def q_holidays(spark, sf_dir):
    """Per-region holiday multipliers for every year the orders touch (local calendar)."""
    return _calendar(_models(spark, sf_dir).stg_orders)


@query("expected_volume")
def q_expected_volume(spark, sf_dir):
    """Expected orders per region and observed UTC hour."""
    o = _models(spark, sf_dir).stg_orders
    hours = volume.hourly_actuals(o).select("region", "hour_ts")
    return volume.expected_volume(hours, _calendar(o))


@query("volume_anomaly")
def q_volume_anomaly(spark, sf_dir):
    """Actual hourly orders vs the expected band (+/-15%, widened by 0.5)."""
    o = _models(spark, sf_dir).stg_orders
    return volume.volume_anomaly(volume.hourly_actuals(o), _calendar(o))


@query("materialised_kpis")
def q_materialised(spark, sf_dir):
    """The KPI table rebuilt as a published table in the shared folder, read back."""
    return materialise(_models(spark, sf_dir), unique_path(spark, "marts"), ["rpt_daily_kpis"])["rpt_daily_kpis"]


# ---------------------------------------------------------------- streaming
def _streamed(spark, sf_dir, entity):
    base = ensure_landing(spark, sf_dir, entity)
    run = unique_path(spark, "ingest")
    run_ingest(spark, base, entity, f"{run}/table", f"{run}/checkpoint")
    t = spark.read.schema(ingested_schema(entity)).parquet(f"{run}/table")
    return t.drop("_loaded_at").withColumn("_source_file", partition_dir())


@query("streaming_ingest")
def q_streaming(spark, sf_dir):
    """availableNow incremental ingest of the landing files into a partitioned table."""
    return _streamed(spark, sf_dir, "orders")


def _stream(entity):
    @query(f"streaming_ingest_{entity}")
    def q(spark, sf_dir):
        return _streamed(spark, sf_dir, entity)
    q.__doc__ = f"I15: the same ingest of {entity}."


for _e in adapter.RAW_ENTITIES[1:]:
    _stream(_e)
