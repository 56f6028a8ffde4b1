"""Plan-shape and partitioning invariance."""

from marketlens.plans.warehouse import Models
from marketlens.registry import conform


def _rows(df):
    return sorted(tuple((x is None, repr(x)) for x in r) for r in conform(df).collect())


def test_single_pass_kpis_equal_two_pass_shape(spark, smoke_dir):
    m = Models.from_test_tables(spark, smoke_dir)
    a = m.rpt_daily_kpis
    b = m.rpt_daily_kpis_two_pass.select(*a.columns)
    assert _rows(a) == _rows(b)


def test_results_do_not_depend_on_shuffle_partitions(spark, smoke_dir):
    m = Models.from_test_tables(spark, smoke_dir)
    names = ["rpt_daily_kpis", "dim_customers", "fact_order_items"]
    before = {n: _rows(getattr(m, n)) for n in names}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        m2 = Models.from_test_tables(spark, smoke_dir)
        for n in names:
            assert _rows(getattr(m2, n)) == before[n], n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_single_pass_matches_two_pass_with_null_region_and_time(spark, smoke_dir):
    import datetime as dt

    from marketlens.sources import adapter
    from marketlens.sources.landing import seed_regions

    raw = adapter.raw_tables(spark, smoke_dir)
    extra = spark.createDataFrame(
        [("x1", "1", None, dt.datetime(2024, 1, 3, 4), "returned", "USD", "P", 10.0, dt.datetime(2024, 1, 3, 5), "f"),
         ("x2", "2", "us-east", None, "pending", "USD", None, 20.0, dt.datetime(2024, 1, 3, 5), "f"),
         ("x3", None, "mars", dt.datetime(2024, 1, 3, 4), "pending", "USD", None, 30.0, dt.datetime(2024, 1, 3, 5), "f")],
        raw.orders.schema)
    raw.orders = raw.orders.unionByName(extra)
    m = Models(raw, seed_regions(spark))
    a = m.rpt_daily_kpis
    b = m.rpt_daily_kpis_two_pass.select(*a.columns)
    assert _rows(a) == _rows(b)
    assert a.filter("region = 'mars'").count() == 1 and a.filter("region IS NULL").count() == 1


def test_build_and_test_on_written_tables_equals_lazy_test_run(spark, smoke_dir):
    from marketlens.plans.data_tests import run_data_tests
    from marketlens.plans.warehouse import build_and_test
    from marketlens.session import local_scratch
    m = Models.from_test_tables(spark, smoke_dir)
    _, report = build_and_test(m, local_scratch())
    assert _rows(report) == _rows(run_data_tests(Models.from_test_tables(spark, smoke_dir)))
    assert report.count() == 33


def test_kpi_load_time_column_is_optional(spark, smoke_dir):
    from marketlens.plans import reporting
    m = Models.from_test_tables(spark, smoke_dir)
    with_ts = reporting.rpt_daily_kpis_single_pass(m.int_orders_enriched, m.stg_marketing_events, m.regions,
                                                   with_updated_at=True)
    assert with_ts.columns[-1] == "_dbt_updated_at" and "_dbt_updated_at" not in m.rpt_daily_kpis.columns
    assert with_ts.filter("_dbt_updated_at IS NULL").count() == 0
