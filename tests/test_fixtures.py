"""Hand-computed cases (null/zero/duplicate branches the test tables do not reach)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketlens.functions.scalars import div_nullif_zero, safe_divide, surrogate_key
from marketlens.operators import checks, gates, volume
from marketlens.operators.dedupe import deterministic_sample, latest_by_key
from marketlens.operators.windows import rolling_avg, with_share_of_group
from marketlens.plans.intermediate import int_order_items_enriched, int_regional_daily

D = dt.date
T = dt.datetime


def test_safe_ratios(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (None, 0), (1, None)], "a int, b int")
    got = df.select(safe_divide("a", "b").alias("z"), div_nullif_zero("a", "b").alias("n")).collect()
    assert [(r.z, r.n) for r in got] == [(0.5, 0.5), (0.0, None), (None, None), (None, None)]


def _items(spark, rows):
    return spark.createDataFrame(
        [(f"i{i}", o, p, 1, Decimal(a), Decimal(a), T(2024, 1, 1)) for i, (o, p, a) in enumerate(rows)],
        "item_id string, order_id string, product_id string, quantity int, unit_price decimal(18,2), "
        "amount decimal(18,2), _loaded_at timestamp_ntz")


def _products(spark, rows):
    return spark.createDataFrame([(p, f"name {p}", "cat") for p in rows], "product_id string, name string, category string")


def test_revenue_contribution_single_product_rows(spark):
    items = _items(spark, [("o1", "p1", "10.00"), ("o1", "p2", "30.00"), ("o2", "p1", "0.00")])
    got = {(r.order_id, float(r.amount)): r.revenue_contribution
           for r in int_order_items_enriched(items, _products(spark, ["p1", "p2"])).collect()}
    assert float(got[("o1", 10.0)]) == 0.25 and float(got[("o1", 30.0)]) == 0.75
    assert got[("o2", 0.0)] is None


def test_revenue_contribution_duplicated_product_rows(spark):
    items = _items(spark, [("o1", "p1", "10.00"), ("o1", "p2", "30.00")])
    got = sorted(float(r.revenue_contribution)
                 for r in int_order_items_enriched(items, _products(spark, ["p1", "p1", "p2", "p2"])).collect())
    assert got == [0.125, 0.125, 0.375, 0.375]


def test_share_of_group_null_key_forms_one_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0)], "k string, v double")
    got = sorted((r.k or "", r.s) for r in with_share_of_group(df, "v", ["k"], "s").collect())
    assert got == [("", 0.25), ("", 0.75), ("a", 1.0)]


def test_latest_by_key(spark):
    df = spark.createDataFrame([("c1", "bronze", T(2024, 1, 1, 10)), ("c1", "gold", T(2024, 1, 1, 11)),
                                ("c2", "silver", T(2024, 1, 1, 10))], "customer_id string, tier string, _loaded_at timestamp_ntz")
    got = sorted((r.customer_id, r.tier) for r in latest_by_key(df, ["customer_id"]).collect())
    assert got == [("c1", "gold"), ("c2", "silver")]


def test_latest_by_key_null_load_time_loses(spark):
    df = spark.createDataFrame([("c1", "a", None), ("c1", "b", T(2024, 1, 1))],
                               "customer_id string, tier string, _loaded_at timestamp_ntz")
    assert [r.tier for r in latest_by_key(df, ["customer_id"]).collect()] == ["b"]


def test_rolling_seven_rows_gap_not_filled(spark):
    days = [D(2024, 1, d) for d in (1, 2, 3, 4, 6, 7, 8, 9)]
    df = spark.createDataFrame([("r", d, float(i + 1)) for i, d in enumerate(days)], "region string, d date, v double")
    got = [r.a for r in df.select("d", rolling_avg("v", ["region"], "d").alias("a")).orderBy("d").collect()]
    assert got == [1, 1.5, 2, 2.5, 3, 3.5, 4, 5]


def test_regional_daily_left_join_drops_marketing_only_days(spark):
    orders = spark.createDataFrame(
        [("o1", "c1", "us-east", D(2024, 1, 1), "delivered", Decimal("10.00")),
         ("o2", "c2", "us-west", D(2024, 1, 1), "returned", Decimal("20.00"))],
        "order_id string, customer_id string, region string, order_date date, status string, total_amount decimal(18,2)")
    events = spark.createDataFrame(
        [("e1", "us-east", "impression", D(2024, 1, 1)), ("e2", "us-east", "click", D(2024, 1, 2))],
        "event_id string, region string, event_type string, event_date date")
    got = {(r.region, r.order_date): r for r in int_regional_daily(orders, events).collect()}
    assert set(got) == {("us-east", D(2024, 1, 1)), ("us-west", D(2024, 1, 1))}
    w = got[("us-west", D(2024, 1, 1))]
    assert (w.impressions, w.clicks, w.purchases, w.return_rate) == (0, 0, 0, 1.0)
    assert got[("us-east", D(2024, 1, 1))].impressions == 1


def test_accepted_values_null_passes(spark):
    df = spark.createDataFrame([("gold",), (None,), ("platinum",)], "tier string")
    got = [r.value for r in checks.accepted_values(df, "tier", ["bronze", "silver", "gold"]).collect()]
    assert got == ["platinum"]


@pytest.mark.parametrize("header,lines,expected", [
    ("100.00", ["60.00", "40.00"], 0),
    ("100.00", ["60.00", "39.99"], 0),
    ("115.00", ["60.00", "40.00"], 1),
])
def test_reconciliation(spark, header, lines, expected):
    h = spark.createDataFrame([("o1", Decimal(header))], "order_id string, total_amount decimal(18,2)")
    li = spark.createDataFrame([("o1", Decimal(a)) for a in lines], "order_id string, amount decimal(18,2)")
    assert checks.reconcile_join_then_sum(h, li, "order_id", "total_amount", "amount").count() == expected
    assert checks.reconcile(h, li, "order_id", "total_amount", "amount").count() == expected


def test_reconciliation_duplicated_header(spark):
    h = spark.createDataFrame([("o1", Decimal("100.00"))] * 2, "order_id string, total_amount decimal(18,2)")
    li = spark.createDataFrame([("o1", Decimal("60.00")), ("o1", Decimal("40.00"))], "order_id string, amount decimal(18,2)")
    joined = checks.reconcile_join_then_sum(h, li, "order_id", "total_amount", "amount").collect()
    assert len(joined) == 1 and joined[0].items_total == Decimal("200.00")
    assert checks.reconcile(h, li, "order_id", "total_amount", "amount").count() == 0


def test_orphans_and_funnel(spark):
    o = spark.createDataFrame([("o1",), ("o2",)], "order_id string")
    i = spark.createDataFrame([("o1", "i1")], "order_id string, item_id string")
    assert [r.order_id for r in checks.orphans(o, i, "order_id").collect()] == ["o2"]
    k = spark.createDataFrame([(D(2024, 1, 1), "r", 5, 6, 2), (D(2024, 1, 2), "r", 5, 4, 2)],
                              "report_date date, region string, impressions int, clicks int, purchases int")
    assert checks.funnel_monotonicity(k).count() == 1


def test_freshness_pass_warn_error(spark):
    now = "2024-01-31 00:00:00"
    mk = lambda ts: spark.createDataFrame([(ts,)], "_loaded_at timestamp_ntz")
    got = {r.source: r.status for r in gates.freshness(
        {"a": mk(T(2024, 1, 30, 23)), "b": mk(T(2024, 1, 30, 21)), "c": mk(T(2024, 1, 30, 17))}, now).collect()}
    assert got == {"a": "pass", "b": "warn", "c": "error"}
    assert gates.recent_rows(mk(T(2024, 1, 30, 23)), now).collect()[0].passed


def test_completeness_five_of_six(spark):
    regions = ["us-east", "us-west", "eu-west", "eu-central", "apac-au"]
    b = spark.createDataFrame([(r, "2024-01-01", "05") for r in regions], "region string, date string, hour string")
    row = gates.hour_completeness(b).collect()[0]
    assert (row.n_regions, row.is_complete, row.missing_regions) == (5, False, "apac-jp")
    m = {r.region: r.present for r in gates.region_manifest(b).collect()}
    assert m["apac-jp"] is False and sum(m.values()) == 5


def test_completeness_of_a_range_with_absent_hours_and_other_regions(spark):
    b = spark.createDataFrame([("us-east", "2024-01-01", "05"), ("mars", "2024-01-01", "05"), ("mars", "2024-01-01", "06"),
                               (None, "2024-01-01", "06"), ("us-east", "2024-01-01", "09")], "region string, date string, hour string")
    got = {r.hour: r for r in gates.hour_completeness(b, since="2024-01-01 04", until="2024-01-01 07").collect()}
    assert sorted(got) == ["04", "05", "06", "07"]
    assert [(got[h].n_regions, got[h].unexpected_regions) for h in sorted(got)] == [(0, ""), (1, "mars"), (0, "mars,null"), (0, "")]
    assert got["07"].missing_regions.count(",") == 5 and not any(r.is_complete for r in got.values())
    assert sorted(r.hour for r in gates.hour_completeness(b).collect()) == ["05", "06", "09"]
    rows = [(r.hour, r.region, r.n_rows, r.expected) for r in gates.region_manifest(b, since="2024-01-01 06", until="2024-01-01 06").collect()]
    assert ("06", "mars", 1, False) in rows and ("06", None, 1, False) in rows and len(rows) == 8


def test_volume_keeps_unlisted_regions_and_stray_timestamps(spark):
    df = spark.createDataFrame([("us-east", T(2024, 1, 1, 5)), ("mars", T(2024, 1, 1, 6)), (None, T(2024, 1, 1, 7)),
                                ("us-east", T(2199, 1, 1, 0)), ("us-east", None)], "region string, created_at timestamp_ntz")
    act = volume.hourly_actuals(df)
    assert act.count() == 24 * (6 * 2 + 2) and act.groupBy().sum("actual_orders").first()[0] == 4
    out = volume.volume_anomaly(act, volume.holiday_calendar(volume.years_of(df)))
    assert out.count() == act.count()
    odd = out.filter("region = 'mars' OR region IS NULL").collect()
    assert len(odd) == 48 and not any(r.has_baseline or r.is_anomaly for r in odd) and sum(r.actual_orders for r in odd) == 2
    days = volume.hourly_actuals(df, since="2024-01-01", until="2024-01-03").filter("region = 'us-east'")
    assert days.count() == 72 and days.groupBy().sum("actual_orders").first()[0] == 1


def test_scorecard_agrees_with_detectors(spark):
    from marketlens.operators import detectors
    orders = spark.createDataFrame(
        [("o1", "c", "us-east", Decimal("100.00"), "USD"), ("o1", "c", "us-east", Decimal("80.00"), "USD"),
         ("o2", "c", "us-east", Decimal("-5.00"), "USD"), ("o2", "c", "us-east", Decimal("7.00"), "USD"), ("o3", "c", "us-east", Decimal("5.00"), "USD")],
        "order_id string, customer_id string, region string, total_amount decimal(18,2), currency string")
    items = spark.createDataFrame([("o1", Decimal("100.00")), ("o2", Decimal("5.00")), ("o3", Decimal("5.00"))], "order_id string, amount decimal(18,2)")
    n = {r.issue: r.n_affected for r in detectors.dq_scorecard(orders, items).collect()}
    assert n["revenue_mismatch_rate"] == detectors.revenue_mismatch(orders, items).select("order_id").distinct().count() == 2
    empty = detectors.dq_scorecard(orders.limit(0), items).collect()
    assert len(empty) == 6 and all(r.n_affected == 0 and r.observed_rate is None for r in empty)


def test_local_time(spark):
    df = spark.createDataFrame([("us-east", T(2025, 11, 29, 0)), ("apac-au", T(2025, 12, 24, 20))],
                               "region string, created_at timestamp_ntz")
    got = {r.region: (r.local_ts, r.local_hour) for r in volume.with_local_time(df).collect()}
    assert got["us-east"] == (T(2025, 11, 28, 19), 19)
    assert got["apac-au"] == (T(2025, 12, 25, 6), 6)


def test_holiday_calendar(spark):
    years = spark.createDataFrame([(2024,), (2025,), (2026,)], "year int")
    cal = volume.holiday_calendar(years).collect()
    us = {(r.year, r.holiday_name): r.holiday_date for r in cal if r.region == "us-east"}
    expect = {2024: ("11-28", "11-29", "12-02", "05-27", "09-02"), 2025: ("11-27", "11-28", "12-01", "05-26", "09-01"),
              2026: ("11-26", "11-27", "11-30", "05-25", "09-07")}
    for y, dates in expect.items():
        names = ("thanksgiving", "black_friday", "cyber_monday", "memorial_day", "labor_day")
        assert tuple(us[(y, n)].strftime("%m-%d") for n in names) == dates
    gw = sorted((r.holiday_date, round(r.multiplier, 6)) for r in cal if r.region == "apac-jp" and r.year == 2025
                and r.holiday_name.startswith("golden_week"))
    assert [m for _, m in gw] == [0.5, 0.6, 0.7, 0.8, 0.9, 1.0, 1.1]
    assert gw[0][0] == D(2025, 4, 29) and gw[-1][0] == D(2025, 5, 5)
    per_region = {}
    for r in cal:
        if r.year == 2025:
            per_region[r.region] = per_region.get(r.region, 0) + 1
    assert per_region == {"us-east": 9, "us-west": 9, "eu-west": 7, "eu-central": 6, "apac-au": 8, "apac-jp": 14}


def test_nth_weekday_matches_python_rule(spark):
    import calendar

    from marketlens.functions.calendar import last_weekday, nth_weekday
    years = spark.range(1990, 2060).select(F.col("id").cast("int").alias("y"))
    got = years.select("y", nth_weekday(F.col("y"), 11, 3, 4).alias("tg"), last_weekday(F.col("y"), 5, 0).alias("md")).collect()
    for r in got:
        first = dt.date(r.y, 11, 1)
        tg = first + dt.timedelta(days=(3 - first.weekday()) % 7 + 21)
        last = dt.date(r.y, 5, calendar.monthrange(r.y, 5)[1])
        md = last - dt.timedelta(days=(last.weekday() - 0) % 7)
        assert (r.tg, r.md) == (tg, md)


@pytest.mark.parametrize("region,ts,expected", [
    ("us-east", T(2025, 6, 1, 14), 138.6), ("us-west", T(2025, 6, 1, 14), 29.7), ("eu-west", T(2025, 6, 1, 14), 168.3),
    ("eu-central", T(2025, 6, 1, 14), 168.3), ("apac-au", T(2025, 6, 1, 14), 19.8), ("apac-jp", T(2025, 6, 1, 14), 108.9),
    ("eu-west", T(2025, 3, 15, 9), 159.6), ("us-east", T(2025, 11, 29, 0), 2138.4), ("apac-au", T(2025, 12, 24, 20), 7.98),
])
def test_expected_volume(spark, region, ts, expected):
    hours = spark.createDataFrame([(region, ts)], "region string, hour_ts timestamp_ntz")
    cal = volume.holiday_calendar(spark.createDataFrame([(2025,)], "year int"))
    r = volume.expected_volume(hours, cal).collect()[0]
    assert r.expected_orders == pytest.approx(expected)
    assert r.lower_bound == pytest.approx(expected * 0.85) and r.upper_bound == pytest.approx(expected * 1.15)


def test_surrogate_key_null_safe(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string")
    k = [r.k for r in df.select(surrogate_key("x", "y").alias("k")).collect()]
    assert k[0] != k[1] and all(len(v) == 32 for v in k)


def test_deterministic_sample_size_and_stability(spark):
    df = spark.createDataFrame([(f"o{i}", "b1" if i < 125 else "b2") for i in range(200)], "order_id string, batch string")
    s1 = deterministic_sample(df, "order_id", 0.02, 42, ["batch"])
    sizes = {r.batch: r["count"] for r in s1.groupBy("batch").count().collect()}
    assert sizes == {"b1": 2, "b2": 2}  # round-half-even(2.5) = 2; max(1, round(1.5)) = 2
    s2 = deterministic_sample(df.repartition(7), "order_id", 0.02, 42, ["batch"])
    assert sorted(r.order_id for r in s1.collect()) == sorted(r.order_id for r in s2.collect())


def test_deterministic_sample_split_groups_equal_single_piece(spark, smoke_dir):
    """Cutting groups into many hash pieces gives exactly the same sample as one piece per group."""
    from marketlens.plans.warehouse import Models
    o = Models.from_test_tables(spark, smoke_dir).stg_orders
    whole = deterministic_sample(o, "order_id", 0.02, 42, ["region"], bins=1)
    split = deterministic_sample(o, "order_id", 0.02, 42, ["region"], bins=4096)
    a = sorted(r.order_id for r in whole.collect())
    assert a == sorted(r.order_id for r in split.collect())
    n = {r.region: r["count"] for r in o.groupBy("region").count().collect()}
    assert len(a) == sum(max(1, round(v * 0.02)) for v in n.values())
    single = deterministic_sample(o, "order_id", 0.02, 42, bins=11)
    assert single.count() == max(1, round(o.count() * 0.02))


def test_deterministic_sample_refines_only_large_boundary_bins(spark):
    """One group of all rows, hot keys and copies: bins of at most a set size, and the sample that a plain sort gives."""
    from marketlens.operators import dedupe
    rows = ([("g", f"k{i}", i) for i in range(700)] + [("g", "hot", i) for i in range(900)] + [("g", "same", 1)] * 400 + [("h", None, i) for i in range(90)]
            + [("h", "k", 1)])
    df = spark.createDataFrame(rows, "grp string, order_id string, v int")
    sizes, real = [], dedupe._finer
    try:
        dedupe._finer = lambda x, edge, g, bins: [sizes.append(edge.count()), real(x, edge, g, bins)][1]
        for group, rate in ((["grp"], 0.3), (["grp"], 0.62), ([], 0.5), ([], 0.9)):
            got = sorted(map(str, deterministic_sample(df, "order_id", rate, 42, group, bins=8, bin_rows=16).collect()))
            ordered = df.select("*", F.coalesce(F.md5(F.concat("order_id", F.lit("42"))), F.lit("0")).alias("h"), F.xxhash64("grp", "order_id", "v").alias("t")
                                ).orderBy("h", "t").collect()
            want = []
            for name in {r.grp for r in ordered} if group else {None}:
                mine = [r for r in ordered if name is None or r.grp == name]
                want += mine[:max(1, round(len(mine) * rate))]
            assert got == sorted(str(r)[:str(r).index(", h=")] + ")" for r in want), (group, rate)
    finally:
        dedupe._finer = real
    assert len(sizes) > 8 and max(sizes) <= 2


def test_expected_volume_local_calendar_option(spark):
    # us-east, Sunday 2025-06-01 03:00 UTC is Saturday 22:00 local: weekday 1.10 (UTC) vs 1.20 (local)
    hours = spark.createDataFrame([("us-east", T(2025, 6, 1, 3))], "region string, hour_ts timestamp_ntz")
    cal = volume.holiday_calendar(spark.createDataFrame([(2025,)], "year int"))
    utc = volume.expected_volume(hours, cal).collect()[0]
    loc = volume.expected_volume(hours, cal, local_calendar=True).collect()[0]
    assert (utc.dow_multiplier, loc.dow_multiplier) == (1.10, 1.20)
    assert utc.expected_orders == pytest.approx(200 * 0.95 * 1.10 * 0.90)


def test_non_empty_load_gate_reports_zero_rows(spark):
    a = spark.createDataFrame([(T(2024, 1, 5, 3),)], "_loaded_at timestamp_ntz")
    b = spark.createDataFrame([(T(2024, 1, 4, 3),)], "_loaded_at timestamp_ntz")
    got = {r.table_name: (r.n_rows, r.passed) for r in gates.non_empty_load({"a": a, "b": b}, "2024-01-05").collect()}
    assert got == {"a": (1, True), "b": (0, False)}


def test_sample_of_identical_copies(spark):
    """Copies of one row past the cut: as many as are missing, no more."""
    df = spark.createDataFrame([("g", "same", 1)] * 50 + [("g", f"k{i}", i) for i in range(10)], "grp string, order_id string, v int")
    for rate in (0.1, 0.5, 0.95):
        got = deterministic_sample(df, "order_id", rate, 42, ["grp"]).collect()
        assert len(got) == max(1, round(60 * rate))


def test_hourly_actuals_reports_an_hour_without_orders(spark):
    df = spark.createDataFrame([("us-east", T(2024, 1, 1, 5, 10)), ("us-west", T(2024, 1, 1, 7, 30))],
                               "region string, created_at timestamp_ntz")
    got = {(r.region, r.hour_ts.hour): r.actual_orders for r in volume.hourly_actuals(df, ["us-east", "us-west"]).collect()}
    assert len(got) == 48 and got[("us-east", 6)] == 0 and got[("us-west", 6)] == 0
    assert got[("us-east", 5)] == 1 and got[("us-west", 7)] == 1


def test_hour_floor_ignores_session_time_zone(spark):
    from marketlens.functions.scalars import hour_floor
    df = spark.createDataFrame([(T(2024, 3, 10, 2, 30),)], "ts timestamp_ntz")  # not a New York wall time
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert df.select(hour_floor("ts").alias("h")).collect()[0].h == T(2024, 3, 10, 2, 0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_deterministic_sample_boundary_inside_a_hot_key(spark):
    """A key with many distinct rows straddling the cut: exact against a brute-force sort."""
    rows = [("g", "hot", i) for i in range(60)] + [("g", f"k{i}", i) for i in range(40)]
    df = spark.createDataFrame(rows, "grp string, order_id string, v int")
    for rate in (0.1, 0.37, 0.5, 0.9):
        got = sorted(tuple(r) for r in deterministic_sample(df, "order_id", rate, 42, ["grp"],
                                                            bins=7).collect())
        ordered = (df.select("*", F.md5(F.concat("order_id", F.lit("42"))).alias("h"),
                             F.xxhash64("grp", "order_id", "v").alias("t")).orderBy("h", "order_id", "t").collect())
        k = max(1, round(100 * rate))
        assert got == sorted((r.grp, r.order_id, r.v) for r in ordered[:k]), rate
