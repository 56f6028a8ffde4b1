"""Tables published in one step, re-landed files, foreign histories, footers, file manifests and views."""

import dataclasses
import datetime as dt
import glob
import hashlib
import os
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from marketlens.operators import checks, gates
from marketlens.operators.windows import rows_of_a_group_at_most, with_share_of_group
from marketlens.plans import warehouse
from marketlens.plans.data_tests import run_data_tests
from marketlens.plans.warehouse import MART_TABLES, Models, build_and_test, materialise, register_views
from marketlens.schemas import LANDING
from marketlens.session import local_scratch
from marketlens.sources.footers import footers, landing_manifest, list_files
from marketlens.sources.ingest import append_audit, ingest_history, ingest_hour
from marketlens.sources.landing import read_foreign, seed_regions
from marketlens.sources.publish import ATTEMPT, PublishedTable, read_table
from marketlens.sources.relanding import ingest_changes

T = dt.datetime


def table(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---------------------------------------------------------------- publication
def test_readers_see_a_version_whole(spark):
    t = PublishedTable(spark, local_scratch() + "/t")
    with pytest.raises(FileNotFoundError):
        t.read()
    one = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, p string")
    assert t.publish(one, ["p"]) == 1
    before = t.read()
    # a publication that fails between its write and its version file
    attempt, folders = t.write_attempt(one.withColumn("id", F.col("id") * 10), ["p"])
    assert sorted(folders) == ["p=__HIVE_DEFAULT_PARTITION__", "p=a", "p=b"] and table(t.read()) == table(one)
    assert t.publish(spark.createDataFrame([(7, "b")], "id long, p string"), ["p"], replace=[{"p": "a"}]) == 2
    assert table(t.read()) == [(3, None), (7, "b")]
    assert table(before) == table(one) == table(t.read(1))  # a reader of the old version keeps it
    t.publish(spark.createDataFrame([], "id long, p string"), ["p"], replace=[{"p": None}])
    assert table(t.read()) == [(7, "b")]
    t.publish(spark.createDataFrame([], "id long, p string"), ["p"], whole=True)
    assert t.read().count() == 0 and t.read().columns == ["id", "p"] and t.versions() == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        t.publish(one, ["id"])


def test_a_taken_version_number_is_not_overwritten(spark):
    t = PublishedTable(spark, local_scratch() + "/t")
    one, two = (spark.createDataFrame([(i, p)], "id long, p string") for i, p in ((1, "a"), (2, "b")))
    t.publish(one, ["p"])
    attempt, folders = t.write_attempt(two, ["p"])
    real, late = t.versions, iter([[1]])
    t.publish(spark.createDataFrame([(3, "c")], "id long, p string"), ["p"])  # another writer takes number 2
    t.versions = lambda: next(late, None) or real()  # this one still believes in number 1
    assert t.point(two.schema, ["p"], {f: attempt for f in folders}) == 3
    assert table(t.read()) == [(1, "a"), (2, "b"), (3, "c")]


def test_odd_partition_values_and_unpartitioned_tables(spark):
    t = PublishedTable(spark, local_scratch() + "/t")
    values = ["run 2024-01-01T05:00:00+00:00", "a/b=c", "{x}[y]*?", "100%", "é"]
    t.publish(spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, p string"), ["p"])
    assert [r.p for r in t.read().orderBy("id").collect()] == values
    t.publish(spark.createDataFrame([], "id long, p string"), ["p"], replace=[{"p": v} for v in values[:4]])
    assert [r.p for r in t.read().collect()] == ["é"]
    u = PublishedTable(spark, local_scratch() + "/u")
    for i in range(3):
        u.publish(spark.createDataFrame([(i,)], "id long"))
    assert table(u.read()) == [(2,)] and table(u.read(1)) == [(0,)]
    u.write_attempt(spark.createDataFrame([(9,)], "id long"))
    assert u.vacuum(keep=2) == 2 and table(u.read()) == [(2,)] and u.versions() == [2, 3]
    plain = local_scratch() + "/plain"
    spark.range(3).write.parquet(plain)
    assert read_table(spark, plain).count() == 3 and read_table(spark, u.path).count() == 1


def test_rebuilt_marts_keep_their_old_version_readable(spark, smoke_dir):
    base = local_scratch()
    m = Models.from_test_tables(spark, smoke_dir)
    old = materialise(m, base, ["dim_products", "rpt_daily_kpis"])
    n = old["dim_products"].count()
    fewer = Models(dataclasses.replace(m.raw, products=m.raw.products.filter("product_id = '1'")), m.regions)
    new = materialise(fewer, base, ["dim_products"])
    assert new["dim_products"].count() == 1 and old["dim_products"].count() == n > 1
    assert read_table(spark, f"{base}/rpt_daily_kpis").count() == old["rpt_daily_kpis"].count()
    assert sorted(os.listdir(base)) == ["dim_products", "rpt_daily_kpis"]


def test_views_are_queried_by_name(spark, smoke_dir):
    views = register_views(Models.from_test_tables(spark, smoke_dir), prefix="v_")
    assert len(views) == 13 and all(spark.catalog.tableExists(v) for v in views)
    df = spark.sql("SELECT region, count(*) AS n FROM v_stg_orders GROUP BY region")
    assert df.count() > 1 and "o_comment" not in df._jdf.queryExecution().executedPlan().toString()


def test_null_and_row_tests_are_counted_while_writing(spark, smoke_dir):
    from marketlens.plans.data_tests import MODELS, NOT_NULL_TESTS, run_data_tests, write_metrics
    from marketlens.plans.warehouse import MART_TABLES
    one = spark.createDataFrame([(None, 5, 9, 1)], "report_date date, impressions int, clicks int, purchases int").withColumns(
        {"region": F.lit("x"), "gross_revenue": F.lit(-1)})
    counts = one.agg(*write_metrics("rpt_daily_kpis")).first().asDict()
    assert counts == {"not_null.rpt_daily_kpis.report_date": 1, "not_null.rpt_daily_kpis.region": 0, "gross_revenue_not_negative.rpt_daily_kpis": 1,
                      "test_funnel_monotonicity": 1}
    m = Models.from_test_tables(spark, smoke_dir)
    counted = {f"not_null.{t}.{c}": 7 for t in MART_TABLES for c in NOT_NULL_TESTS[t]} | {"test_funnel_monotonicity": 3, "gross_revenue_not_negative.rpt_daily_kpis": 0}
    report = run_data_tests({name: getattr(m, name) for name in MODELS}, counted)
    assert {r.test_id: r.failures for r in report.filter("failures IN (3, 7)").collect()}.items() >= {k: v for k, v in counted.items() if v}.items()
    assert report.count() == 33


def test_the_kpi_table_is_built_from_the_written_order_fact(spark, smoke_dir, monkeypatch):
    read, publish = {}, PublishedTable.publish

    def spy(self, df, *args, **kw):
        read[self.path.rsplit("/", 1)[1]] = df.inputFiles()
        return publish(self, df, *args, **kw)

    monkeypatch.setattr(PublishedTable, "publish", spy)
    m = Models.from_test_tables(spark, smoke_dir)
    out = materialise(m, local_scratch())
    assert any("/fact_orders/" in f for f in read["rpt_daily_kpis"]) and not any("orders_with_customer" in f for x in read.values() for f in x)
    assert table(out["rpt_daily_kpis"]) == table(m.rpt_daily_kpis)
    loaded = Models.from_test_tables(spark, smoke_dir, dedupe_dimensions=False)
    assert table(materialise(loaded, local_scratch(), ["fact_orders", "rpt_daily_kpis"])["rpt_daily_kpis"]) == table(loaded.rpt_daily_kpis)


def shuffle_files(spark):
    names = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return {os.path.basename(f) for f in names if os.path.basename(f).startswith("shuffle_")}


def test_marts_leave_no_shuffle_files(spark, smoke_dir, monkeypatch):
    before, at_start, publish = shuffle_files(spark), {}, PublishedTable.publish

    def gone(kept):
        for _ in range(100):  # they are removed in the background
            if shuffle_files(spark) <= kept:
                return True
            time.sleep(0.1)
        return False

    def spy(self, df, *args, **kw):
        at_start[self.path.rsplit("/", 1)[1]] = time.time()
        return publish(self, df, *args, **kw)

    monkeypatch.setattr(PublishedTable, "publish", spy)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was, out = spark.conf.get(key, None), materialise(Models.from_test_tables(spark, smoke_dir), local_scratch())
    assert gone(before) and spark.conf.get(key, None) == was
    assert list(out) == list(MART_TABLES) and all(out[name].count() for name in MART_TABLES)
    assert max(at_start[t] for t in ("dim_customers", "dim_products", "fact_orders")) < min(at_start["fact_order_items"], at_start["rpt_daily_kpis"])


def test_published_tables_are_compressed_with_zstd_unless_the_session_says_otherwise(spark):
    df, key = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("key")), "spark.sql.parquet.compression.codec"

    def codecs(path):
        PublishedTable(spark, path).publish(df)
        assert PublishedTable(spark, path).read().distinct().count() == 1000
        files = glob.glob(f"{path}/data/**/*.parquet", recursive=True)
        return {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files if pq.ParquetFile(f).metadata.num_rows}

    assert spark.conf.get(key, None) is None and codecs(local_scratch() + "/a") == {"ZSTD"}
    spark.conf.set(key, "gzip")
    try:
        assert codecs(local_scratch() + "/b") == {"GZIP"}
    finally:
        spark.conf.unset(key)


def test_keys_of_the_item_fact_are_not_shuffled(spark):
    from marketlens.plans import intermediate, marts
    T0 = T(2024, 1, 1)
    items = spark.createDataFrame([("i1", "o1", "p1", 1, 2, 2, T0), ("i2", "o1", "p2", 1, 2, 6, T0), ("i3", "o2", "p3", 1, 2, 5, T0),
                                   ("i4", "o3", None, 1, 2, 5, T0), ("i4", "o3", "p9", 1, 2, None, T0)],
                                  "item_id string, order_id string, product_id string, quantity int, unit_price int, amount int, _loaded_at timestamp_ntz")
    products = spark.createDataFrame([("p1", "a", "x", True), ("p2", "b", "y", False), ("p3", "c", "z", None)],
                                     "product_id string, name string, category string, is_active boolean")
    orders = spark.createDataFrame([("o1",), ("o1",), ("o3",), (None,)], "order_id string")
    fact = marts.fact_order_items(intermediate.items_with_product(items, products), orders)
    md5 = {x: hashlib.md5(x.encode()).hexdigest() for x in ("i1", "i2", "i3", "i4", "o1", "o3", "p1")}
    line1, line2 = ((md5[i], i, "o1", md5["o1"], p, md5.get(p), 1, 2, a, a / 8, n, c) for i, p, a, n, c in (("i1", "p1", 2, "a", "x"), ("i2", "p2", 6, "b", "y")))
    rest = [(md5["i3"], "i3", "o2", None, "p3", None, 1, 2, 5, 1.0, "c", "z"), (md5["i4"], "i4", "o3", md5["o3"], None, None, 1, 2, 5, 1.0, None, None),
            (md5["i4"], "i4", "o3", md5["o3"], "p9", None, 1, 2, None, None, None, None)]
    assert sorted(map(repr, map(tuple, fact.collect()))) == sorted(map(repr, [line1, line1, line2, line2, *rest]))
    plan = fact._jdf.queryExecution().sparkPlan().toString().split("\n")
    below = [x for x in plan[1 + next(i for i, x in enumerate(plan) if "Join" in x):] if "md5(" in x and "product_id" not in x]
    assert not below, below
    looked_up = intermediate.items_with_product(items, products)._jdf.queryExecution().sparkPlan().toString().split("Join", 1)[1]
    assert "md5(" not in looked_up


def test_staged_orders_are_computed_once_for_marts_and_tests(spark, smoke_dir, monkeypatch):
    seen, publish = {}, PublishedTable.publish

    def spy(self, df, *args, **kw):
        seen[self.path.rsplit("/", 1)[1]] = df.inputFiles()
        return publish(self, df, *args, **kw)

    monkeypatch.setattr(PublishedTable, "publish", spy)
    m = Models.from_test_tables(spark, smoke_dir)
    _, report = build_and_test(m, local_scratch())
    for name in ("fact_orders", "fact_order_items"):
        assert any("/staged_orders/" in f for f in seen[name]) and not any("orders.parquet" in f for f in seen[name])
    folder = next(f for f in seen["fact_orders"] if "/staged_orders/" in f).rsplit("/", 1)[0].removeprefix("file://")
    assert not os.path.exists(folder) and report.count() == 33  # counted: nothing of the run is read again
    assert table(report) == table(run_data_tests(m))
    monkeypatch.setattr(PublishedTable, "publish", lambda *a, **k: 1 / 0)
    before = set(os.listdir(os.path.dirname(folder)))
    with pytest.raises(ZeroDivisionError):
        build_and_test(m, local_scratch())
    assert set(os.listdir(os.path.dirname(folder))) <= before


def test_share_of_small_groups_is_a_window(spark, smoke_dir, monkeypatch):
    rows = [("a", 1, "1.10"), ("a", 1, "2.20"), ("a", None, "3.00"), (None, 1, "4.00"), (None, 1, None), ("z", 1, "1.00"), ("z", 1, "-1.00"), ("n", 2, None)]
    df = spark.createDataFrame(rows, "k string, j int, v string").withColumn("v", F.col("v").cast("decimal(18,2)"))
    for keys in (["k"], ["k", "j"]):
        assert table(with_share_of_group(df, "v", keys, "s", small_groups=True)) == table(with_share_of_group(df, "v", keys, "s"))
    assert with_share_of_group(df, "v", ["k"], "s", small_groups=True).columns == ["k", "j", "v", "s"]
    assert rows_of_a_group_at_most(df, ["k"], 1) == 8 and 3 <= rows_of_a_group_at_most(df, ["k"]) <= 8
    assert rows_of_a_group_at_most(df.filter("false"), ["k"]) == 0
    plans, publish, loaded = [], PublishedTable.publish, Models.from_test_tables(spark, smoke_dir, dedupe_dimensions=False)

    def spy(self, df, *args, **kw):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return publish(self, df, *args, **kw)

    monkeypatch.setattr(PublishedTable, "publish", spy)
    m, facts = Models.from_test_tables(spark, smoke_dir), []
    for limit, models in ((warehouse.SMALL_ORDER, m), (1, m), (warehouse.SMALL_ORDER, loaded)):  # orders of over ``limit`` lines: as before
        monkeypatch.setattr(warehouse, "SMALL_ORDER", limit)
        facts.append(materialise(models, local_scratch(), ["fact_order_items"])["fact_order_items"])
    assert ["Window" in p for p in plans] == [True, False, False]
    assert table(facts[0]) == table(facts[1]) == table(m.fact_order_items)


def test_repeated_values_are_found_whatever_their_form(spark):
    values = ["0a", "0A", "0a0", "a", "", "zz", "12", "1234", "12.5", "ä1", "00", "0", "000", hashlib.md5(b"1").hexdigest(), hashlib.md5(b"2").hexdigest().upper()]
    rows = [(v,) for i, v in enumerate(values) for _ in range(2 + i)] + [(None,)] * 3 + [("b0",), ("B0",), ("1",), ("01",), ("once",)]
    got = checks.unique(spark.createDataFrame(rows, "v string"), "v", "m")
    assert table(got) == sorted((("m", "v", v, 2 + i) for i, v in enumerate(values)), key=str)
    numbers = checks.unique(spark.createDataFrame([(12,), (12,), (-5,), (-5,), (7,), (None,)], "v int"), "v", "m")
    assert table(numbers) == [("m", "v", "-5", 2), ("m", "v", "12", 2)] and numbers.schema["value"].dataType.simpleString() == "string"
    keys = spark.range(4000).select(F.md5(F.col("id").cast("string")).alias("v"))
    shuffled = checks.unique(keys, "v")._jdf.queryExecution().sparkPlan().toString()
    assert "unhex" in shuffled and checks.unique(keys, "v").count() == 0


# ---------------------------------------------------------------- re-landed files
def land(base, region, date, hour, rows, entity="orders", **types):
    """A file as a foreign writer lands it, in the generator's layout."""
    os.makedirs(folder := f"{base}/region={region}/date={date}/hour={hour}", exist_ok=True)
    names = [n for n in LANDING[entity].fieldNames() if n != "region"]
    cols = {n: [r.get(n) for r in rows] for n in names}
    default = {"created_at": pa.timestamp("us"), "total_amount": pa.float64()}
    pq.write_table(pa.table({n: pa.array(v, types.get(n, default.get(n, pa.string()))) for n, v in cols.items()}), f"{folder}/{entity}.parquet")


def order(i, total=1.0, **more):
    return {"order_id": f"o{i}", "created_at": T(2024, 1, 1, 5), "total_amount": total, "status": "pending", **more}


def test_a_file_overwritten_under_its_name_is_ingested_again(spark):
    base, raw = local_scratch(), local_scratch() + "/raw_order"
    land(base, "us-east", "2024-01-01", "05", [order(1), order(2)])
    land(base, "eu-west", "2024-01-01", "05", [order(3)])
    land(base, "us-east", "2024-01-01", "06", [order(4)])
    assert ingest_changes(spark, base, "orders", raw, "2024-01-01 07:00:00") == [("2024-01-01", "05"), ("2024-01-01", "06")]
    assert ingest_changes(spark, base, "orders", raw, "2024-01-01 08:00:00") == []
    t = PublishedTable(spark, raw)
    assert sorted(r.order_id for r in t.read().collect()) == ["o1", "o2", "o3", "o4"]
    land(base, "us-east", "2024-01-01", "05", [order(1, 5.0), order(2), order(5), order(6)])  # the same name again
    assert ingest_changes(spark, base, "orders", raw, "2024-01-01 09:00:00") == [("2024-01-01", "05")]
    got = {r.order_id: (r.total_amount, str(r._loaded_at)) for r in t.read().collect()}
    assert set(got) == {"o1", "o2", "o3", "o4", "o5", "o6"} and got["o1"] == (5.0, "2024-01-01 09:00:00")
    assert got["o4"][1] == "2024-01-01 07:00:00" and got["o3"][1] == "2024-01-01 09:00:00"
    os.remove(f"{base}/region=us-east/date=2024-01-01/hour=06/orders.parquet")  # withdrawn
    assert ingest_changes(spark, base, "orders", raw, "2024-01-01 10:00:00") == [("2024-01-01", "06")]
    assert "o4" not in {r.order_id for r in t.read().collect()}


def test_a_run_that_ends_before_its_ledger_is_repeated(spark, monkeypatch):
    base, raw = local_scratch(), local_scratch() + "/raw_order"
    land(base, "us-east", "2024-01-01", "05", [order(1)])
    real = PublishedTable.publish

    def fails(self, *args, **kw):
        if self.path.endswith("_ledger"):
            raise RuntimeError("lost")
        return real(self, *args, **kw)

    monkeypatch.setattr(PublishedTable, "publish", fails)
    with pytest.raises(RuntimeError):
        ingest_changes(spark, base, "orders", raw, "2024-01-01 06:00:00")
    monkeypatch.undo()
    assert ingest_changes(spark, base, "orders", raw, "2024-01-01 07:00:00") == [("2024-01-01", "05")]
    assert PublishedTable(spark, raw).read().count() == 1


# ---------------------------------------------------------------- foreign histories
def test_foreign_history_of_mixed_schemas_takes_one_scan_each(spark):
    base, raw = local_scratch(), local_scratch()
    ns = pa.timestamp("ns")
    regions = ["us-east", "us-west", "eu-west", "eu-north", "ap-south", "ap-east", "mars"]
    for i, r in enumerate(regions):
        for h in ("05", "06"):
            kinds = [{}, {"created_at": ns}, {"promo_code": pa.null()}, {"total_amount": pa.int64(), "order_id": pa.large_string()}][(i + int(h)) % 4]
            land(base, r, "2024-01-01", h, [order(f"{r}{h}{j}", 2, promo_code=None if "promo_code" in kinds else f"p{j}") for j in range(3)], **kinds)
    land(base, "us-east", "2024-01-01", "07", [], created_at=ns)  # a file without rows
    df = read_foreign(spark, base, "orders")
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 4
    rows = df.collect()
    assert len(rows) == 42 and {r.region for r in rows} == set(regions)
    assert all(r.created_at == T(2024, 1, 1, 5) and r.total_amount == 2.0 and r.customer_id is None for r in rows)
    assert sum(r.promo_code is None for r in rows) < 42 and {r.hour for r in rows} == {"05", "06"}
    assert all(r._source_file.endswith(f"region={r.region}/date=2024-01-01/hour={r.hour}/orders.parquet") for r in rows)
    ingest_history(spark, base, raw, ["orders"], foreign=True)
    assert read_table(spark, f"{raw}/orders").count() == 42
    n, audit = ingest_hour(spark, base, raw + "/hour", "orders", "2024-01-01", "05", "r", "2024-01-01 06:00:00", foreign=True)
    assert n == 21 and {r.region for r in audit.collect()} == set(regions)
    assert read_foreign(spark, base, "orders", "2024-01-01", "09").count() == 0


# ---------------------------------------------------------------- audit, manifest, footers, gates
def test_audit_rows_stay_once_per_run(spark):
    base, root = local_scratch(), local_scratch()
    land(base, "us-east", "2024-01-01", "05", [order(1), order(2)])
    for run in ("scheduled__2024-01-01T05:00:00+00:00", "manual", "manual"):
        _, audit = ingest_hour(spark, base, root + "/raw", "orders", "2024-01-01", "05", run, "2024-01-01 06:00:00")
        append_audit(spark, root + "/audit", audit, "orders", "2024-01-01", "05", run)
    kept = read_table(spark, root + "/audit")
    assert sorted((r.dag_run_id, r.region, r.sf_actual_rows) for r in kept.collect()) == [
        ("manual", "us-east", 2), ("scheduled__2024-01-01T05:00:00+00:00", "us-east", 2)]
    os.remove(f"{base}/region=us-east/date=2024-01-01/hour=05/orders.parquet")
    n, audit = ingest_hour(spark, base, root + "/raw", "orders", "2024-01-01", "05", "manual", "2024-01-01 07:00:00")
    append_audit(spark, root + "/audit", audit, "orders", "2024-01-01", "05", "manual")
    assert n == 0 and read_table(spark, root + "/raw").count() == 0 and read_table(spark, root + "/audit").count() == 1


def test_manifest_counts_files_not_rows(spark):
    base = local_scratch()
    land(base, "us-east", "2024-01-01", "05", [order(1)])
    land(base, "us-west", "2024-01-01", "05", [])
    os.makedirs(f"{base}/region=eu-west/date=2024-01-01/hour=05")
    land(base, "mars", "2024-01-01", "06", [order(1)])
    files = landing_manifest(spark, base, "orders")
    assert files.count() == 3 and "content" not in files.columns
    m = {(r.hour, r.region): r for r in gates.file_manifest(files, ["us-east", "us-west", "eu-west"], "2024-01-01 05", "2024-01-01 06").collect()}
    assert [m["05", r].present for r in ("us-east", "us-west", "eu-west")] == [True, True, False]
    assert m["06", "mars"].present and not m["06", "mars"].expected and not m["06", "us-east"].present and m["05", "us-west"].n_bytes > 0


def test_footers_tell_counts_and_newest_load(spark):
    path = local_scratch()
    at = [T(2024, 1, 1, h) for h in range(10)]
    pq.write_table(pa.table({"_loaded_at": pa.array(at, pa.timestamp("us")), "x": range(10)}), f"{path}/a.parquet", row_group_size=3)
    pq.write_table(pa.table({"_loaded_at": pa.array([T(2024, 1, 2), None], pa.timestamp("ms")), "x": [1, 2]}), f"{path}/b.parquet")
    pq.write_table(pa.table({"_loaded_at": pa.array([None], pa.timestamp("us")), "x": [1]}), f"{path}/c.parquet")
    feet = {os.path.basename(r.path): r for r in footers(list_files(spark, path), ["X", "y"], "_LOADED_AT").collect()}
    assert [feet[f].n_rows for f in ("a.parquet", "b.parquet", "c.parquet")] == [10, 2, 1]
    assert feet["a.parquet"].kinds == ["x:bigint"] and feet["c.parquet"].known and feet["c.parquet"].newest is None
    pq.write_table(pa.table({"_loaded_at": pa.array([T(2024, 1, 3)], pa.timestamp("us")), "x": [1]}), f"{path}/d.parquet", write_statistics=False)
    empty = local_scratch()
    pq.write_table(pa.table({"_loaded_at": pa.array([], pa.timestamp("us"))}), f"{empty}/a.parquet")
    schema = "_loaded_at timestamp_ntz, x bigint"
    got = {r.source: r for r in gates.gates_from_footers(
        {"t": spark.read.schema(schema).parquet(path), "none": spark.read.schema(schema).parquet(empty)}, "2024-01-03 03:00:00").collect()}
    assert (got["t"].n_rows, got["t"].max_loaded_at, got["t"].age_hours, got["t"].status) == (14, T(2024, 1, 3), 3.0, "warn")
    assert (got["none"].n_rows, got["none"].max_loaded_at, got["none"].status) == (0, None, "error")


def test_recent_rows_pushes_its_filter(spark):
    path = local_scratch() + "/t"
    spark.range(10).select(F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id as int))").alias("_loaded_at")).write.parquet(path)
    df = gates.recent_rows(spark.read.parquet(path), "2024-01-01 09:00:00", 2)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(_loaded_at" in plan
    assert table(df) == [(3, True)] and table(gates.recent_rows(spark.read.parquet(path), "2024-01-03 00:00:00", 2)) == [(0, False)]


def test_models_read_published_raw_tables(spark, smoke_dir):
    from marketlens.sources import adapter
    raw = local_scratch()
    for e in adapter.RAW_ENTITIES:
        PublishedTable(spark, f"{raw}/{e}").publish(getattr(adapter.raw_tables(spark, smoke_dir), e))
    m = Models(adapter.read_raw_tables(spark, raw), seed_regions(spark))
    assert m.rpt_daily_kpis.count() == Models.from_test_tables(spark, smoke_dir).rpt_daily_kpis.count()
    assert ATTEMPT not in m.raw.orders.columns
