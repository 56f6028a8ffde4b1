"""Landing files: six-region union, missing files, empty hour, idempotent rewrite, foreign files."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from marketlens.constants import REGIONS
from marketlens.schemas import LANDING
from marketlens.session import local_scratch
from marketlens.sources.landing import (flagged_load, nanos_to_timestamp, partition_dir, read_foreign_hour, read_landing,
                                        typed_load, with_audit, with_partition_columns, write_hour)
from marketlens.sources.publish import read_table
from marketlens.streaming.ingest import ingested_schema, run_ingest

T = dt.datetime


def _orders(spark, regions, hour=T(2024, 1, 1, 5), n=3):
    rows = [(f"{r}-{i}", f"c{i}", r, hour, "pending", "USD", None, float(i)) for r in regions for i in range(n)]
    return spark.createDataFrame(rows, LANDING["orders"])


def test_six_region_union_and_lineage(spark):
    base = local_scratch()
    write_hour(with_partition_columns(_orders(spark, REGIONS)), f"{base}/orders")
    df = with_audit(read_landing(spark, base, "orders", "2024-01-01", "05"), "2024-01-01 06:00:00")
    assert df.count() == 18
    files = {r._source_file for r in df.select("_source_file").distinct().collect()}
    assert all(f.startswith("file:") and base in f and f.endswith(".parquet") for f in files)
    dirs = {r.d for r in df.select(partition_dir().alias("d")).distinct().collect()}
    assert dirs == {f"region={r}/date=2024-01-01/hour=05" for r in REGIONS}


def test_missing_region_file_is_skipped(spark):
    base = local_scratch()
    write_hour(with_partition_columns(_orders(spark, REGIONS[:5])), f"{base}/orders")
    df = read_landing(spark, base, "orders", "2024-01-01", "05")
    assert {r.region for r in df.select("region").distinct().collect()} == set(REGIONS[:5])


def test_no_file_gives_empty_frame_with_schema(spark):
    base = local_scratch()
    write_hour(with_partition_columns(_orders(spark, REGIONS)), f"{base}/orders")
    df = read_landing(spark, base, "orders", "2024-01-01", "06")
    assert df.count() == 0 and "total_amount" in df.columns


def test_a_base_without_any_landing_raises(spark):
    with pytest.raises(FileNotFoundError):
        read_landing(spark, local_scratch(), "orders", "2024-01-01", "05")


def _generator_layout(spark, base, smoke_dir, hours=3):
    """The five entities of a few hours as the generator lands them: region=R/date=D/hour=HH/{entity}.parquet, one file each."""
    from marketlens.sources import adapter
    counts = {}
    for entity in adapter.RAW_ENTITIES:
        pdf = adapter.landing_entity(spark, smoke_dir, entity).filter(F.col("hour").cast("int") < hours).toPandas()
        counts[entity] = len(pdf)
        for (r, d, h), part in pdf.groupby(["region", "date", "hour"]):
            path = f"{base}/region={r}/date={d}/hour={h}"
            os.makedirs(path, exist_ok=True)
            cols = LANDING[entity].fieldNames()
            table = pa.Table.from_pandas(part[cols], preserve_index=False)
            for i, f in enumerate(table.schema):  # a column without any value keeps its type here
                if pa.types.is_null(f.type):
                    table = table.set_column(i, f.name, table.column(i).cast(pa.string()))
            pq.write_table(table, f"{path}/{entity}.parquet", coerce_timestamps="us")
    return counts


def test_generator_layout_end_to_end(spark, smoke_dir):
    """Landing files in the generator's layout -> scan, batch ingest, stream, models, KPI table."""
    from marketlens.plans.warehouse import Models
    from marketlens.sources.adapter import RAW_ENTITIES, read_raw_tables
    from marketlens.sources.ingest import ingest_history, ingest_hour
    from marketlens.sources.landing import seed_regions
    base, raw = local_scratch(), local_scratch()
    counts = _generator_layout(spark, base, smoke_dir)
    for entity in RAW_ENTITIES:
        df = read_landing(spark, base, entity)
        assert df.count() == counts[entity] > 0 and {"region", "date", "hour"} <= set(df.columns)
    one = read_landing(spark, base, "orders", "2024-01-02", "01", regions=["us-east", "eu-west"])
    assert {r.region for r in one.collect()} <= {"us-east", "eu-west"}
    assert read_landing(spark, base, "orders", "2023-01-01", "00").count() == 0
    ingest_history(spark, base, raw)
    m = Models(read_raw_tables(spark, raw), seed_regions(spark))
    assert m.rpt_daily_kpis.groupBy().sum("total_orders").first()[0] == counts["orders"]
    assert m.stg_orders.filter("_source_file NOT LIKE '%/orders.parquet'").count() == 0
    assert m.raw.order_items.filter("_source_file LIKE '%/order_items.parquet'").count() == counts["order_items"]
    n, audit = ingest_hour(spark, base, f"{raw}/hour", "orders", "2024-01-02", "01", "r", "2024-01-02 02:00:00")
    assert n == sum(r.sf_actual_rows for r in audit.collect()) == read_landing(spark, base, "orders", "2024-01-02", "01").count()
    run_ingest(spark, base, "orders", f"{raw}/stream", f"{raw}/ckpt")
    assert spark.read.schema(ingested_schema("orders")).parquet(f"{raw}/stream").count() == counts["orders"]


def test_nanoseconds_are_cut_to_microseconds(spark):
    df = spark.createDataFrame([(1748786700123456999,), (1748786700123456000,), (None,), (999,)], "n long")
    got = [r.t for r in df.select(nanos_to_timestamp(F.col("n")).alias("t")).collect()]
    assert got == [T(2025, 6, 1, 14, 5, 0, 123456), T(2025, 6, 1, 14, 5, 0, 123456), None, T(1970, 1, 1)]


def test_fractions_round_in_whole_number_columns(spark):
    from pyspark.sql.types import IntegerType, StructField, StructType

    from marketlens.plans.staging import whole
    df = spark.createDataFrame([("2.5",), ("2.4",), ("-2.5",), ("x",), (None,), ("3000000000",)], "q string").coalesce(1)
    flag = flagged_load(df, StructType([StructField("q", IntegerType())]))
    assert [(r.q, r._rejected) for r in flag.collect()] == [(3, False), (2, False), (-3, False), (None, True), (None, False), (None, True)]
    good = spark.createDataFrame([(2.5,), (2.4,), (-2.5,), (None,)], "q double")
    assert [r.q for r in good.select(whole(F.col("q")).alias("q")).collect()] == [3, 2, -3, None]


def test_ingest_audit_counts_unlisted_regions(spark):
    from marketlens.sources.ingest import ingest_hour
    base, raw = local_scratch(), local_scratch() + "/raw_order"
    write_hour(with_partition_columns(_orders(spark, ["us-east", "mars"])), f"{base}/orders")
    n, audit = ingest_hour(spark, base, raw, "orders", "2024-01-01", "05", "r1", "2024-01-01 06:00:00")
    assert n == 6 and {(r.region, r.s3_expected_rows, r.sf_actual_rows) for r in audit.collect()} == {("us-east", 3, 3), ("mars", 3, 3)}


def test_same_hour_written_twice_is_idempotent(spark):
    base = local_scratch()
    src = with_partition_columns(_orders(spark, REGIONS))
    write_hour(src, f"{base}/orders")
    write_hour(src, f"{base}/orders")
    other = with_partition_columns(_orders(spark, REGIONS, hour=T(2024, 1, 1, 6)))
    write_hour(other, f"{base}/orders")  # another hour does not replace the first
    assert read_landing(spark, base, "orders").count() == 36


def test_typed_load_rejects(spark):
    df = spark.createDataFrame([("o1", "3", "x"), ("o2", "abc", "y"), ("o3", None, "z")], "ORDER_ID string, q string, s string")
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType
    schema = StructType([StructField("order_id", StringType()), StructField("q", IntegerType())])
    good, rejects = typed_load(df, schema)
    assert sorted(r.order_id for r in good.collect()) == ["o1", "o3"]
    assert [r.ORDER_ID for r in rejects.collect()] == ["o2"]


def test_foreign_files_ns_timestamps_and_all_null_column(spark):
    base = local_scratch()
    for r, promo in [("us-east", ["P1", None]), ("eu-west", [None, None])]:
        d = f"{base}/orders/region={r}/date=2025-06-01/hour=14"
        os.makedirs(d)
        t = pa.table({"order_id": [f"a-{r}", f"b-{r}"],
                      "created_at": pa.array([1748786700123456789, 1748787000000000000], pa.timestamp("ns")),
                      "promo_code": pa.array(promo, pa.string() if any(promo) else pa.null()),
                      "total_amount": [1.5, 2.5]})
        pq.write_table(t, f"{d}/orders.parquet", coerce_timestamps=None, version="2.6")
    df = read_foreign_hour(spark, base, "orders", "2025-06-01", "14")
    assert spark.conf.get("spark.sql.legacy.parquet.nanosAsLong", "false") == "false"
    rows = {r.order_id: r for r in df.collect()}
    assert len(rows) == 4 and all(r._source_file.endswith("/orders.parquet") for r in rows.values())
    from marketlens.sources.ingest import ingest_hour
    n, audit = ingest_hour(spark, base, local_scratch() + "/raw", "orders", "2025-06-01", "14", "r", "2025-06-01 15:00:00", foreign=True)
    assert n == 4 and {(r.region, r.sf_actual_rows) for r in audit.collect()} == {("us-east", 2), ("eu-west", 2)}
    assert rows["a-us-east"].created_at == T(2025, 6, 1, 14, 5, 0, 123456)
    assert rows["a-us-east"].promo_code == "P1" and rows["a-eu-west"].promo_code is None
    assert dict(df.dtypes)["promo_code"] == "string"


def test_streaming_ingest_rerun_does_not_duplicate(spark):
    base, run = local_scratch(), local_scratch()
    write_hour(with_partition_columns(_orders(spark, REGIONS)), f"{base}/orders")
    sink, ckpt = f"{run}/table", f"{run}/ckpt"
    run_ingest(spark, base, "orders", sink, ckpt)
    run_ingest(spark, base, "orders", sink, ckpt)  # nothing new: no duplicates
    read = lambda: spark.read.schema(ingested_schema("orders")).parquet(sink)
    assert read().count() == 18
    write_hour(with_partition_columns(_orders(spark, REGIONS, hour=T(2024, 1, 1, 6))), f"{base}/orders")
    run_ingest(spark, base, "orders", sink, ckpt)  # only the new hour is added
    assert read().count() == 36
    assert read().filter(partition_dir() == "region=us-east/date=2024-01-01/hour=06").count() == 3


def test_ingest_hour_is_idempotent_and_audited(spark):
    from marketlens.sources.ingest import ingest_hour
    base, raw = local_scratch(), local_scratch() + "/raw_order"
    write_hour(with_partition_columns(_orders(spark, REGIONS)), f"{base}/orders")
    write_hour(with_partition_columns(_orders(spark, REGIONS, hour=T(2024, 1, 1, 6))), f"{base}/orders")
    n1, audit = ingest_hour(spark, base, raw, "orders", "2024-01-01", "05", "r1", "2024-01-01 06:00:00")
    n2, _ = ingest_hour(spark, base, raw, "orders", "2024-01-01", "05", "r2", "2024-01-01 06:10:00")
    n3, _ = ingest_hour(spark, base, raw, "orders", "2024-01-01", "06", "r3", "2024-01-01 07:00:00")
    assert (n1, n2, n3) == (18, 18, 18)
    assert read_table(spark, raw).count() == 36  # the rerun replaced hour 05 instead of appending
    rows = audit.collect()
    assert len(rows) == 6 and all(r.s3_expected_rows == r.sf_actual_rows == 3 for r in rows)
    assert len({r.load_id for r in rows}) == 6


def test_seed_csv_matches_fixed_rows(spark):
    from marketlens.constants import SEED_REGIONS
    from marketlens.sources.landing import read_seed_csv
    d = local_scratch()
    with open(f"{d}/regions.csv", "w") as f:
        f.write("region,continent,timezone_offset\n" + "\n".join(f"{r},{c},{o}" for r, c, o in SEED_REGIONS) + "\n")
    got = [tuple(r) for r in read_seed_csv(spark, f"{d}/regions.csv").collect()]
    assert sorted(got) == sorted(SEED_REGIONS)


def test_streaming_backlog_in_several_bounded_batches(spark):
    from marketlens.streaming.ingest import stream_landing
    base, run = local_scratch(), local_scratch()
    write_hour(with_partition_columns(_orders(spark, REGIONS)), f"{base}/orders")
    write_hour(with_partition_columns(_orders(spark, REGIONS, hour=T(2024, 1, 1, 6))), f"{base}/orders")
    q = stream_landing(spark, base, "orders", f"{run}/t", f"{run}/ck", max_files_per_trigger=4)
    q.awaitTermination()
    assert q.lastProgress is not None and int(q.lastProgress["batchId"]) >= 2  # 12 files, 4 per batch
    assert spark.read.schema(ingested_schema("orders")).parquet(f"{run}/t").count() == 36


def test_rows_are_computed_once_for_a_clustered_write(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return x

    df = spark.range(300, numPartitions=4).select(F.udf(count, "bigint")("id").alias("id"), (F.col("id") % 3).cast("string").alias("date"))
    out = f"{local_scratch()}/t"
    write_hour(df, out, ["date"])
    assert seen.value == 300  # a range partitioning computes them a second time, to sample them
    assert spark.read.parquet(out).groupBy("date").count().count() == 3


def test_a_partition_with_most_rows_is_written_by_several_tasks(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "20k")
    try:
        out = f"{local_scratch()}/t"
        write_hour(spark.range(0, 60000, numPartitions=8).select("id", F.lit("2024-01-01").alias("date")), out, ["date"])
    finally:
        spark.conf.set(key, old) if old else spark.conf.unset(key)
    files = spark.read.parquet(out).select(F.input_file_name().alias("f"), "id")
    assert files.select("f").distinct().count() > 1 and files.select("id").distinct().count() == 60000


def test_without_adaptive_execution_a_write_is_range_partitioned(spark):
    from marketlens.sources.landing import cluster_for_write
    df = spark.range(10).select("id", F.lit("x").alias("date"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "rangepartitioning" in cluster_for_write(df, ["date"])._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "rangepartitioning" not in cluster_for_write(df, ["date"])._jdf.queryExecution().toString()


def test_large_landing_files_are_streamed_without_a_shuffle(spark):
    from marketlens.streaming.ingest import small_files, stream_landing
    base, run = local_scratch(), local_scratch()
    write_hour(with_partition_columns(_orders(spark, REGIONS)), f"{base}/orders")
    assert small_files(spark, base, "orders") and not small_files(spark, base, "orders", 1)
    rows = []
    for small, name in ((1 << 20, "a"), (1, "b")):
        q = stream_landing(spark, base, "orders", f"{run}/{name}", f"{run}/ck{name}", small_file=small)
        q.awaitTermination()
        plan = q._jsq.explainInternal(False)
        assert ("Exchange" in plan) == (name == "a"), plan
        rows.append(sorted(spark.read.schema(ingested_schema("orders")).parquet(f"{run}/{name}").drop("_loaded_at").collect(), key=str))
    assert rows[0] == rows[1] and len(rows[0]) == 18


def test_jobs_at_once_keep_their_order_and_raise(spark):
    import threading
    from marketlens.session import at_once
    gate = threading.Barrier(2, timeout=60)  # passes only if both run at the same time

    def job(n):
        gate.wait()
        return spark.range(n).count()

    assert at_once(spark, [lambda: job(3), lambda: job(5)]) == [3, 5] and at_once(spark, []) == []
    with pytest.raises(ZeroDivisionError):
        at_once(spark, [lambda: 1, lambda: 1 // 0])
