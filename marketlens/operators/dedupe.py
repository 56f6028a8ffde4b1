"""Latest-row-per-key and deterministic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.operators.joins import attach_by_key
from marketlens.session import unique_path


def latest_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ("_loaded_at",),
                  tie_break: Sequence[str] | None = None) -> DataFrame:
    """Keep the row with the greatest ``order_by`` per key (QUALIFY row_number() = 1, DESC).

    Expressed as ``max(struct(order_by, tie_break, rest))`` per key instead of a
    window: the aggregate combines map-side, so a key holding a large share
    of the rows is reduced to one row per input partition before the shuffle,
    and no task ever buffers a whole key group. A struct of strings needs a
    sort-based aggregate, which sorts the rows of a partition by key (and
    spills) on either side of the shuffle. Ties on ``order_by`` are broken
    by ``tie_break`` and then every remaining column, so the result is
    deterministic. NULL ``order_by`` values lose (DESC NULLS LAST): a row whose
    load time is unknown never replaces one with a known load time.
    """
    keys = list(keys)
    order = list(order_by)
    tie = list(tie_break) if tie_break is not None else []
    rest = [c for c in df.columns if c not in keys and c not in order and c not in tie]
    fields = order + tie + rest
    packed = F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(fields)])
    agg = df.groupBy(*keys).agg(F.max(packed).alias("_latest"))
    out = agg.select(*keys, *[F.col(f"_latest.f{i}").alias(c) for i, c in enumerate(fields)])
    return out.select(*df.columns)


#: Numbers of a row's place in a sample's order: 128 bits of the key's MD5 in three, and 48 bits of the row's hash.
_PLACES, _WIDTH = 4, 1 << 48


def _places(key: str, seed: int, cols: Sequence[str]) -> Column:
    md5 = F.coalesce(F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed)))), F.lit("0" * 32))
    row = F.lpad(F.hex(F.xxhash64(*[F.col(c) for c in cols]).bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    parts = [F.substring(md5, 1, 12), F.substring(md5, 13, 12), F.rpad(F.substring(md5, 25, 8), 12, "0"), F.substring(row, 1, 12)]
    return F.array(*[F.conv(p, 16, 10).cast("long") for p in parts])


def _finer(x: DataFrame, edge: DataFrame, g: list[str], bins: int) -> DataFrame:
    """For each group of ``edge`` the one of ``bins`` equal parts of its range in which its last sampled row lies."""
    # a range of one value goes on with the next number of the place
    done = F.col("hi") - F.col("lo") == 1
    at = edge.select(*g, (F.col("j") + done.cast("int")).alias("j"), F.when(done, F.concat("path", F.array("lo"))).otherwise(F.col("path")).alias("path"),
                     F.when(done, F.lit(0)).otherwise(F.col("lo")).cast("long").alias("lo"),
                     F.when(done, F.lit(_WIDTH)).otherwise(F.col("hi")).cast("long").alias("hi"), "need")
    here = attach_by_key(x, at, g, ["j", "path", "lo", "hi", "need"], how="inner", null_safe=True).filter(_inside())
    bin_ = F.expr("(get(_place, j) - lo) * {0} div (hi - lo)".format(bins))
    per = here.groupBy(*g, "j", "path", "lo", "hi", "need", bin_.alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("_t").alias("low_t"), F.max("_t").alias("high_t"))
    per = per.withColumn("upto", F.sum("rows").over(Window.partitionBy(*g).orderBy("bin")))
    before = F.col("upto") - F.col("rows")
    edge_at = F.expr(f"lo + (bin * (hi - lo) + {bins - 1}) div {bins}"), F.expr(f"lo + ((bin + 1) * (hi - lo) + {bins - 1}) div {bins}")
    return per.filter((F.col("upto") >= F.col("need")) & (before < F.col("need"))).select(
        *g, "j", "path", edge_at[0].cast("long").alias("lo"), edge_at[1].cast("long").alias("hi"), (F.col("need") - before).alias("need"), "rows",
        (F.col("low_t") == F.col("high_t")).alias("alike"))


def _inside() -> Column:
    return (F.slice("_place", F.lit(1), F.col("j")) == F.col("path")) & F.expr("get(_place, j) >= lo AND get(_place, j) < hi")


def deterministic_sample(df: DataFrame, key: str, rate: float, seed: int, group_by: Sequence[str] = (), bins: int = 1024,
                         bin_rows: int = 65536) -> DataFrame:
    """Fixed-size seeded sample: k = max(1, round_half_even(n * rate)) rows per group, 0 if empty.

    Rows are ordered by (md5(key || seed), row hash), which does not depend on partitioning or task retries,
    unlike ``sample()``; the first k rows of each group are kept. Exact, without a group or a key in one task:

    1. a histogram: rows per group and bin of the key hash (``bins`` equal ranges; counted map-side), which gives each
       group's n, k and the bin in which the k-th row lies;
    2. while such a bin holds over ``bin_rows`` rows that aren't all copies of one, its rows alone are counted again in ``bins`` ranges of it, on
       through the key hash and the row hash; each level is a job, and their number grows with the logarithm of the rows;
    3. rows before the bin are kept and rows after it dropped, early in the last scan; in it distinct rows are counted, so that identical
       copies are one row, and ranked up to k.

    The bins of all groups are a small table in the shared folder; only their largest size comes to the driver.
    """
    if bins < 1:
        raise ValueError("a level has one bin at least")
    spark, cols, g = df.sparkSession, df.columns, list(group_by)
    if not g:  # one group: a constant key keeps the same plan shape (no cross join)
        df, g = df.withColumn("_all", F.lit(0)), ["_all"]
    x = df.withColumn("_place", _places(key, seed, cols)).withColumn("_t", F.xxhash64(*[F.col(c) for c in cols]))

    def kept(edge: DataFrame) -> DataFrame:
        path = unique_path(spark, "sample")
        edge.write.parquet(path)
        return spark.read.schema(edge.schema).parquet(path)

    first = F.expr(f"get(_place, 0) * {bins} div {_WIDTH}L")
    per = x.groupBy(*g, first.alias("bin")).agg(F.count(F.lit(1)).alias("rows"), F.min("_t").alias("low_t"), F.max("_t").alias("high_t"))
    per = per.withColumn("upto", F.sum("rows").over(Window.partitionBy(*g).orderBy("bin"))).withColumn(
        "n", F.sum("rows").over(Window.partitionBy(*g)))
    k = F.greatest(F.lit(1), F.bround(F.col("n") * F.lit(rate), 0).cast("bigint"))
    before = F.col("upto") - F.col("rows")
    low, high = F.expr(f"(bin * {_WIDTH}L + {bins - 1}) div {bins}"), F.expr(f"((bin + 1) * {_WIDTH}L + {bins - 1}) div {bins}")
    edge = kept(per.filter((F.col("upto") >= k) & (before < k)).select(
        *g, F.lit(0).alias("j"), F.array().cast("array<bigint>").alias("path"), low.cast("long").alias("lo"), high.cast("long").alias("hi"),
        (k - before).alias("need"), "rows", (F.col("low_t") == F.col("high_t")).alias("alike")))
    large = (F.col("rows") > bin_rows) & ~F.col("alike") & ~((F.col("j") == _PLACES - 1) & (F.col("hi") - F.col("lo") == 1))
    while bins > 1 and (edge.agg(F.max(F.when(large, F.col("rows")))).first()[0] or 0) > 0:
        edge = kept(edge.filter(~large).unionByName(_finer(x, edge.filter(large), g, bins)))

    x = attach_by_key(x, edge, g, ["j", "path", "lo", "hi", "need"], how="inner", null_safe=True)
    head = F.slice("_place", F.lit(1), F.col("j"))
    ahead = (head < F.col("path")) | ((head == F.col("path")) & F.expr("get(_place, j) < lo"))
    whole = x.filter(ahead).select(*cols)
    distinct = x.filter(_inside()).groupBy(*df.columns, "_place", "_t", "need").agg(F.count(F.lit(1)).alias("_copies"))
    upto = Window.partitionBy(*g).orderBy("_place", "_t").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("need") - F.coalesce(F.sum("_copies").over(upto), F.lit(0))
    taken = distinct.withColumn("_take", F.least(left, F.col("_copies"))).filter("_take > 0")
    taken = taken.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_take"))))
    return whole.unionByName(taken.select(*cols))
