"""Data-quality checks. Each returns its violating rows; empty means pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null_counts(df: DataFrame, cols: Sequence[str], model: str) -> DataFrame:
    """One pass over ``df``: NULL count per column, unpivoted to (model, column_name, n_null, n_rows)."""
    cols = list(cols)
    agg = df.agg(F.count(F.lit(1)).alias("n_rows"),
                 *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    stack = "stack({n}, {pairs}) as (column_name, n_null)".format(
        n=len(cols), pairs=", ".join(f"'{c}', _n{i}" for i, c in enumerate(cols)))
    return agg.select(F.lit(model).alias("model"), F.expr(stack), "n_rows")


def not_null(df: DataFrame, cols: Sequence[str], model: str = "model") -> DataFrame:
    return not_null_counts(df, cols, model).filter(F.col("n_null") > 0)


def unique(df: DataFrame, col: str, model: str = "model") -> DataFrame:
    """Values of ``col`` that occur more than once (NULLs ignored), with their counts.

    A grouped count: partial counts combine map-side, so a hot value costs
    one row per input partition in the shuffle. Values that are lower-case hex,
    as surrogate keys are, are counted as their bytes: half as much to shuffle.
    """
    v = F.col(col).cast("string")
    packed = F.when((F.length(v) % 2 == 0) & (F.lower(v) == v), F.unhex(v))  # NULL where it isn't hex
    return (df.filter(F.col(col).isNotNull()).select(packed.alias("_packed"), F.when(packed.isNull(), v).alias("_plain"))
            .groupBy("_packed", "_plain").agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)
            .select(F.lit(model).alias("model"), F.lit(col).alias("column_name"),
                    F.coalesce(F.lower(F.hex("_packed")), F.col("_plain")).alias("value"), "n_rows"))


def accepted_values(df: DataFrame, col: str, values: Sequence[str], model: str = "model") -> DataFrame:
    """Counts of values outside ``values`` (NULLs pass)."""
    return (df.filter(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))
            .groupBy(F.col(col).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.lit(model).alias("model"), F.lit(col).alias("column_name"), "value", "n_rows"))


def funnel_monotonicity(kpis: DataFrame) -> DataFrame:
    return kpis.filter((F.col("clicks") > F.col("impressions")) | (F.col("purchases") > F.col("clicks"))).select(
        "report_date", "region", "impressions", "clicks", "purchases")


def orphans(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose ``key`` has no row in ``right`` (anti join; left multiplicity kept).

    The right side is reduced to its distinct non-null keys first (a map-side
    combined aggregate), so a key with very many right rows costs one row in
    the join; the aggregate's key partitioning is reused by the join.
    """
    keys = right.select(key).filter(F.col(key).isNotNull()).distinct()
    return left.join(keys, key, "left_anti")


def reconcile_join_then_sum(header: DataFrame, lines: DataFrame, key: str, total: str, amount: str,
                            tol: float = 0.01) -> DataFrame:
    """Header total vs the sum of its joined lines, grouped by (key, total) after an inner join.

    This is the source test's semantics: duplicated headers or lines multiply
    the line sum. It is computed without materialising the join: for a
    (key, total) group with c identical header rows, the sum over the joined
    rows is c x (sum of the key's lines). Both sides are aggregated per key
    first, so an order with many header or line rows never multiplies rows
    inside one task. Use :func:`reconcile` for the per-order (deduplicated) form.
    """
    h = header.groupBy(key, total).agg(F.count(F.lit(1)).alias("_copies"))
    li = lines.groupBy(key).agg(F.sum(amount).alias("_lines_total"))
    j = h.join(li, key)
    items_total = F.col("_copies").cast("decimal(20,0)") * F.col("_lines_total")
    return (j.select(key, total, items_total.alias("items_total"))
            .filter(F.abs(F.col(total) - F.col("items_total")) > F.lit(tol).cast("decimal(18,2)")))


def reconcile(header: DataFrame, lines: DataFrame, key: str, total: str, amount: str,
              tol: float = 0.01) -> DataFrame:
    """Header vs pre-aggregated line totals: lines are summed per key first (map-side combined)."""
    sums = lines.groupBy(key).agg(F.sum(amount).alias("items_total"), F.count(F.lit(1)).alias("n_lines"))
    j = header.join(sums, key)
    return j.filter(F.abs(F.col(total) - F.col("items_total")) > F.lit(tol).cast("decimal(18,2)"))


def total_reconcile(a: DataFrame, a_col: str, b: DataFrame, b_col: str) -> DataFrame:
    """Grand totals of two columns from two models; one summary row with ``passed``.

    Each side is a single global aggregate (partial sums per task, one merge);
    the two one-row results are combined by union + aggregate, not a join.
    """
    sa = a.agg(F.sum(a_col).alias("v")).select(F.col("v").alias("model_total"),
                                               F.lit(None).cast(a.schema[a_col].dataType).alias("staged_total"))
    sb = b.agg(F.sum(b_col).alias("v")).select(F.lit(None).cast(b.schema[b_col].dataType).alias("model_total"),
                                               F.col("v").alias("staged_total"))
    u = sa.unionByName(sb, allowMissingColumns=False).agg(F.max("model_total").alias("model_total"),
                                                          F.max("staged_total").alias("staged_total"))
    return u.select("model_total", "staged_total",
                    (F.col("model_total") - F.col("staged_total")).alias("difference"),
                    (F.col("model_total") == F.col("staged_total")).alias("passed"))


def not_negative(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col) < 0)


def seed_coverage(seed: DataFrame, key: str, counts: dict[str, DataFrame]) -> DataFrame:
    """Seed rows next to per-key row counts from data tables (full outer joins on the key).

    ``counts`` maps an output column name to a DataFrame whose rows carry
    ``key``; each is reduced to one row per key before joining, so the joins
    are between small aggregates. ``in_seed`` is false for keys seen in the
    data but missing from the seed.
    """
    out = seed.withColumn("_in_seed", F.lit(True))
    for name, df in counts.items():
        c = df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias(name))
        out = out.join(c, out[key].eqNullSafe(c["_k"]), "full").select(
            F.coalesce(out[key], c["_k"]).alias(key), *[out[x] for x in out.columns if x != key], c[name])
    return out.select(*seed.columns, *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in counts],
                      F.coalesce("_in_seed", F.lit(False)).alias("in_seed"))
