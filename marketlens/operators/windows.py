"""Group shares and row-based rolling averages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rows_of_a_group_at_most(df: DataFrame, keys: Sequence[str], buckets: int = 1 << 16) -> int:
    """No group by ``keys`` has more rows than this: the rows of the fullest of ``buckets`` hash buckets (counted map-side)."""
    bucket = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets))
    return df.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


def with_share_of_group(df: DataFrame, value: str, keys: Sequence[str], out: str,
                        keys_nullable: bool | None = None, small_groups: bool = False) -> DataFrame:
    """``value / nullif(sum(value) over (partition by keys), 0)`` as a new double column.

    Computed as a pre-aggregated group total joined back on the keys rather
    than a window: the total is combined map-side, and adaptive execution splits
    a key with very many rows over several tasks (:func:`attach_by_key`); a
    window would hold the whole group in one task. With nullable keys, NULL keys form one
    group via null-safe equality, as in the window form.

    ``small_groups``: the caller knows that a group fits a task (:func:`rows_of_a_group_at_most`); then it is a
    window, which shuffles the rows alone and not the totals three times.
    """
    from marketlens.operators.joins import attach_by_key

    keys = list(keys)
    if small_groups:
        total = F.sum(value).over(Window.partitionBy(*keys))
        return df.withColumn(out, F.col(value).cast("double") / F.nullif(total.cast("double"), F.lit(0.0)))
    if keys_nullable is None:
        keys_nullable = any(df.schema[k].nullable for k in keys)
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_group_total"))
    j = attach_by_key(df, totals, keys, ["_group_total"], null_safe=keys_nullable)
    # the total is summed exactly (decimal stays decimal); the ratio itself is a
    # double: a wide-decimal division per row would run on BigDecimal
    share = F.col(value).cast("double") / F.nullif(F.col("_group_total").cast("double"), F.lit(0.0))
    return j.withColumn(out, share).drop("_group_total")


def rolling_avg(value: str, keys: Sequence[str], order: str, rows: int = 7) -> Column:
    """Mean of the current and ``rows - 1`` preceding rows (row frame, gaps not filled).

    Used only after a daily aggregation, where each partition key has one row
    per day, so the per-key groups are small regardless of input size.
    """
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(rows - 1), Window.currentRow)
    return F.avg(value).over(w)
