"""Join helpers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def own_exchange(stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``stats`` (one row per key) dealt out so that a join on ``keys`` shuffles it again.

    Adaptive execution splits a hot key's rows over several tasks only where both sides of the join
    come straight from a shuffle made for it. An aggregate by the join key is already partitioned by the
    key, so the join would read it without one, and all rows of a hot key would meet in one task. Dealing
    the aggregate out by another expression of the key leaves the join its own shuffle on both sides. It
    costs one more exchange of one row per key.
    """
    return stats.repartition(F.xxhash64(*[F.col(k) for k in keys], F.lit("own exchange")))


def left_lookup(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str],
                right_key: str | None = None) -> DataFrame:
    """``left LEFT JOIN right ON left.key = right.right_key``, adding ``columns``.

    ``right`` has one row per key (a current dimension, usually an aggregate). Rows with a NULL key match
    nothing and keep NULL columns. A key with very many rows, NULL included, is split over several tasks by
    adaptive execution (:func:`own_exchange`); a small ``right`` is broadcast by the planner.
    """
    rk = right_key or key
    r = right.select(F.col(rk).alias("_lk"), *columns)
    return left.join(own_exchange(r, ["_lk"]), F.col(key) == F.col("_lk"), "left").drop("_lk")


def attach_by_key(df: DataFrame, stats: DataFrame, keys: Sequence[str], columns: Sequence[str],
                  how: str = "left", null_safe: bool = False) -> DataFrame:
    """Attach per-key ``columns`` of ``stats`` (one row per key) to every row of ``df``.

    With ``null_safe`` a NULL key is a key like any other. Hot keys: see :func:`own_exchange`. Nothing here is
    random, so a rerun of a lost task deals its rows out as before.
    """
    keys = list(keys)
    names = [f"_sk{i}" for i in range(len(keys))]
    s = stats.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], *columns)
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) if null_safe else F.col(k) == F.col(n)
                                     for k, n in zip(keys, names, strict=True)])
    return df.join(own_exchange(s, names), on, how).drop(*names)
