"""Scalar Column helpers used by the models."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlens.constants import SURROGATE_NULL, SURROGATE_SEPARATOR


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_divide(a, b, zero: float | None = 0.0) -> Column:
    """Zero-safe ratio as a double.

    NULL operand -> NULL; b == 0 -> ``zero`` (0.0 by default; ``zero=None``
    gives NULL, the ``div0(a, nullif(b, 0))`` shape); otherwise a / b.
    """
    a, b = _c(a).cast("double"), _c(b).cast("double")
    zero_val = F.lit(None).cast("double") if zero is None else F.lit(float(zero))
    return (F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
            .when(b == 0, zero_val)
            .otherwise(a / b))


def div_nullif_zero(a, b) -> Column:
    """a / nullif(b, 0): NULL when the divisor is 0 or NULL."""
    return F.try_divide(_c(a).cast("double"), F.nullif(_c(b).cast("double"), F.lit(0.0)))


def surrogate_key(*cols) -> Column:
    """md5 over the string forms of the key columns, NULL-safe.

    Each key is cast to string with NULL replaced by a fixed sentinel and the
    parts are joined with '-', so (NULL) and ('') hash differently.
    """
    parts = [F.coalesce(_c(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))


def lookup(key, mapping: Mapping, default=None) -> Column:
    """Literal map lookup (fixed small tables stay in the expression, no join)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    v = F.element_at(m, _c(key)) if default is None else F.coalesce(F.element_at(m, _c(key)), F.lit(default))
    return v


def to_local(ts, offset_hours) -> Column:
    """Naive UTC timestamp shifted by a fixed whole-hour offset."""
    return _c(ts) + F.make_dt_interval(F.lit(0), _c(offset_hours).cast("int"))


def hour_floor(ts) -> Column:
    """Start of the hour of a naive (timestamp_ntz) value, without any time-zone conversion.

    ``date_trunc`` goes through the session time zone, so on a non-UTC
    session a wall-clock hour that does not exist locally (DST) would move.
    """
    t = _c(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.lit(0), F.lit(0))


def line_amount(quantity, unit_price) -> Column:
    """round(quantity * unit_price, 2) in exact decimal arithmetic."""
    return F.round(_c(quantity).cast("decimal(18,0)") * _c(unit_price).cast("decimal(18,2)"), 2).cast("decimal(18,2)")
