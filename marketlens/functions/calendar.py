"""Calendar rules as date expressions (evaluated per row on executors)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY = ["MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN"]


def nth_weekday(year, month: int, weekday: int, n: int) -> Column:
    """n-th (1-based) ``weekday`` (0 = Monday) of ``month`` in ``year``.

    next_day() returns the first matching day strictly after its argument, so
    start from the last day of the previous month.
    """
    first = F.make_date(year, F.lit(month), F.lit(1))
    return F.date_add(F.next_day(F.date_sub(first, 1), _DAY[weekday]), 7 * (n - 1))


def last_weekday(year, month: int, weekday: int) -> Column:
    """Last ``weekday`` (0 = Monday) of ``month`` in ``year``."""
    last = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
    return F.date_sub(F.next_day(last, _DAY[weekday]), 7)

