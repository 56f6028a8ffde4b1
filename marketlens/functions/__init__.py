"""Column-level functions (JVM-side expressions, no Python UDFs)."""

from marketlens.functions.scalars import (  # noqa: F401
    div_nullif_zero,
    hour_floor,
    line_amount,
    lookup,
    safe_divide,
    surrogate_key,
    to_local,
)
from marketlens.functions.calendar import last_weekday, nth_weekday  # noqa: F401
