"""Date coarsening that keeps the input type and never raises."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def coarsen(column: str, dtype: T.DataType, unit: str) -> Column:
    """Truncate ``column`` to ``unit`` ('hour' or 'month').

    * TIMESTAMP_NTZ: rebuilt with ``make_timestamp_ntz`` -- no time zone involved.
    * TIMESTAMP: ``date_trunc`` in the session time zone.
    * DATE: month -> first day of month; hour -> unchanged.
    * anything else (strings): ``try_cast`` to TIMESTAMP first, so invalid
      text becomes NULL instead of failing the job under ANSI mode."""
    c = F.col(column)
    if unit not in ("hour", "month"):
        raise ValueError(f"unsupported unit {unit!r}")
    if isinstance(dtype, T.TimestampNTZType):
        day = F.dayofmonth(c) if unit == "hour" else F.lit(1)
        hour = F.hour(c) if unit == "hour" else F.lit(0)
        return F.make_timestamp_ntz(F.year(c), F.month(c), day, hour, F.lit(0), F.lit(0))
    if isinstance(dtype, T.TimestampType):
        return F.date_trunc(unit, c)
    if isinstance(dtype, T.DateType):
        return F.trunc(c, "month") if unit == "month" else c
    return F.date_trunc(unit, c.try_cast("timestamp"))
