"""Date and time column expressions.

All are built-in Catalyst expressions, so they stay inside whole-stage
codegen. Semantics follow pandas:

* elapsed whole days floor the elapsed time, they do not count calendar
  boundaries (``datediff`` would);
* day of week is Monday=0 (``weekday``), not Sunday=1 (``dayofweek``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def as_ts(c: Column | str) -> Column:
    """Parse / widen to a session-zone timestamp.

    The driver's Parquet timestamps load as TIMESTAMP_NTZ; with the session
    zone at UTC the cast is the identity on the wall-clock value.
    """
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("timestamp")


def parse_ts(c: Column | str, fmt: str | None = None) -> Column:
    """String -> timestamp; unparsable text becomes NULL (pandas ``coerce``)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Whole days of elapsed time, floored (pandas ``(a - b).dt.days``)."""
    diff = F.unix_micros(as_ts(later)) - F.unix_micros(as_ts(earlier))
    return F.floor(diff / F.lit(MICROS_PER_DAY)).cast("bigint")


def weekday_mon0(c: Column | str) -> Column:
    """Day of week with Monday=0 .. Sunday=6 (pandas ``dayofweek``)."""
    return F.weekday(as_ts(c)).cast("bigint")


def is_weekend(c: Column | str) -> Column:
    """1 on Saturday and Sunday, else 0."""
    return weekday_mon0(c).isin(5, 6).cast("bigint")


def cyclical(c: Column, period: float) -> tuple[Column, Column]:
    """(sin, cos) of ``2*pi*c/period``."""
    angle = F.lit(2 * math.pi) * c / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def daily_range(start: Column, end: Column) -> Column:
    """Array of every date from start to end inclusive (W8: ``date_range``)."""
    return F.sequence(F.to_date(start), F.to_date(end), F.expr("INTERVAL 1 DAY"))
