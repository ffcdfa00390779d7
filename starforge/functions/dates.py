"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def whole_days_between(later, earlier) -> Column:
    """Whole days from ``earlier`` to ``later``, floored toward -infinity.

    -12 hours is -1 day; +18 hours is 0 days.  NULL if either side is NULL.
    Works on TIMESTAMP and TIMESTAMP_NTZ alike.
    """
    micros = F.timestamp_diff("MICROSECOND", _c(earlier), _c(later))
    return F.floor(micros / F.lit(float(MICROS_PER_DAY))).cast("int")


def date_key(d) -> Column:
    """YYYYMMDD as an integer."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def iso_weekday(d) -> Column:
    """Monday = 1 .. Sunday = 7."""
    return (F.weekday(_c(d)) + 1).cast("int")


def month_start(ts) -> Column:
    """First day of the month of ``ts`` as a DATE."""
    return F.trunc(F.to_date(_c(ts)), "MM")


def months_between_starts(later_month, earlier_month) -> Column:
    """Whole calendar months between two month starts."""
    a, b = _c(later_month), _c(earlier_month)
    return ((F.year(a) - F.year(b)) * 12 + (F.month(a) - F.month(b))).cast("int")
