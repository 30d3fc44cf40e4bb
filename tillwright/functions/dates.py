"""Calendar months as first-of-month dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(day: Column | str) -> Column:
    return F.trunc(day, "MM")


def month_number(day: Column | str) -> Column:
    """Months since year 0: consecutive months differ by one."""
    return F.year(day) * 12 + F.month(day)


def months_apart(later: Column | str, earlier: Column | str) -> Column:
    """Month boundaries between two dates."""
    return month_number(later) - month_number(earlier)
