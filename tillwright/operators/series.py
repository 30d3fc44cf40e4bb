"""Monthly series: checks, gaps and the seasonal naive baseline.

`keys` names the series columns; without keys the frame is one series. A series has one row per
month, so windows over it stay small however many order lines there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwright.functions.dates import month_number, months_apart
from tillwright.session import written


def missing_months(monthly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Months absent between the first and last month of each series."""
    following = F.lead("month").over(Window.partitionBy(*keys).orderBy("month"))
    return (
        monthly.select(*keys, F.add_months("month", 1).alias("_first"), F.add_months(following, -1).alias("_last"))
        .filter(F.col("_first") <= F.col("_last"))
        .select(*keys, F.explode(F.expr("sequence(_first, _last, interval 1 month)")).alias("missing_month"))
    )


def duplicate_keys(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    return frame.groupBy(*keys).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def _typed(monthly: DataFrame, keys: Sequence[str]) -> DataFrame:
    absent = {"month", "total_sales", *keys} - set(monthly.columns)
    if absent:
        raise ValueError(f"monthly sales lacks columns: {sorted(absent)}")
    return monthly.select(
        *keys, F.col("month").try_cast("date").alias("month"), F.col("total_sales").try_cast("double").alias("total_sales")
    )


# What broken monthly sales say, in this order.
_SERIES_FAULTS = {"invalid": "holds invalid months or amounts", "repeated": "repeats a month", "gap": "skips a month"}


def series_faults(monthly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per fault of monthly sales, in one pass: `invalid` rows, `repeated` months, and the places where a
    `gap` interrupts a series."""
    series = _typed(monthly, keys)
    invalid = F.col("month").isNull() | F.col("total_sales").isNull() | F.isnan("total_sales")
    following = F.lead("month").over(Window.partitionBy(*keys).orderBy("month"))
    found = (
        series.groupBy(*keys, "month")
        .agg(F.count("*").alias("_copies"), F.count_if(invalid).alias("_invalid"))
        .withColumn("_gap", months_apart(following, "month") > 1)
        .agg(
            F.coalesce(F.sum("_invalid"), F.lit(0)).alias("invalid"),
            F.count_if((F.col("_copies") > 1) & F.col("month").isNotNull()).alias("repeated"),
            F.count_if("_gap").alias("gap"),
        )
    )
    rows = F.array(*(F.struct(F.lit(f).alias("fault"), F.col(f).cast("bigint").alias("failures")) for f in _SERIES_FAULTS))
    return found.select(F.inline(rows)).filter("failures > 0")


def monthly_series(monthly: DataFrame, keys: Sequence[str] = (), gaps: bool = False) -> DataFrame:
    """Typed (keys, month, total_sales) rows of complete series.

    Raises ValueError on missing columns, invalid dates or amounts, repeated months and, unless
    `gaps` are allowed, missing months.
    """
    # Written first: the checks and the caller then read a small table, whatever `monthly` is computed from.
    series = written(_typed(monthly, keys), "series")
    found = {r["fault"] for r in series_faults(series, keys).collect()} - ({"gap"} if gaps else set())
    for fault, message in _SERIES_FAULTS.items():
        if fault in found:
            raise ValueError(f"monthly sales {message}")
    return series.orderBy(*keys, "month")


def seasonal_naive(monthly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Adds `baseline`: sales twelve calendar months ago, else of the previous month.

    The frame is a range over month numbers, so a gap in a series gives NULL, never a wrong month.
    """
    series = Window.partitionBy(*keys).orderBy(month_number("month"))

    def months_ago(n: int):
        return F.max("total_sales").over(series.rangeBetween(-n, -n))

    return monthly.select(
        *keys, "month", "total_sales", F.coalesce(months_ago(12), months_ago(1)).alias("baseline")
    )
