"""Forecast features from months strictly before the target month."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.contract import PREDICTION_COLUMNS, TRAINING_COLUMNS
from tillwright.functions.dates import month_start, months_apart
from tillwright.functions.money import TOTAL, ratio

HISTORY = 6


def _exact_total() -> Column:
    return F.col("total_sales").cast(TOTAL)


def months_before(monthly: DataFrame, as_of: date | None) -> DataFrame:
    """Without the month of `as_of` and later ones: the last month in the data may be partial."""
    return monthly if as_of is None else monthly.filter(F.col("month") < month_start(F.lit(as_of)))


def forecast_training(monthly: DataFrame, keys: Sequence[str] = (), as_of: date | None = None) -> DataFrame:
    """One row per month that has the six calendar months before it.

    `monthly` has (keys, month, total_sales). The row frames end one row before the target, and
    the month span tells six rows from six consecutive months.
    """
    monthly = months_before(monthly, as_of)
    series = Window.partitionBy(*keys).orderBy("month")

    def mean_of_last(n: int) -> Column:
        frame = series.rowsBetween(-n, -1)
        return ratio(F.sum(_exact_total()).over(frame), F.count("total_sales").over(frame))

    rows = monthly.select(
        *keys,
        F.col("month").alias("target_month"),
        F.col("total_sales").alias("target_sales"),
        *(F.lag("total_sales", n).over(series).alias(f"lag_{n}") for n in (1, 2, 3)),
        F.month("month").alias("month_of_year"),
        mean_of_last(3).alias("rolling_mean_3"),
        mean_of_last(HISTORY).alias("rolling_mean_6"),
        F.count("total_sales").over(series.rowsBetween(-HISTORY, -1)).alias("_known"),
        F.lag("month", HISTORY).over(series).alias("_start"),
    )
    complete = (F.col("_known") == HISTORY) & (months_apart("target_month", "_start") == HISTORY)
    return rows.filter(complete).select(*keys, *TRAINING_COLUMNS)


def _last_month(monthly: DataFrame, as_of: date | None) -> Column:
    """Last complete month of the whole input: the one before `as_of`, else the newest one in the data."""
    if as_of is not None:
        return F.add_months(month_start(F.lit(as_of)), -1)
    return monthly.agg(F.max("month").alias("month")).scalar()


def next_month_features(monthly: DataFrame, keys: Sequence[str] = (), as_of: date | None = None) -> DataFrame:
    """The feature row of the month after the last complete one, the same month for every series.

    A series whose history does not reach over the six months before gives no row; `stale_series` names
    those that ended earlier. Without `as_of` the newest month of the whole input counts as complete, and
    `monthly` is read twice: pass a written table.
    """
    monthly = months_before(monthly, as_of)
    age = F.col("_age")

    def mean_of_last(n: int) -> Column:
        return ratio(F.sum(F.when(age <= n, _exact_total())), F.count(F.when(age <= n, F.col("total_sales"))))

    last = (
        monthly.select(*keys, "month", "total_sales", _last_month(monthly, as_of).alias("_last"))
        .withColumn("_age", months_apart("_last", "month") + 1)
        .filter(age <= HISTORY)
        .groupBy(*keys)
        .agg(
            F.count("*").alias("_months"),
            F.max("_last").alias("_end"),
            *(F.max(F.when(age == n, F.col("total_sales"))).alias(f"lag_{n}") for n in (1, 2, 3)),
            mean_of_last(3).alias("rolling_mean_3"),
            mean_of_last(HISTORY).alias("rolling_mean_6"),
        )
    )
    return (
        last.filter(F.col("_months") == HISTORY)
        .withColumn("target_month", F.add_months("_end", 1))
        .withColumn("month_of_year", F.month("target_month"))
        .select(*keys, *PREDICTION_COLUMNS)
    )


def stale_series(monthly: DataFrame, keys: Sequence[str], as_of: date | None = None) -> DataFrame:
    """Series that end before the last complete month of the whole input, with their own last month and the
    number of months they lack."""
    monthly = months_before(monthly, as_of)
    ends = monthly.groupBy(*keys).agg(F.max("month").alias("last_month"))
    ends = ends.withColumn("months_behind", months_apart(_last_month(monthly, as_of), "last_month"))
    return ends.filter(F.col("months_behind") > 0).withColumn("months_behind", F.col("months_behind").cast("bigint"))
