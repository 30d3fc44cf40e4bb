"""Forecast error measures, the same to the last bit for any order of the rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands in for a zero sMAPE denominator.
SMAPE_FLOOR = 1e-8


def relative_error(actual: Column, predicted: Column) -> Column:
    """Absolute error in percent of a nonzero actual; NULL for a zero one."""
    return F.when(actual != 0, F.abs((actual - predicted) / F.nullif(actual, F.lit(0.0)))) * 100


def symmetric_error(actual: Column, predicted: Column) -> Column:
    size = F.abs(actual) + F.abs(predicted)
    return 2 * F.abs(predicted - actual) / F.when(size == 0, F.lit(SMAPE_FLOOR)).otherwise(size) * 100


def error_measures(actual: Column, predicted: Column) -> dict[str, tuple[str, Column]]:
    """All four measures by name, as kinds of a row's error; MAPE is NULL if every actual is zero."""
    error = actual - predicted
    return {
        "mape": ("mean", relative_error(actual, predicted)),
        "smape": ("mean", symmetric_error(actual, predicted)),
        "mae": ("mean", F.abs(error)),
        "rmse": ("root_mean_square", error),
    }
