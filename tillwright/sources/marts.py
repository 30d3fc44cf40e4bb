"""Reads over built marts."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.contract import MART_GRAIN, PREDICTION_COLUMNS, TRAINING_COLUMNS
from tillwright.sinks.tables import read_table

# Bounds and default of a mart read.
MAX_ROWS = 10_000
DEFAULT_ROWS = 1_000


def run_sql(spark: SparkSession, query: str, **args) -> DataFrame:
    """Ad-hoc SQL with named parameters; the result stays distributed."""
    return spark.sql(query, args=args)


def read_mart(spark: SparkSession, folder: str, name: str, limit: int = DEFAULT_ROWS) -> DataFrame:
    """The first rows of an analytics mart in the order of its grain."""
    if name not in MART_GRAIN:
        raise ValueError(f"not an analytics mart: {name}")
    if isinstance(limit, bool) or not isinstance(limit, int) or not 1 <= limit <= MAX_ROWS:
        raise ValueError(f"limit must be a whole number from 1 to {MAX_ROWS}")
    return read_table(spark, folder, name).orderBy(*MART_GRAIN[name]).limit(limit)


def mart_records(spark: SparkSession, folder: str, name: str, limit: int = DEFAULT_ROWS) -> list[dict]:
    """The rows of `read_mart`, at most MAX_ROWS, as dictionaries of JSON values."""
    return [json.loads(row) for row in read_mart(spark, folder, name, limit).toJSON().collect()]


def read_training(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "mart_forecast_training").select(*TRAINING_COLUMNS).orderBy("target_month")


def read_next_month_features(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "mart_next_month_features").select(*PREDICTION_COLUMNS)


def read_monthly_sales(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "int_monthly_sales").select("month", "total_sales").orderBy("month")


def latest_months(monthly: DataFrame, months: int) -> DataFrame:
    return monthly.orderBy(F.desc("month")).limit(months)
