"""Report queries over staged order lines (or per-order sums) and marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.functions.dates import month_start
from tillwright.functions.money import exact_sum, percent, ratio, rounded


def _total(lines: DataFrame, name: str, to: str) -> Column:
    return rounded(exact_sum(lines, name), 2).alias(to)


def _orders(per_order: bool) -> Column:
    return (F.count if per_order else F.count_distinct)("order_id")


def executive_kpis(lines: DataFrame, per_order: bool = False) -> DataFrame:
    sales, profit = exact_sum(lines, "sales"), exact_sum(lines, "profit")
    return lines.agg(
        _total(lines, "sales", "total_sales"),
        _total(lines, "profit", "total_profit"),
        _orders(per_order).alias("total_orders"),
        rounded(percent(profit, sales), 2).alias("profit_margin_pct"),
    )


def eda_kpis(lines: DataFrame, per_order: bool = False) -> DataFrame:
    orders = _orders(per_order)
    return lines.agg(
        _total(lines, "sales", "total_revenue"),
        orders.alias("total_orders"),
        rounded(ratio(exact_sum(lines, "sales"), orders), 2).alias("avg_order_value"),
    )


def revenue_by(lines: DataFrame, key: str) -> DataFrame:
    return lines.groupBy(key).agg(_total(lines, "sales", "total_sales")).orderBy(F.desc("total_sales"))


def monthly_revenue(daily: DataFrame, day: str = "date", revenue: str = "revenue") -> DataFrame:
    """Revenue per month of a dated revenue frame, such as the CSV input."""
    return daily.groupBy(month_start(day).alias("month")).agg(_total(daily, revenue, "revenue")).orderBy("month")


def price_by_quantity(lines: DataFrame) -> DataFrame:
    """Lines and mean unit price per ordered quantity."""
    return (
        lines.groupBy("quantity")
        .agg(
            F.count("*").alias("lines"),
            rounded(ratio(exact_sum(lines, "sales"), F.sum("quantity")), 2).alias("avg_unit_price"),
        )
        .orderBy("quantity")
    )
