"""Build every relation from staged order lines."""

from __future__ import annotations

from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from tillwright.operators.features import forecast_training, next_month_features
from tillwright.operators.marts import (
    monthly_kpis,
    monthly_sales,
    product_performance,
    product_totals,
    sales_by_category,
    sales_by_region,
    sales_by_segment,
)
from tillwright.session import written
from tillwright.sinks.tables import as_table, as_view


def build(
    lines: DataFrame,
    folder: str,
    orders: DataFrame | None = None,
    products: DataFrame | None = None,
    publish: bool = False,
    parallel: int = 4,
) -> dict[str, DataFrame]:
    """Write all marts below `folder` and return every relation by name.

    `orders` may hold one row per order with its sales and profit: the monthly, segment and region
    marts then read those rows instead of all lines. `products` may hold product totals. `publish`
    makes each relation a temporary view of its name. Up to `parallel` tables are written at once.
    """
    per_order = orders is not None
    orders = orders if per_order else lines
    products = product_totals(lines) if products is None else products

    def write(tables: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
        def table(name: str) -> DataFrame:
            return as_table(tables[name](), folder, name)

        with ThreadPool(parallel) as pool:
            done = pool.map(inheritable_thread_target(lines.sparkSession)(table), tables)
        return dict(zip(tables, done))

    from_lines = write(
        {
            "int_monthly_sales": lambda: monthly_sales(orders, per_order),
            "mart_sales_by_category": lambda: sales_by_category(lines),
            "mart_product_performance": lambda: product_performance(written(products, "product-totals")),
            "mart_sales_by_segment": lambda: sales_by_segment(orders, per_order),
            "mart_sales_by_region": lambda: sales_by_region(orders, per_order),
        }
    )
    monthly = from_lines["int_monthly_sales"]
    from_months = write(
        {
            "mart_monthly_sales": lambda: monthly_kpis(monthly),
            "mart_forecast_training": lambda: forecast_training(monthly),
            "mart_next_month_features": lambda: next_month_features(monthly),
        }
    )
    relations = {"stg_orders": lines, **from_lines, **from_months}
    if publish:
        for name, frame in relations.items():
            as_view(frame, name)
    return relations
