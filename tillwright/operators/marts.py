"""Sales marts over staged order lines.

The monthly, segment and region marts also take rows summed per order. With `per_order` each order
has exactly one row, so orders are counted as rows and only customers need a distinct count; Spark
then neither expands the rows once per distinct count nor shuffles the order ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.functions.dates import month_start
from tillwright.functions.money import exact_sum, percent, ratio, rounded
from tillwright.operators.ranking import rank_within, share_within

PRODUCT_KEYS = ("product_id", "product_name", "category", "sub_category")


def _money(total: str) -> Column:
    return rounded(F.col(total), 2).alias(total)


def _margin_percent() -> Column:
    return rounded(percent(F.col("total_profit"), F.col("total_sales")), 2).alias("profit_margin_pct")


def _average_discount(lines: DataFrame) -> Column:
    return rounded(ratio(exact_sum(lines, "discount"), F.count("discount")), 4).alias("avg_discount")


def _orders(per_order: bool) -> Column:
    count = F.count if per_order else F.count_distinct
    return count("order_id").alias("order_count")


def monthly_sales(lines: DataFrame, per_order: bool = False) -> DataFrame:
    """Sales, profit, distinct orders and customers per calendar month, unrounded."""
    return lines.groupBy(month_start("order_date").alias("month")).agg(
        exact_sum(lines, "sales").cast("double").alias("total_sales"),
        exact_sum(lines, "profit").cast("double").alias("total_profit"),
        _orders(per_order),
        F.count_distinct("customer_id").alias("unique_customers"),
    )


def monthly_totals(lines: DataFrame, *keys: str) -> DataFrame:
    """Sales per series and month: the input of the forecast features."""
    return lines.groupBy(*keys, month_start("order_date").alias("month")).agg(
        exact_sum(lines, "sales").cast("double").alias("total_sales")
    )


def monthly_kpis(monthly: DataFrame) -> DataFrame:
    """The monthly mart: rounded totals and margin."""
    return monthly.select(
        "month",
        _money("total_sales"),
        "order_count",
        "unique_customers",
        _money("total_profit"),
        rounded(ratio(F.col("total_profit"), F.col("total_sales")), 4).alias("profit_margin"),
    ).orderBy("month")


def sales_by_category(lines: DataFrame) -> DataFrame:
    totals = lines.groupBy("category", "sub_category").agg(
        exact_sum(lines, "sales").alias("total_sales"),
        exact_sum(lines, "profit").alias("total_profit"),
        F.sum("quantity").alias("total_quantity"),
        F.count_distinct("order_id").alias("order_count"),
        _average_discount(lines),
    )
    return totals.select(
        "category",
        "sub_category",
        _money("total_sales"),
        _money("total_profit"),
        "total_quantity",
        "order_count",
        _margin_percent(),
        rounded(ratio(F.col("total_sales"), F.col("total_quantity")), 2).alias("avg_unit_price"),
        "avg_discount",
    ).orderBy(F.desc("total_sales"))


def _customer_sales(lines: DataFrame, per_order: bool, *keys: Column | str) -> DataFrame:
    return lines.groupBy(*keys).agg(
        exact_sum(lines, "sales").alias("total_sales"),
        exact_sum(lines, "profit").alias("total_profit"),
        _orders(per_order),
        F.count_distinct("customer_id").alias("unique_customers"),
    )


def sales_by_segment(lines: DataFrame, per_order: bool = False) -> DataFrame:
    totals = _customer_sales(lines, per_order, month_start("order_date").alias("month"), "segment")
    return totals.select(
        "month",
        "segment",
        _money("total_sales"),
        _money("total_profit"),
        "order_count",
        "unique_customers",
        _margin_percent(),
    ).orderBy("month", F.desc("total_sales"))


def sales_by_region(lines: DataFrame, per_order: bool = False) -> DataFrame:
    return _customer_sales(lines, per_order, "region", "state").select(
        "region",
        "state",
        _money("total_sales"),
        _money("total_profit"),
        "order_count",
        "unique_customers",
        _margin_percent(),
        rounded(ratio(F.col("total_sales"), F.col("order_count")), 2).alias("avg_order_value"),
    ).orderBy(F.desc("total_sales"))


def of_products(lines: DataFrame, category: str | None = None, sub_category: str | None = None) -> DataFrame:
    """Lines of one category or sub-category: the filter of the product report, below its aggregate."""
    if category is not None:
        lines = lines.filter(F.col("category") == category)
    return lines if sub_category is None else lines.filter(F.col("sub_category") == sub_category)


def product_totals(lines: DataFrame, *keys: str) -> DataFrame:
    """Rounded product measures by the four product columns.

    With a product dimension at hand, group by `product_id` alone and join the names afterwards:
    the shuffle then carries no strings.
    """
    keys = keys or PRODUCT_KEYS
    totals = lines.groupBy(*keys).agg(
        exact_sum(lines, "sales").alias("total_sales"),
        exact_sum(lines, "profit").alias("total_profit"),
        F.sum("quantity").alias("total_quantity"),
        F.count_distinct("order_id").alias("order_count"),
        _average_discount(lines),
    )
    return totals.select(
        *keys,
        _money("total_sales"),
        _money("total_profit"),
        "total_quantity",
        "order_count",
        "avg_discount",
        _margin_percent(),
    )


def product_performance(totals: DataFrame) -> DataFrame:
    """Rank inside the sub-category and share of category sales, over rounded product totals.

    `totals` is read several times and should be a written table.
    """
    ranked = rank_within(totals, "sub_category", "total_sales", "rank_in_subcategory")
    return share_within(ranked, totals, "category", "total_sales", "pct_of_category_sales")


def top_products(totals: DataFrame, limit: int = 10) -> DataFrame:
    """Products ranked up to `limit` inside their sub-category, ties included."""
    best_first = Window.partitionBy("sub_category").orderBy(F.desc("total_sales"))
    # The rank filter becomes a group limit below the shuffle: a map task keeps only its own best.
    best = totals.withColumn("rank_in_subcategory", F.rank().over(best_first)).filter(
        F.col("rank_in_subcategory") <= limit
    )
    return best.withColumn("rank_in_subcategory", F.col("rank_in_subcategory").cast("bigint"))
