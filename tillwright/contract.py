"""Column contracts shared by sources, operators and checks."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw order-line columns and their staged names.
STAGED_NAMES = {
    "Row ID": "row_id",
    "Order ID": "order_id",
    "Order Date": "order_date",
    "Ship Date": "ship_date",
    "Ship Mode": "ship_mode",
    "Customer ID": "customer_id",
    "Customer Name": "customer_name",
    "Segment": "segment",
    "Country": "country",
    "City": "city",
    "State": "state",
    "Postal Code": "postal_code",
    "Region": "region",
    "Product ID": "product_id",
    "Category": "category",
    "Sub-Category": "sub_category",
    "Product Name": "product_name",
    "Sales": "sales",
    "Quantity": "quantity",
    "Discount": "discount",
    "Profit": "profit",
}

# The measures staging casts; every other column keeps its type.
STAGED_CASTS = {"sales": "double", "quantity": "bigint", "discount": "double", "profit": "double"}

RAW_SCHEMA = T.StructType(
    [
        T.StructField(
            raw,
            T.DateType()
            if staged.endswith("_date")
            else {"double": T.DoubleType(), "bigint": T.LongType()}.get(
                STAGED_CASTS.get(staged, ""), T.StringType()
            ),
        )
        for raw, staged in STAGED_NAMES.items()
    ]
)

# The ordered forecast feature contract.
FEATURES = ("lag_1", "lag_2", "lag_3", "month_of_year", "rolling_mean_3", "rolling_mean_6")
TRAINING_COLUMNS = ("target_month", "target_sales", *FEATURES)
PREDICTION_COLUMNS = ("target_month", *FEATURES)

# The two feature sets of the backtest.
FEATURE_SETS = {
    "five_features": ("lag_1", "lag_2", "lag_3", "month_of_year", "rolling_mean_3"),
    "six_features": FEATURES,
}

# The analytics marts open to readers, with the columns that order each one.
MART_GRAIN = {
    "mart_monthly_sales": ("month",),
    "mart_sales_by_category": ("category", "sub_category"),
    "mart_sales_by_region": ("region", "state"),
    "mart_sales_by_segment": ("month", "segment"),
    "mart_product_performance": ("product_id", "product_name", "category", "sub_category"),
}

# Accepted categories of the retail data.
ACCEPTED = {
    "category": ("Furniture", "Office Supplies", "Technology"),
    "region": ("East", "West", "Central", "South"),
    "segment": ("Consumer", "Corporate", "Home Office"),
}


class FeatureContractError(ValueError):
    """A feature table or model breaks the forecast feature contract."""


class DataCheckError(ValueError):
    """A built relation fails one of its declared checks."""
