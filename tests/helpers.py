"""Small hand-made inputs."""

from __future__ import annotations

from datetime import date

RAW_COLUMNS = (
    "Row ID", "Order ID", "Order Date", "Ship Date", "Ship Mode", "Customer ID", "Customer Name", "Segment",
    "Country", "City", "State", "Postal Code", "Region", "Product ID", "Category", "Sub-Category", "Product Name",
    "Sales", "Quantity", "Discount", "Profit",
)


def month(n: int, year: int = 2014) -> date:
    """The n-th month from January of `year`, counted from 0."""
    return date(year + n // 12, n % 12 + 1, 1)


def raw_line(row_id: str, **values) -> tuple:
    line = dict(
        zip(
            RAW_COLUMNS,
            (row_id, "o1", date(2014, 1, 5), date(2014, 1, 7), "Second Class", "c1", "Ann", "Consumer", "US", "Kent",
             "Ohio", "42420", "East", "p1", "Furniture", "Chairs", "Chair", 10.0, 2, 0.1, 1.5),
        )
    )
    return tuple({**line, **values}[c] for c in RAW_COLUMNS)


def monthly_frame(spark, values, keys=()):
    """(keys, month, total_sales) from (key values..., month number, amount) tuples."""
    fields = "".join(f"{k} string, " for k in keys)
    rows = [(*v[:-2], month(v[-2]), float(v[-1]) if v[-1] is not None else None) for v in values]
    return spark.createDataFrame(rows, f"{fields}month date, total_sales double")


def dicts(frame) -> list[dict]:
    return [row.asDict(recursive=True) for row in frame.collect()]
