"""Order lines from a star schema.

`lineitem` and `orders` are the large sides and meet on the order key. The dimensions join from
the left, so no order line is lost, and only those a caller's columns need are joined at all. No
join is hinted: Catalyst broadcasts a dimension below `spark.sql.autoBroadcastJoinThreshold` and
otherwise sorts and merges, where adaptive execution splits a hot customer or part.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.contract import STAGED_NAMES
from tillwright.functions.dates import month_start
from tillwright.functions.money import fits, partial_sum
from tillwright.operators.quality import Check, unique_check, weighted_checks
from tillwright.session import written
from tillwright.sources.orders import stage

# Fixed value: margin before discount of the stand-in profit.
MARGIN_PERCENT = 6

_CUSTOMER = {"Customer Name", "Segment"}
_NATION = {"Country", "State"}
_REGION = {"Region"}
_PART = {"Category", "Sub-Category", "Product Name"}
_RAW_NAMES = {staged: raw for raw, staged in STAGED_NAMES.items()}


# The tables whose size grows with the business.
GROWING = ("lineitem", "orders", "customer", "part")


def table_path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(folder, name))


def line_key() -> Column:
    """Digest of a whole line: order key and line number repeat, whole lines do not.

    Different lines have different texts: NULL is a mark that no value can have, separators inside a text
    are escaped, and amounts are whole hundredths or else the double's own text, which has a point.
    """
    keys = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    amounts = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")

    def amount(name: str) -> Column:
        value = F.col(name).cast("double")
        return F.when(fits(value, 2), F.rint(value * 100).cast("decimal(38,0)").cast("string")).otherwise(value.cast("string"))

    def escaped(name: str) -> Column:
        return F.replace(F.replace(F.col(name), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\p"))

    fields = [
        *(F.col(name).cast("string") for name in keys),
        *(amount(name) for name in amounts),
        *(escaped(name) for name in ("l_returnflag", "l_linestatus")),
        F.col("l_shipdate").cast("date").cast("string"),
    ]
    return F.md5(F.concat_ws("|", *(F.coalesce(field, F.lit("\\N")) for field in fields)))


def line_profit() -> Column:
    """Price times margin less discount, counted in ten-thousandths to be exact.

    Defined for prices and discounts of whole hundredths; others fail the query instead of being rounded.
    """
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    profit = F.rint(price * 100) * (MARGIN_PERCENT - F.rint(discount * 100)) / 10_000
    misfit = F.raise_error(F.lit("a price or discount has more than 2 decimals"))
    return F.when(price.isNull() | discount.isNull(), None).when(fits(price, 2) & fits(discount, 2), profit).otherwise(misfit)


def customers(spark: SparkSession, folder: str, wanted: set[str]) -> DataFrame:
    """Customer attributes, with nation and region where wanted."""
    frame = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("Customer ID"),
        F.col("c_name").alias("Customer Name"),
        F.col("c_mktsegment").alias("Segment"),
        F.col("c_nationkey").alias("n_nationkey"),
    )
    if wanted & (_NATION | _REGION):
        frame = frame.join(table(spark, folder, "nation"), "n_nationkey", "left")
        frame = frame.withColumns({"Country": F.col("n_name"), "State": F.col("n_name")})
    if wanted & _REGION:
        region = table(spark, folder, "region").select(
            F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("Region")
        )
        frame = frame.join(region, "n_regionkey", "left")
    return frame.drop("n_nationkey", "n_regionkey", "n_name")


def _sub_category() -> Column:
    return F.concat(F.col("p_type"), F.lit(" / "), F.col("p_brand"))


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("Product ID"),
        F.col("p_type").alias("Category"),
        _sub_category().alias("Sub-Category"),
        F.col("p_name").alias("Product Name"),
    )


def _dated_orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").filter(F.col("o_orderdate").isNotNull()).select(
        F.col("o_orderkey").alias("Order ID"),
        F.col("o_orderdate").cast("date").alias("Order Date"),
        F.col("o_orderpriority").alias("Ship Mode"),
        F.col("o_custkey").alias("Customer ID"),
    )


def raw_order_lines(spark: SparkSession, folder: str, columns: Iterable[str] = tuple(STAGED_NAMES)) -> DataFrame:
    """The raw order-line columns asked for, one row per line.

    Lines are moved at most twice, by product and by order, and in a slim form: orders meet their customers before
    they meet the lines, the line key travels as its 16 bytes, and what follows from other columns (profit,
    sub-category, its text) is made above the joins. Where orders are counted the rows stay spread by order.
    """
    wanted = {*columns, "Order Date", "Sales"}
    lines = table(spark, folder, "lineitem").select(
        F.unhex(line_key()).alias("_key"),
        F.col("l_orderkey").alias("Order ID"),
        F.col("l_shipdate").cast("date").alias("Ship Date"),
        F.col("l_partkey").alias("Product ID"),
        "l_extendedprice",
        "l_quantity",
        "l_discount",
    )
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("Product ID"), "p_type", "p_brand", "p_name")
    orders = _dated_orders(spark, folder)
    if wanted & (_CUSTOMER | _NATION | _REGION):
        orders = orders.join(customers(spark, folder, wanted), "Customer ID", "left")
    # Products come first where orders are counted, and otherwise late, so that names are not moved with the lines.
    count_orders = "Order ID" in wanted
    if wanted & _PART and count_orders:
        lines = lines.join(parts, "Product ID", "left")
    # A line without a dated order would not pass staging, so this join may be an inner one.
    frame = lines.join(orders, "Order ID")
    if wanted & _PART and not count_orders:
        frame = frame.join(parts, "Product ID", "left")
    made = {
        "Row ID": F.lower(F.hex("_key")),
        "City": F.lit(None).cast("string"),
        "Postal Code": F.lit(None).cast("string"),
        "Category": F.col("p_type"),
        "Sub-Category": _sub_category(),
        "Product Name": F.col("p_name"),
        "Sales": F.col("l_extendedprice"),
        "Quantity": F.col("l_quantity"),
        "Discount": F.col("l_discount"),
        "Profit": line_profit(),
    }
    return frame.select(*(made.get(name, F.col(f"`{name}`")).alias(name) for name in STAGED_NAMES if name in wanted))


def order_lines(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Staged order lines with the given staged columns, all by default."""
    raw = raw_order_lines(spark, folder, [_RAW_NAMES[c] for c in columns] or STAGED_NAMES)
    return stage(raw, pruned=True).select(*(columns or STAGED_NAMES.values()))


def order_totals(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """One row per order: its sales and profit, with the given staged order and customer columns.

    Lines are added up below the join: the map side already folds a hot order into one row per
    task, the shuffle on the order key also serves the join with `orders`, and everything above
    handles orders instead of lines. Sales and profit are partial sums.
    """
    wanted = {_RAW_NAMES[c] for c in columns}
    lines = (
        table(spark, folder, "lineitem")
        .filter(F.col("l_extendedprice").isNotNull())
        .select(F.col("l_orderkey").alias("Order ID"), F.col("l_extendedprice").alias("sales"), line_profit().alias("profit"))
    )
    sums = lines.groupBy("Order ID").agg(
        partial_sum(lines, "sales").alias("sales"), partial_sum(lines, "profit").alias("profit")
    )
    frame = sums.join(_dated_orders(spark, folder), "Order ID")
    # Customers come last, which leaves the orders spread by customer for the distinct customer counts.
    if wanted & (_CUSTOMER | _NATION | _REGION):
        frame = frame.join(customers(spark, folder, wanted), "Customer ID", "left")
    return frame.select(*(F.col(f"`{_RAW_NAMES[c]}`").alias(c) for c in columns), "sales", "profit")


def part_totals(spark: SparkSession, folder: str, *columns: str, monthly: bool = False) -> DataFrame:
    """Sales per part, and per order month with `monthly`, with the given staged product columns.

    Lines meet their dated order and are then summed per part, so the map side folds a hot part and the join
    with `part` handles one row per part and month. `sales` is a partial sum, `order_date` the first of the month.
    """
    lines = (
        table(spark, folder, "lineitem")
        .filter(F.col("l_extendedprice").isNotNull())
        .select(F.col("l_orderkey").alias("Order ID"), F.col("l_partkey").alias("Product ID"), F.col("l_extendedprice").alias("sales"))
    )
    dated = (
        table(spark, folder, "orders")
        .filter(F.col("o_orderdate").isNotNull())
        .select(F.col("o_orderkey").alias("Order ID"), month_start("o_orderdate").alias("order_date"))
    )
    frame = lines.join(dated if monthly else dated.select("Order ID"), "Order ID")
    by = ["Product ID", *(["order_date"] if monthly else [])]
    sums = frame.groupBy(*by).agg(partial_sum(frame, "sales").alias("sales"))
    named = sums.join(products(spark, folder), "Product ID", "left")
    return named.select(*(F.col(f"`{_RAW_NAMES[c]}`").alias(c) for c in columns), *by[1:], "sales")


def staged_checks(spark: SparkSession, folder: str, checks: Sequence[Check], relation: str = "stg_orders") -> DataFrame:
    """The report of the staged lines without joining the lines to any dimension but their order.

    Dated lines are written with a 16-byte key. The key alone is shuffled to find repeats; NULL and accepted-value
    checks are made on counts per customer and per part, which fold before they meet the dimensions.
    """
    lines = table(spark, folder, "lineitem").filter(F.col("l_extendedprice").isNotNull())
    lines = lines.select(F.unhex(line_key()).alias("row_id"), "l_orderkey", F.col("l_partkey").alias("Product ID"))
    dated = table(spark, folder, "orders").filter(F.col("o_orderdate").isNotNull())
    dated = dated.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("Customer ID"))
    lines = written(lines.join(dated, "l_orderkey").drop("l_orderkey"), "dated-lines")

    def counted(key: str, dimension: DataFrame, columns: dict[str, str]) -> DataFrame:
        counts = lines.groupBy(key).agg(F.count("*").alias("_n")).join(dimension, key, "left")
        return counts.select("_n", *(F.col(f"`{_RAW_NAMES[c]}`").alias(c) for c in columns))

    known = {"customer": {"segment", "region"}, "part": {"category"}}
    sure = ("row_id", "order_id", "order_date", "sales")  # the join and the filters leave no NULL
    by = {name: [c for c in checks if c.kind != "unique" and c.column in columns] for name, columns in known.items()}
    rest = [c for c in checks if c.kind != "unique" and c.column in sure]
    unique = [c for c in checks if c.kind == "unique"]
    if len(unique) != 1 or unique[0].column != "row_id" or len(rest) + sum(map(len, by.values())) + 1 != len(checks):
        raise ValueError("a staged check is not known here")
    nowhere = lines.agg(F.count("*").alias("_n")).select("_n", *(F.lit("").alias(c) for c in sure))
    parts = [
        unique_check(lines.select("row_id"), relation, "row_id"),
        weighted_checks(nowhere, "_n", relation, rest),
        weighted_checks(counted("Customer ID", customers(spark, folder, {"Segment", "Region"}), known["customer"]), "_n", relation, by["customer"]),
        weighted_checks(counted("Product ID", products(spark, folder), known["part"]), "_n", relation, by["part"]),
    ]
    return reduce(DataFrame.unionByName, parts)
