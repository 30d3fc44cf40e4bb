import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.helpers import dicts, raw_line
from tillwright.contract import RAW_SCHEMA
from tillwright.functions.money import partial_sum
from tillwright.operators import dashboards, marts
from tillwright.operators.ranking import rank_within, ranged_values, share_within
from tillwright.sources.orders import stage


@pytest.fixture(scope="module")
def lines(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        order = rng.randrange(120)
        product = rng.choice(["p0"] * 10 + [f"p{n}" for n in range(20)])  # p0 holds a third
        rows.append(
            raw_line(
                str(i),
                **{
                    "Order ID": f"o{order}",
                    "Order Date": pd.Timestamp(2014, order % 12 + 1, order % 28 + 1).date(),
                    "Customer ID": f"c{order % 17}",
                    "Segment": ["Consumer", "Corporate", None][order % 17 % 3],
                    "Region": ["East", "West"][order % 17 % 2],
                    "State": f"s{order % 17 % 4}",
                    "Product ID": product,
                    "Product Name": f"name {product}",
                    "Category": ["Furniture", "Technology"][int(product[1:]) % 2],
                    "Sub-Category": f"sub{int(product[1:]) % 4}",
                    "Sales": rng.randrange(1, 10**6) / 1e4,
                    "Quantity": rng.randrange(1, 9),
                    "Discount": rng.choice([0.0, 0.15, 0.2, None]),
                    "Profit": rng.choice([None, rng.randrange(-(10**5), 10**5) / 1e4]),
                },
            )
        )
    return stage(spark.createDataFrame(rows, RAW_SCHEMA)).cache()


def pandas_of(lines):
    frame = lines.toPandas()
    frame["month"] = pd.to_datetime(frame["order_date"]).dt.to_period("M").dt.to_timestamp().dt.date
    return frame


def test_monthly_sales(lines):
    want = pandas_of(lines).groupby("month").agg(
        total_sales=("sales", "sum"), order_count=("order_id", "nunique"), unique_customers=("customer_id", "nunique")
    )
    got = marts.monthly_sales(lines).toPandas().set_index("month").sort_index()
    assert (got["order_count"] == want["order_count"]).all() and (got["unique_customers"] == want["unique_customers"]).all()
    assert got["total_sales"].round(6).tolist() == want["total_sales"].round(6).tolist()


def test_rows_per_order_give_the_same_marts(lines):
    keys = ["order_id", "order_date", "customer_id", "segment", "region", "state"]
    orders = lines.groupBy(*keys).agg(
        partial_sum(lines, "sales").alias("sales"), partial_sum(lines, "profit").alias("profit")
    )
    for mart in (marts.monthly_sales, marts.sales_by_segment, marts.sales_by_region, dashboards.executive_kpis, dashboards.eda_kpis):
        from_lines, from_orders = mart(lines), mart(orders, per_order=True)
        assert from_lines.columns == from_orders.columns
        assert sorted(map(repr, from_lines.collect())) == sorted(map(repr, from_orders.collect()))


def test_category_mart(lines):
    frame = pandas_of(lines)
    groups = frame.groupby(["category", "sub_category"])
    for row in dicts(marts.sales_by_category(lines)):
        part = groups.get_group((row["category"], row["sub_category"]))
        assert row["total_sales"] == pytest.approx(part["sales"].sum(), abs=0.00501)
        assert row["total_quantity"] == part["quantity"].sum()
        assert row["order_count"] == part["order_id"].nunique()
        assert row["avg_discount"] == pytest.approx(part["discount"].mean(), abs=0.0000501)
        assert row["avg_unit_price"] == pytest.approx(part["sales"].sum() / part["quantity"].sum(), abs=0.00501)
        assert row["profit_margin_pct"] == pytest.approx(part["profit"].sum() / part["sales"].sum() * 100, abs=0.00501)


def test_product_mart_against_pandas(lines):
    got = marts.product_performance(marts.product_totals(lines)).toPandas().sort_values("product_id", ignore_index=True)
    rank = got.groupby("sub_category")["total_sales"].rank(method="min", ascending=False).astype(int)
    assert got["rank_in_subcategory"].tolist() == rank.tolist()
    share = got["total_sales"] / got.groupby("category")["total_sales"].transform("sum") * 100
    assert got["pct_of_category_sales"].tolist() == pytest.approx(share.tolist(), abs=0.00501)
    top = marts.top_products(marts.product_totals(lines), 2).toPandas()
    assert sorted(top["product_id"]) == sorted(got[got["rank_in_subcategory"] <= 2]["product_id"])


def test_zero_sales_give_null_ratios(spark):
    raw = [raw_line("1", Sales=5.0, Quantity=0), raw_line("2", Sales=-5.0, Quantity=0)]
    lines = stage(spark.createDataFrame(raw, RAW_SCHEMA))
    category = dicts(marts.sales_by_category(lines))[0]
    assert category["profit_margin_pct"] is None and category["avg_unit_price"] is None
    assert dicts(marts.monthly_kpis(marts.monthly_sales(lines)))[0]["profit_margin"] is None
    assert dicts(marts.product_performance(marts.product_totals(lines)))[0]["pct_of_category_sales"] is None


def test_null_profit_is_skipped(spark):
    lines = stage(spark.createDataFrame([raw_line("1", Profit=None), raw_line("2", Profit=2.0)], RAW_SCHEMA))
    row = dicts(marts.monthly_sales(lines))[0]
    assert (row["total_profit"], row["total_sales"]) == (2.0, 20.0)


def test_rank_matches_a_window_on_hot_groups_ties_and_nulls(spark):
    from pyspark.sql import Window

    rng = random.Random(5)
    values = [0.0, -3.5, 1e-4, 7.0, 1e9] + [rng.uniform(-50, 5000) for _ in range(60)]
    groups = ["hot"] * 10 + [None, "b", "c"]
    rows = [(i, rng.choice(groups), round(rng.choice(values), 2)) for i in range(3000)]
    frame = spark.createDataFrame(rows, "id int, g string, v double")
    window = F.rank().over(Window.partitionBy("g").orderBy(F.desc("v")))
    want = {r["id"]: r["r"] for r in frame.withColumn("r", window).collect()}
    got = {r["id"]: r["r"] for r in rank_within(frame, "g", "v", "r").collect()}
    assert got == want
    shares = share_within(frame, frame, "g", "v", "share")
    assert shares.count() == 3000


def test_values_close_together_are_ranked_by_many_tasks(spark):
    """A million values within 0.1 %, and as many rows of ties and of a second group with values far apart."""
    close = spark.range(1_000_000).selectExpr("id", "'close' AS g", "1000D + id / 1000000D AS v")
    tied = spark.range(1_000_000).selectExpr("id", "'tied' AS g", "double(id % 3) AS v")
    frame = close.unionByName(tied).unionByName(spark.range(1000).selectExpr("id", "'far' AS g", "exp(id / 50D) AS v"))
    ranges = ranged_values(frame, "g", "v").groupBy("g", "_range").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    own = sorted((r["_range"], r["n"], r["low"], r["high"]) for r in ranges.where("g = 'close'").collect())
    assert len(own) >= 128 and max(n for _, n, _, _ in own) < 1.1 * 1_000_000 / 128
    assert all(a[3] < b[2] for a, b in zip(own, own[1:]))
    ranked = rank_within(frame, "g", "v", "r")
    want = F.when(F.col("g") == "close", 1_000_000 - F.col("id")).when(F.col("g") == "far", 1000 - F.col("id")).otherwise(
        F.when(F.col("v") == 2, 1).when(F.col("v") == 1, 333_334).otherwise(666_667)
    )
    assert ranked.agg(F.count("*"), F.count_if(F.col("r") == want)).first()[:] == (2_001_000, 2_001_000)


def test_repeated_product_id_keeps_its_rows(spark):
    raw = [raw_line("1"), raw_line("2", **{"Product Name": "Other"})]
    lines = stage(spark.createDataFrame(raw, RAW_SCHEMA))
    got = dicts(marts.product_performance(marts.product_totals(lines)))
    assert len(got) == 2 and {r["rank_in_subcategory"] for r in got} == {1}
    assert {r["pct_of_category_sales"] for r in got} == {50.0}


def test_reports(lines):
    frame = pandas_of(lines)
    row = dicts(dashboards.eda_kpis(lines))[0]
    assert row["total_orders"] == frame["order_id"].nunique()
    assert row["avg_order_value"] == pytest.approx(frame["sales"].sum() / frame["order_id"].nunique(), abs=0.00501)
    prices = dicts(dashboards.price_by_quantity(lines))
    assert [r["quantity"] for r in prices] == sorted(frame["quantity"].unique())
    assert sum(r["lines"] for r in prices) == len(frame)
    assert {r["region"] for r in dicts(dashboards.revenue_by(lines, "region"))} == set(frame["region"])
