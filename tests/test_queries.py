import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tillwright.catalog import queries as catalog
from tests.oracle import DATA, compare, connect
from tillwright.session import tune

SF = str(DATA / "sf0.001")
# 600 rounds of Spark's own boosting take minutes; `python -m tests.oracle` compares it too.
HEAVY = {"gbt_holdout_rows"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry(spark):
    assert entry.entry(spark).count() == 74


LIBRARY = set(catalog.registered())


@pytest.mark.parametrize("name", sorted(LIBRARY & set(entry.oracle_sql()) - HEAVY))
def test_query_equals_its_oracle(spark, con, name):
    assert compare(spark, con, SF, name) is None


def test_every_library_query_has_an_oracle():
    assert LIBRARY <= set(entry.oracle_sql())


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


def final_plan(frame) -> str:
    frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def scanned(plan: str, first: str) -> set[str]:
    return set(re.search(rf"FileScan parquet \[({first}[^\]]*)\]", re.sub(r"#\d+L?", "", plan)).group(1).split(","))


def test_scans_are_pruned_and_filters_pushed(spark):
    plan = final_plan(entry.queries()["mart_forecast_training"](spark, SF))
    assert scanned(plan, "l_") == {"l_orderkey", "l_extendedprice"}
    assert scanned(plan, "o_") == {"o_orderkey", "o_orderdate"}
    assert "PushedFilters: [IsNotNull(l_extendedprice)" in plan and "IsNotNull(o_orderdate)" in plan
    assert "customer" not in plan and "part.parquet" not in plan


def test_top_products_are_cut_before_the_shuffle(spark):
    plan = final_plan(entry.queries()["top10_products_per_subcategory"](spark, SF))
    assert plan.count("WindowGroupLimit") == 2


def test_orders_are_counted_without_expanding_rows(spark, no_broadcast):
    plan = final_plan(entry.queries()["mart_sales_by_segment"](spark, SF))
    assert "Expand" not in plan
    # Lines, orders, joined orders, customers, and the final small groups.
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 5


@pytest.mark.parametrize("name", ["panel_training_by_subcategory", "category_revenue"])
def test_only_one_shuffle_of_unfolded_lines(spark, no_broadcast, name):
    """Below each exchange: a scan of lines without an aggregate between means whole lines are moved."""
    frame = entry.queries()[name](spark, SF)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = plan.split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    unfolded = 0
    for n, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            below = []
            for other in lines[n + 1 :]:
                if depth(other) <= depth(line):
                    break
                below.append(other)
            first = next((i for i, b in enumerate(below) if "Aggregate" in b or "Join" in b), len(below))
            whole = [b for b in below[:first] if "l_orderkey" in b and "FileScan" in b]
            unfolded += bool(whole) or (first < len(below) and "Join" in below[first])
    assert unfolded == 1


@pytest.mark.parametrize("name", ["int_monthly_sales", "mart_sales_by_category", "mart_product_performance", "mart_sales_by_region"])
def test_results_hold_without_broadcasts(spark, con, no_broadcast, name):
    assert compare(spark, con, SF, name) is None


def test_a_hot_order_customer_and_part_are_split(spark, tmp_path, no_broadcast):
    """A third of the rows shares one key of each join; adaptive execution splits its partition."""
    for name in ("nation", "region", "part", "customer"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    hot = lambda c, n, to: F.when(F.rand(n) < 1 / 3, F.lit(to)).otherwise(F.col(c))
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    orders.withColumn("o_custkey", hot("o_custkey", 1, 7)).write.parquet(str(tmp_path / "orders.parquet"))
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").repartition(16)
    lines = lines.withColumns({"l_orderkey": hot("l_orderkey", 2, 5), "l_partkey": hot("l_partkey", 3, 11)})
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    con = connect_folders(tmp_path)
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        for name in ("mart_sales_by_category", "mart_sales_by_segment", "panel_training_by_subcategory", "stg_orders"):
            assert compare(spark, con, str(tmp_path), name) is None
        plan = final_plan(entry.queries()["panel_training_by_subcategory"](spark, str(tmp_path)))
        assert "skew=true" in plan
    finally:
        for key in settings:
            spark.conf.unset(key)


def connect_folders(folder):
    import duckdb

    con = duckdb.connect()
    for path in folder.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}/*.parquet'")
    return con


def test_shuffle_partitions_grow_with_the_input(spark, monkeypatch):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    tune(spark, f"{SF}/lineitem.parquet")
    assert spark.conf.get(key) == "8"
    monkeypatch.setattr("tillwright.session.stored_bytes", lambda *_: 100 * 10**12)
    tune(spark, SF)
    assert 20_000 < int(spark.conf.get(key)) < 30_000
    spark.conf.unset(key)
