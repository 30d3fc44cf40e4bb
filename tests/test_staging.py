from datetime import date

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from tests.helpers import RAW_COLUMNS, dicts, raw_line
from tillwright.contract import RAW_SCHEMA, STAGED_NAMES
from tillwright.operators.dashboards import monthly_revenue
from tillwright.sources.orders import read_coerced_orders, read_daily_revenue, read_raw_orders, stage


def raw(spark, *lines):
    return spark.createDataFrame(list(lines), RAW_SCHEMA)


def test_names_and_types(spark):
    staged = stage(raw(spark, raw_line("1")))
    assert staged.columns == list(STAGED_NAMES.values()) and len(RAW_COLUMNS) == 21
    types = dict(staged.dtypes)
    assert (types["sales"], types["quantity"], types["discount"], types["profit"]) == ("double", "bigint", "double", "double")
    assert types["order_date"] == "date"


def test_all_columns_are_needed_unless_pruned(spark):
    few = raw(spark, raw_line("1")).drop("City")
    with pytest.raises(ValueError, match="City"):
        stage(few)
    assert "city" not in stage(few, pruned=True).columns


def test_text_measures_are_cast(spark):
    text = raw(spark, raw_line("1")).withColumns({c: F.col(c).cast("string") for c in ("Sales", "Quantity")})
    assert dicts(stage(text).select("sales", "quantity")) == [{"sales": 10.0, "quantity": 2}]


def test_lines_without_date_or_sales_are_dropped(spark):
    lines = [
        raw_line("1"),
        raw_line("2", **{"Order Date": None}),
        raw_line("3", Sales=None),
        raw_line("4", Profit=None, Category=None),
    ]
    assert {r["row_id"] for r in dicts(stage(raw(spark, *lines)))} == {"1", "4"}


def test_csv_and_parquet_agree(spark, tmp_path):
    frame = raw(spark, raw_line("1"), raw_line("2", Profit=None, Sales=957.5775))
    frame.write.option("header", True).csv(str(tmp_path / "csv"))
    frame.write.parquet(str(tmp_path / "parquet"))
    from_csv = stage(read_raw_orders(spark, str(tmp_path / "csv"), "csv")).orderBy("row_id")
    from_parquet = stage(read_raw_orders(spark, str(tmp_path / "parquet"))).orderBy("row_id")
    assert from_csv.collect() == from_parquet.collect()
    assert from_csv.schema == from_parquet.schema


def test_csv_dates_in_another_format_and_wrong_headers(spark, tmp_path):
    frame = raw(spark, raw_line("1"))
    frame.write.option("header", True).option("dateFormat", "M/d/yyyy").csv(str(tmp_path / "us"))
    staged = stage(read_raw_orders(spark, str(tmp_path / "us"), "csv", "M/d/yyyy"))
    assert dicts(staged.select("order_date")) == [{"order_date": date(2014, 1, 5)}]
    frame.withColumnRenamed("Sales", "Turnover").write.option("header", True).csv(str(tmp_path / "wrong"))
    with pytest.raises(Py4JJavaError, match="CSV header does not conform"):
        stage(read_raw_orders(spark, str(tmp_path / "wrong"), "csv")).collect()


def test_daily_revenue_csv(spark, tmp_path):
    (tmp_path / "s.csv").write_text("store,date,revenue\na,2020-01-03,1.5\nb,2020-01-09,2.25\na,2020-02-01,4\n")
    months = monthly_revenue(read_daily_revenue(spark, str(tmp_path / "s.csv")))
    assert dicts(months) == [
        {"month": date(2020, 1, 1), "revenue": 3.75},
        {"month": date(2020, 2, 1), "revenue": 4.0},
    ]


def csv_of(folder, *lines):
    folder.mkdir()
    (folder / "part.csv").write_text("\n".join([",".join(RAW_COLUMNS), *lines]) + "\n")
    return str(folder)


GOOD = "1,o1,2014-01-05,2014-01-07,Second Class,c1,Ann,Consumer,US,Kent,Ohio,42420,East,p1,Furniture,Chairs,Chair,10.5,2,0.1,1.5"


def test_values_that_cannot_be_read_become_null_and_are_named(spark, tmp_path):
    path = csv_of(
        tmp_path / "a",
        GOOD,
        GOOD.replace("1,o1,2014-01-05", "2,o1,2014-02-30"),
        GOOD.replace("1,o1", "3,o1").replace("10.5,2,", "n/a,two,"),
        GOOD.replace("1,o1,2014-01-05", "4,o1,").replace(",10.5,", ",,"),
        "5,o1,2014-01-05",
        GOOD.replace("1,o1", "6,o1") + ",more",
    )
    lines, rejects = read_coerced_orders(spark, path)
    assert lines.schema == RAW_SCHEMA
    rows = {r["Row ID"]: r for r in dicts(lines)}
    assert set(rows) == set("123456")
    assert rows["1"]["Order Date"] == date(2014, 1, 5) and (rows["1"]["Sales"], rows["1"]["Quantity"]) == (10.5, 2)
    assert rows["2"]["Order Date"] is None and rows["2"]["Ship Date"] == date(2014, 1, 7)
    assert rows["3"]["Sales"] is rows["3"]["Quantity"] is None and rows["3"]["Profit"] == 1.5
    found = {r["Row ID"]: (r["faults"], r["record"]) for r in dicts(rejects)}
    assert found == {
        "2": (["Order Date"], None),
        "3": (["Sales", "Quantity"], None),
        "5": (["*"], "5,o1,2014-01-05"),
        "6": (["*"], GOOD.replace("1,o1", "6,o1") + ",more"),
    }
    assert {r["row_id"] for r in dicts(stage(lines))} == {"1", "6"}


def test_a_clean_or_empty_file_has_no_rejects(spark, tmp_path):
    for name, lines in (("clean", [GOOD]), ("empty", [])):
        coerced, rejects = read_coerced_orders(spark, csv_of(tmp_path / name, *lines))
        assert coerced.count() == len(lines) and rejects.count() == 0
    same = stage(read_raw_orders(spark, str(tmp_path / "clean"), "csv"))
    assert same.collect() == stage(read_coerced_orders(spark, str(tmp_path / "clean"))[0]).collect()


def test_coerced_dates_in_another_format_and_wrong_headers(spark, tmp_path):
    path = csv_of(tmp_path / "us", GOOD.replace("2014-01-05", "1/5/2014").replace("2014-01-07", "13/7/2014"))
    lines, rejects = read_coerced_orders(spark, path, "M/d/yyyy")
    assert dicts(lines.select("Order Date", "Ship Date")) == [{"Order Date": date(2014, 1, 5), "Ship Date": None}]
    assert [r["faults"] for r in dicts(rejects)] == [["Ship Date"]]
    (tmp_path / "us" / "part.csv").write_text(",".join(RAW_COLUMNS).replace("Sales", "Turnover") + "\n" + GOOD + "\n")
    with pytest.raises(Py4JJavaError, match="CSV header does not conform"):
        read_coerced_orders(spark, path)[0].collect()


def test_daily_revenue_with_dirty_values(spark, tmp_path):
    (tmp_path / "s.csv").write_text("date,revenue\n2020-01-03,1.5\nsoon,8\n2020-01-04,none\n")
    rows = dicts(read_daily_revenue(spark, str(tmp_path / "s.csv"), lenient=True))
    assert [(r["date"], r["revenue"]) for r in rows] == [(date(2020, 1, 3), 1.5), (None, 8.0), (date(2020, 1, 4), None)]
    with pytest.raises(Exception, match="CANNOT_PARSE|CAST_INVALID"):
        read_daily_revenue(spark, str(tmp_path / "s.csv")).collect()
