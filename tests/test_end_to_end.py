"""From a raw CSV file to a logged forecast, for one series."""

import random
from datetime import date, timedelta

import pytest

from tests.helpers import dicts, month, raw_line
from tillwright.contract import ACCEPTED, RAW_SCHEMA, DataCheckError
from tillwright.operators import models
from tillwright.operators.quality import quality_report, require_clean
from tillwright.plans import forecasting, training, warehouse
from tillwright.session import tune
from tillwright.sinks.forecast_log import latest_forecasts
from tillwright.sources.orders import read_raw_orders, stage


def retail_lines(months):
    rng = random.Random(11)
    for i in range(months * 25):
        n, order = i // 25, i // 2
        category = rng.choice(ACCEPTED["category"])
        yield raw_line(
            f"r{i}",
            **{
                "Order ID": f"CA-{order}",
                "Order Date": month(n) + timedelta(days=rng.randrange(28)),
                "Customer ID": f"c{order % 40}",
                "Segment": ACCEPTED["segment"][order % 3],
                "Region": rng.choice(ACCEPTED["region"]),
                "Product ID": f"p{rng.randrange(30)}",
                "Category": category,
                "Sub-Category": f"{category} {rng.randrange(3)}",
                "Sales": round(rng.uniform(1, 900) * (1 + (n % 12 == 11)), 4),
                "Profit": round(rng.uniform(-50, 90), 4),
            },
        )


def test_csv_to_forecast(spark, tmp_path):
    raw = str(tmp_path / "raw")
    spark.createDataFrame(list(retail_lines(48)), RAW_SCHEMA).write.option("header", True).csv(raw)
    tune(spark, raw)
    lines = stage(read_raw_orders(spark, raw, "csv"))
    tables = warehouse.build(lines, str(tmp_path / "marts"))
    report = quality_report(tables)
    require_clean(report)
    assert report.count() == 47
    assert tables["mart_forecast_training"].count() == 42
    done = training.train(
        "rf", tables["mart_forecast_training"], tables["int_monthly_sales"], str(tmp_path / "reports"), numTrees=10
    )
    assert [r["target_month"] for r in dicts(done.evaluation.orderBy("target_month"))] == [month(n) for n in (45, 46, 47)]
    log = str(tmp_path / "log")
    (row,) = dicts(forecasting.forecast_and_log(done.model, "rf", tables["mart_next_month_features"], log))
    assert row["target_month"] == date(2018, 1, 1) and row["logged"]
    saved = models.load_model(str(tmp_path / "reports/models/sales_forecast_rf"))
    assert dicts(models.predict(saved, tables["mart_next_month_features"]))[0]["prediction"] == row["prediction"]
    assert [r["prediction"] for r in dicts(latest_forecasts(spark, log))] == [row["prediction"]]


def test_a_bad_line_fails_the_checks(spark, tmp_path):
    lines = [*retail_lines(8), raw_line("r0", Category="Food", Region=None)]
    tables = warehouse.build(stage(spark.createDataFrame(lines, RAW_SCHEMA)), str(tmp_path / "marts"))
    with pytest.raises(DataCheckError) as failed:
        require_clean(quality_report(tables))
    for part in ("stg_orders.row_id unique", "stg_orders.category accepted_values", "stg_orders.region not_null",
                 "mart_sales_by_category.category accepted_values"):
        assert part in str(failed.value)
