import json
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.helpers import dicts, monthly_frame
from tests.oracle import DATA
from tillwright.contract import FEATURE_SETS, FEATURES, FeatureContractError
from tillwright.operators import models
from tillwright.operators.features import forecast_training, next_month_features
from tillwright.plans import backtest, training as train_plan, warehouse
from tillwright.plans.forecasting import forecast_and_log
from tillwright.session import work_path, written
from tillwright.sinks.forecast_log import LOG_SCHEMA, latest_forecasts, numbered
from tillwright.sinks.tables import as_table, read_table
from tillwright.sources import marts as mart_reads
from tillwright.sources.star import order_lines, order_totals

TREES = {"numTrees": 5, "maxDepth": 4}
SF = str(DATA / "sf0.001")


@pytest.fixture(scope="module")
def monthly(spark):
    values = [(s, n, 1000 + 40 * n + 300 * (n % 12 == 11) + 7 * len(s) * (n % 5)) for s in ("a", "bb", "ccc") for n in range(30)]
    return written(monthly_frame(spark, values, ["s"]), "monthly")


@pytest.fixture(scope="module")
def panel(monthly):
    return written(forecast_training(monthly, ["s"]).orderBy("s", "target_month"), "training")


def test_defaults_are_the_full_settings(spark):
    forest = models.create_model("rf").getStages()[1]
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMinInstancesPerNode(), forest.getSeed()) == (600, 12, 2, 42)
    boosted = models.create_model("gbt").getStages()[1]
    assert (boosted.getMaxIter(), boosted.getMaxDepth(), boosted.getStepSize(), boosted.getSubsamplingRate()) == (600, 8, 0.05, 0.9)
    with pytest.raises(ValueError):
        models.create_model("arima")


@pytest.mark.parametrize("name, settings", [("rf", TREES), ("gbt", {"maxIter": 3, "maxDepth": 3})])
def test_same_seed_same_model(panel, name, settings):
    first, second = (dicts(models.predict(models.fit(name, panel, **settings), panel).orderBy("s", "target_month")) for _ in "12")
    assert first == second


def test_boosting_cuts_its_lineage_within_a_few_rounds(spark, panel):
    """Tasks carry all trees since the last checkpoint, which shows as a job of its own and changes no prediction."""
    work_path(spark, "checkpoints")  # sets the checkpoint folder of a local session
    few, jobs, found = {"maxIter": 12, "maxDepth": 2}, {}, {}
    for name, settings in {"default": few, "never": {**few, "checkpointInterval": -1}}.items():
        spark.sparkContext.setJobGroup(f"boosting {name}", name)
        model = models.fit("gbt", panel, **settings)
        jobs[name] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"boosting {name}"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        found[name] = dicts(models.predict(model, panel).orderBy("s", "target_month"))
    assert jobs["default"] > jobs["never"]
    assert found["default"] == found["never"]


def test_saved_model_keeps_its_contract(panel, tmp_path):
    model = models.fit("rf", panel, **TREES)
    for _ in "12":  # the second save replaces the first
        models.save_model(model, str(tmp_path / "m"))
    loaded = models.load_model(str(tmp_path / "m"))
    assert models.feature_names(loaded) == FEATURES
    assert dicts(models.predict(loaded, panel)) == dicts(models.predict(model, panel))
    models.save_model(models.fit("rf", panel, FEATURES[::-1], **TREES), str(tmp_path / "reversed"))
    with pytest.raises(FeatureContractError):
        models.load_model(str(tmp_path / "reversed"))


def test_training_writes_its_reports(panel, monthly, tmp_path, spark):
    done = train_plan.train("rf", panel, monthly, str(tmp_path), ["s"], horizon=2, **TREES)
    assert done.evaluation.columns == ["s", "target_month", "Actual", "Forecast", "Baseline"]
    assert done.evaluation.count() == 6
    assert {r["model"] for r in dicts(done.metrics)} == {"Forecast", "Baseline"}
    csv = spark.read.option("header", True).csv(str(tmp_path / "forecast_evaluation_rf"))
    assert csv.count() == 6 and "Baseline" in csv.columns
    (part,) = Path(tmp_path / "training_metrics_rf").glob("part-*.json")
    report = json.loads(part.read_text())
    assert report["training_rows_total"] == 72 and report["holdout_rows"] == 6 and report["horizon"] == 2
    assert report["holdout_start"] == "2016-05-01" and report["training_end"] == report["holdout_end"] == "2016-06-01"
    assert report["feature_columns"] == list(FEATURES) and set(report["metrics"]) == {"Baseline", "Model"}
    assert set(report["metrics"]["Model"]) == {"MAPE", "sMAPE", "MAE", "RMSE"}
    assert models.load_model(str(tmp_path / "models/sales_forecast_rf"))


def test_a_panel_with_gaps_trains_unless_strict(spark, tmp_path):
    values = [("a", n, 50 + n * n % 13) for n in range(24)] + [("b", n, 30 + n) for n in range(24) if n != 8]
    monthly = monthly_frame(spark, values, ["s"])
    rows = forecast_training(monthly, ["s"])
    with pytest.raises(ValueError, match="skips"):
        train_plan.train("rf", rows, monthly, str(tmp_path), ["s"], **TREES)
    done = train_plan.train("rf", rows, monthly, str(tmp_path), ["s"], strict=False, **TREES)
    assert {(r["s"], r["Baseline"]) for r in dicts(done.evaluation)} >= {("b", 30.0 + 9), ("b", 30.0 + 10)}


def test_a_backtest_refuses_broken_features(panel):
    with pytest.raises(FeatureContractError, match="repeats"):
        backtest.compare_feature_sets(panel.union(panel), {"rf": TREES}, ["s"], folds=2)


def test_holdout_is_not_trained_on(panel, monthly):
    rows = train_plan.holdout_forecast("rf", panel, monthly, ["s"], **TREES)
    doubled = F.when(F.col("target_month") >= "2016-04-01", F.col("target_sales") * 2).otherwise(F.col("target_sales"))
    changed = written(panel.withColumn("target_sales", doubled).orderBy("s", "target_month"), "changed")
    again = train_plan.holdout_forecast("rf", changed, monthly, ["s"], **TREES)
    pick = lambda f: sorted((r["s"], r["target_month"], r["Forecast"]) for r in dicts(f))
    assert pick(rows) == pick(again)


def test_feature_set_comparison(panel, tmp_path, spark):
    done = backtest.compare_feature_sets(panel, {"rf": TREES}, ["s"], folds=2, months=2)
    rows = dicts(done.results.orderBy("feature_set", "fold"))
    assert [(r["feature_set"], r["feature_count"], r["fold"]) for r in rows] == [
        ("five_features", 5, 1), ("five_features", 5, 2), ("six_features", 6, 1), ("six_features", 6, 2)
    ]
    assert [r["training_rows"] for r in rows] == [60, 66, 60, 66] and set(FEATURE_SETS) == {r["feature_set"] for r in rows}
    assert done.summary.count() == 2
    assert all(w["six_feature_wins"] + w["five_feature_wins"] + w["ties"] == w["folds"] == 2 for w in dicts(done.wins))
    done.write(str(tmp_path))
    assert spark.read.option("header", True).csv(str(tmp_path / "feature_set_comparison_wins")).count() == 2


def test_forecasts_are_logged_with_growing_ids(panel, monthly, tmp_path, spark):
    model, log = models.fit("rf", panel, **TREES), str(tmp_path / "log")
    features = next_month_features(monthly, ["s"])
    for _ in "12":
        rows = dicts(forecast_and_log(model, "rf", features, log, ["s"]))
        assert len(rows) == 3 and all(r["logged"] for r in rows)
        assert all(r["forecast"] == round(r["prediction"], 2) and r["feature_source"] for r in rows)
    newest = dicts(latest_forecasts(spark, log, 4))
    assert [r["id"] for r in newest] == [6, 5, 4, 3]
    assert ", ".join(f"{n} {t}" for n, t in latest_forecasts(spark, log).dtypes) == LOG_SCHEMA
    assert None not in newest[0].values() and set(newest[0]["series"]) == {"s"}
    single = next_month_features(monthly.filter("s = 'a'").drop("s"))
    forecast_and_log(model, "rf", single, log)  # another kind of run in the same log
    assert dicts(latest_forecasts(spark, log, 1))[0]["id"] == 7 and dicts(latest_forecasts(spark, log, 1))[0]["series"] == {}
    for limit in (0, 101):
        with pytest.raises(ValueError):
            latest_forecasts(spark, log, limit)


def test_a_failing_log_does_not_fail_the_forecast(panel, monthly, tmp_path):
    (tmp_path / "file").write_text("in the way")
    model = models.fit("rf", panel, **TREES)
    rows = dicts(forecast_and_log(model, "rf", next_month_features(monthly, ["s"]), str(tmp_path / "file"), ["s"]))
    assert len(rows) == 3 and not any(r["logged"] for r in rows)


def test_broken_features_do_not_get_a_forecast(panel, monthly, tmp_path):
    bad = next_month_features(monthly, ["s"]).withColumn("month_of_year", F.lit(0))
    with pytest.raises(FeatureContractError):
        forecast_and_log(models.fit("rf", panel, **TREES), "rf", bad, str(tmp_path / "log"), ["s"])


def test_ids_are_dense_over_partitions(spark):
    rows = written(spark.range(1000, numPartitions=7), "ids").withColumnRenamed("id", "x")
    got = dicts(numbered(rows, 41))
    assert sorted(r["id"] for r in got) == list(range(41, 1041)) and len({r["x"] for r in got}) == 1000


def test_warehouse_from_lines_and_from_orders(spark, tmp_path):
    lines = order_lines(spark, SF)
    orders = order_totals(spark, SF, "order_id", "order_date", "customer_id", "segment", "region", "state")
    first = warehouse.build(lines, str(tmp_path / "a"))
    second = warehouse.build(lines, str(tmp_path / "b"), orders)
    assert len(first) == 9
    for name in first:
        assert sorted(map(repr, first[name].collect())) == sorted(map(repr, second[name].collect())), name
    # A rebuild replaces the tables; a failing one leaves them, and a table can be rebuilt from itself.
    with pytest.raises(PySparkException):
        as_table(first["mart_monthly_sales"].withColumn("month", F.raise_error(F.lit("broken"))), str(tmp_path / "a"), "mart_monthly_sales")
    assert read_table(spark, str(tmp_path / "a"), "mart_monthly_sales").count() == 80
    as_table(read_table(spark, str(tmp_path / "a"), "mart_monthly_sales").limit(7), str(tmp_path / "a"), "mart_monthly_sales")
    assert read_table(spark, str(tmp_path / "a"), "mart_monthly_sales").count() == 7
    first = warehouse.build(lines, str(tmp_path / "a"), publish=True)
    assert first["mart_monthly_sales"].count() == second["mart_monthly_sales"].count() == 80
    folder = str(tmp_path / "a")
    months = [r["month"] for r in mart_reads.read_mart(spark, folder, "mart_monthly_sales", 5).collect()]
    assert len(months) == 5 and months == sorted(months)
    records = mart_reads.mart_records(spark, folder, "mart_monthly_sales", 2)
    assert [r["month"] for r in records] == ["1995-01-01", "1995-02-01"] and isinstance(records[0]["total_sales"], float)
    for name, limit in (("int_monthly_sales", 5), ("mart_monthly_sales", 0), ("mart_monthly_sales", 10_001), ("mart_monthly_sales", "5")):
        with pytest.raises(ValueError):
            mart_reads.read_mart(spark, folder, name, limit)
    assert mart_reads.read_training(spark, folder).count() == 74
    assert mart_reads.read_next_month_features(spark, folder).count() == 1
    assert mart_reads.read_monthly_sales(spark, folder).columns == ["month", "total_sales"]
    top = mart_reads.run_sql(spark, "SELECT * FROM mart_sales_by_region WHERE region = :r", r="ASIA")
    assert top.count() == dicts(first["mart_sales_by_region"].groupBy("region").count().filter("region = 'ASIA'"))[0]["count"]
