import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.helpers import dicts, month, monthly_frame
from tillwright.operators import evaluation as ev
from tillwright.operators.features import forecast_training


def actual_and(spark, pairs):
    return spark.createDataFrame([tuple(map(float, p)) for p in pairs], "Actual double, p double")


def test_metrics_with_a_zero_actual(spark):
    row = dicts(ev.forecast_metrics(actual_and(spark, [(0, 5), (100, 90)]), ["p"]))[0]
    assert row["model"] == "p" and row["mape"] == pytest.approx(10) and row["mae"] == pytest.approx(7.5)
    assert row["rmse"] == pytest.approx(7.905694, abs=1e-6) and row["smape"] == pytest.approx(105.263158, abs=1e-6)


def test_metrics_of_zeros_only(spark):
    row = dicts(ev.forecast_metrics(actual_and(spark, [(0, 0)]), ["p"]))[0]
    assert row["mape"] is None and row["smape"] == 0 and row["mae"] == 0


def training(spark, months, keys=()):
    values = [(n, 100 + n * n % 37) for n in range(months + 6)]
    return forecast_training(monthly_frame(spark, values), keys)


def test_holdout_split(spark):
    split = {r["target_month"]: r["split"] for r in dicts(ev.holdout_split(training(spark, 10)))}
    assert sorted(m for m, s in split.items() if s == "test") == [month(n) for n in (13, 14, 15)]
    assert len(split) == 10
    with pytest.raises(ValueError):
        ev.holdout_split(training(spark, 10), 0)
    values = [("a", n, n) for n in range(16)] + [("b", n, n) for n in range(4, 13)]
    panel = forecast_training(monthly_frame(spark, values, ["s"]), ["s"])
    own = {(r["s"], r["target_month"]): r["split"] for r in dicts(ev.holdout_split(panel, keys=["s"]))}
    assert {s for (k, _), s in own.items() if k == "b"} == {"short"} and own["a", month(13)] == "test"
    pooled = {(r["s"], r["target_month"]): r["split"] for r in dicts(ev.holdout_split(panel, keys=["s"], calendar=True))}
    assert {s for (k, _), s in pooled.items() if k == "b"} == {"train"} and len(pooled) == len(own)
    assert {m for (k, m), s in pooled.items() if s == "test"} == {month(13), month(14), month(15)}
    with pytest.raises(PySparkException, match="too few months"):
        ev.holdout_split(training(spark, 3)).collect()


def test_fold_sizes_of_42_months(spark):
    folds = dicts(ev.fold_calendar(training(spark, 42)).orderBy("fold"))
    assert [f["training_rows"] for f in folds] == [27, 30, 33, 36, 39]
    assert [f["fold"] for f in folds] == [1, 2, 3, 4, 5] and {f["test_rows"] for f in folds} == {3}
    assert folds[0]["train_start"] == month(6) and folds[0]["train_end"] == month(32)
    assert folds[0]["test_start"] == month(33) and folds[-1]["test_end"] == month(47)
    with pytest.raises(PySparkException, match="too few months"):
        ev.fold_calendar(training(spark, 15)).collect()


def test_pooled_folds_never_train_on_a_test_month(spark):
    rows = [("a", n, 10 + n) for n in range(40)] + [("b", n, 5 + n) for n in range(30)]
    panel = forecast_training(monthly_frame(spark, rows, ["s"]), ["s"])
    for fold in dicts(ev.fold_calendar(panel)):
        assert fold["train_end"] < fold["test_start"]
        assert fold["training_rows"] == panel.filter(F.col("target_month") < fold["test_start"]).count()


def test_baseline_missing(spark):
    monthly = monthly_frame(spark, [(0, 5), (2, 7), (3, 8)])
    targets = spark.createDataFrame([(month(2), 7.0), (month(3), 8.0)], "target_month date, target_sales double")
    loose = dicts(ev.with_baseline(targets, monthly, strict=False))
    assert sorted((r["target_month"], r["Baseline"]) for r in loose) == [(month(2), None), (month(3), 7.0)]
    metrics = {r["model"]: r for r in dicts(ev.forecast_metrics(ev.with_baseline(targets, monthly, strict=False), ["Baseline"]))}
    assert metrics["Baseline"]["mae"] == 1.0
    with pytest.raises(PySparkException, match="neither"):
        ev.with_baseline(targets, monthly).collect()


def results(spark):
    errors = {"five_features": [3.0, 2.0, 5.0], "six_features": [1.0, 2.0, 6.0]}
    rows = [("rf", s, n, i, e, e, e, e) for (s, es), n in zip(errors.items(), (5, 6)) for i, e in enumerate(es)]
    return spark.createDataFrame(
        rows,
        "model string, feature_set string, feature_count int, fold int, rmse double, mae double, mape double, smape double",
    )


def test_fold_wins_and_summary(spark):
    wins = dicts(ev.fold_wins(results(spark)))
    assert [w["metric"] for w in wins] == ["rmse", "smape"]
    for w in wins:
        assert (w["six_feature_wins"], w["five_feature_wins"], w["ties"], w["folds"]) == (1, 1, 1, 3)
    summary = dicts(ev.fold_summary(results(spark)))
    assert [s["feature_set"] for s in summary] == ["six_features", "five_features"]
    assert summary[0]["rmse_mean"] == 3.0 and summary[0]["rmse_std"] == pytest.approx(math.sqrt(7))
