import pytest
from pyspark.sql import functions as F

from tests.helpers import dicts, monthly_frame
from tillwright.contract import FEATURES, DataCheckError, FeatureContractError
from tillwright.operators import quality
from tillwright.operators.features import forecast_training, next_month_features


@pytest.fixture(scope="module")
def monthly(spark):
    return monthly_frame(spark, [(n, 50 + n * 7 % 11) for n in range(12)])


def failures(frame):
    return {(r["check"], r["column"]): r["failures"] for r in dicts(frame)}


def test_47_checks_are_declared():
    declared = quality.declared_checks()
    assert sum(len(c) for c in declared.values()) == 44
    assert [len(c) for c in declared.values()] == [10, 6, 3, 3, 1, 1, 1, 10, 9]


def test_column_checks_count_failures(spark):
    frame = spark.createDataFrame(
        [("1", "a"), ("1", "x"), (None, None), (None, "b"), ("2", "x")], "id string, kind string"
    )
    checks = [
        quality.Check("unique", "id"),
        quality.Check("not_null", "id"),
        quality.Check("not_null", "kind"),
        quality.Check("accepted_values", "kind", ("a", "b")),
    ]
    assert failures(quality.column_checks(frame, "r", checks)) == {
        ("unique", "id"): 1, ("not_null", "id"): 2, ("not_null", "kind"): 1, ("accepted_values", "kind"): 2
    }
    assert set(failures(quality.column_checks(frame.limit(0), "r", checks)).values()) == {0}
    assert set(failures(quality.column_checks(frame.limit(0), "r", checks[1:])).values()) == {0}


def test_failed_checks_are_named(spark):
    frame = spark.createDataFrame([(None,), (2,)], "id int")
    report = quality.column_checks(frame, "r", [quality.Check("not_null", "id"), quality.Check("unique", "id")])
    assert {r["rows"] for r in dicts(report)} == {2}
    with pytest.raises(DataCheckError, match="r.id not_null: 1 failures$"):
        quality.require_clean(report)
    quality.require_clean(report.filter("check = 'unique'"))


def test_one_row_check(monthly):
    features = next_month_features(monthly)
    assert failures(quality.one_row_check(features, "r")) == {("one_row", "*"): 0}
    assert failures(quality.one_row_check(features.limit(0), "r")) == {("one_row", "*"): 1}
    assert failures(quality.one_row_check(features.union(features), "r")) == {("one_row", "*"): 1}


@pytest.mark.parametrize("column", ["target_sales", *FEATURES])
def test_recomputation_finds_a_wrong_training_value(monthly, column):
    good = forecast_training(monthly)
    assert set(failures(quality.training_value_check(good, monthly)).values()) == {0}
    bad = good.withColumn(column, F.when(F.month("target_month") == 9, F.col(column) + 1).otherwise(F.col(column)))
    found = failures(quality.training_value_check(bad, monthly))
    assert {c for (_, c), n in found.items() if n} == {column} and sum(found.values()) == 1


def test_recomputation_finds_missing_history(spark, monthly):
    short = monthly.filter(F.month("month") != 4)
    found = failures(quality.training_value_check(forecast_training(monthly), short))
    assert found[("recomputed", "history")] == 4  # targets July to October look back at April


@pytest.mark.parametrize("column", FEATURES)
def test_recomputation_finds_a_wrong_next_month_value(monthly, column):
    good = next_month_features(monthly)
    assert set(failures(quality.next_month_value_check(good, monthly)).values()) == {0}
    found = failures(quality.next_month_value_check(good.withColumn(column, F.col(column) + 1), monthly))
    assert {c for (_, c), n in found.items() if n} == {column}


def test_panel_recomputation_with_a_null_series(spark):
    values = [(s, n, 3 * n + len(str(s))) for s in ("a", None) for n in range(9)]
    monthly = monthly_frame(spark, values, ["s"])
    assert set(failures(quality.training_value_check(forecast_training(monthly, ["s"]), monthly, ["s"])).values()) == {0}
    assert set(failures(quality.next_month_value_check(next_month_features(monthly, ["s"]), monthly, ["s"])).values()) == {0}


def test_valid_training_is_typed_and_sorted(monthly):
    text = forecast_training(monthly).select([F.col(c).cast("string") for c in ("target_month", "target_sales", *FEATURES)])
    valid = quality.validate_training(text.orderBy(F.desc("target_month")))
    assert dict(valid.dtypes)["target_month"] == "date" and dict(valid.dtypes)["lag_1"] == "double"
    months = [r["target_month"] for r in valid.collect()]
    assert months == sorted(months) and len(months) == 6


@pytest.mark.parametrize(
    "spoil, message",
    [
        (lambda f: f.limit(0), "no training rows"),
        (lambda f: f.drop("lag_2"), "absent"),
        (lambda f: f.withColumn("target_month", F.lit("soon")), "invalid dates"),
        (lambda f: f.union(f), "repeats"),
        (lambda f: f.withColumn("target_sales", F.lit("many")), "target_sales"),
        (lambda f: f.withColumn("target_sales", F.lit(float("nan"))), "target_sales"),
        (lambda f: f.withColumn("lag_1", F.lit(None).cast("double")), r"missing feature values in \['lag_1'\]"),
        (lambda f: f.withColumn("lag_3", F.lit("n/a")), r"non-numeric feature values in \['lag_3'\]"),
        (lambda f: f.withColumn("month_of_year", F.lit(13)), "1 to 12"),
        (lambda f: f.withColumn("month_of_year", F.lit(1.5)), "whole number"),
        (lambda f: f.withColumn("target_month", F.col("target_month").cast("timestamp") + F.expr("interval 1 hour")), "invalid dates"),
        (lambda f: f.withColumn("target_month", F.concat(F.col("target_month").cast("string"), F.lit(" 10:00"))), "invalid dates"),
        (lambda f: f.withColumn("target_month", F.col("target_month").cast("string")).union(
            f.withColumn("target_month", F.date_format("target_month", "yyyy-M-d"))), "repeats"),
    ],
)
def test_training_contract(monthly, spoil, message):
    with pytest.raises(FeatureContractError, match=message):
        quality.validate_training(spoil(forecast_training(monthly)))


def test_prediction_contract(spark, monthly):
    row = next_month_features(monthly)
    assert quality.validate_prediction(row).count() == 1
    for rows in (row.limit(0), row.union(row)):
        with pytest.raises(FeatureContractError, match="one prediction row"):
            quality.validate_prediction(rows)
    with pytest.raises(FeatureContractError, match="invalid dates"):
        quality.validate_prediction(row.withColumn("target_month", F.lit(None).cast("date")))
    panel = next_month_features(monthly_frame(spark, [(s, n, n) for s in "ab" for n in range(7)], ["s"]), ["s"])
    assert quality.validate_prediction(panel, ["s"]).count() == 2
    with pytest.raises(FeatureContractError, match="one prediction row"):
        quality.validate_prediction(panel.union(panel.limit(1)), ["s"])


def test_feature_names():
    quality.validate_feature_names(FEATURES)
    for names in (None, FEATURES[:5], tuple(reversed(FEATURES))):
        with pytest.raises(FeatureContractError):
            quality.validate_feature_names(names)
