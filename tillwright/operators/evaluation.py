"""Hold-out split, expanding folds, error measures and fold summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.functions.joins import null_safe_join
from tillwright.functions.metrics import error_measures
from tillwright.functions.moments import exact_measures
from tillwright.operators.series import seasonal_naive

# The backtest's shape.
FOLDS = 5
FOLD_MONTHS = 3
HOLDOUT_MONTHS = 3


def holdout_split(
    training: DataFrame, horizon: int = HOLDOUT_MONTHS, keys: Sequence[str] = (), calendar: bool = False
) -> DataFrame:
    """Adds `split`: the last `horizon` months are `test`, earlier ones `train`.

    The cut is made in each series' own months or, with `calendar`, in the months of the whole input, as a pooled
    fit needs it. A single series with no training month left fails the query; in a panel the rows of such a
    series are marked `short`.
    """
    if horizon < 1:
        raise ValueError("horizon must be at least 1")
    series = Window.partitionBy(*keys)
    if calendar:
        # One row per calendar month.
        ages = training.select("target_month").distinct()
        ages = ages.withColumn("_age", F.row_number().over(Window.orderBy(F.desc("target_month"))))
        training = training.join(ages, "target_month").select(*training.columns, "_age")
    else:
        training = training.withColumn("_age", F.row_number().over(series.orderBy(F.desc("target_month"))))
    none_left = F.max("_age").over(series) <= horizon
    short = F.lit("short") if keys else F.raise_error(F.lit(f"too few months for a hold-out of {horizon}"))
    split = F.when(none_left, short).when(F.col("_age") <= horizon, F.lit("test")).otherwise(F.lit("train"))
    return training.withColumn("split", split).drop("_age")


def with_baseline(targets: DataFrame, monthly: DataFrame, keys: Sequence[str] = (), strict: bool = True) -> DataFrame:
    """Evaluation rows: adds `Actual` and `Baseline` to the target rows.

    A target without a baseline fails the query or, if not `strict`, keeps a NULL baseline, which every error
    measure skips.
    """
    naive = seasonal_naive(monthly, keys).withColumnRenamed("month", "target_month")
    rows = null_safe_join(targets, naive.drop("total_sales"), [*keys, "target_month"], "left")
    baseline = F.col("baseline")
    if strict:
        none = F.raise_error(F.lit("a hold-out month has neither last year's nor the previous month's sales"))
        baseline = F.when(baseline.isNull(), none).otherwise(baseline)
    return rows.withColumns({"Actual": F.col("target_sales"), "Baseline": baseline})


def forecast_metrics(evaluation: DataFrame, predictions: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """MAPE, sMAPE, MAE and RMSE of each prediction column against `Actual`."""
    actual = F.col("Actual")
    wanted = {name: error_measures(actual, F.col(name)) for name in predictions}
    measured = exact_measures(evaluation, by, {f"{name} {m}": given for name, own in wanted.items() for m, given in own.items()})
    # One pass over the rows: the models become rows only after the aggregate.
    models = F.array(
        *(F.struct(F.lit(name).alias("model"), *(F.col(f"`{name} {m}`").alias(m) for m in own)) for name, own in wanted.items())
    )
    return measured.select(*by, F.inline(models))


def fold_calendar(training: DataFrame, folds: int = FOLDS, months: int = FOLD_MONTHS) -> DataFrame:
    """Fold bounds and row counts of an expanding-window backtest.

    Folds are cut over the distinct target months, so a pooled fit of many series never trains on
    a month of its test window. For one series this is the usual split by rows. Fewer months than
    the folds need fail the query.
    """
    per_month = training.groupBy("target_month").agg(F.count("*").alias("_rows"))
    # From here on there is one row per calendar month.
    newest_first = Window.orderBy(F.desc("target_month"))
    position = F.row_number().over(newest_first)
    every_month = Window.partitionBy()
    enough = F.count("*").over(every_month) > folds * months
    fold = F.lit(folds) - F.floor((position - 1) / F.lit(months)).cast("int")
    assigned = per_month.withColumn(
        "fold",
        F.when(~enough, F.raise_error(F.lit(f"too few months for {folds} folds of {months}"))).otherwise(fold),
    )
    earlier = Window.orderBy("fold").rowsBetween(Window.unboundedPreceding, -1)
    # Months before the first fold share fold 0.
    bounds = (
        assigned.withColumn("fold", F.greatest("fold", F.lit(0)))
        .groupBy("fold")
        .agg(
            F.sum("_rows").alias("test_rows"),
            F.min("target_month").alias("test_start"),
            F.max("target_month").alias("test_end"),
        )
    )
    return bounds.select(
        "fold",
        F.sum("test_rows").over(earlier).alias("training_rows"),
        "test_rows",
        F.min("test_start").over(earlier).alias("train_start"),
        F.max("test_end").over(earlier).alias("train_end"),
        "test_start",
        "test_end",
    ).filter(F.col("fold") > 0)


def fold_results(test_rows: DataFrame, calendar: DataFrame, predictions: dict[str, int], model: str) -> DataFrame:
    """Metrics per feature set and fold.

    `test_rows` has `fold`, `Actual` and one prediction column per feature set; `predictions` maps
    the feature set to its number of features.
    """
    counts = F.create_map(*(F.lit(x) for pair in predictions.items() for x in pair))
    measured = forecast_metrics(test_rows, list(predictions), by=["fold"])
    return (
        measured.withColumnRenamed("model", "feature_set")
        .join(calendar, "fold")
        # The result columns.
        .select(
            F.lit(model).alias("model"),
            "feature_set",
            counts[F.col("feature_set")].alias("feature_count"),
            "fold",
            "training_rows",
            "test_rows",
            "train_start",
            "train_end",
            "test_start",
            "test_end",
            "rmse",
            "mae",
            "mape",
            "smape",
        )
    )


def test_months(training: DataFrame, calendar: DataFrame) -> DataFrame:
    """Training rows that fall into a test window, with their fold."""
    windows = calendar.select(
        "fold", F.explode(F.expr("sequence(test_start, test_end, interval 1 month)")).alias("target_month")
    )
    return training.join(windows, "target_month").withColumn("Actual", F.col("target_sales"))


def fold_summary(results: DataFrame) -> DataFrame:
    """Mean and spread of the fold metrics per model and feature set."""
    kinds = {"rmse": ("mean", "stddev"), "mae": ("mean",), "mape": ("mean",), "smape": ("mean", "stddev")}
    names = {"mean": "mean", "stddev": "std"}
    wanted = {f"{error}_{names[kind]}": (kind, F.col(error)) for error, own in kinds.items() for kind in own}
    return exact_measures(results, ["model", "feature_set", "feature_count"], wanted).orderBy("model", "smape_mean")


def fold_wins(results: DataFrame, five: str = "five_features", six: str = "six_features") -> DataFrame:
    """Folds won by either feature set, per model and metric."""
    folds = (
        results.unpivot(["model", "fold", "feature_set"], ["rmse", "smape"], "metric", "error")
        .groupBy("model", "metric", "fold")
        .pivot("feature_set", [five, six])
        .agg(F.first("error"))
    )
    return (
        folds.groupBy("model", "metric")
        .agg(
            F.count_if(F.col(six) < F.col(five)).alias("six_feature_wins"),
            F.count_if(F.col(five) < F.col(six)).alias("five_feature_wins"),
            F.count_if(F.col(five) == F.col(six)).alias("ties"),
            F.count("*").alias("folds"),
        )
        .orderBy("model", "metric")
    )
