"""Train, evaluate on the last months, refit on every row, and report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.contract import FEATURES
from tillwright.functions.joins import one_row
from tillwright.operators import models
from tillwright.operators.evaluation import (
    HOLDOUT_MONTHS,
    fold_calendar,
    forecast_metrics,
    test_months,
    with_baseline,
)
from tillwright.operators.quality import validate_training
from tillwright.operators.series import monthly_series
from tillwright.session import written
from tillwright.sinks.tables import as_csv, as_json


@dataclass(frozen=True)
class Trained:
    """The final model, and the hold-out rows and metrics of the evaluation fit."""

    model: PipelineModel
    evaluation: DataFrame
    metrics: DataFrame


def holdout_forecast(
    name: str,
    training: DataFrame,
    monthly: DataFrame,
    keys: Sequence[str] = (),
    horizon: int = HOLDOUT_MONTHS,
    strict: bool = True,
    **settings,
) -> DataFrame:
    """Actual, Forecast and Baseline of the last `horizon` months.

    A pooled fit holds out the same calendar months of all series. `training` and `monthly` are
    written tables.
    """
    if horizon < 1:
        raise ValueError("horizon must be at least 1")
    # The hold-out is a backtest of a single fold.
    holdout = fold_calendar(training, folds=1, months=horizon)
    cutoff = holdout.first()["test_start"]
    model = models.fit(name, training.filter(F.col("target_month") < cutoff), **settings)
    rows = with_baseline(test_months(training, holdout), monthly, keys, strict)
    return models.predict(model, rows, "Forecast").select(*keys, "target_month", "Actual", "Forecast", "Baseline")


# The names of the metrics in a report.
_MEASURES = {"MAPE": "mape", "sMAPE": "smape", "MAE": "mae", "RMSE": "rmse"}


def training_report(
    training: DataFrame, metrics: DataFrame, name: str, horizon: int = HOLDOUT_MONTHS, model: str = "Forecast"
) -> DataFrame:
    """One row of run metadata with the metrics of `Baseline` and `Model` side by side.

    `metrics` has one row per prediction column; `model` names the one that is the model's.
    """
    holdout = fold_calendar(training, folds=1, months=horizon)

    def measured(of: str) -> Column:
        values = F.struct(*(F.col(c).alias(to) for to, c in _MEASURES.items()))
        return F.max(F.when(F.col("model") == of, values))

    both = metrics.agg(measured("Baseline").alias("Baseline"), measured(model).alias("Model"))
    # The fields of a report.
    return holdout.select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("trained_at_utc"),
        F.lit(name).alias("model"),
        F.lit("mart_forecast_training").alias("source"),
        F.array(*(F.lit(f) for f in FEATURES)).alias("feature_columns"),
        (F.col("training_rows") + F.col("test_rows")).alias("training_rows_total"),
        F.col("training_rows").alias("evaluation_training_rows"),
        F.col("test_rows").alias("holdout_rows"),
        F.lit(horizon).alias("horizon"),
        F.col("train_start").alias("training_start"),
        F.col("test_end").alias("training_end"),
        F.col("test_start").alias("holdout_start"),
        F.col("test_end").alias("holdout_end"),
        one_row(both).alias("metrics"),
    )


def train(
    name: str,
    training: DataFrame,
    monthly: DataFrame,
    out: str,
    keys: Sequence[str] = (),
    horizon: int = HOLDOUT_MONTHS,
    strict: bool = True,
    **settings,
) -> Trained:
    """Validate, evaluate, refit on all rows, and write model, evaluation and report below `out`.

    Strict runs refuse gaps in a series and hold-out months without a baseline. A panel of series
    that come and go is run with `strict=False`: such hold-out rows then have a NULL baseline.
    """
    # Written before they are checked, so that a lazy input is computed once.
    training = validate_training(written(training, "training"), keys)
    monthly = monthly_series(monthly, keys, gaps=not strict)
    evaluation = written(holdout_forecast(name, training, monthly, keys, horizon, strict, **settings), "evaluation")
    metrics = forecast_metrics(evaluation, ["Forecast", "Baseline"])
    final = models.fit(name, training, **settings)
    out = out.rstrip("/")
    models.save_model(final, f"{out}/models/sales_forecast_{name}")
    as_csv(evaluation.orderBy(*keys, "target_month"), f"{out}/forecast_evaluation_{name}")
    as_json(training_report(training, metrics, name, horizon), f"{out}/training_metrics_{name}")
    return Trained(final, evaluation, metrics)
