"""Forecast the next month of every series and log it."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.operators.models import next_month_forecast
from tillwright.operators.quality import validate_prediction
from tillwright.session import written
from tillwright.sinks.forecast_log import append_forecasts

logger = logging.getLogger(__name__)


def forecast_and_log(
    model: PipelineModel,
    name: str,
    features: DataFrame,
    log_path: str,
    keys: Sequence[str] = (),
    source: str = "mart_next_month_features",
) -> DataFrame:
    """Forecast each feature row; `logged` says whether the log took the rows.

    Features that break the contract raise. A failing log does not fail the forecast.
    """
    features = validate_prediction(written(features, "features"), keys)
    forecasts = written(next_month_forecast(model, name, features, source), "forecasts")
    try:
        append_forecasts(forecasts, log_path, keys)
        logged = True
    except Exception:
        logger.exception("forecasts were made but not logged")
        logged = False
    return forecasts.withColumn("logged", F.lit(logged))
