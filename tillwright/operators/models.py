"""Forecast models on `pyspark.ml`: one pooled fit over all series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.contract import FEATURES
from tillwright.operators.quality import validate_feature_names
from tillwright.operators.task_boosting import fit_in_task

# The tree settings. A leaf of two rows also implies splits of four or more.
RANDOM_FOREST = {"numTrees": 600, "maxDepth": 12, "minInstancesPerNode": 2, "seed": 42}
BOOSTED_TREES = {"maxIter": 600, "maxDepth": 8, "stepSize": 0.05, "subsamplingRate": 0.9, "seed": 42}

# More bins than training months of one series: every value can be a split. The memory lets one pass over the rows
# serve all nodes of a level. Keeping node ids between levels made fits of a monthly series a third slower. Until the
# next checkpoint every job of a boosted fit carries the trees since the last one in its tasks, so that comes soon.
_FIT = {"maxBins": 256, "maxMemoryInMB": 1024, "checkpointInterval": 10}

_ESTIMATORS = {
    "rf": (RandomForestRegressor, {"featureSubsetStrategy": "all", **_FIT, **RANDOM_FOREST}),
    "gbt": (GBTRegressor, {"featureSubsetStrategy": "0.9", **_FIT, **BOOSTED_TREES}),
}
MODELS = tuple(_ESTIMATORS)


def create_model(name: str, features: Sequence[str] = FEATURES, **settings) -> Pipeline:
    """An unfitted model; `settings` replace the defaults above."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    if name not in _ESTIMATORS:
        raise ValueError(f"unknown model {name}, expected one of {MODELS}")
    make, defaults = _ESTIMATORS[name]
    trees = make(featuresCol="features", labelCol="target_sales", predictionCol="prediction", **{**defaults, **settings})
    return Pipeline(stages=[assembler, trees])


def feature_names(model: PipelineModel) -> tuple[str, ...]:
    return tuple(model.stages[0].getInputCols())


def fit(name: str, training: DataFrame, features: Sequence[str] = FEATURES, **settings) -> PipelineModel:
    """Fit on the training rows. Read them from a written table, so that a repeat gives the same model.

    A boosted model of few rows is grown in one task, with the trees that Spark's own jobs per level would give.
    """
    pipeline, rows = create_model(name, features, **settings), training.select("target_sales", *features)
    assembler, trees = pipeline.getStages()
    grown = fit_in_task(trees, rows, features) if name == "gbt" else None
    model = pipeline.fit(rows) if grown is None else PipelineModel([assembler, grown])
    validate_feature_names(feature_names(model), features)
    return model


def predict(model: PipelineModel, rows: DataFrame, to: str = "prediction") -> DataFrame:
    scored = model.transform(rows).drop("features")
    return scored if to == "prediction" else scored.withColumnRenamed("prediction", to)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str, features: Sequence[str] = FEATURES) -> PipelineModel:
    model = PipelineModel.load(path)
    validate_feature_names(feature_names(model), features)
    return model


def next_month_forecast(model: PipelineModel, name: str, features: DataFrame, source: str) -> DataFrame:
    """Full-precision `prediction` and its two-decimal `forecast` for each feature row."""
    return predict(model, features).select(
        F.lit(name).alias("model"),
        *features.columns,
        "prediction",
        F.round("prediction", 2).alias("forecast"),
        F.lit(source).alias("feature_source"),
    )
