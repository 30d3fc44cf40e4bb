"""Compare feature sets over expanding folds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.contract import FEATURE_SETS
from tillwright.operators import boosting, models
from tillwright.operators.evaluation import (
    FOLD_MONTHS,
    FOLDS,
    fold_calendar,
    fold_results,
    fold_summary,
    fold_wins,
    test_months,
)
from tillwright.operators.quality import validate_training
from tillwright.session import written
from tillwright.sinks.tables import as_csv


# Boosting by `operators/boosting.py`, beside the estimators of `operators/models.py`.
BOOSTED = "hist"


@dataclass(frozen=True)
class Comparison:
    results: DataFrame
    summary: DataFrame
    wins: DataFrame

    def write(self, out: str) -> None:
        for part in ("results", "summary", "wins"):
            as_csv(getattr(self, part), f"{out.rstrip('/')}/feature_set_comparison_{part}")


def boosted_folds(
    training: DataFrame,
    test_rows: DataFrame,
    starts: Mapping[int, date],
    feature_sets: Mapping[str, Sequence[str]],
    keys: Sequence[str],
    given: boosting.Settings,
) -> DataFrame:
    """Test rows (`fold`, `Actual`) with a column of predictions per feature set, from one boosted model per set and fold.

    `starts` has the first test month of each fold; earlier rows train it.
    """
    row_id = F.to_json(F.struct("target_month", *keys))
    inputs = F.array(
        *(F.struct(F.lit(s).alias("set"), F.array(*(F.col(f).cast("double") for f in own)).alias("x")) for s, own in feature_sets.items())
    )

    def jobs(rows: DataFrame, y: Column) -> DataFrame:
        model = F.concat_ws("/", "input.set", "fold").alias("model")
        exploded = rows.select("fold", row_id.alias("row_id"), y.alias("y"), F.explode(inputs).alias("input"))
        return exploded.select(model, "row_id", "y", F.col("input.x").alias("x"))

    later = F.array(*(F.when(F.col("target_month") < F.lit(start), F.lit(fold)) for fold, start in starts.items()))
    fitted = training.withColumn("fold", F.explode(F.array_compact(later)))
    both = jobs(fitted, F.col("target_sales").cast("double")).unionByName(jobs(test_rows, F.lit(None).cast("double")))
    predicted = boosting.boost(both, given).predictions
    per_row = predicted.groupBy(F.substring_index("model", "/", -1).cast("int").alias("fold"), "row_id").agg(
        *(F.max(F.when(F.substring_index("model", "/", 1) == s, F.col("prediction"))).alias(s) for s in feature_sets)
    )
    return test_rows.select("fold", "Actual", row_id.alias("row_id")).join(per_row, ["fold", "row_id"]).drop("row_id")


def compare_feature_sets(
    training: DataFrame,
    settings: Mapping[str, Mapping] | None = None,
    keys: Sequence[str] = (),
    feature_sets: Mapping[str, Sequence[str]] = FEATURE_SETS,
    folds: int = FOLDS,
    months: int = FOLD_MONTHS,
    parallel: int = 4,
) -> Comparison:
    """Fit every model and feature set on each fold and measure the fold's test months.

    `settings` maps the models to run to their setting overrides; `hist` is boosting with an L2 term, whose folds and
    feature sets are all grown in one job. The training rows are validated
    and written once, sorted by month, so that a fold skips the row groups of other months. Several
    fits are in flight at once, as in Spark's own cross-validation.
    """
    training = written(validate_training(written(training, "training"), keys), "sorted-training")
    settings = {name: {} for name in (*models.MODELS, BOOSTED)} if settings is None else settings
    calendar = written(fold_calendar(training, folds, months), "folds")
    starts = {row["fold"]: row["test_start"] for row in calendar.select("fold", "test_start").collect()}
    test_rows = test_months(training, calendar)

    def one_fold(job: tuple[str, str, int]) -> DataFrame:
        name, feature_set, fold = job
        rows = training.filter(F.col("target_month") < starts[fold])
        model = models.fit(name, rows, feature_sets[feature_set], **settings[name])
        predicted = models.predict(model, test_rows.filter(F.col("fold") == fold), feature_set)
        return predicted.select("fold", "Actual", feature_set)

    jobs = [(name, s, fold) for name in settings if name != BOOSTED for s in feature_sets for fold in sorted(starts)]
    with ThreadPool(parallel) as pool:
        scored = pool.map(inheritable_thread_target(training.sparkSession)(one_fold), jobs)

    if BOOSTED in settings:
        given = boosting.Settings(**settings[BOOSTED])
        boosted = written(boosted_folds(training, test_rows, starts, feature_sets, keys, given), "boosted-folds")

    def results_of(name: str, feature_set: str) -> DataFrame:
        if name == BOOSTED:
            rows = boosted.select("fold", "Actual", feature_set)
        else:
            parts = [f for f, job in zip(scored, jobs) if job[:2] == (name, feature_set)]
            rows = reduce(DataFrame.unionByName, parts)
        return fold_results(rows, calendar, {feature_set: len(feature_sets[feature_set])}, name)

    parts = [results_of(name, s) for name in settings for s in feature_sets]
    results = written(reduce(DataFrame.unionByName, parts), "fold-results")
    return Comparison(results, fold_summary(results), fold_wins(results))
