"""The registered queries over the star-schema tables of a folder.

Each query reads whole tables. A query asks the star source for just the columns it needs, which
decides the joins; where lines are not needed it starts from sums per order.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.contract import FEATURES, PREDICTION_COLUMNS
from tillwright.functions.money import exact_sum, partial_sum, rounded
from tillwright.operators import boosting, dashboards, evaluation, features, marts, models, node_table, quality, series
from tillwright.plans import backtest, training, warehouse
from tillwright.plans.forecasting import forecast_and_log
from tillwright.session import tune, work_path, written
from tillwright.sinks.forecast_log import latest_forecasts as read_latest_forecasts
from tillwright.sinks.tables import as_csv, as_json, as_table, as_view
from tillwright.sources import marts as mart_reads
from tillwright.sources.orders import read_coerced_orders, read_daily_revenue, read_raw_orders, stage
from tillwright.sources.star import (
    GROWING,
    order_lines,
    order_totals,
    part_totals,
    products,
    raw_order_lines,
    staged_checks,
    table_path,
)

Query = Callable[[SparkSession, str], DataFrame]

# The dimension values of the test tables.
ACCEPTED = {
    "category": ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"),
    "region": ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"),
    "segment": ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
}

_LATEST = 12

# The last month of the test tables, 2001-08, is partial.
AS_OF = date(2001, 8, 15)
_REGISTERED: dict[str, Query] = {}


def _query(run: Query) -> Query:
    def tuned(spark: SparkSession, folder: str) -> DataFrame:
        return run(tune(spark, *(table_path(folder, name) for name in GROWING)), folder)

    _REGISTERED[run.__name__] = tuned
    return run


def registered() -> dict[str, Query]:
    return dict(_REGISTERED)


def _measures(frame: DataFrame, money: tuple[str, ...], percent: tuple[str, ...]) -> DataFrame:
    """Round double averages: their last bits depend on the order of addition."""
    return frame.withColumns(
        {**{c: rounded(F.col(c), 2) for c in money}, **{c: rounded(F.col(c), 6) for c in percent}}
    )


# Inputs shared by several queries.


def _monthly(spark: SparkSession, folder: str) -> DataFrame:
    return marts.monthly_sales(order_totals(spark, folder, "order_id", "order_date", "customer_id"), per_order=True)


def _total_by_month(spark: SparkSession, folder: str) -> DataFrame:
    return marts.monthly_totals(order_totals(spark, folder, "order_date"))


def _by_segment(spark: SparkSession, folder: str) -> DataFrame:
    return marts.monthly_totals(order_totals(spark, folder, "order_date", "segment"), "segment")


def _by_sub_category(spark: SparkSession, folder: str) -> DataFrame:
    return marts.monthly_totals(part_totals(spark, folder, "sub_category", monthly=True), "sub_category")


def _product_totals(spark: SparkSession, folder: str) -> DataFrame:
    measures = ("product_id", "order_id", "sales", "profit", "quantity", "discount")
    totals = marts.product_totals(order_lines(spark, folder, *measures), "product_id")
    names = products(spark, folder).toDF("product_id", "category", "sub_category", "product_name")
    measured = [c for c in totals.columns if c != "product_id"]
    return totals.join(names, "product_id", "left").select(*marts.PRODUCT_KEYS, *measured)


# Staging and marts.


@_query
def stg_orders(spark: SparkSession, folder: str) -> DataFrame:
    return order_lines(spark, folder)


@_query
def int_monthly_sales(spark: SparkSession, folder: str) -> DataFrame:
    return _monthly(spark, folder)


@_query
def mart_monthly_sales(spark: SparkSession, folder: str) -> DataFrame:
    return marts.monthly_kpis(_monthly(spark, folder))


@_query
def mart_sales_by_category(spark: SparkSession, folder: str) -> DataFrame:
    return marts.sales_by_category(
        order_lines(spark, folder, "order_id", "category", "sub_category", "sales", "profit", "quantity", "discount")
    )


@_query
def mart_sales_by_region(spark: SparkSession, folder: str) -> DataFrame:
    return marts.sales_by_region(order_totals(spark, folder, "order_id", "customer_id", "region", "state"), per_order=True)


@_query
def mart_sales_by_segment(spark: SparkSession, folder: str) -> DataFrame:
    return marts.sales_by_segment(
        order_totals(spark, folder, "order_id", "order_date", "customer_id", "segment"), per_order=True
    )


@_query
def mart_product_performance(spark: SparkSession, folder: str) -> DataFrame:
    totals = written(_product_totals(spark, folder), "product-totals")
    return marts.product_performance(totals).orderBy(F.desc("total_sales"), "product_id")


# Forecast features.


@_query
def mart_forecast_training(spark: SparkSession, folder: str) -> DataFrame:
    return features.forecast_training(_total_by_month(spark, folder))


@_query
def mart_next_month_features(spark: SparkSession, folder: str) -> DataFrame:
    return features.next_month_features(written(_total_by_month(spark, folder), "monthly"))


@_query
def next_month_features_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """The month of `AS_OF` is the first one that is not complete."""
    return features.next_month_features(_total_by_month(spark, folder), as_of=AS_OF)


@_query
def stale_series(spark: SparkSession, folder: str) -> DataFrame:
    """Sub-categories without sales in the last complete month."""
    return features.stale_series(_by_sub_category(spark, folder), ["sub_category"], as_of=AS_OF)


@_query
def panel_training_by_segment(spark: SparkSession, folder: str) -> DataFrame:
    return features.forecast_training(_by_segment(spark, folder), ["segment"])


@_query
def panel_training_by_subcategory(spark: SparkSession, folder: str) -> DataFrame:
    return features.forecast_training(_by_sub_category(spark, folder), ["sub_category"])


@_query
def panel_next_month_by_segment(spark: SparkSession, folder: str) -> DataFrame:
    return features.next_month_features(written(_by_segment(spark, folder), "monthly"), ["segment"])


@_query
def panel_next_month_by_subcategory(spark: SparkSession, folder: str) -> DataFrame:
    return features.next_month_features(written(_by_sub_category(spark, folder), "monthly"), ["sub_category"])


# Reports.


@_query
def top10_products_per_subcategory(spark: SparkSession, folder: str) -> DataFrame:
    return marts.top_products(_product_totals(spark, folder)).select(
        "category",
        "sub_category",
        "rank_in_subcategory",
        "product_id",
        "product_name",
        "total_sales",
        "total_profit",
        "profit_margin_pct",
    )


_PRODUCT_LINES = (*marts.PRODUCT_KEYS, "order_id", "sales", "profit", "quantity", "discount")


@_query
def product_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Grouped by the four product columns themselves."""
    return marts.product_totals(order_lines(spark, folder, *_PRODUCT_LINES))


@_query
def top10_products_of_category(spark: SparkSession, folder: str) -> DataFrame:
    lines = marts.of_products(order_lines(spark, folder, *_PRODUCT_LINES), category="PROMO")
    return marts.top_products(marts.product_totals(lines)).select("sub_category", "rank_in_subcategory", "product_id", "total_sales")


@_query
def executive_kpis(spark: SparkSession, folder: str) -> DataFrame:
    return dashboards.executive_kpis(order_totals(spark, folder, "order_id"), per_order=True)


@_query
def eda_kpis(spark: SparkSession, folder: str) -> DataFrame:
    return dashboards.eda_kpis(order_totals(spark, folder, "order_id"), per_order=True)


@_query
def category_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return dashboards.revenue_by(part_totals(spark, folder, "category"), "category")


@_query
def region_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return dashboards.revenue_by(order_totals(spark, folder, "region"), "region")


@_query
def eda_monthly_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return dashboards.monthly_revenue(order_totals(spark, folder, "order_date"), "order_date", "sales")


@_query
def price_by_quantity(spark: SparkSession, folder: str) -> DataFrame:
    return dashboards.price_by_quantity(order_lines(spark, folder, "quantity", "sales"))


@_query
def latest_months(spark: SparkSession, folder: str) -> DataFrame:
    marts_folder = work_path(spark, "marts")
    as_table(marts.monthly_kpis(_monthly(spark, folder)), marts_folder, "mart_monthly_sales")
    return mart_reads.latest_months(mart_reads.read_mart(spark, marts_folder, "mart_monthly_sales"), _LATEST)


# Data checks.


@_query
def monthly_gaps_by_subcategory(spark: SparkSession, folder: str) -> DataFrame:
    return series.missing_months(_by_sub_category(spark, folder), ["sub_category"])


@_query
def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    by_order = ("order_id", "order_date", "customer_id", "segment", "region", "state")
    orders = written(order_totals(spark, folder, *by_order), "order-totals")
    relations = warehouse.build(
        order_lines(spark, folder), work_path(spark, "warehouse"), orders, _product_totals(spark, folder)
    )
    staged = staged_checks(spark, folder, quality.declared_checks(ACCEPTED)["stg_orders"])
    order_keys = spark.read.parquet(table_path(folder, "orders")).select("o_orderkey")
    report = quality.quality_report(relations, ACCEPTED, {"stg_orders": staged})
    # Sums per order count on unique order keys.
    return report.unionByName(quality.unique_check(order_keys, "orders", "o_orderkey"))


@_query
def dq_training_values(spark: SparkSession, folder: str) -> DataFrame:
    monthly = _total_by_month(spark, folder)
    return quality.training_value_check(features.forecast_training(monthly), monthly)


@_query
def dq_panel_training_values(spark: SparkSession, folder: str) -> DataFrame:
    monthly, keys = written(_by_sub_category(spark, folder), "monthly"), ["sub_category"]
    return quality.training_value_check(features.forecast_training(monthly, keys), monthly, keys)


@_query
def dq_next_month_values(spark: SparkSession, folder: str) -> DataFrame:
    monthly = written(_total_by_month(spark, folder), "monthly")
    return quality.next_month_value_check(features.next_month_features(monthly), monthly)


# Split, baseline, metrics and folds.


@_query
def holdout_split(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.holdout_split(features.forecast_training(_total_by_month(spark, folder)))


@_query
def holdout_split_by_subcategory(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["sub_category"]
    return evaluation.holdout_split(features.forecast_training(_by_sub_category(spark, folder), keys), keys=keys)


def _segment_holdout(spark: SparkSession, folder: str) -> DataFrame:
    monthly, keys = _by_segment(spark, folder), ["segment"]
    split = evaluation.holdout_split(features.forecast_training(monthly, keys), keys=keys)
    targets = split.filter(F.col("split") == "test")
    return evaluation.with_baseline(targets, monthly, keys, strict=False)


def _naive_by_segment(spark: SparkSession, folder: str) -> DataFrame:
    return _segment_holdout(spark, folder).select("segment", "target_month", "Actual", "Baseline")


@_query
def seasonal_naive_by_segment(spark: SparkSession, folder: str) -> DataFrame:
    return _naive_by_segment(spark, folder)


@_query
def forecast_metrics_naive(spark: SparkSession, folder: str) -> DataFrame:
    rows = _segment_holdout(spark, folder)
    metrics = evaluation.forecast_metrics(rows, ["Baseline", "rolling_mean_3", "rolling_mean_6"], by=["segment"])
    return _measures(metrics, ("mae", "rmse"), ("mape", "smape"))


def _naive_report(spark: SparkSession, folder: str) -> DataFrame:
    rows, monthly = _training_rows(spark, folder)
    tests = evaluation.test_months(rows, evaluation.fold_calendar(rows, 1, evaluation.HOLDOUT_MONTHS))
    metrics = evaluation.forecast_metrics(evaluation.with_baseline(tests, monthly), ["Baseline"])
    measured = _measures(metrics, ("mae", "rmse"), ("mape", "smape"))
    return training.training_report(rows, measured, "seasonal_naive", model="Baseline")


def _flat_report(report: DataFrame) -> DataFrame:
    measures = [F.col(f"metrics.Model.{c}").alias(c.lower()) for c in ("MAPE", "sMAPE", "MAE", "RMSE")]
    return report.select(*(c for c in report.columns if c not in ("trained_at_utc", "feature_columns", "metrics")), *measures)


@_query
def training_report(spark: SparkSession, folder: str) -> DataFrame:
    return _flat_report(_naive_report(spark, folder))


@_query
def expanding_folds(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.fold_calendar(features.forecast_training(_total_by_month(spark, folder)))


def _mean_backtest(spark: SparkSession, folder: str) -> DataFrame:
    """Fold results of two fixed predictors over the pooled segment series."""
    rows = written(features.forecast_training(_by_segment(spark, folder), ["segment"]), "training")
    calendar = evaluation.fold_calendar(rows)
    tests = evaluation.test_months(rows, calendar)
    return evaluation.fold_results(tests, calendar, {"rolling_mean_3": 1, "rolling_mean_6": 1}, "rolling_mean")


@_query
def backtest_folds(spark: SparkSession, folder: str) -> DataFrame:
    return _measures(_mean_backtest(spark, folder), ("rmse", "mae"), ("mape", "smape"))


@_query
def backtest_summary(spark: SparkSession, folder: str) -> DataFrame:
    summary = evaluation.fold_summary(_mean_backtest(spark, folder))
    money, percent = ("rmse_mean", "rmse_std", "mae_mean"), ("mape_mean", "smape_mean", "smape_std")
    return _measures(summary, money, percent)


@_query
def backtest_fold_wins(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.fold_wins(_mean_backtest(spark, folder), five="rolling_mean_3", six="rolling_mean_6")


@_query
def sums_of_large_amounts(spark: SparkSession, folder: str) -> DataFrame:
    """Exact sums of prices scaled up to 10^12 and of sevenths of prices, in two steps, by part number's last digit."""
    price = F.col("l_extendedprice")
    scaled = spark.read.parquet(table_path(folder, "lineitem")).select(
        (F.col("l_partkey") % 10).alias("digit"), "l_linenumber", (price * 1000003.0).alias("large"), (price / 7).alias("long")
    )
    parts = scaled.groupBy("digit", "l_linenumber").agg(
        partial_sum(scaled, "large").alias("large"), partial_sum(scaled, "long").alias("long")
    )
    text = [exact_sum(parts, name).cast("string").alias(name) for name in ("large", "long")]
    return parts.groupBy("digit").agg(*text)


# Models, on the monthly series at the full settings. A tree's value has no SQL; what surrounds it has.


def _training_rows(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Written training rows and monthly sales."""
    monthly = written(_total_by_month(spark, folder), "monthly")
    return written(features.forecast_training(monthly).coalesce(1), "training"), monthly


def _within_targets(prediction: str, rows: DataFrame) -> Column:
    """A forest averages training targets, so it never leaves their range."""
    low, high = rows.agg(F.min("target_sales")).scalar(), rows.agg(F.max("target_sales")).scalar()
    return F.col(prediction).between(low, high)


@_query
def rf_holdout_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows, monthly = _training_rows(spark, folder)
    forecast = training.holdout_forecast("rf", rows, monthly)
    return forecast.select("target_month", "Actual", "Baseline", _within_targets("Forecast", rows).alias("in_range"))


@_query
def gbt_holdout_rows(spark: SparkSession, folder: str) -> DataFrame:
    forecast = training.holdout_forecast("gbt", *_training_rows(spark, folder))
    return forecast.select("target_month", "Actual", "Baseline", F.col("Forecast").isNotNull().alias("forecast_present"))


@_query
def feature_set_folds(spark: SparkSession, folder: str) -> DataFrame:
    """Fold results of the forest and of boosting with an L2 term, with either feature set, written as CSV and read back,
    and whether wins add up."""
    rows, _ = _training_rows(spark, folder)
    done = backtest.compare_feature_sets(rows, {"rf": {}, backtest.BOOSTED: {}})
    out = work_path(spark, "comparison")
    done.write(out)
    folds = spark.read.schema(done.results.schema).option("header", True).csv(f"{out}/feature_set_comparison_results")
    wins = spark.read.schema(done.wins.schema).option("header", True).csv(f"{out}/feature_set_comparison_wins")
    added = F.col("six_feature_wins") + F.col("five_feature_wins") + F.col("ties") == F.col("folds")
    present = F.col("rmse").isNotNull() & F.col("mae").isNotNull() & F.col("mape").isNotNull() & F.col("smape").isNotNull()
    return folds.withColumns(
        {"metrics_present": present, "wins_add_up": wins.agg(F.every(added)).scalar()}
    ).drop("rmse", "mae", "mape", "smape")


# A single tree without resampling, and a few boosted ones over all rows and features, can be grown in SQL: their
# predictions are compared by value. Four decimals: a mean of cents often ends in half a cent.
_ONE_TREE = {"numTrees": 1, "bootstrap": False, "maxDepth": 2}
_FEW_ROUNDS = {"maxIter": 4, "maxDepth": 2, "subsamplingRate": 1.0, "featureSubsetStrategy": "all"}


def _train_one_tree(spark: SparkSession, folder: str) -> tuple[training.Trained, DataFrame, DataFrame, str]:
    rows, monthly = _training_rows(spark, folder)
    out = work_path(spark, "training")
    return training.train("rf", rows, monthly, out, **_ONE_TREE), rows, monthly, out


@_query
def trained_tree_report(spark: SparkSession, folder: str) -> DataFrame:
    """The report that a training run wrote, with the metrics of its model and of the baseline."""
    done, rows, _, out = _train_one_tree(spark, folder)
    schema = training.training_report(rows, done.metrics, "rf").schema
    report = spark.read.schema(schema).json(f"{out}/training_metrics_rf")
    measures = [
        rounded(F.col(f"metrics.{of}.{name}"), 4).alias(f"{of}_{name}".lower())
        for of in ("Model", "Baseline")
        for name in ("MAPE", "sMAPE", "MAE", "RMSE")
    ]
    kept = [c for c in report.columns if c not in ("trained_at_utc", "feature_columns", "metrics")]
    return report.select(*kept, F.array_join("feature_columns", ",").alias("feature_columns"), *measures)


@_query
def trained_tree_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """What a training run left: its final model, loaded and scored by its nodes, for all training months and the next
    one, beside forecast and baseline of the hold-out months as written."""
    done, rows, monthly, out = _train_one_tree(spark, folder)
    nodes = written(node_table.node_table(spark, models.load_model(f"{out}/models/sales_forecast_rf")), "nodes")
    held = spark.read.schema(done.evaluation.schema).option("header", True).csv(f"{out}/forecast_evaluation_rf")
    held = held.withColumn("Forecast", rounded(F.col("Forecast"), 4))
    return _scored_months(rows, monthly, nodes).join(held, "target_month", "left")


@_query
def boosted_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """The nodes of a boosted model: predictions of all training months and of the next one."""
    rows, monthly = _training_rows(spark, folder)
    nodes = written(node_table.node_table(spark, models.fit("gbt", rows, **_FEW_ROUNDS)), "nodes")
    return _scored_months(rows, monthly, nodes)


@_query
def penalised_boosting(spark: SparkSession, folder: str) -> DataFrame:
    """Boosting with an L2 term, all rows and features drawn: predictions of all training months and of the next one.

    They come from the nodes; `same` tells whether the booster itself gave the same double."""
    rows, monthly = _training_rows(spark, folder)
    months = rows.unionByName(features.next_month_features(monthly), allowMissingColumns=True)
    x = F.array(*(F.col(f).cast("double") for f in FEATURES)).alias("x")
    jobs = months.select(F.lit("all").alias("model"), F.col("target_month").alias("row_id"), F.col("target_sales").alias("y"), x)
    done = boosting.boost(jobs, boosting.Settings(rounds=4, depth=2, row_share=1.0, column_share=1.0))
    own = done.predictions.select(F.col("row_id").cast("date").alias("target_month"), F.col("prediction").alias("own"))
    scored = node_table.score(months, written(boosting.model_nodes(done, "all", FEATURES), "nodes")).join(own, "target_month")
    return scored.select(
        "target_month", rounded(F.col("prediction"), 2).alias("prediction"), (F.col("prediction") == F.col("own")).alias("same")
    )


def _scored_months(rows: DataFrame, monthly: DataFrame, nodes: DataFrame) -> DataFrame:
    months = rows.drop("target_sales").unionByName(features.next_month_features(monthly))
    return node_table.score(months, nodes).select("target_month", rounded(F.col("prediction"), 4).alias("prediction"))


@_query
def forest_nodes_agree(spark: SparkSession, folder: str) -> DataFrame:
    """For each month, whether the nodes of the full forest predict the same double as the forest, and the leaves' rows."""
    rows, _ = _training_rows(spark, folder)
    model = models.fit("rf", rows)
    nodes = written(node_table.node_table(spark, model), "nodes")
    both = node_table.score(models.predict(model, rows, "own"), nodes, "by_nodes")
    # Every tree's leaves hold its bootstrap rows, which are counted once each in its root.
    counts = nodes.groupBy("tree").agg(
        F.sum(F.when(F.col("feature").isNull(), F.col("training_rows"))).alias("leaves"),
        F.sum(F.when(F.col("node") == 0, F.col("training_rows"))).alias("root"),
    )
    trees, whole = counts.agg(F.count("*")), counts.agg(F.every(F.col("leaves") == F.col("root")))
    same = (F.col("own") == F.col("by_nodes")).alias("same")
    return both.select("target_month", same, trees.scalar().alias("trees"), whole.scalar().alias("whole"))


def _forecasts(spark: SparkSession, folder: str, log: str) -> DataFrame:
    """The forecast of a forest that was saved and loaded again."""
    rows, monthly = _training_rows(spark, folder)
    path = work_path(spark, "model")
    models.save_model(models.fit("rf", rows), path)
    forecasts = forecast_and_log(models.load_model(path), "rf", features.next_month_features(monthly), log)
    return forecasts.withColumn("in_range", _within_targets("prediction", rows))


@_query
def next_month_forecast(spark: SparkSession, folder: str) -> DataFrame:
    forecasts = _forecasts(spark, folder, work_path(spark, "forecast-log"))
    return forecasts.select("model", "target_month", *FEATURES, "feature_source", "logged", "in_range")


@_query
def latest_forecasts(spark: SparkSession, folder: str) -> DataFrame:
    log = work_path(spark, "forecast-log")
    _forecasts(spark, folder, log)
    rows = read_latest_forecasts(spark, log)
    return rows.select("id", "model", F.size("series").alias("series_columns"), "target_month", *FEATURES)


# Reads of built marts, and files written and read back.


@_query
def read_region_mart(spark: SparkSession, folder: str) -> DataFrame:
    marts_folder = work_path(spark, "marts")
    orders = order_totals(spark, folder, "order_id", "customer_id", "region", "state")
    as_table(marts.sales_by_region(orders, per_order=True), marts_folder, "mart_sales_by_region")
    return mart_reads.read_mart(spark, marts_folder, "mart_sales_by_region", 10)


@_query
def read_training_mart(spark: SparkSession, folder: str) -> DataFrame:
    marts_folder = work_path(spark, "marts")
    as_table(features.forecast_training(_total_by_month(spark, folder)), marts_folder, "mart_forecast_training")
    return mart_reads.read_training(spark, marts_folder)


@_query
def read_next_month_mart(spark: SparkSession, folder: str) -> DataFrame:
    """The mart is rebuilt from itself before it is read."""
    marts_folder, name = work_path(spark, "marts"), "mart_next_month_features"
    monthly = written(_total_by_month(spark, folder), "monthly")
    built = as_table(features.next_month_features(monthly), marts_folder, name)
    as_table(built, marts_folder, name)
    return mart_reads.read_next_month_features(spark, marts_folder)


@_query
def read_monthly_mart(spark: SparkSession, folder: str) -> DataFrame:
    marts_folder = work_path(spark, "marts")
    as_table(_monthly(spark, folder), marts_folder, "int_monthly_sales")
    return mart_reads.read_monthly_sales(spark, marts_folder)


@_query
def adhoc_sql(spark: SparkSession, folder: str) -> DataFrame:
    as_view(_by_segment(spark, folder), "sales_by_segment_month")
    sql = "SELECT month, total_sales FROM sales_by_segment_month WHERE segment = :segment AND month >= :since"
    return mart_reads.run_sql(spark, sql, segment="BUILDING", since=date(2000, 1, 1))


@_query
def csv_order_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = work_path(spark, "raw")
    as_csv(raw_order_lines(spark, folder).withColumn("Quantity", F.col("Quantity").cast("bigint")), path, "gzip")
    return stage(read_raw_orders(spark, path, "csv"))


def _coerced_orders(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Order lines from a CSV file in which some dates, amounts and quantities can't be read, and its faulty lines."""
    path, lines = work_path(spark, "dirty"), raw_order_lines(spark, folder)
    product, customer, day = F.col("Product ID"), F.col("Customer ID"), F.col("Order Date")
    quantity, sales = F.col("Quantity").cast("bigint").cast("string"), F.col("Sales").cast("string")
    dirty = {
        "Order Date": F.when(product % 50 == 7, F.date_format(day, "dd.MM.yyyy")).otherwise(day.cast("string")),
        "Quantity": F.when(product % 40 == 3, F.concat(quantity, F.lit(" pcs"))).otherwise(quantity),
        "Sales": F.when(customer % 60 == 5, F.lit("n/a")).otherwise(sales),
    }
    as_csv(lines.withColumns(dirty), path, "gzip")
    return read_coerced_orders(spark, path)


@_query
def csv_coerced_lines(spark: SparkSession, folder: str) -> DataFrame:
    return stage(_coerced_orders(spark, folder)[0])


@_query
def csv_rejected_lines(spark: SparkSession, folder: str) -> DataFrame:
    rejects = _coerced_orders(spark, folder)[1]
    return rejects.select(F.col("Row ID").alias("row_id"), F.array_join("faults", ",").alias("faults"), "record")


@_query
def csv_daily_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue by month of a file of daily revenue in which some dates and amounts can't be read."""
    path, orders = work_path(spark, "daily"), order_totals(spark, folder, "order_date")
    daily = orders.groupBy(F.col("order_date").alias("date")).agg(exact_sum(orders, "sales").cast("double").alias("revenue"))
    which = F.dayofmonth("date")
    dirty = {
        "revenue": F.when(which == 17, F.lit("none")).otherwise(F.col("revenue").cast("string")),
        "date": F.when(which == 13, F.lit("soon")).otherwise(F.col("date").cast("string")),
    }
    as_csv(daily.withColumns(dirty), path)
    return dashboards.monthly_revenue(read_daily_revenue(spark, path, lenient=True))


@_query
def csv_evaluation(spark: SparkSession, folder: str) -> DataFrame:
    path, rows = work_path(spark, "evaluation"), _naive_by_segment(spark, folder)
    as_csv(rows, path)
    return spark.read.schema(rows.schema).option("header", True).csv(path)


@_query
def json_training_report(spark: SparkSession, folder: str) -> DataFrame:
    path, report = work_path(spark, "report"), _naive_report(spark, folder)
    as_json(report, path)
    return _flat_report(spark.read.schema(report.schema).json(path))


# Contract checks over broken copies of the training mart.


@_query
def contract_faults(spark: SparkSession, folder: str) -> DataFrame:
    good = written(features.forecast_training(_total_by_month(spark, folder)), "training")
    month, moy = F.col("target_month"), F.col("month_of_year")
    unpadded = F.concat_ws("-", F.year(month), F.month(month), F.dayofmonth(month))

    def broken(column: str, when: int, value: Column, kind: str) -> DataFrame:
        return good.withColumn(column, F.when(moy == when, value).otherwise(F.col(column).cast(kind)))

    january = good.filter(moy == 1).withColumn("target_month", unpadded)
    copies = {
        "good": good,
        "empty": good.limit(0),
        "same month as other text": good.withColumn("target_month", month.cast("string")).unionByName(january),
        "no date": broken("target_month", 2, F.lit("soon"), "string"),
        "time of day": broken("target_month", 3, month.cast("timestamp") + F.expr("interval 90 minutes"), "timestamp"),
        "month 13": broken("month_of_year", 5, F.lit(13), "int"),
        "month and a half": broken("month_of_year", 6, F.lit(6.5), "double"),
        "lag missing": broken("lag_2", 7, F.lit(None), "double"),
        "lag as text": broken("lag_3", 8, F.lit("n/a"), "string"),
        "sales missing": broken("target_sales", 9, F.lit(float("nan")), "double"),
    }
    parts = [quality.contract_faults(copy).select(F.lit(name).alias("copy"), "*") for name, copy in copies.items()]
    return reduce(DataFrame.unionByName, parts)


@_query
def prediction_contract_faults(spark: SparkSession, folder: str) -> DataFrame:
    """Faults of feature rows to predict from: one row of a single series, and one row of each series of a panel."""
    monthly = written(_by_segment(spark, folder), "monthly")
    panel = written(features.next_month_features(monthly, ["segment"]), "features")
    one = written(features.next_month_features(_total_by_month(spark, folder)), "one-row")
    rising = F.col("lag_2") > F.col("lag_3")
    single = {"one row": one, "no row": one.limit(0), "all series as one": panel.drop("segment")}
    several = {
        "panel": panel,
        "rising series twice": panel.unionByName(panel.filter(rising)),
        "rising series without lag": panel.withColumn("lag_3", F.when(~rising, F.col("lag_3"))),
        "falling series with text": panel.withColumn("lag_2", F.when(rising, F.col("lag_2").cast("string")).otherwise("n/a")),
        "month 0": panel.withColumn("month_of_year", F.lit(0)),
    }

    def faults(name: str, copy: DataFrame, keys: list[str]) -> DataFrame:
        found = quality.contract_faults(copy, PREDICTION_COLUMNS, keys, one_per_series=True)
        return found.select(F.lit(name).alias("copy"), "*")

    parts = [faults(n, c, []) for n, c in single.items()] + [faults(n, c, ["segment"]) for n, c in several.items()]
    return reduce(DataFrame.unionByName, parts)


@_query
def series_faults(spark: SparkSession, folder: str) -> DataFrame:
    """Faults of broken copies of the monthly sales."""
    good = written(_total_by_month(spark, folder), "monthly")
    which = F.month("month")
    copies = {
        "good": good,
        "month as text": good.withColumn("month", F.when(which == 2, F.lit("soon")).otherwise(F.col("month").cast("string"))),
        "no amount": good.withColumn("total_sales", F.when(which == 3, F.lit(float("nan"))).otherwise(F.col("total_sales"))),
        "repeated": good.unionByName(good.filter(which == 1)),
        "gap": good.filter(which != 6),
    }
    parts = [series.series_faults(copy).select(F.lit(name).alias("copy"), "*") for name, copy in copies.items()]
    return reduce(DataFrame.unionByName, parts)
