"""Data checks as counts of failures, and raising contract checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.contract import (
    ACCEPTED,
    FEATURES,
    PREDICTION_COLUMNS,
    TRAINING_COLUMNS,
    DataCheckError,
    FeatureContractError,
)
from tillwright.functions.dates import months_apart
from tillwright.functions.joins import null_safe_join, one_row
from tillwright.functions.money import TOTAL, ratio

# Fixed value: largest difference between a feature and its recomputation.
TOLERANCE = 1e-6

REPORT_COLUMNS = ("relation", "check", "column", "rows", "failures")


@dataclass(frozen=True)
class Check:
    kind: str
    column: str
    values: tuple = ()


def _not_null(*columns: str) -> list[Check]:
    return [Check("not_null", c) for c in columns]


def declared_checks(accepted: Mapping[str, Sequence[str]] = ACCEPTED) -> dict[str, list[Check]]:
    """The column checks of every relation; `accepted` holds the allowed dimension values."""

    def allowed(column: str) -> Check:
        return Check("accepted_values", column, tuple(accepted[column]))

    months = Check("accepted_values", "month_of_year", tuple(range(1, 13)))
    return {
        "stg_orders": [
            Check("unique", "row_id"),
            *_not_null("row_id", "order_id", "order_date", "sales", "category", "region"),
            *(allowed(c) for c in ("category", "region", "segment")),
        ],
        "int_monthly_sales": [
            Check("unique", "month"),
            *_not_null("month", "total_sales", "total_profit", "order_count", "unique_customers"),
        ],
        "mart_monthly_sales": [Check("unique", "month"), *_not_null("month", "total_sales")],
        "mart_sales_by_category": [*_not_null("category", "profit_margin_pct"), allowed("category")],
        "mart_sales_by_segment": [allowed("segment")],
        "mart_sales_by_region": [allowed("region")],
        "mart_product_performance": _not_null("product_id"),
        "mart_forecast_training": [Check("unique", "target_month"), *_not_null(*TRAINING_COLUMNS), months],
        "mart_next_month_features": [Check("unique", "target_month"), *_not_null(*PREDICTION_COLUMNS), months],
    }


def _fails(check: Check) -> Column:
    column = F.col(check.column)
    if check.kind == "not_null":
        return column.isNull()
    if check.kind == "accepted_values":
        # A NULL value passes: only the not_null check speaks about it.
        return column.isNotNull() & ~column.isin(*check.values)
    raise ValueError(f"unknown check {check.kind}")


def _report(counts: DataFrame, relation: str, checks: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One row per (check, column, count column) of a one-row frame, with the rows looked at."""
    rows = F.array(
        *(
            F.struct(
                F.lit(relation).alias("relation"),
                F.lit(kind).alias("check"),
                F.lit(column).alias("column"),
                F.coalesce("_rows", F.lit(0)).alias("rows"),
                F.coalesce(F.col(count), F.lit(0)).cast("bigint").alias("failures"),
            )
            for kind, column, count in checks
        )
    )
    return counts.select(F.inline(rows))


def column_checks(frame: DataFrame, relation: str, checks: Sequence[Check]) -> DataFrame:
    """Failures per check in a single pass over the relation.

    `not_null` and `accepted_values` count rows, `unique` counts repeated keys. Row counts ride
    along the grouping by the unique key, so the relation is read once; the map side folds a key
    that holds many rows.
    """
    unique = [c for c in checks if c.kind == "unique"]
    if len(unique) > 1:
        raise ValueError("one unique column per relation")
    by_row = {f"_{i}": c for i, c in enumerate(checks) if c.kind != "unique"}
    counts = [F.count_if(_fails(c)).alias(name) for name, c in by_row.items()]
    named = [(c.kind, c.column, name) for name, c in by_row.items()]
    if not unique:
        return _report(frame.agg(F.count("*").alias("_rows"), *counts), relation, named)
    key = unique[0].column
    per_key = frame.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_copies"), *counts)
    repeated = F.count_if((F.col("_copies") > 1) & F.col("_key").isNotNull()).alias("_unique")
    totals = per_key.agg(F.sum("_copies").alias("_rows"), repeated, *(F.sum(name).alias(name) for name in by_row))
    return _report(totals, relation, [("unique", key, "_unique"), *named])


def unique_check(keys: DataFrame, relation: str, column: str) -> DataFrame:
    """Repeated keys of a one-column frame. Nothing but the key is shuffled."""
    key = keys.columns[0]
    per_key = keys.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_copies"))
    repeated = F.count_if((F.col("_copies") > 1) & F.col("_key").isNotNull()).alias("_unique")
    return _report(per_key.agg(F.sum("_copies").alias("_rows"), repeated), relation, [("unique", column, "_unique")])


def weighted_checks(frame: DataFrame, weight: str, relation: str, checks: Sequence[Check]) -> DataFrame:
    """Row checks over a frame in which a row stands for `weight` rows of the relation."""
    counts = {f"_{i}": c for i, c in enumerate(checks)}
    sums = [F.sum(F.when(_fails(c), F.col(weight)).otherwise(0)).alias(name) for name, c in counts.items()]
    totals = frame.agg(F.sum(weight).alias("_rows"), *sums)
    return _report(totals, relation, [(c.kind, c.column, name) for name, c in counts.items()])


def one_row_check(frame: DataFrame, relation: str) -> DataFrame:
    """Fails unless the relation has exactly one row."""
    counts = frame.agg(F.count("*").alias("_rows"), (F.count("*") != 1).cast("bigint").alias("_bad"))
    return _report(counts, relation, [("one_row", "*", "_bad")])


def _differs(actual: str, expected: str) -> Column:
    return F.abs(F.col(actual).cast("double") - F.col(expected).cast("double")) > TOLERANCE


def _count_failures(frame: DataFrame, relation: str, failing: Mapping[str, Column]) -> DataFrame:
    counts = [F.count_if(condition).alias(f"_{name}") for name, condition in failing.items()]
    return _report(frame.agg(F.count("*").alias("_rows"), *counts), relation, [("recomputed", name, f"_{name}") for name in failing])


def training_value_check(
    training: DataFrame, monthly: DataFrame, keys: Sequence[str] = (), relation: str = "mart_forecast_training"
) -> DataFrame:
    """Recompute the training features by calendar joins instead of window frames.

    Each training row looks up its target month and the six months before it in one join on
    (keys, month): month m serves the targets m .. m+6.
    """
    offsets = monthly.select(
        *keys, "total_sales", "month", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("_back")
    ).withColumn("target_month", F.expr("add_months(month, _back)"))
    lookup = offsets.groupBy(*keys, "target_month").agg(
        *(F.max(F.when(F.col("_back") == k, F.col("total_sales"))).alias(f"_m{k}") for k in range(7))
    )
    rows = null_safe_join(training, lookup, [*keys, "target_month"], "left")

    def mean(n: int) -> Column:
        return reduce(lambda a, b: a + b, (F.col(f"_m{k}").cast(TOTAL) for k in range(1, n + 1))).cast("double") / n

    rows = rows.withColumns({"_month": F.month("target_month"), "_mean3": mean(3), "_mean6": mean(6)})
    failing = {
        "history": reduce(or_, (F.col(f"_m{k}").isNull() for k in range(7))),
        "target_sales": _differs("target_sales", "_m0"),
        "lag_1": _differs("lag_1", "_m1"),
        "lag_2": _differs("lag_2", "_m2"),
        "lag_3": _differs("lag_3", "_m3"),
        "month_of_year": F.col("month_of_year") != F.col("_month"),
        "rolling_mean_3": _differs("rolling_mean_3", "_mean3"),
        "rolling_mean_6": _differs("rolling_mean_6", "_mean6"),
    }
    return _count_failures(rows, relation, failing)


def next_month_value_check(
    features: DataFrame, monthly: DataFrame, keys: Sequence[str] = (), relation: str = "mart_next_month_features"
) -> DataFrame:
    """Recompute the next-month features from the calendar distance to the last month of all series."""
    last = monthly.agg(F.max("month")).scalar()
    months = monthly.select(*keys, "month", "total_sales", months_apart(last, "month").alias("_back")).filter(
        F.col("_back") < 6
    )

    def mean(n: int) -> Column:
        recent = F.when(F.col("_back") < n, F.col("total_sales"))
        return ratio(F.sum(recent.cast(TOTAL)), F.count(recent))

    expected = months.groupBy(*keys).agg(
        F.count("*").alias("_months"),
        F.add_months(F.max(last), 1).alias("_target"),
        *(F.max(F.when(F.col("_back") == k - 1, F.col("total_sales"))).alias(f"_lag{k}") for k in (1, 2, 3)),
        mean(3).alias("_mean3"),
        mean(6).alias("_mean6"),
    )
    if keys:
        rows = null_safe_join(features, expected, keys)
    else:
        rows = features.withColumn("_expected", one_row(expected)).select(*features.columns, "_expected.*")
    failing = {
        "history": F.col("_months") != 6,
        "target_month": F.col("target_month") != F.col("_target"),
        "lag_1": _differs("lag_1", "_lag1"),
        "lag_2": _differs("lag_2", "_lag2"),
        "lag_3": _differs("lag_3", "_lag3"),
        "month_of_year": F.col("month_of_year") != F.month("_target"),
        "rolling_mean_3": _differs("rolling_mean_3", "_mean3"),
        "rolling_mean_6": _differs("rolling_mean_6", "_mean6"),
    }
    return _count_failures(rows, relation, failing)


def quality_report(
    tables: Mapping[str, DataFrame],
    accepted: Mapping[str, Sequence[str]] = ACCEPTED,
    checked: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Every declared check and the three feature checks over the given relations.

    `checked` holds reports, with all declared checks, of relations that were looked at in another way.
    """
    checked = checked or {}
    declared = declared_checks(accepted).items()
    parts = [checked[name] if name in checked else column_checks(tables[name], name, checks) for name, checks in declared]
    features, monthly = tables["mart_next_month_features"], tables["int_monthly_sales"]
    values = [
        training_value_check(tables["mart_forecast_training"], monthly),
        next_month_value_check(features, monthly),
    ]
    # The recomputations report one row per check, with the failures of all compared columns.
    parts += [
        v.groupBy("relation", "check").agg(
            F.lit("*").alias("column"), F.max("rows").alias("rows"), F.sum("failures").alias("failures")
        )
        for v in values
    ]
    parts.append(one_row_check(features, "mart_next_month_features"))
    return reduce(DataFrame.unionByName, parts).select(*REPORT_COLUMNS)


def require_clean(report: DataFrame) -> None:
    """Raise DataCheckError naming the failed checks of a report."""
    failed = report.filter(F.col("failures") > 0).orderBy(*REPORT_COLUMNS).collect()
    if failed:
        raise DataCheckError(
            "; ".join(f"{r['relation']}.{r['column']} {r['check']}: {r['failures']} failures" for r in failed)
        )


def require_columns(frame: DataFrame, columns: Sequence[str]) -> None:
    absent = [c for c in columns if c not in frame.columns]
    if absent:
        raise FeatureContractError(f"columns absent: {absent}")


def _is_number(frame: DataFrame, name: str) -> bool:
    return isinstance(frame.schema[name].dataType, T.NumericType)


def _absent_value(frame: DataFrame, name: str) -> Column:
    """NULL, or NaN in a floating column."""
    column = F.col(name)
    if isinstance(frame.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def _number(frame: DataFrame, name: str) -> Column:
    return F.col(name) if _is_number(frame, name) else F.col(name).try_cast("double")


def _plain_date(frame: DataFrame, name: str) -> Column:
    """The date of a date column, of a text of just a date, or of a timestamp at midnight; else NULL."""
    kind, value = frame.schema[name].dataType, F.col(name)
    if isinstance(kind, T.DateType):
        return value
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.when(F.date_trunc("day", value) == value, value.cast("date"))
    text = F.trim(value.cast("string"))
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), text.try_cast("date"))


# What a broken contract says, in this order.
MESSAGES = {
    "empty": "no training rows",
    "not one row": "expected one prediction row per series",
    "target_month": "target_month holds invalid dates",
    "repeated month": "target_month repeats",
    "target_sales": "target_sales holds missing or non-numeric values",
    "missing feature": "missing feature values",
    "text feature": "non-numeric feature values",
    "month_of_year": "month_of_year is not a whole number from 1 to 12",
}


def contract_faults(
    frame: DataFrame, columns: Sequence[str] = TRAINING_COLUMNS, keys: Sequence[str] = (), one_per_series: bool = False
) -> DataFrame:
    """One row per fault of a feature table: `fault`, the `column` it is in, and the `failures`.

    Row faults count rows, a repeated month counts months (of a series), and `not one row` series. A month is a
    plain date, whatever its text looks like, and is parsed before months are compared.
    """
    require_columns(frame, [*keys, *columns])
    month, moy = _plain_date(frame, "target_month"), _number(frame, "month_of_year")
    counts = {("target_month", "target_month"): month.isNull()}
    if "target_sales" in columns:
        sales = _number(frame, "target_sales")
        counts["target_sales", "target_sales"] = _absent_value(frame, "target_sales") | sales.isNull() | F.isnan(sales.cast("double"))
    for name in FEATURES:
        counts["missing feature", name] = _absent_value(frame, name)
    for name in FEATURES:
        counts["text feature", name] = F.col(name).isNotNull() & _number(frame, name).isNull()
    counts["month_of_year", "month_of_year"] = ~(moy.between(1, 12) & (moy == F.rint(moy.cast("double"))))
    # One pass: faults are added up per series (and month), then over all of them.
    by = list(keys) if one_per_series else [*keys, "_month"]
    named = {f"_{n}": condition for n, condition in enumerate(counts.values())}
    grouped = (
        frame.withColumn("_month", month)
        .groupBy(*by)
        .agg(F.count("*").alias("_copies"), *(F.count_if(c).alias(n) for n, c in named.items()))
    )
    repeated = F.col("_copies") > 1
    if not one_per_series:
        repeated &= F.col("_month").isNotNull()  # an invalid date is a fault of its own
    found = grouped.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"),
        F.count_if(repeated).alias("repeated"),
        *(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in named),
    )
    none = (F.col("rows") == 0).cast("bigint")
    if one_per_series:
        wrong = (F.col("rows") != 1).cast("bigint") if not keys else F.col("repeated") + none
        faults = [("not one row", "*", wrong)]
    else:
        faults = [("empty", "*", none), ("repeated month", "target_month", F.col("repeated"))]
    faults += [(fault, column, F.col(n)) for (fault, column), n in zip(counts, named)]
    rows = F.array(
        *(F.struct(F.lit(f).alias("fault"), F.lit(c).alias("column"), n.cast("bigint").alias("failures")) for f, c, n in faults)
    )
    return found.select(F.inline(rows)).filter("failures > 0")


def _validated(frame: DataFrame, columns: Sequence[str], keys: Sequence[str], one_per_series: bool) -> DataFrame:
    found = contract_faults(frame, columns, keys, one_per_series).collect()  # a few rows per column
    for fault, message in MESSAGES.items():
        if where := [r["column"] for r in found if r["fault"] == fault]:
            raise FeatureContractError(f"{message} in {where}" if "feature" in fault else message)
    typed = {"month_of_year": "int"}
    month = _plain_date(frame, "target_month").alias("target_month")
    return frame.select(
        *keys, *(month if c == "target_month" else F.col(c).cast(typed.get(c, "double")).alias(c) for c in columns)
    )


def validate_training(frame: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Typed training rows in month order, or FeatureContractError."""
    return _validated(frame, TRAINING_COLUMNS, keys, one_per_series=False).orderBy("target_month", *keys)


def validate_prediction(frame: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The typed feature row of each series, or FeatureContractError."""
    return _validated(frame, PREDICTION_COLUMNS, keys, one_per_series=True)


def validate_feature_names(names: Sequence[str] | None, expected: Sequence[str] = FEATURES) -> None:
    """A model must take exactly the expected features in their order."""
    if names is None or tuple(names) != tuple(expected):
        raise FeatureContractError(f"model features {names} differ from {list(expected)}")
