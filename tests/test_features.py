from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.helpers import dicts, month, monthly_frame
from tillwright.contract import FEATURES
from tillwright.operators.features import forecast_training, next_month_features, stale_series
from tillwright.operators.series import missing_months, monthly_series, seasonal_naive


@pytest.mark.parametrize("months, training, following", [(5, 0, 0), (6, 0, 1), (7, 1, 1)])
def test_history_length(spark, months, training, following):
    monthly = monthly_frame(spark, [(n, n + 1) for n in range(months)])
    assert forecast_training(monthly).count() == training
    assert next_month_features(monthly).count() == following


def test_training_values_end_before_the_target(spark):
    row = dicts(forecast_training(monthly_frame(spark, [(n, 10 * (n + 1)) for n in range(7)])))[0]
    assert row == {
        "target_month": month(6), "target_sales": 70.0, "lag_1": 60.0, "lag_2": 50.0, "lag_3": 40.0,
        "month_of_year": 7, "rolling_mean_3": 50.0, "rolling_mean_6": 35.0,
    }


def test_published_example(spark):
    """Lags and three-month mean of the published sample forecast for 2018-01."""
    history = [1.0, 2.0, 3.0, 77776.9232, 118447.825, 83829.3188]
    row = dicts(next_month_features(monthly_frame(spark, [(42 + n, v) for n, v in enumerate(history)])))[0]
    assert row["target_month"] == date(2018, 1, 1) and row["month_of_year"] == 1
    assert (row["lag_1"], row["lag_2"], row["lag_3"]) == (83829.3188, 118447.825, 77776.9232)
    assert round(row["rolling_mean_3"], 4) == 93351.3557


def test_a_gap_removes_the_next_six_targets(spark):
    monthly = monthly_frame(spark, [(n, n + 1) for n in range(20) if n != 9])
    assert [r["target_month"] for r in dicts(forecast_training(monthly).orderBy("target_month"))] == [
        month(n) for n in [6, 7, 8, 16, 17, 18, 19]
    ]
    assert next_month_features(monthly_frame(spark, [(n, 1) for n in (0, 1, 2, 4, 5, 6)])).count() == 0


def test_zero_month_counts_and_null_month_does_not(spark):
    values = [1, 2, 0, 4, 5, 6, 7]
    assert forecast_training(monthly_frame(spark, list(enumerate(values)))).count() == 1
    values[2] = None
    assert forecast_training(monthly_frame(spark, list(enumerate(values)))).count() == 0


def test_as_of_leaves_out_the_partial_month(spark):
    monthly = monthly_frame(spark, [(n, n + 1) for n in range(8)])
    assert dicts(next_month_features(monthly))[0]["target_month"] == month(8)
    row = dicts(next_month_features(monthly, as_of=date(2014, 8, 15)))[0]
    assert row["target_month"] == month(7) and row["lag_1"] == 7.0
    assert [r["target_month"] for r in dicts(forecast_training(monthly, as_of=date(2014, 8, 15)))] == [month(6)]


PANELS = st.dictionaries(
    st.tuples(st.sampled_from("abc"), st.integers(0, 25)), st.decimals(0, 10**6, places=2), min_size=20, max_size=70
)


@settings(max_examples=15, deadline=None)
@given(PANELS)
def test_features_of_random_panels(spark, panel):
    def features(series, at):
        past = [panel.get((series, at - k)) for k in range(1, 7)]
        if None in past:
            return None
        means = [float(sum(past[:n])) / n for n in (3, 6)]
        return (series, month(at), *(float(v) for v in past[:3]), month(at).month, *means)

    values = [(s, n, v) for (s, n), v in panel.items()]
    monthly = monthly_frame(spark, values, ["s"])
    columns = ["s", "target_month", *FEATURES]
    want = sorted(f for s, n in panel if (f := features(s, n)))
    assert sorted(tuple(r) for r in forecast_training(monthly, ["s"]).select(columns).collect()) == want
    last = max(n for _, n in panel)
    want = sorted(f for s in {s for s, _ in panel} if (f := features(s, last + 1)))
    assert sorted(tuple(r) for r in next_month_features(monthly, ["s"]).select(columns).collect()) == want


def test_panel_series_stay_apart(spark):
    values = [("a", n, n + 1) for n in range(9)] + [("b", n, 100 + n) for n in range(3, 9)] + [(None, n, n) for n in range(7)]
    monthly = monthly_frame(spark, values, ["s"])
    training = dicts(forecast_training(monthly, ["s"]))
    assert sorted((str(r["s"]), r["target_month"]) for r in training) == [
        ("None", month(6)), ("a", month(6)), ("a", month(7)), ("a", month(8))
    ]
    following = {r["s"]: r["lag_1"] for r in dicts(next_month_features(monthly, ["s"]))}
    assert following == {"a": 9.0, "b": 108.0}  # the third series ended two months before
    behind = {(r["s"], r["last_month"], r["months_behind"]) for r in dicts(stale_series(monthly, ["s"]))}
    assert behind == {(None, month(6), 2)}
    assert stale_series(monthly, ["s"], as_of=month(7)).count() == 0
    early = dicts(next_month_features(monthly, ["s"], as_of=month(7)))
    assert {r["s"]: r["lag_1"] for r in early} == {"a": 7.0, None: 6.0} and {r["target_month"] for r in early} == {month(7)}


def test_gaps_and_series_checks(spark):
    holes = monthly_frame(spark, [("a", 0, 1), ("a", 3, 1), ("b", 0, 1), ("b", 1, 1)], ["s"])
    assert sorted((r["s"], r["missing_month"]) for r in dicts(missing_months(holes, ["s"]))) == [
        ("a", month(1)), ("a", month(2))
    ]
    with pytest.raises(ValueError, match="skips"):
        monthly_series(holes, ["s"])
    with pytest.raises(ValueError, match="repeats"):
        monthly_series(monthly_frame(spark, [(0, 1), (0, 2)]))
    with pytest.raises(ValueError, match="invalid"):
        monthly_series(spark.createDataFrame([("2014-13-01", "1")], "month string, total_sales string"))
    with pytest.raises(ValueError, match="invalid"):
        monthly_series(spark.createDataFrame([("2014-01-01", "x")], "month string, total_sales string"))
    with pytest.raises(ValueError, match="lacks"):
        monthly_series(spark.createDataFrame([(1,)], "month int"))
    text = spark.createDataFrame([("2014-02-01", "2"), ("2014-01-01", "1.5")], "month string, total_sales string")
    assert [tuple(r.values()) for r in dicts(monthly_series(text))] == [(month(0), 1.5), (month(1), 2.0)]


def test_seasonal_naive_uses_calendar_months(spark):
    monthly = monthly_frame(spark, [(n, n + 1) for n in range(14) if n != 12])
    got = {r["month"]: r["baseline"] for r in dicts(seasonal_naive(monthly))}
    assert got[month(0)] is None  # nothing before it
    assert got[month(5)] == 5.0  # previous month
    assert got[month(13)] == 2.0  # twelve months ago, although one row is missing between


def counted(spark, frame, counts):
    """The frame, counting the rows that are computed."""
    def pass_on(batches):
        for batch in batches:
            counts.add(batch.num_rows)
            yield batch
    return frame.mapInArrow(pass_on, frame.schema)


def test_a_lazy_input_is_computed_once(spark, tmp_path):
    from tillwright.plans import training

    monthly = monthly_frame(spark, [(n, 100 + n * n % 13) for n in range(24)])
    counts = spark.sparkContext.accumulator(0)
    monthly_series(counted(spark, monthly, counts)).collect()
    assert counts.value == 24
    rows, lazy = forecast_training(monthly), spark.sparkContext.accumulator(0)
    training.train("rf", counted(spark, rows, lazy), monthly, str(tmp_path), numTrees=2, maxDepth=2)
    assert lazy.value == 18
