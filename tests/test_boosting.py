"""Boosting with an L2 term against a plain booster in exact numbers, and the same trees whichever way they are grown."""

from fractions import Fraction

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.helpers import dicts, monthly_frame
from tillwright.operators import boosting, node_table
from tillwright.operators.boosting import Settings, boost
from tillwright.operators.features import forecast_training
from tillwright.plans import backtest

SCHEMA = "model string, row_id long, y double, x array<double>"
NONE_LEFT_OUT = {"row_share": 1.0, "column_share": 1.0}


def noisy(model="a", rows=60, scored=7):
    """Rows whose labels depend on two of three features; each `scored`-th has no label."""
    return [
        (model, i, None if i % scored == 0 else 100.0 * (i * 7 % 10) + 13.0 * (i * i % 11) + i / 8, [float(i * 7 % 10), float(i * i % 11), float(i % 4)])
        for i in range(rows)
    ]


def plain_booster(rows, given):
    """Predictions of all rows, by trying every cut in exact fractions."""
    y = {i: Fraction(v) for _, i, v, _ in rows if v is not None}
    x = {i: v for _, i, _, v in rows}
    l2, p = Fraction(given.l2), dict.fromkeys(x, sum(y.values()) / len(y))
    for _ in range(given.rounds):
        left = {i: y[i] - p[i] for i in y}

        def grow(here, depth):
            train = [i for i in here if i in y]
            worth = lambda part: sum(left[i] for i in part) ** 2 / (len(part) + l2)
            best = None
            for f in range(len(x[rows[0][1]])) if depth else ():
                for cut in sorted({x[i][f] for i in train})[:-1]:
                    low, high = [i for i in train if x[i][f] <= cut], [i for i in train if x[i][f] > cut]
                    gain = worth(low) + worth(high) - worth(train)
                    if gain > 0 and (best is None or gain > best[0]):
                        best = gain, f, cut
            if best is None:
                value = sum(left[i] for i in train) / (len(train) + l2) * Fraction(given.rate)
                return {i: value for i in here}
            _, f, cut = best
            return grow([i for i in here if x[i][f] <= cut], depth - 1) | grow([i for i in here if x[i][f] > cut], depth - 1)

        step = grow(list(x), given.depth)
        p = {i: p[i] + step[i] for i in p}
    return {i: float(v) for i, v in p.items()}


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def grown(done):
    return rows_of(done.nodes), rows_of(done.predictions)


@pytest.mark.parametrize("given", [Settings(rounds=5, depth=3, rate=0.3, **NONE_LEFT_OUT), Settings(rounds=3, depth=2, l2=0.0, rate=1.0, **NONE_LEFT_OUT)])
def test_small_trees_equal_a_plain_booster(spark, given):
    rows = noisy()
    found = {int(r["row_id"]): r["prediction"] for r in dicts(boost(spark.createDataFrame(rows, SCHEMA), given).predictions)}
    want = plain_booster(rows, given)
    assert found.keys() == want.keys()
    assert all(found[i] == pytest.approx(want[i], rel=1e-12) for i in want)


def test_large_models_grow_by_levels_to_the_same_bits(spark):
    rows = noisy("a") + noisy("b", 45, 4) + noisy("small", 20, 5)
    frame = spark.createDataFrame(rows, SCHEMA)
    for given in (Settings(rounds=27, depth=2, rate=0.3), Settings(rounds=3, depth=4, bins=4)):
        alone = grown(boost(frame, given))
        assert alone == grown(boost(frame.repartition(7), given, in_task=0))
    # Some models by levels, one within a task.
    assert alone == grown(boost(frame.repartition(3, "y"), given, in_task=30))


def test_nodes_score_to_the_same_double(spark):
    frame = spark.createDataFrame(noisy(), SCHEMA)
    done = boost(frame, Settings(rounds=40, depth=5))
    names = ["p", "q", "r"]
    wide = frame.select(F.col("row_id").cast("string").alias("row_id"), *(F.col("x")[i].alias(n) for i, n in enumerate(names)))
    both = node_table.score(wide, boosting.model_nodes(done, "a", names), "by_nodes").join(done.predictions, "row_id")
    assert both.count() == 60 and both.where("by_nodes = prediction").count() == 60
    per_tree = dicts(done.nodes.groupBy("tree").agg(F.count("*").alias("n"), F.max("node").alias("last")))
    assert len(per_tree) == 41 and all(t["n"] == t["last"] + 1 for t in per_tree)


def test_rows_and_columns_are_drawn_by_their_shares(spark):
    frame = spark.createDataFrame(noisy(rows=600, scored=601), SCHEMA)
    nodes = boost(frame, Settings(rounds=30, depth=3, row_share=0.5, column_share=0.7)).nodes.where("tree > 0")
    roots = [r["training_rows"] for r in dicts(nodes.where("node = 0"))]
    assert 280 < sum(roots) / len(roots) < 320 and len(set(roots)) > 5
    used = dicts(nodes.where("position IS NOT NULL").groupBy("tree").agg(F.countDistinct("position").alias("n")))
    assert max(r["n"] for r in used) == 2


def test_defined_cases(spark):
    rows = noisy(rows=20, scored=50) + [("a", 90, None, [None, 1.0, 1.0]), ("a", 91, None, [float("nan"), 1.0, 1.0]), ("a", 91, None, [99.0, 1.0, 1.0])]
    rows += [("constant", i, 5.0, [1.0]) for i in range(4)] + [("one", 1, -2.5, [3.0]), ("one", 2, None, [8.0])]
    frame = spark.createDataFrame(rows, SCHEMA)
    given = Settings(rounds=4, depth=3)
    done = boost(frame, given)
    assert grown(done) == grown(boost(frame, given, in_task=0))
    found = {}
    for r in dicts(done.predictions):
        found.setdefault((r["model"], r["row_id"]), []).append(r["prediction"])
    assert found["a", "90"] == [None]
    # NaN goes right, as a value above all others does; rows may share an id.
    assert len(found["a", "91"]) == 2 and len(set(found["a", "91"])) == 1 and found["a", "91"][0] is not None
    assert [found["constant", str(i)] for i in range(4)] == [[5.0]] * 4
    assert found["one", "1"] == found["one", "2"] == [-2.5]
    empty = boost(frame.limit(0), given)
    assert empty.nodes.count() == 0 and empty.predictions.count() == 0


@pytest.mark.parametrize(
    ("bad", "message"),
    [
        (("b", 1, 1.0, [None, 1.0]), "finite"),
        (("b", 1, 1.0, [float("nan"), 1.0]), "finite"),
        (("b", 1, float("inf"), [1.0, 1.0]), "finite"),
        (("b", 1, 1.0, None), "finite"),
        (("b", 1, None, [1.0, 1.0]), "no training rows"),
    ],
)
def test_rows_that_cannot_train(spark, bad, message):
    with pytest.raises(PySparkException, match=message):
        boost(spark.createDataFrame([*noisy(rows=10), bad], SCHEMA), Settings(rounds=1))


def test_settings_out_of_range():
    for wrong in ({"rounds": 0}, {"depth": 0}, {"rate": 0.0}, {"row_share": 0.0}, {"column_share": 1.5}, {"l2": -1.0}, {"bins": 1}):
        with pytest.raises(ValueError, match="out of range"):
            Settings(**wrong)


def test_folds_of_a_panel_equal_fits_of_each_fold_alone(spark):
    values = [(s, n, 1000 + 40 * n + 300 * (n % 12 == 11) + 7.31 * len(s) * (n % 5)) for s in ("a", "bb") for n in range(36)]
    rows = forecast_training(monthly_frame(spark, values, ["s"]), ["s"])
    done = backtest.compare_feature_sets(rows, {backtest.BOOSTED: {"rounds": 10, "depth": 3}}, ["s"], folds=2, months=3)
    results = dicts(done.results)
    assert sorted((r["model"], r["feature_set"], r["fold"], r["test_rows"]) for r in results) == [
        ("hist", s, f, 6) for s in ("five_features", "six_features") for f in (1, 2)
    ]
    assert {r["folds"] for r in dicts(done.wins)} == {2}
    # The second fold's six features, fitted by themselves.
    fold = next(r for r in results if r["fold"] == 2 and r["feature_set"] == "six_features")
    x = F.array(*(F.col(f).cast("double") for f in backtest.FEATURE_SETS["six_features"])).alias("x")
    y = F.when(F.col("target_month") < F.lit(fold["test_start"]), F.col("target_sales")).alias("y")
    row_id = F.to_json(F.struct("target_month", "s"))
    alone = boost(rows.select(F.lit("m").alias("model"), row_id.alias("row_id"), y, x), Settings(rounds=10, depth=3)).predictions
    actual = rows.where(F.col("target_month") >= F.lit(fold["test_start"])).select(row_id.alias("row_id"), "target_sales")
    mae = actual.join(alone, "row_id").agg(F.avg(F.abs(F.col("prediction") - F.col("target_sales")))).first()[0]
    assert mae == pytest.approx(fold["mae"], rel=1e-12)
