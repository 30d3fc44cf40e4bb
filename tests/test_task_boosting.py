"""Boosting in one task: the trees of Spark's own jobs, and few jobs."""

import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.helpers import dicts
from tests.oracle import DATA, compare, connect
from tillwright.contract import FEATURES
from tillwright.operators import models, node_table, task_boosting
from tillwright.session import written

SF = str(DATA / "sf0.001")
SCHEMA = ", ".join(["n int", "target_sales double", *(f"{f} double" for f in FEATURES)])


def made(seed, count, places=2, scale=1e6, names=FEATURES, zeros=0.0):
    """Rows with targets that follow the features, by chance zero."""
    draw, out = random.Random(seed), []
    for n in range(count):
        x = [0.0 if draw.random() < zeros else round(draw.uniform(-0.5, 1) * scale, places) for _ in names]
        out.append((n, round(3 * x[0] - x[1] + draw.uniform(0, scale), places), *x))
    return out


ROWS = {
    "sales": made(1, 70),
    "ties and zeros": made(2, 90, places=0, scale=4, zeros=0.3),
    "constant columns": [(*r[:3], 0.0, 7.0, *r[5:]) for r in made(3, 40)],
    "constant all over": [(n, 10.0 * n, *[1.0] * len(FEATURES)) for n in range(9)],
    "one target": [(*r[:1], 5.25, *r[2:]) for r in made(4, 30)],
    "two rows": made(5, 2),
}
SETTINGS = {
    "defaults": {"maxIter": 6},
    "few bins": {"maxIter": 4, "maxBins": 8},
    "all rows drawn": {"maxIter": 4, "subsamplingRate": 1.0, "stepSize": 0.3},
    "few rows drawn": {"maxIter": 6, "subsamplingRate": 0.05, "seed": -7},
    "large leaves": {"maxIter": 4, "minInstancesPerNode": 4, "minInfoGain": 1e3, "seed": 2**40},
    "one leaf": {"maxIter": 3, "maxDepth": 0},
}


def table(spark, rows, parts=1):
    return written(spark.createDataFrame(rows, SCHEMA).repartitionByRange(parts, "n").sortWithinPartitions("n"), "rows")


def by_spark(rows, **settings):
    return models.create_model("gbt", **settings).fit(rows.select("target_sales", *FEATURES))


def saved(spark, model, path):
    model.stages[-1].write().overwrite().save(str(path))
    trees = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id")
    weights = spark.read.parquet(f"{path}/treesMetadata").orderBy("_1").select("_1", "_3")
    return dicts(trees), dicts(weights)


def jobs(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    result = run()
    found = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return found, result


@pytest.mark.parametrize(
    "rows, settings", [*((r, "defaults") for r in ROWS), *(("sales", s) for s in SETTINGS if s != "defaults"), ("ties and zeros", "few bins"), ("ties and zeros", "large leaves")]
)
def test_the_trees_are_sparks_to_the_last_bit(spark, tmp_path, rows, settings):
    training = table(spark, ROWS[rows])
    done, own = models.fit("gbt", training, **SETTINGS[settings]), by_spark(training, **SETTINGS[settings])
    assert saved(spark, done, tmp_path / "done") == saved(spark, own, tmp_path / "own")
    assert dicts(models.predict(done, training)) == dicts(models.predict(own, training))


def test_jobs_do_not_grow_with_levels(spark):
    """Spark's own way takes a job per level of each tree, here some 160."""
    training = table(spark, ROWS["sales"])
    found, model = jobs(spark, "twenty rounds", lambda: models.fit("gbt", training, maxIter=20))
    assert model.stages[-1].getNumTrees == 20 and model.stages[-1].totalNumNodes > 500
    assert found < 40


def test_the_holdout_of_all_rounds_equals_its_oracle(spark):
    found, difference = jobs(spark, "all rounds", lambda: compare(spark, connect(SF), SF, "gbt_holdout_rows"))
    assert difference is None
    assert 60 < found < 400
    assert "gbt_holdout_rows" in entry.queries()


def test_checkpoints_change_no_tree(spark, tmp_path):
    training = table(spark, ROWS["sales"])
    found = [saved(spark, models.fit("gbt", training, maxIter=7, checkpointInterval=c), tmp_path / str(c)) for c in (-1, 1, 3, 100)]
    assert all(f == found[0] for f in found)


def test_rows_of_several_partitions_are_drawn_as_spark_draws_them(spark, tmp_path):
    """Whole numbers in the first tree: their sums are exact in any order."""
    training = table(spark, [(n, float(n * n % 97), *(float(n * k % 31) for k in range(2, 2 + len(FEATURES)))) for n in range(200)], parts=4)
    spark.conf.set("spark.sql.files.openCostInBytes", "1g")
    try:
        assert training.rdd.getNumPartitions() == 4
        one = {"maxIter": 1, "subsamplingRate": 0.5}
        done, own = models.fit("gbt", training, **one), by_spark(training, **one)
        assert saved(spark, done, tmp_path / "done") == saved(spark, own, tmp_path / "own")
        assert models.fit("gbt", training, maxIter=5).stages[-1].totalNumNodes > 100
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_the_model_has_its_settings(spark, tmp_path):
    training = table(spark, ROWS["sales"])
    given = {"maxIter": 3, "maxDepth": 2, "seed": 5}
    done, own = (f.stages[-1] for f in (models.fit("gbt", training, **given), by_spark(training, **given)))
    assert {p.name: v for p, v in done.extractParamMap().items()} == {p.name: v for p, v in own.extractParamMap().items()}
    assert done.treeWeights == own.treeWeights and done.featureImportances == own.featureImportances
    assert [t.toDebugString.split("\n", 1)[1] for t in done.trees] == [t.toDebugString.split("\n", 1)[1] for t in own.trees]
    assert len({t.uid for t in done.trees}) == 3 and done.getMaxDepth() == 2
    models.save_model(models.fit("gbt", training, **given), str(tmp_path / "m"))
    assert dicts(models.predict(models.load_model(str(tmp_path / "m")), training)) == dicts(done.transform(models.create_model("gbt").getStages()[0].transform(training)).drop("features"))


def test_whole_numbers_and_decimals(spark):
    as_other = {"target_sales": "decimal(18,2)", FEATURES[0]: "int", FEATURES[1]: "decimal(18,2)"}
    training = table(spark, ROWS["sales"]).withColumns({c: F.col(c).cast(t) for c, t in as_other.items()})
    few = {"maxIter": 3}
    done, own = (dicts(node_table.node_table(spark, m).orderBy("tree", "node")) for m in (models.fit("gbt", training, **few), by_spark(training, **few)))
    assert done == own


def test_what_is_left_to_spark(spark):
    def grown(training, in_task=task_boosting.IN_TASK, **settings):
        trees = models.create_model("gbt", **{"maxIter": 1, **settings}).getStages()[1]
        return task_boosting.fit_in_task(trees, training, FEATURES, in_task) is not None

    training = table(spark, ROWS["sales"])
    assert grown(training) and grown(training, in_task=70) and not grown(training, in_task=69)
    others = ({"featureSubsetStrategy": "0.5"}, {"featureSubsetStrategy": "sqrt"}, {"featureSubsetStrategy": "2"}, {"lossType": "absolute"})
    others += ({"minWeightFractionPerNode": 0.1}, {"weightCol": "lag_1"})
    assert not any(grown(training, **other) for other in others)
    assert all(grown(training, featureSubsetStrategy=s) for s in ("all", "auto", "1.0", "6", "9"))
    assert not grown(training.limit(1)) and not grown(training.limit(0))


@pytest.mark.parametrize("column", ["target_sales", "lag_1"])
@pytest.mark.parametrize("value", [None, float("nan"), float("inf")])
def test_rows_without_a_finite_number_fail_as_before(spark, column, value):
    training = table(spark, ROWS["sales"]).withColumn(column, F.when(F.col("n") == 3, F.lit(value).cast("double")).otherwise(F.col(column)))
    refused = (PySparkException, Py4JJavaError)
    with pytest.raises(refused) as own:
        by_spark(training, maxIter=1)
    with pytest.raises(refused) as done:
        models.fit("gbt", training, maxIter=1)
    assert type(done.value) is type(own.value)
