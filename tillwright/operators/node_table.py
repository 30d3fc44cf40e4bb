"""A fitted forest or boosted model as a table of nodes, and scoring by that table.

The table is plain data: any engine can score from it, and two models can be compared by a join. Scoring stays in
Spark's own functions and shuffles no row: the table, of a checked size, goes to the tasks as one value.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.operators.models import feature_names
from tillwright.session import work_path

# Some 50 MB as one value.
MAX_NODES = 1_000_000


def node_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """One row per node of the model's trees, read from the model as it is saved.

    Rows whose `feature` is at most `threshold` go to node `left`, others to `right`; all four are NULL in leaves.
    `position` is the feature's place in the model, from 0, and `depth` the largest depth of the settings. A prediction
    is the sum over the trees of `weight` x `value` of the leaf reached, divided by `divisor`.
    """
    names, trees = feature_names(model), model.stages[-1]
    path = work_path(spark, "trees")
    trees.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "_metadata", "weight").drop("_metadata")
    averaged = type(trees).__name__.startswith("RandomForest")
    # Features declare no categories, so every split has a threshold.
    threshold = F.when(F.col("split.numCategories") < 0, F.get("split.leftCategoriesOrThreshold", F.lit(0))).otherwise(
        F.raise_error(F.lit("a split on categories has no threshold"))
    )
    inner = {
        "feature": F.get(F.array(*map(F.lit, names)), F.col("split.featureIndex")),
        "position": F.col("split.featureIndex"),
        "threshold": threshold,
        "left": F.col("leftChild"),
        "right": F.col("rightChild"),
        "gain": F.col("gain"),
    }
    return nodes.join(weights, "tree").select(
        "tree",
        "weight",
        F.lit(float(trees.getNumTrees) if averaged else 1.0).alias("divisor"),
        F.lit(trees.getOrDefault("maxDepth")).alias("depth"),
        F.col("id").alias("node"),
        *(F.when(F.col("leftChild") >= 0, value).alias(name) for name, value in inner.items()),
        F.col("prediction").alias("value"),
        F.col("rawCount").alias("training_rows"),
    )


def _packed(nodes: DataFrame) -> DataFrame:
    """All trees as one row: an array of trees in their order, each with its nodes in the order of their numbers."""
    node = F.struct("node", "position", "threshold", "left", "right", "value")
    trees = nodes.groupBy("tree", "weight").agg(F.sort_array(F.collect_list(node)).alias("nodes"))
    return trees.agg(F.sort_array(F.collect_list(F.struct("tree", "weight", "nodes"))).alias("trees"))


def score(rows: DataFrame, nodes: DataFrame, to: str = "prediction") -> DataFrame:
    """`rows` with the prediction in `to`: NULL where a feature is NULL, while NaN goes right at every split.

    Trees are added in their order, as a forest itself does, so its predictions come out to the last bit; a boosted
    model adds in another order and may differ in the last bits. `nodes` is a written table, or cheap to compute twice.
    Raises ValueError for no nodes, more than `MAX_NODES`, or a tree whose nodes are not numbered from 0 without gaps.
    """
    per_tree = nodes.groupBy("tree").agg(
        F.count("*").alias("n"), F.countDistinct("node").alias("numbers"), F.min("node").alias("low"), F.max("node").alias("high")
    )
    whole = (F.col("n") == F.col("numbers")) & (F.col("low") == 0) & (F.col("high") == F.col("n") - 1)
    size = per_tree.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("nodes"), F.every(whole).alias("whole")).first()
    if not 0 < size["nodes"] <= MAX_NODES:
        raise ValueError(f"{size['nodes']} nodes, expected 1 to {MAX_NODES}")
    if not size["whole"]:
        raise ValueError("nodes of a tree are repeated or missing")
    used = nodes.filter("position IS NOT NULL").select("position", "feature").distinct().collect()
    depth, divisor = nodes.agg(F.max("depth"), F.max("divisor")).first()
    features = {row["position"]: F.col(f"`{row['feature']}`").cast("double") for row in used}
    values = F.array(*(features.get(place, F.lit(0.0)) for place in range(max(features, default=0) + 1)))

    def leaf(tree: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            node = F.get(tree["nodes"], at)
            goes_left = F.get(values, node["position"]) <= node["threshold"]
            return F.coalesce(F.when(goes_left, node["left"]).otherwise(node["right"]), at)

        return F.get(tree["nodes"], F.aggregate(F.array_repeat(F.lit(0), depth), F.lit(0), step))

    # A subquery can't stand inside a function over arrays. As its column is used once, Catalyst puts it there, and no
    # row carries the trees along.
    rows = rows.withColumn("_trees", _packed(nodes).scalar())
    total = F.aggregate("_trees", F.lit(0.0), lambda total, tree: total + tree["weight"] * leaf(tree)["value"])
    known = F.lit(True)
    for value in features.values():
        known = known & value.isNotNull()
    return rows.withColumn(to, F.when(known, total / divisor)).drop("_trees")
