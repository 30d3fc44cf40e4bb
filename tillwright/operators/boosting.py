"""Boosted regression trees over binned features, with an L2 term and columns drawn per tree, for many models at once.

Squared error; a leaf's value is its rows' residual sum / (their number + `l2`), times `rate`. Features are cut at
quantiles of the training rows. Labels and predictions are whole multiples of a power of two, so all sums are exact:
the same trees come out for any partitioning, and after a lost executor. A model of at most `in_task` training and
scored rows is grown within one task; larger ones share one Spark aggregation per level, whose histograms are summed
by (model, node, feature, bin) and whose best cuts alone reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.session import located, work_path, written
from tillwright.shipping import ship


@dataclass(frozen=True)
class Settings:
    # The boosted model's settings.
    rounds: int = 600
    depth: int = 8
    rate: float = 0.05
    row_share: float = 0.9
    column_share: float = 0.9
    l2: float = 1.0
    bins: int = 256
    seed: int = 42

    def __post_init__(self):
        shares = 0 < self.row_share <= 1 and 0 < self.column_share <= 1
        if self.rounds < 1 or self.depth < 1 or not 0 < self.rate <= 1 or not shares or self.l2 < 0 or self.bins < 2:
            raise ValueError(f"settings out of range: {self}")


@dataclass(frozen=True)
class Boosted:
    """`nodes`: model, tree, node, position, threshold, left, right, gain, value, training_rows, depth.
    `predictions`: model, row_id, prediction, for all rows."""

    nodes: DataFrame
    predictions: DataFrame


# Rows of a model that one task can hold: some 50 MB with six features.
IN_TASK = 100_000
# Rounds after which the predictions of large models are written; until then tasks repeat them from the trees.
_KEEP = 25

_OUT = (
    "model string, tree int, node int, position int, threshold double, left int, right int, gain double, value double, "
    "training_rows long, row_id string, prediction double"
)
_SUMS = "model string, node int, place int, bin int, g long, n long"
_FOUND = "model string, node int, place int, bin int, gain double, g long, n long, low_g long, low_n long"


def _names(schema: str) -> list[str]:
    return [column.split()[0] for column in schema.split(", ")]


@dataclass
class _Tree:
    """Nodes by number; `position` is -1 in leaves, `g` and `n` are the gradient sum and number of the rows drawn."""

    position: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    g: list[int] = field(default_factory=lambda: [0])
    n: list[int] = field(default_factory=lambda: [0])

    def split(self, node: int, position: int, at: int, gain: float, low_g: int, low_n: int) -> list[int]:
        made = [len(self.g), len(self.g) + 1]
        self.position[node], self.bin[node], self.gain[node] = position, at, gain
        self.left[node], self.right[node] = made
        for g, n in ((low_g, low_n), (self.g[node] - low_g, self.n[node] - low_n)):
            for values, value in zip((self.position, self.bin, self.left, self.right, self.gain, self.g, self.n), (-1, 0, 0, 0, 0.0, g, n)):
                values.append(value)
        return made

    def steps(self, given: Settings) -> np.ndarray:
        """What each node would add to a prediction, in units."""
        rows = np.array(self.n, float) + given.l2
        return np.rint(np.divide(-np.array(self.g, float), rows, out=np.zeros(len(rows)), where=rows > 0) * given.rate).astype(np.int64)

    def reached(self, bins: np.ndarray) -> np.ndarray:
        position, at, left, right = map(np.array, (self.position, self.bin, self.left, self.right))
        node, every = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while True:
            inner = position[node] >= 0
            if not inner.any():
                return node
            low = bins[every, position[node]] <= at[node]
            node = np.where(inner, np.where(low, left[node], right[node]), node)


def _best_cuts(g: np.ndarray, n: np.ndarray, l2: float):
    """Per node of sums by (node, place, bin): place (-1: none), bin and gain of the best cut, totals, sums below it.
    Of equal gains the first place's lowest bin is taken."""
    all_g, all_n = g[:, 0].sum(-1), n[:, 0].sum(-1)
    low_g, low_n = g.cumsum(-1)[..., :-1], n.cumsum(-1)[..., :-1]
    high_g, high_n = all_g[:, None, None] - low_g, all_n[:, None, None] - low_n
    apart = (low_n > 0) & (high_n > 0)

    def worth(s, c):
        return np.divide(s.astype(float) ** 2, c + l2, out=np.zeros(s.shape), where=c > 0)

    both = worth(low_g, low_n) + worth(high_g, high_n)
    gain = both - worth(all_g, all_n)[:, None, None]
    # A difference of rounded numbers: what is lost in them is no gain.
    gain = np.where(apart & (gain > 1e-12 * both), gain, -1.0).reshape(len(g), -1)
    if not gain.shape[1]:
        none = np.zeros(len(g), np.int64)
        return none - 1, none, none.astype(float), all_g, all_n, none, none
    best, every = gain.argmax(1), np.arange(len(g))
    place, at = np.divmod(best, low_g.shape[-1])
    found = gain[every, best] > 0
    return np.where(found, place, -1), at, gain[every, best], all_g, all_n, low_g[every, place, at], low_n[every, place, at]


def _drawn_columns(given: Settings, tree: int, features: int) -> list[int]:
    count = max(1, int(given.column_share * features))
    return sorted(np.random.default_rng([given.seed, tree]).permutation(features)[:count].tolist())


def _drawn_rows(given: Settings, tree: int, ids: np.ndarray) -> np.ndarray:
    """By a hash of row, tree and seed alone, so that a repeated task draws the same rows."""
    mixed = ids.astype(np.int64).view(np.uint64) + np.uint64((given.seed * 1_000_003 + tree) * 0x9E3779B97F4A7C15 % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return ((mixed ^ (mixed >> np.uint64(31))) >> np.uint64(11)) < np.uint64(int(given.row_share * 2**53))


def _exponent(rows: int, top: float) -> int:
    """Units are 2^-k: sums of four times the largest label over all rows fit 63 bits, single values 53 bits."""
    return min(50, 60 - rows.bit_length()) - math.frexp(top)[1]


def _units(y: pd.Series, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Labels in units, and which rows have one."""
    live = y.notna().to_numpy()
    return np.rint(np.ldexp(y.fillna(0.0).to_numpy(float), k)).astype(np.int64), live


def _binned(x: pd.Series, cuts: Sequence[np.ndarray]) -> np.ndarray:
    values = np.array([np.asarray(v, float) for v in x], float).reshape(len(x), len(cuts))
    return np.stack([np.searchsorted(c, values[:, i], "left") for i, c in enumerate(cuts)], 1).astype(np.int64)


def _gradients(predicted: np.ndarray, y: np.ndarray, live: np.ndarray, bits: int) -> np.ndarray:
    g = np.where(live, predicted - y, 0)
    if np.abs(g).max(initial=0) > 1 << (bits + 2):
        raise OverflowError("a prediction has left the range of the labels")
    return g


def _sums(g: np.ndarray, bins: np.ndarray, slot: np.ndarray, slots: int, columns: Sequence[int], width: int):
    """Gradient sums and row counts by (slot, column, bin)."""
    shape = (slots, len(columns), width)
    sums, counts = np.zeros(shape, np.int64).ravel(), np.zeros(shape, np.int64).ravel()
    for place, column in enumerate(columns):
        at = (slot * len(columns) + place) * width + bins[:, column]
        np.add.at(sums, at, g)
        np.add.at(counts, at, 1)
    return sums.reshape(shape), counts.reshape(shape)


def _node_rows(model: str, number: int, tree: _Tree, steps: np.ndarray, cuts: Sequence[np.ndarray], k: int) -> list[tuple]:
    rows = []
    for node, position in enumerate(tree.position):
        inner = (None,) * 5
        if position >= 0:
            gain = math.ldexp(tree.gain[node], -2 * k)
            inner = (position, float(cuts[position][tree.bin[node]]), tree.left[node], tree.right[node], gain)
        rows.append((model, number, node, *inner, math.ldexp(int(steps[node]), -k), tree.n[node], None, None))
    return rows


def _grow_in_task(rows: pd.DataFrame, facts: pd.DataFrame, given: Settings) -> pd.DataFrame:
    """All trees of one model, and its rows' predictions."""
    model, count, top, total_cuts = facts[["model", "rows", "top", "cuts"]].iloc[0]
    k, cuts = _exponent(int(count), top), [np.asarray(c, float) for c in total_cuts]
    (y, live), bins, ids = _units(rows["y"], k), _binned(rows["x"], cuts), rows["draw"].to_numpy(np.int64)
    base, width = int(y[live].sum()) // int(count), max(len(c) for c in cuts) + 1
    predicted = np.full(len(rows), base, np.int64)
    out = _node_rows(model, 0, _Tree(n=[int(count)]), np.array([base]), cuts, k)
    for number in range(1, given.rounds + 1):
        g = _gradients(predicted, y, live, _exponent(int(count), 0.0))
        used, columns = live & _drawn_rows(given, number, ids), _drawn_columns(given, number, len(cuts))
        tree = _Tree(g=[int(g[used].sum())], n=[int(used.sum())])
        node, open_nodes = np.zeros(len(rows), np.int64), [0]
        for _ in range(given.depth):
            slots = np.full(len(tree.g), -1)
            slots[open_nodes] = np.arange(len(open_nodes))
            slot = np.where(used, slots[node], -1)
            at = slot >= 0
            found = _best_cuts(*_sums(g[at], bins[at], slot[at], len(open_nodes), columns, width), given.l2)
            made = []
            for split, place, cut, gain, _, _, low_g, low_n in zip(open_nodes, *(f.tolist() for f in found)):
                if place >= 0:
                    here = node == split
                    children = tree.split(split, columns[place], cut, gain, low_g, low_n)
                    node[here] = np.where(bins[here, columns[place]] <= cut, *children)
                    made += [c for c in children if tree.n[c] > 1]
            open_nodes = made
            if not open_nodes:
                break
        steps = tree.steps(given)
        predicted += steps[node]
        out += _node_rows(model, number, tree, steps, cuts, k)
    prediction = pd.Series(np.ldexp(predicted.astype(float), -k), rows.index).astype(object).where(rows["whole"], None)
    scored = pd.DataFrame({"model": model, "row_id": rows["row_id"], "prediction": prediction})
    return pd.concat([pd.DataFrame(out, columns=_names(_OUT), dtype=object), scored.astype(object)])


def _advanced(part: pd.DataFrame, trees: Sequence[_Tree], given: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Bins and predictions of a batch after the given trees."""
    bins, predicted = np.stack(part["bins"].to_numpy()).astype(np.int64), part["predicted"].to_numpy(np.int64).copy()
    for tree in trees:
        predicted += tree.steps(given)[tree.reached(bins)]
    return bins, predicted


def _grow_by_levels(spark: SparkSession, rows: DataFrame, facts: list, given: Settings) -> DataFrame:
    """The same trees for models too large for a task: one aggregation per level serves all of them."""
    known = {f["model"]: (_exponent(f["rows"], f["top"]), [np.asarray(c, float) for c in f["cuts"]], f["rows"]) for f in facts}

    def prepared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for model, part in batch.groupby("model"):
                k, cuts, _ = known[model]
                y, live = _units(part["y"], k)
                units = pd.Series(y, part.index).where(live).astype("Int64")
                bins = pd.Series(list(_binned(part["x"], cuts)), part.index)
                yield part[["model", "row_id", "draw", "whole"]].assign(y=units, bins=bins, predicted=0)

    schema = "model string, row_id string, draw long, whole boolean, y long, bins array<int>, predicted long"
    path = work_path(spark, "boosting")
    rows.mapInPandas(prepared, schema).write.parquet(path)
    state = spark.read.schema(schema).parquet(path)
    labels = {r["model"]: r["s"] for r in state.groupBy("model").agg(F.sum("y").alias("s")).collect()}
    bases = {model: labels[model] // count for model, (_, _, count) in known.items()}
    out = []
    for model, (k, cuts, count) in known.items():
        out += _node_rows(model, 0, _Tree(n=[count]), np.array([bases[model]]), cuts, k)
    trees: dict[str, list[_Tree]] = {model: [] for model in known}
    first = True
    for number in range(1, given.rounds + 1):
        columns = {model: _drawn_columns(given, number, len(cuts)) for model, (_, cuts, _) in known.items()}
        growing = {model: _Tree() for model in known}
        waiting = {model: [0] for model in known}
        for level in range(given.depth):

            def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                for batch in batches:
                    for model, part in batch[batch["model"].isin([m for m in waiting if waiting[m]])].groupby("model"):
                        bins, predicted = _advanced(part, trees[model], given)
                        predicted += bases[model] * first
                        live = part["y"].notna().to_numpy()
                        y = part["y"].fillna(0).to_numpy(np.int64)
                        g = _gradients(predicted, y, live, _exponent(known[model][2], 0.0))
                        slots = np.full(len(growing[model].g), -1)
                        slots[waiting[model]] = np.arange(len(waiting[model]))
                        used = live & _drawn_rows(given, number, part["draw"].to_numpy(np.int64))
                        slot = np.where(used, slots[growing[model].reached(bins)], -1)
                        at = slot >= 0
                        width = max(len(c) for c in known[model][1]) + 1
                        s, n = _sums(g[at], bins[at], slot[at], len(waiting[model]), columns[model], width)
                        a, place, cut = n.nonzero()
                        yield pd.DataFrame(
                            {"model": model, "node": np.array(waiting[model])[a], "place": place, "bin": cut, "g": s[n > 0], "n": n[n > 0]}
                        )

            def best(part: pd.DataFrame) -> pd.DataFrame:
                model, node = part[["model", "node"]].iloc[0]
                shape = (1, len(columns[model]), max(len(c) for c in known[model][1]) + 1)
                g, n = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
                g[0, part["place"], part["bin"]], n[0, part["place"], part["bin"]] = part["g"], part["n"]
                return pd.DataFrame([(model, node, *(v[0] for v in _best_cuts(g, n, given.l2)))], columns=_names(_FOUND))

            summed = state.mapInPandas(sums, _SUMS).groupBy("model", "node", "place", "bin").agg(F.sum("g").alias("g"), F.sum("n").alias("n"))
            # A group is one node's histogram: drawn columns x bins rows at most.
            found = summed.groupBy("model", "node").applyInPandas(best, _FOUND).collect()
            opened: dict[str, list[int]] = {model: [] for model in known}
            for f in sorted(found, key=lambda f: f["node"]):
                tree = growing[f["model"]]
                if level == 0:
                    tree.g[0], tree.n[0] = f["g"], f["n"]
                if f["place"] >= 0:
                    made = tree.split(f["node"], columns[f["model"]][f["place"]], f["bin"], f["gain"], f["low_g"], f["low_n"])
                    opened[f["model"]] += [c for c in made if tree.n[c] > 1]
            waiting = opened
            if not any(waiting.values()):
                break
        for model, (k, cuts, _) in known.items():
            trees[model].append(growing[model])
            out += _node_rows(model, number, growing[model], growing[model].steps(given), cuts, k)
        if number % _KEEP == 0 or number == given.rounds:

            def advanced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                for batch in batches:
                    for model, part in batch.groupby("model"):
                        yield part.assign(predicted=_advanced(part, trees[model], given)[1] + bases[model] * first, y=part["y"].astype("Int64"))

            newer = work_path(spark, "boosting")
            state.mapInPandas(advanced, schema).write.parquet(newer)
            system, place = located(spark, path)
            system.delete(place, True)
            path, state = newer, spark.read.schema(schema).parquet(newer)
            trees, first = {model: [] for model in known}, False
    nodes = spark.createDataFrame(out, _OUT)
    back = F.create_map(*(F.lit(v) for model, (k, _, _) in known.items() for v in (model, math.ldexp(1.0, -k))))
    value = F.when(F.col("whole"), F.col("predicted").cast("double") * back[F.col("model")])
    empty = [F.lit(None).cast(kind).alias(name) for name, kind in (c.split() for c in _OUT.split(", ")[1:10])]
    return nodes.unionByName(state.select("model", *empty, "row_id", value.alias("prediction")))


def boost(jobs: DataFrame, given: Settings | None = None, in_task: int = IN_TASK) -> Boosted:
    """Grow one boosted model per `model` of `jobs`: model string, row_id, y double, x array<double>.

    Rows with a NULL `y` are only scored. All rows of a model have the same features. A hash of `row_id` decides with
    the seed in which rounds a row is drawn; rows may share one. Predictions give it back as a string. The first tree is the mean label, as a single leaf. A bin's cut is
    the largest value on its left; NaN lies right of every cut. A scored row with a NULL feature gets a NULL prediction.
    A training row with a NULL, NaN or infinite feature or label fails the query, as does a model without training rows.
    No rows give no nodes and no predictions.
    """
    given = given or Settings()
    spark = ship(jobs.sparkSession)
    whole = F.col("x").isNotNull() & ~F.exists("x", lambda v: v.isNull())
    finite = F.forall(F.array_append("x", F.col("y")), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    fault = F.raise_error(F.lit("a training row has a label or feature that is no finite number")).cast("double")
    label = F.when(F.col("y").isNotNull() & ~F.coalesce(whole & finite, F.lit(False)), fault).otherwise(F.col("y"))
    row_id = F.col("row_id").cast("string")
    rows = jobs.select(
        "model",
        row_id.alias("row_id"),
        F.xxhash64(row_id).alias("draw"),
        label.alias("y"),
        F.col("x").cast("array<double>").alias("x"),
        F.coalesce(whole, F.lit(False)).alias("whole"),
    )
    rows = written(rows, "boosting-rows")
    sizes = rows.groupBy("model").agg(F.count("*").alias("all_rows"), F.count("y").alias("rows"), F.max(F.abs("y")).alias("top"))
    shares = F.array(*(F.lit(i / given.bins) for i in range(1, given.bins)))
    per_feature = rows.where("y IS NOT NULL").select("model", F.posexplode("x").alias("position", "v")).groupBy("model", "position").agg(
        F.max("v").alias("high"), F.percentile_approx("v", shares, F.lit(max(10_000, 16 * given.bins))).alias("q")
    )
    # The largest value is no cut: nothing lies right of it.
    cuts = F.array_sort(F.array_distinct(F.filter("q", lambda v: v < F.col("high"))))
    per_model = per_feature.groupBy("model").agg(F.array_sort(F.collect_list(F.struct("position", cuts.alias("cuts")))).alias("by_position"))
    facts = sizes.join(per_model, "model", "left").select("model", "all_rows", "rows", "top", F.col("by_position.cuts").alias("cuts"))
    none = F.raise_error(F.lit("a model has no training rows or no features")).cast("long")
    facts = written(facts.withColumn("rows", F.when((F.col("rows") == 0) | F.col("cuts").isNull(), none).otherwise(F.col("rows"))), "boosting-facts")
    # Few by their size: each has more rows than a task is given.
    large = facts.where(F.col("all_rows") > in_task).collect()
    small = facts.where(F.col("all_rows") <= in_task)

    def in_one_task(part: pd.DataFrame, about: pd.DataFrame) -> pd.DataFrame:
        return _grow_in_task(part, about, given) if len(part) and len(about) else pd.DataFrame(columns=_names(_OUT))

    fitting = rows.join(small.select("model"), "model", "left_semi")
    done = fitting.groupBy("model").cogroup(small.groupBy("model")).applyInPandas(in_one_task, _OUT)
    if large:
        of_large = rows.where(F.col("model").isin([f["model"] for f in large]))
        done = done.unionByName(_grow_by_levels(spark, of_large, large, given))
    done = written(done, "boosted")
    nodes = done.where("tree IS NOT NULL").drop("row_id", "prediction").withColumn("depth", F.lit(given.depth))
    return Boosted(nodes, done.where("tree IS NULL").select("model", "row_id", "prediction"))


def model_nodes(boosted: Boosted, model: str, features: Sequence[str]) -> DataFrame:
    """One model's nodes in the form that `node_table.score` reads; its predictions are the same to the last bit."""
    name = F.get(F.array(*map(F.lit, features)), F.col("position")).alias("feature")
    one = [F.lit(1.0).alias(c) for c in ("weight", "divisor")]
    return boosted.nodes.where(F.col("model") == model).select(
        "tree", *one, "depth", "node", name, "position", "threshold", "left", "right", "gain", "value", "training_rows"
    )
