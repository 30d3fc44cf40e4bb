"""Approximate nearest neighbours by stable projections, kd-tree and a chi-square stopping test.

Vectors are projected onto `dims` Gaussian directions. The squared projected distance of two vectors, divided by
their squared distance, follows a chi-square law with `dims` degrees of freedom whatever the data. So if the k-th
best distance found so far is d, a closer vector lies within a projected distance of d * sqrt(q) with the
probability `confidence` at least, q being the law's quantile, and the search may stop there.

All rows are indexed: the upper levels of a kd-tree over the projections are fitted on a bounded sample
(`sample` rows) and cut the corpus into cells; a cell of more than `cell_rows` rows is dealt out to several blocks,
so that equal vectors don't meet in one task. In each block the tree goes on down to leaves. A query searches
its own cell first, and then the cells whose bounding box is not beyond its stopping distance; inside a block it
takes leaves in the order of their projected distance, verifies their vectors, and stops by the same test.
Blocks with many queries are searched by several tasks.

Defined results: vectors null, empty, zero or with null or non-finite components, rows with a null id, and vectors
not of the most frequent length take no part. Rows that repeat an id are candidates of their own, but never of a
query with this id; queries that repeat an id are one query, of the smallest vector. Ties go to the smaller id.
Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.session import written

DIMS, CONFIDENCE, SAMPLE, CELL_ROWS, LEAF_ROWS, PROBE_ROWS = 12, 0.98, 20_000, 1_024, 32, 1_024


def chi_square_quantile(share: float, dims: int) -> float:
    """Value that a chi-square variable with an even number of degrees of freedom stays below with this probability."""

    def below(x: float) -> float:
        terms = [1.0]
        for i in range(1, dims // 2):
            terms.append(terms[-1] * (x / 2) / i)
        return 1 - math.exp(-x / 2) * math.fsum(terms)

    low, high = 0.0, 20.0 * dims
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < share else (low, middle)
    return high


class Splits:
    """Upper kd-tree: at each node of a full binary tree the dimension and the value to split at."""

    def __init__(self, points: np.ndarray, depth: int):
        self.depth = depth
        self.dim = np.zeros((1 << depth) - 1, np.int64)
        self.value = np.zeros((1 << depth) - 1)
        groups = [points]
        for level in range(depth):
            parts = []
            for n, group in enumerate(groups):
                node = (1 << level) - 1 + n
                if len(group):
                    self.dim[node] = int(np.argmax(np.ptp(group, axis=0)))
                    self.value[node] = np.median(group[:, self.dim[node]])
                left = group[:, self.dim[node]] < self.value[node]
                parts += [group[left], group[~left]]
            groups = parts

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            right = points[np.arange(len(points)), self.dim[node]] >= self.value[node]
            node = 2 * node + 1 + right
        return node - ((1 << self.depth) - 1)


def _projected(batches: Iterator[pa.RecordBatch], directions: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = _flat(batch.column("vector"), len(directions))
        points = vectors @ directions
        yield pa.record_batch(
            [batch.column("id"), _binary(vectors), _binary(points)], names=["id", "vector", "point"]
        )


def _flat(lists: pa.Array, size: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in rows], type=pa.binary())


def _unpacked(column, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.float64).reshape(-1, size)


def _in_cells(batches: Iterator[pa.RecordBatch], splits: Splits, dims: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cells = splits.cell(_unpacked(batch.column("point").to_pylist(), dims))
        yield batch.append_column("cell", pa.array(cells.astype(np.int32)))


def _partial_boxes(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    """Bounding box and row count of each cell in each batch."""
    for batch in batches:
        cells = batch.column("cell").to_numpy()
        points = _unpacked(batch.column("point").to_pylist(), dims)
        order = np.argsort(cells, kind="stable")
        found, first = np.unique(cells[order], return_index=True)
        if len(found):
            low = np.minimum.reduceat(points[order], first)
            high = np.maximum.reduceat(points[order], first)
            counts = np.diff(np.append(first, len(cells)))
            yield pa.record_batch(
                [
                    pa.array(found), pa.array(counts.astype(np.int64)),
                    pa.array(list(low)), pa.array(list(high)),
                ],
                names=["cell", "n", "low", "high"],
            )


class Leaves:
    """A block's vectors in kd-tree leaves with their bounding boxes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, points: np.ndarray):
        groups = [np.arange(len(ids))]
        while len(groups[0]) > LEAF_ROWS:
            groups = [half for g in groups for half in self._halves(points, g)]
        groups = [g for g in groups if len(g)]
        order = np.concatenate(groups)
        self.ids, self.vectors = ids[order], vectors[order]
        self.first = np.concatenate(([0], np.cumsum([len(g) for g in groups])))
        self.low = np.minimum.reduceat(points[order], self.first[:-1])
        self.high = np.maximum.reduceat(points[order], self.first[:-1])

    @staticmethod
    def _halves(points: np.ndarray, group: np.ndarray) -> list[np.ndarray]:
        dim = int(np.argmax(np.ptp(points[group], axis=0)))
        order = group[np.argsort(points[group, dim], kind="stable")]
        return [order[: (len(order) + 1) // 2], order[(len(order) + 1) // 2 :]]

    def search(self, query_id: int, vector: np.ndarray, point: np.ndarray, k: int, bound: float, quantile: float):
        """Ids and distances of the k best found; `bound` is the stopping distance squared so far."""
        gaps = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        gaps = np.einsum("ij,ij->i", gaps, gaps)
        best_ids, best = np.zeros(0, np.int64), np.zeros(0)
        order = np.argsort(gaps, kind="stable")
        at = 0
        while at < len(order) and gaps[order[at]] <= bound:
            step = order[at : at + 4]
            step = step[gaps[step] <= bound]
            at += len(step)
            rows = np.concatenate([np.arange(self.first[leaf], self.first[leaf + 1]) for leaf in step])
            rows = rows[self.ids[rows] != query_id]
            away = self.vectors[rows] - vector
            ids = np.concatenate((best_ids, self.ids[rows]))
            far = np.concatenate((best, np.sqrt(np.einsum("ij,ij->i", away, away))))
            top = np.lexsort((ids, far))[:k]
            best_ids, best = ids[top], far[top]
            if len(best) == k:
                # Rounding must not cut off equal distances.
                bound = min(bound, best[-1] ** 2 * quantile * (1 + 1e-9))
        return best_ids, best


def _search(_key, candidates: pd.DataFrame, probes: pd.DataFrame, size: int, dims: int, k: int, quantile: float) -> pd.DataFrame:
    found = []
    if len(candidates) and len(probes):
        leaves = Leaves(
            candidates["id"].to_numpy(), _unpacked(candidates["vector"], size), _unpacked(candidates["point"], dims)
        )
        vectors, points = _unpacked(probes["vector"], size), _unpacked(probes["point"], dims)
        for n, (query, bound) in enumerate(zip(probes["query_id"], probes["bound"])):
            ids, far = leaves.search(query, vectors[n], points[n], k, bound, quantile)
            found.append(pd.DataFrame({"query_id": query, "vec_id": ids, "score": far}))
    empty = {"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)}
    return pd.concat(found) if found else pd.DataFrame(empty)


def _near_cells(batches: Iterator[pa.RecordBatch], cells: np.ndarray, low: np.ndarray, high: np.ndarray, dims: int):
    """For each query the other cells whose box lies within its stopping distance."""
    for batch in batches:
        points = _unpacked(batch.column("point").to_pylist(), dims)
        bounds, home = batch.column("bound").to_numpy(), batch.column("cell").to_numpy()
        rows, near = [], []
        for n, point in enumerate(points):
            gaps = np.maximum(np.maximum(low - point, point - high), 0)
            hit = cells[(np.einsum("ij,ij->i", gaps, gaps) <= bounds[n]) & (cells != home[n])]
            rows.append(np.full(len(hit), n))
            near.append(hit)
        rows, near = np.concatenate([[], *rows]).astype(np.int64), np.concatenate([[], *near]).astype(np.int32)
        picked = batch.select(["query_id", "vector", "point", "bound"]).take(pa.array(rows))
        yield picked.append_column("cell", pa.array(near))


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """`id` and `vector` (double components) of the rows that take part."""
    named = vectors.select(F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    named = named.where(F.col("id").isNotNull() & (F.size("vector") > 0) & finite & F.exists("vector", lambda x: x != 0))
    lengths = named.groupBy(F.size("vector").alias("length")).count()
    usual = lengths.agg(F.max_by("length", F.struct("count", -F.col("length")))).first()[0]
    return named.where(F.size("vector") == (usual or 0))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = 10,
    dims: int = DIMS,
    confidence: float = CONFIDENCE,
    sample: int = SAMPLE,
    cell_rows: int = CELL_ROWS,
    seed: int = 7,
) -> DataFrame:
    """`query_id`, `rank` (from 1), `vec_id` and `score` (Euclidean distance): the `k` nearest found for each row
    that meets `is_query` (over the column `id`), nearest first."""
    rows = usable(vectors, vec_id, vector)
    first = rows.select(F.size("vector")).first()
    size = first[0] if first else 1
    directions = np.random.default_rng(seed).standard_normal((size, dims))
    quantile = chi_square_quantile(confidence, dims)
    base = "id bigint, vector binary, point binary"
    projected = written(
        rows.select(F.col("id").cast("long").alias("id"), "vector").mapInArrow(partial(_projected, directions=directions), base),
        "projected",
    )
    total = projected.count()
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit(9), "vector"), 11) / F.lit(float(1 << 53))
    taken = projected.where(drawn < min(1.0, sample / max(total, 1))).select("point").toArrow()["point"].to_pylist()
    depth = max(0, math.ceil(math.log2(max(1.0, min(total / cell_rows, sample / 16)))))
    splits = Splits(_unpacked(taken, dims), depth)
    indexed = written(projected.mapInArrow(partial(_in_cells, splits=splits, dims=dims), base + ", cell int"), "cells")
    boxes = (
        indexed.select("cell", "point")
        .mapInArrow(partial(_partial_boxes, dims=dims), "cell int, n bigint, low array<double>, high array<double>")
        .groupBy("cell")
        .agg(
            F.sum("n").alias("n"),
            F.array(*[F.min(F.col("low")[i]) for i in range(dims)]).alias("low"),
            F.array(*[F.max(F.col("high")[i]) for i in range(dims)]).alias("high"),
        )
        .collect()  # at most 2 ** depth cells
    )
    queries = indexed.where(is_query).withColumn("_least", F.min("vector").over(Window.partitionBy("id")))
    queries = queries.where("vector = _least").dropDuplicates(["id"])
    queries = written(queries.select(F.col("id").alias("query_id"), "vector", "point", "cell"), "queries")
    spark = vectors.sparkSession
    blocks = spark.createDataFrame([(b["cell"], -(-b["n"] // cell_rows)) for b in boxes], "cell int, parts bigint")
    spread = indexed.join(F.broadcast(blocks), "cell").withColumn("part", F.pmod(F.xxhash64("id", "vector"), "parts"))
    search = partial(_search, size=size, dims=dims, k=k, quantile=quantile)
    result = "query_id bigint, vec_id bigint, score double"

    def searched(probes: DataFrame, label: str) -> DataFrame:
        """The best of each block a query goes to; probes are queries with `bound` and the `cell` to search."""
        probes = probes.join(F.broadcast(blocks), "cell").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        load = written(probes.groupBy("cell").agg(F.count_distinct("query_id").alias("n")), "load")
        turns = load.select("cell", F.ceil(F.col("n") / PROBE_ROWS).alias("turns"))
        probes = probes.join(turns, "cell").withColumn("turn", F.pmod(F.xxhash64("query_id"), "turns"))
        copies = spread.join(turns, "cell").withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.col("turns") - 1)))
        by = ["cell", "part", "turn"]
        pairs = copies.select(*by, "id", "vector", "point").groupBy(*by).cogroup(
            probes.select(*by, "query_id", "vector", "point", "bound").groupBy(*by)
        )
        return written(pairs.applyInPandas(search, result), label)

    home = searched(queries.withColumn("bound", F.lit(float("inf"))), "home-hits")
    by_query = Window.partitionBy("query_id").orderBy("score", "vec_id")
    kth = home.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") == k)
    kth = kth.select("query_id", (F.col("score") * F.col("score") * quantile * (1 + 1e-9)).alias("bound"))
    bounded = queries.join(kth, "query_id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
    cells = np.array([b["cell"] for b in boxes], np.int32)
    low = np.array([b["low"] for b in boxes]).reshape(-1, dims)
    high = np.array([b["high"] for b in boxes]).reshape(-1, dims)
    probes = bounded.select("query_id", "vector", "point", "bound", "cell").mapInArrow(
        partial(_near_cells, cells=cells, low=low, high=high, dims=dims),
        "query_id bigint, vector binary, point binary, bound double, cell int",
    )
    hits = home.unionByName(searched(written(probes, "probes"), "other-hits"))
    ranked = hits.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
