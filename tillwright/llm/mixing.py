"""Mixing sources to target weights by Pfair scheduling.

The rows of each source are numbered and cut into blocks. Time is a row of slots, one block each. With target
weight w, block j (from 0) of a source is released at slot floor(j / w) and due by slot ceil((j + 1) / w), and each
slot goes to the released block with the earliest deadline. As the weights sum to one, every block gets a slot
inside its window, so after any number of slots a source that still has blocks is less than one block away from
its target share.

The weights are taken as they are given, as exact fractions. The driver sees the number of blocks of each source
and deals out the slots, some five numbers per block of `block_rows` rows; rows are placed by a join with that
table. A source that runs out is not waited for: slots that no block is released for stay unused. With a
`resolution`, weights are rounded to whole shares of as many slots, and only one period of that length is worked
out: block j of a source with q shares takes its slot from block j mod q, j div q periods later. No row is dropped
or repeated.

Defined results: a null source is a source of its own; rows without an id, with the same id or equal rows all
keep their places (the order among equal sort keys is fixed when the numbered table is written). The number of
sources is taken as small (the driver sees one row per source). An empty table gives an empty table. A weight so
small that a block of its source would only be due beyond slot 2^63 is an error. Columns pass through; the added ones, `slot`, `place`, `block`, `release` and `deadline`, replace columns of these names.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping
from fractions import Fraction

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tillwright.functions.joins import null_safe_join
from tillwright.session import written

RESOLUTION, BLOCK_ROWS = 10_000, 16
ADDED = ["slot", "place", "block", "release", "deadline"]


def shares(weights: Mapping, resolution: int = RESOLUTION) -> dict:
    """Whole shares that sum to `resolution`, by largest remainders, at least one each."""
    if any(not w > 0 for w in weights.values()):
        raise ValueError("target weights must be positive")
    if len(weights) > resolution:
        raise ValueError(f"{len(weights)} sources need a resolution of as many slots at least")
    total = sum(weights.values())
    exact = {s: (resolution - len(weights)) * w / total for s, w in weights.items()}
    out = {s: 1 + int(x) for s, x in exact.items()}
    by_rest = sorted(weights, key=lambda s: (int(exact[s]) - exact[s], s is not None, str(s)))
    for source in by_rest[: resolution - sum(out.values())]:
        out[source] += 1
    return out


def period(quotas: Mapping) -> dict[object, list[int]]:
    """Slot of each block of each source within one period, earliest deadline first."""
    length = sum(quotas.values())
    names = list(quotas)
    waiting = [(0, n) for n in range(len(names))]  # release, source; sorted
    ready: list[tuple[int, int]] = []
    slots: dict[object, list[int]] = {s: [] for s in names}
    for now in range(length):
        while waiting and waiting[0][0] <= now:
            _, n = heapq.heappop(waiting)
            quota, j = quotas[names[n]], len(slots[names[n]])
            heapq.heappush(ready, (-(-(j + 1) * length // quota), n))
        _, n = heapq.heappop(ready)
        quota, mine = quotas[names[n]], slots[names[n]]
        mine.append(now)
        if len(mine) < quota:
            heapq.heappush(waiting, (len(mine) * length // quota, n))
    return slots


def schedule(weights: Mapping, blocks: Mapping) -> tuple[list, np.ndarray]:
    """The sources, and per block a row of the source's place among them, block, slot, release and deadline,
    for the weights as they are given; earliest deadline first."""
    if any(not w > 0 for w in weights.values()):
        raise ValueError("target weights must be positive")
    names = [s for s in weights if blocks.get(s)]
    exact = {s: Fraction(w) for s, w in weights.items()}
    total = sum(exact.values())
    rates = [((exact[s] / total).numerator, (exact[s] / total).denominator) for s in names]
    sizes = [blocks[s] for s in names]
    if late := [names[n] for n, (up, down) in enumerate(rates) if -(-sizes[n] * down // up) >= 1 << 63]:
        raise ValueError(f"the weight of source {late[0]!r} is too small: its last slot is beyond 2^63")
    waiting = [(0, n, 0) for n in range(len(names))]  # release, source, block; sorted
    ready: list[tuple[int, int, int, int]] = []
    out = np.empty((sum(sizes), 5), np.int64)
    now = 0
    for row in range(len(out)):
        if not ready:
            now = max(now, waiting[0][0])
        while waiting and waiting[0][0] <= now:
            release, n, j = heapq.heappop(waiting)
            up, down = rates[n]
            heapq.heappush(ready, (-(-(j + 1) * down // up), n, j, release))
        deadline, n, j, release = heapq.heappop(ready)
        out[row] = n, j, now, release, deadline
        now += 1
        if j + 1 < sizes[n]:
            up, down = rates[n]
            heapq.heappush(waiting, ((j + 1) * down // up, n, j + 1))
    return names, out


def numbered(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """`rows` with `_rank`, the number from 0 of each row among the rows of its key, in the given order.

    A key with a third of all rows is numbered by many tasks: rows are range-partitioned by key and order, and a
    row's number is its place in its partition plus the rows of the key in the partitions before.
    """
    spread = rows.withColumns({f"_o{i}": c for i, c in enumerate(order)})
    by = [key, *[f"_o{i}" for i in range(len(order))]]
    placed = spread.repartitionByRange(*by).sortWithinPartitions(*by).drop(*by[1:])
    placed = written(placed.withColumn("_row", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn("_part", F.shiftright("_row", 33))  # the upper bits of the row are its partition
    parts = placed.groupBy("_part", key).agg(F.min("_row").alias("_begin"), F.count("*").alias("_n"))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    parts = written(parts.select("_part", key, (F.col("_before") - F.col("_begin")).alias("_shift")), "parts")
    return null_safe_join(placed, parts, ["_part", key]).withColumn("_rank", F.col("_row") + F.col("_shift")).drop(
        "_row", "_part", "_shift"
    )


def mix(
    rows: DataFrame,
    source: str = "source",
    order: list[str] | None = None,
    weights: Mapping | None = None,
    temperature: float = 0.5,
    block_rows: int = BLOCK_ROWS,
    resolution: int | None = None,
) -> DataFrame:
    """`rows` with `slot` (when its block is due to be read), `place` in the block, `block` (number within its
    source), `release` and `deadline`. Reading by `slot`, then `place`, gives the mixture.

    Without `weights` (one for each source), a source weighs its number of rows to the power `temperature`. Within
    a source, rows are read in the order of a hash of the `order` columns (all columns by default). With a
    `resolution`, weights are rounded to shares of as many slots.
    """
    spark = rows.sparkSession
    names = [c for c in rows.columns if c not in ADDED]
    packed = rows.select(F.col(source).alias("_source"), F.struct(*names).alias("_data"))
    mixed_order = F.xxhash64(F.lit(17), *[F.col(f"_data.{c}") for c in order or names])
    ranked = numbered(packed, "_source", [mixed_order, *[F.col(f"_data.{c}") for c in order or []]])
    if weights is None:
        sizes = rows.groupBy(source).count().collect()
        weights = {r[0]: r[1] ** temperature for r in sorted(sizes, key=lambda r: (r[0] is not None, r[0] or 0))}
    elif missing := rows.select(source).distinct().where(
        ~F.coalesce(F.col(source).isin([s for s in weights if s is not None]), F.lit(None in weights))
    ).take(1):
        raise ValueError(f"no target weight for source {missing[0][0]!r}")
    if resolution is None:
        return _placed_exactly(ranked, weights, names, block_rows)
    quotas = shares(weights, resolution) if weights else {}
    schema = StructType([
        StructField("_source", rows.schema[source].dataType),
        *[StructField(name, LongType()) for name in ("_turn", "_offset", "_quota")],
    ])
    table = [(s, j, slot, quotas[s]) for s, slots in period(quotas).items() for j, slot in enumerate(slots)]
    offsets = spark.createDataFrame(table, schema)  # `resolution` rows
    quota = spark.createDataFrame([(s, q) for s, q in quotas.items()], StructType([schema[0], schema[3]]))
    placed = null_safe_join(
        ranked.withColumns({"block": F.expr(f"_rank div {block_rows}L"), "place": F.col("_rank") % block_rows}),
        F.broadcast(quota), ["_source"],
    )
    placed = placed.withColumns({"_turn": F.col("block") % F.col("_quota"), "_round": F.expr("block div _quota")})
    placed = null_safe_join(placed.drop("_quota"), F.broadcast(offsets), ["_source", "_turn"])
    return placed.select(
        *[F.col("_data")[c].alias(c) for c in names],
        (F.col("_round") * resolution + F.col("_offset")).alias("slot"),
        "place",
        "block",
        F.expr(f"block * {resolution}L div _quota").alias("release"),
        F.expr(f"((block + 1) * {resolution}L + _quota - 1) div _quota").alias("deadline"),
    )


def _placed_exactly(ranked: DataFrame, weights: Mapping, names: list[str], block_rows: int) -> DataFrame:
    """The numbered rows with their places by the weights as they are."""
    spark = ranked.sparkSession
    last = ranked.groupBy("_source").agg(F.max("_rank").alias("last")).collect()
    sources, slots = schedule(weights, {r["_source"]: r["last"] // block_rows + 1 for r in last})
    schema = StructType([StructField("_source", ranked.schema["_source"].dataType), StructField("_n", LongType())])
    known = spark.createDataFrame([(s, n) for n, s in enumerate(sources)], schema)
    columns = ["_n", "block", "slot", "release", "deadline"]
    if len(slots):
        table = spark.createDataFrame(pa.table({c: slots[:, i].copy() for i, c in enumerate(columns)}))
    else:
        table = spark.createDataFrame([], StructType([StructField(c, LongType()) for c in columns]))
    placed = null_safe_join(ranked, F.broadcast(known), ["_source"]).withColumns(
        {"block": F.expr(f"_rank div {block_rows}L"), "place": F.col("_rank") % block_rows}
    )
    placed = placed.join(written(table, "schedule"), ["_n", "block"])
    return placed.select(*[F.col("_data")[c].alias(c) for c in names], "slot", "place", "block", "release", "deadline")
