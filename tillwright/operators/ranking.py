"""Rank and share inside groups of any size.

A plain window puts a whole group into one task. Here a group is cut into value ranges, each range
is ranked on its own, and the rows above a range are added from a small count per range. Ties
always share a range, so ranks are exact whatever the ranges are. Ranges are cut by size, and where
values lie close together also at quantiles of the group, from a sketch that map tasks merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.functions.joins import null_safe_join
from tillwright.functions.money import exact_sum, percent, rounded
from tillwright.session import written

# Ranges per e-fold of the value: at most some 17,000 in a group, about 0.4 % wide each.
RANGES = 256
# Quantiles of each group that cut it further, and the sketch's accuracy: a range holds few more rows than its share.
QUANTILES = 128
ACCURACY = 10_000


def value_range(value: Column) -> Column:
    """Number of the range of a value; never falls as the value grows."""
    return F.floor(F.signum(value) * F.log1p(F.abs(value)) * RANGES)


def ranged_values(frame: DataFrame, group: str, value: str) -> DataFrame:
    """Distinct values of each group with their `_rows` and the number of their `_range`, higher for higher values."""
    shares = F.array(*(F.lit(i / QUANTILES) for i in range(1, QUANTILES)))
    cuts = F.array_distinct(F.percentile_approx(value, shares, F.lit(ACCURACY))).alias("_cuts")
    # One row per group, written, so that its real size decides about a broadcast.
    cuts = written(frame.groupBy(group).agg(cuts), "rank-cuts")
    passed = F.coalesce(F.size(F.filter("_cuts", lambda cut: cut < F.col(value))), F.lit(0))
    values = frame.groupBy(group, value).agg(F.count("*").alias("_rows"))
    return null_safe_join(values, cuts, [group]).select(
        group, value, "_rows", (value_range(F.col(value)) * QUANTILES + passed).alias("_range")
    )


def rank_within(frame: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """Competition rank of `value`, highest first, inside `group`; a tie leaves a gap.

    `frame` is read several times and should be a written table.
    """
    values = ranged_values(frame, group, value)
    higher_ranges = Window.partitionBy(group).orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    higher_values = (
        Window.partitionBy(group, "_range").orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, -1)
    )
    ranges = (
        values.groupBy(group, "_range")
        .agg(F.sum("_rows").alias("_rows"))
        .select(group, "_range", F.sum("_rows").over(higher_ranges).alias("_above"))
    )
    inside = values.select(group, value, "_range", F.sum("_rows").over(higher_values).alias("_before"))
    ranks = null_safe_join(inside, ranges, [group, "_range"]).select(
        group, value, (1 + F.coalesce("_above", F.lit(0)) + F.coalesce("_before", F.lit(0))).alias(name)
    )
    return null_safe_join(frame, ranks, [group, value])


def share_within(frame: DataFrame, totals: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """Percent of the group's sum of `value` in `totals`, added to the rows of `frame`."""
    # Written, so that its real size decides about a broadcast before `frame` is shuffled.
    sums = written(totals.groupBy(group).agg(exact_sum(totals, value).alias("_sum")), "group-sums")
    return (
        null_safe_join(frame, sums, [group])
        .withColumn(name, rounded(percent(F.col(value), F.col("_sum")), 2))
        .drop("_sum")
    )
