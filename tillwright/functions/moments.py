"""Sums, means and spreads of doubles that do not depend on the order of the rows.

A double is cut into whole numbers of 32 bits, each a multiple of another power of two, and these are summed as
longs. No such sum is rounded, so any partitioning, retry or merge gives the same limbs, and only the last step,
from the limbs to a double, rounds. Squares keep the part that a product rounds away, which is again a double.

Values, or their squares, lie below 2^127, and what lies below 2^-96 is cut off; NaN and larger values fail the
query. 2^31 rows of a group always fit, and more fail the query rather than wrap around.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, LOW, HIGH = 32, -3, 3  # limbs LOW..HIGH of BITS bits
_UNIT = f"{2.0**BITS}D"
_HALF = f"{1 << (BITS - 1)}L"
_SPLIT = f"{2.0**27 + 1}D"  # halves the digits of a double

MEASURES = ("sum", "mean", "root_mean_square", "stddev")


def _nearest(name: str, limb: int) -> str:
    return f"rint({name} * {2.0 ** (-BITS * limb)!r}D)"


def _limb(name: str, limb: int) -> str:
    """One limb of a double: a whole number of at most 32 bits."""
    above = _nearest(name, limb + 1)
    whole = f"cast({_nearest(name, limb)} - {above} * {_UNIT} AS bigint)"
    if limb < HIGH:
        return whole
    return f"if({above} != 0, raise_error(concat('too large for an exact sum: ', string({name}))), {whole})"


def _total(names: Sequence[str]) -> str:
    """The sum of columns over the rows as a struct of a double and the small rest of it."""
    sums = ", ".join(f"sum({' + '.join(_limb(name, limb) for name in names)})" for limb in range(LOW, HIGH + 1))
    whole = "limb + at.carry"
    carry = f"shiftright({whole} + {_HALF}, {BITS})"  # the nearest multiple goes on to the next limb
    terms = f"""aggregate(array({sums}),
        named_struct('carry', 0L, 'unit', {2.0 ** (BITS * LOW)!r}D, 'terms', cast(array() AS array<double>)),
        (at, limb) -> named_struct('carry', {carry}, 'unit', at.unit * {_UNIT},
            'terms', concat(array(({whole} - shiftleft({carry}, {BITS})) * at.unit), at.terms)),
        at -> concat(array(at.carry * at.unit), at.terms))"""
    return f"""aggregate({terms}, named_struct('sum', 0D, 'rest', 0D),
        (at, term) -> named_struct('sum', at.sum + term, 'rest', at.rest + (term - (at.sum + term - at.sum))))"""


def _product(left: str, right: str, frame: DataFrame, to: str) -> DataFrame:
    """`frame` with a product as a double (`to`) and what that rounds away (`to_lost`)."""
    both = list(enumerate((left, right)))
    frame = frame.withColumns({to: F.expr(f"{left} * {right}"), **{f"_wide{n}": F.expr(f"{name} * {_SPLIT}") for n, name in both}})
    frame = frame.withColumns({f"_high{n}": F.expr(f"_wide{n} - (_wide{n} - {name})") for n, name in both})
    frame = frame.withColumns({f"_low{n}": F.expr(f"{name} - _high{n}") for n, name in both})
    lost = f"((_high0 * _high1 - {to}) + _high0 * _low1 + _low0 * _high1) + _low0 * _low1"
    return frame.withColumn(f"{to}_lost", F.expr(lost)).drop(*[f"{part}{n}" for part in ("_wide", "_high", "_low") for n in range(2)])


def exact_measures(frame: DataFrame, by: Sequence[str], values: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """One row per group with the named measures; each is a kind (`sum`, `mean`, `root_mean_square`, `stddev`) of the
    non-null values of a column. No rows, and a spread of one row, give NULL."""
    if odd := {kind for kind, _ in values.values()} - set(MEASURES):
        raise ValueError(f"unknown measures {sorted(odd)}, expected {MEASURES}")
    names = {to: f"_v{n}" for n, to in enumerate(values)}
    rows = frame.select(*by, *[value.cast("double").alias(names[to]) for to, (_, value) in values.items()])
    squared = [names[to] for to, (kind, _) in values.items() if kind in ("root_mean_square", "stddev")]
    for name in squared:
        rows = _product(name, name, rows, f"{name}_square")
    totals = []
    for to, (kind, _) in values.items():
        name = names[to]
        totals.append(F.expr(f"count({name})").alias(f"{name}_count"))
        if kind != "root_mean_square":
            totals.append(F.expr(_total([name])).alias(f"{name}_sum"))
        if name in squared:
            totals.append(F.expr(_total([f"{name}_square", f"{name}_square_lost"])).alias(f"{name}_squares"))
    found = rows.groupBy(*by).agg(*totals)
    out = []
    for to, (kind, _) in values.items():
        name = names[to]
        count = f"nullif({name}_count, 0L)"
        if kind == "stddev":
            # (sum of squares - squared sum / n) / (n - 1), the squared sum as a double and its rest.
            found = found.withColumns({f"{name}_s": F.expr(f"{name}_sum.sum"), f"{name}_n": F.expr(f"cast({count} AS double)")})
            found = _product(f"{name}_s", f"{name}_s", found, f"{name}_p")
            found = found.withColumn(f"{name}_part", F.expr(f"{name}_p / {name}_n"))
            found = _product(f"{name}_part", f"{name}_n", found, f"{name}_back")
            less = f"({name}_p - {name}_back - {name}_back_lost + {name}_p_lost + 2 * {name}_s * {name}_sum.rest) / {name}_n"
            variance = f"(({name}_squares.sum - {name}_part) + ({name}_squares.rest - {less})) / ({name}_n - 1)"
            out.append(F.expr(f"if({name}_count > 1, sqrt(greatest({variance}, 0D)), NULL)").alias(to))
        elif kind == "root_mean_square":
            out.append(F.expr(f"sqrt(({name}_squares.sum + {name}_squares.rest) / {count})").alias(to))
        else:
            total = f"{name}_sum.sum + {name}_sum.rest"
            out.append(F.expr(f"({total}) / {count}" if kind == "mean" else f"if({name}_count > 0, {total}, NULL)").alias(to))
    return found.select(*by, *out)
