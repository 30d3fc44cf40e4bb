"""Joins on columns that may be NULL, and values of one-row frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match, keeping the left copies of the key columns."""
    copies = {name: f"_{name}" for name in names}
    on = [F.col(name).eqNullSafe(F.col(copy)) for name, copy in copies.items()]
    return left.join(right.withColumnsRenamed(copies), on, how).drop(*copies.values())


def one_row(frame: DataFrame) -> Column:
    """The single row of a frame as a struct, to use in a select over another frame."""
    return frame.select(F.struct(*frame.columns)).scalar()
