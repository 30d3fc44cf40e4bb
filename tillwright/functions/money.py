"""Exact amounts.

Sums of doubles depend on the order in which tasks finish, so a retried task may change a result. Here an amount is
the decimal that a double is printed as, and these decimals are summed without rounding, in any order.

Amounts of at most 15 digits with 6 decimals (3 from 10^9 on, none from 10^12 on) are split into whole part and
millionths, which are summed as longs. All others, with up to 18 decimals, go through decimal sums, which stay NULL
where there are none. A sum of 10^19 or more, an amount with more than 18
decimals, and NaN fail the query; no sum is ever rounded. A decimal column keeps all places of its own scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Decimals of a double amount that is summed as longs, and of any amount.
PLACES, MOST_PLACES = 6, 18

TOTAL = f"decimal(30,{PLACES})"
_WHOLE = "decimal(19,0)"


def fits(value: Column, places: int) -> Column:
    """Whether a double is the nearest one to a number of so many decimals, and its whole part a long."""
    exact = (F.rint(value * 10**places) / 10**places == value) | (value == F.rint(value))
    return exact & (F.abs(value) < 2.0**63)


def _split(name: str, value: Column) -> dict[str, Column]:
    """Parts of a double: whole part and millionths, or whole part and fraction as decimals."""
    size = F.abs(value)
    step = F.when(size < 1e9, 1e6).when(size < 1e12, 1e3).otherwise(1.0)
    units = F.rint(value * step)
    # Up to 15 digits, no other number of units is the nearest double's; and longs hold them.
    plain = (size < 1e15) & (units / step == value)
    count, per = units.cast("bigint"), step.cast("bigint")
    rest = count % per
    digits = value.cast(f"decimal(38,{MOST_PLACES})")
    misfit = F.raise_error(F.concat(F.lit(f"{name} has more than {MOST_PLACES} decimals: "), value.cast("string")))
    digits = F.when(digits.cast("double") == value, digits).otherwise(misfit)
    none = F.when(value.isNotNull(), F.lit(0).cast("bigint"))
    return {
        "whole": F.when(plain, ((count - rest) / per).cast("bigint")).otherwise(none),
        f"rest{PLACES}": F.when(plain, rest * (10**PLACES / per).cast("bigint")).otherwise(none),
        "large": F.when(~plain, (digits - digits % 1).cast("decimal(20,0)")),
        "fraction": F.when(~plain, (digits % 1).cast(f"decimal({MOST_PLACES},{MOST_PLACES})")),
    }


def _parts(frame: DataFrame, name: str) -> dict[str, Column]:
    """What is summed of a column, or of its partial sums: `whole`, the rest in units of the last place, named by the
    number of places, and of doubles `large` and `fraction`."""
    kind, value = frame.schema[name].dataType, F.col(name)
    if isinstance(kind, T.StructType):
        return {part: value[part] for part in kind.names}
    if isinstance(kind, T.DecimalType):
        whole = value.cast("bigint")
        return {"whole": whole, f"rest{kind.scale}": ((value - whole) * F.lit(10**kind.scale).cast("decimal(38,0)")).cast("bigint")}
    return _split(name, value.cast("double"))


def partial_sum(frame: DataFrame, name: str) -> Column:
    """Sum that later sums can go on adding to: a struct of the parts."""
    return F.struct(*[F.sum(part).alias(to) for to, part in _parts(frame, name).items()])


def exact_sum(frame: DataFrame, name: str) -> Column:
    """Decimal sum of a column or of partial sums."""
    sums = {to: F.sum(part) for to, part in _parts(frame, name).items()}
    whole, rest = sums.pop("whole"), next(to for to in sums if to.startswith("rest"))
    places = int(rest.removeprefix("rest"))
    if "large" not in sums:
        if not places:
            return whole.cast("decimal(20,0)")
        step = F.lit(f"1e-{places}").cast(f"decimal({places},{places})")
        return whole.cast("decimal(20,0)") + sums[rest].cast("decimal(20,0)") * step
    # Types in which no sum loses a place: 20 digits, and 18 decimals.
    step = F.lit(f"1e-{places}").cast(f"decimal({places},{places})")
    whole = whole.cast(_WHOLE) + F.coalesce(sums["large"], F.lit(0)).cast(_WHOLE)
    tail = sums[rest].cast("decimal(18,0)") * step + F.coalesce(sums["fraction"], F.lit(0)).cast(f"decimal(28,{MOST_PLACES})")
    return whole.cast(_WHOLE) + tail.cast(f"decimal(32,{MOST_PLACES})")


def rounded(value: Column, places: int) -> Column:
    """Round half up on the decimal value, so that ties agree between engines."""
    return F.round(value.cast("decimal(30,10)"), places).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient, NULL where the denominator is zero."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def percent(numerator: Column, denominator: Column) -> Column:
    return ratio(numerator, denominator) * 100
