import math
import statistics
from fractions import Fraction

import pytest
from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillwright.functions import metrics, moments

VALUES = st.one_of(
    st.floats(-1e12, 1e12), st.floats(-1e-6, 1e-6).filter(lambda x: x == 0 or abs(x) > 1e-12), st.floats(-1e18, 1e18),
    st.integers(-100, 100).map(lambda n: 1e9 + n / 8),
)


def near(got, want):
    """Equal, or next to it: the last step rounds once."""
    return got == want or abs(got - want) <= 2 * math.ulp(want)


@settings(max_examples=3, deadline=None, phases=[Phase.generate])
@given(st.lists(st.lists(VALUES, min_size=2, max_size=30), min_size=20, max_size=40))
def test_any_order_gives_the_exact_result(spark, lists):
    frame = spark.createDataFrame([(g, x) for g, values in enumerate(lists) for x in values], "g int, x double")
    measures = {kind: (kind, F.col("x")) for kind in moments.MEASURES}
    of = lambda rows: {r["g"]: tuple(r)[1:] for r in moments.exact_measures(rows, ["g"], measures).collect()}
    first = of(frame.repartition(7))
    for parts in (1, 3):
        turned = frame.orderBy(F.rand(parts)).repartition(parts)
        assert of(turned) == first
    for g, values in enumerate(lists):
        exact = [Fraction(x) for x in values]
        mean = sum(exact) / len(exact)
        total, average, square, spread = first[g]
        assert near(total, math.fsum(values)) and near(average, float(mean))
        assert math.isclose(square, math.sqrt(float(sum(x * x for x in exact) / len(exact))), rel_tol=1e-11)
        want = math.sqrt(sum((x - mean) ** 2 for x in exact) / (len(exact) - 1))
        assert math.isclose(spread, want, rel_tol=1e-9, abs_tol=1e-12 * max(map(abs, values), default=0))


def test_spread_far_from_zero(spark):
    values = [1e9 + n / 8 for n in range(40)]
    frame = spark.createDataFrame([(x,) for x in values], "x double")
    got = moments.exact_measures(frame, [], {"s": ("stddev", F.col("x"))}).first()["s"]
    assert math.isclose(got, statistics.stdev(map(Fraction, values)), rel_tol=1e-14)


def test_nulls_single_rows_and_values_out_of_range(spark):
    frame = spark.createDataFrame([(1, None), (2, 4.0), (2, None)], "g int, x double")
    out = moments.exact_measures(frame, ["g"], {kind: (kind, F.col("x")) for kind in moments.MEASURES})
    assert sorted(tuple(r) for r in out.collect()) == [(1, None, None, None, None), (2, 4.0, 4.0, 4.0, None)]
    for odd in (float("nan"), 1e300, float("inf")):
        with pytest.raises(Exception, match="too large|CAST_OVERFLOW"):
            moments.exact_measures(spark.createDataFrame([(odd,)], "x double"), [], {"s": ("sum", F.col("x"))}).collect()


def test_measures_do_not_depend_on_partitions(spark):
    rows = spark.range(5000).select((F.rand(1) * 1e6).alias("a"), (F.rand(2) * 1e6).alias("p")).collect()
    frame = spark.createDataFrame(rows, "a double, p double")
    found = {tuple(moments.exact_measures(f, [], metrics.error_measures(F.col("a"), F.col("p"))).first()) for f in (frame.repartition(1), frame.repartition(13), frame.orderBy(F.desc("p")))}
    assert len(found) == 1
