import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import sample_table
from tillwright.llm import neighbours

SCHEMA = "vec_id bigint, embedding array<double>"


def brute(rows, queries, k=10):
    good = [(i, np.array(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q, x in good:
        if q in queries:
            far = sorted((float(np.sqrt(((y - x) ** 2).sum())), i) for i, y in good if i != q)
            out[q] = far[:k]
    return out


def found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"], r["rank"]))
    return out


def recall(got, want):
    hits = sum(len({i for _, i, _ in got.get(q, [])} & {i for _, i in far}) for q, far in want.items())
    return hits / sum(len(far) for far in want.values())


def test_chi_square_quantile():
    draws = (np.random.default_rng(0).standard_normal((200_000, 8)) ** 2).sum(axis=1)
    assert (draws < neighbours.chi_square_quantile(0.9, 8)).mean() == pytest.approx(0.9, abs=0.005)


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_recall_and_exact_scores(spark, spread):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((12, 16)) * (0 if spread else 3)
    rows = [(i, (centres[i % 12] + rng.standard_normal(16)).tolist()) for i in range(1500)]
    got = found(neighbours.nearest(spark.createDataFrame(rows, SCHEMA), F.col("id") % 20 == 0, cell_rows=100))
    want = brute(rows, set(range(0, 1500, 20)))
    assert set(got) == set(want)
    assert recall(got, want) >= 0.95
    vectors = {i: np.array(v) for i, v in rows}
    for q, hits in got.items():
        assert [n for _, _, n in hits] == list(range(1, 11))
        assert [(s, i) for s, i, _ in hits] == sorted((s, i) for s, i, _ in hits)
        for s, i, _ in hits:
            assert s == pytest.approx(np.linalg.norm(vectors[i] - vectors[q]), rel=1e-14)


def test_recall_on_the_embeddings(spark):
    table = sample_table(spark, "embeddings")
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in table.collect()]
    got = found(neighbours.nearest(table, F.col("id") % 5 == 0, cell_rows=64))
    assert recall(got, brute(rows, {i for i, _ in rows if i % 5 == 0})) >= 0.9


def test_hot_vector_ties_and_bad_rows(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PROBE_ROWS", 8)
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(200)] + [(200 + i, rng.standard_normal(3).tolist()) for i in range(100)]
    bad = [(500, None), (510, []), (520, [0.0, 0.0, 0.0]), (530, [1.0, None, 2.0]), (540, [1.0, float("nan"), 2.0]), (550, [float("inf"), 1.0, 1.0]), (560, [1.0, 2.0])]
    table = spark.createDataFrame(rows + bad + [(None, [1.0, 2.0, 3.0])], SCHEMA)
    got = found(neighbours.nearest(table, F.col("id") % 10 == 0, cell_rows=20))
    want = brute(rows, set(range(0, 300, 10)))
    assert set(got) == set(want)
    for q in range(0, 200, 10):
        assert [(s, i) for s, i, _ in got[q]] == want[q]
    assert recall(got, want) >= 0.95


def test_few_or_no_rows_and_repeated_ids(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert neighbours.nearest(empty, F.col("id") % 10 == 0).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 1.0]), (2, [1.0, 0.0])], SCHEMA)
    got = found(neighbours.nearest(few, F.col("id") == 0))
    assert got == {0: [(1.0, 1, 1), (pytest.approx(2**0.5), 2, 2)]}


def test_clashing_columns(spark):
    rows = [(i, [float(i), 1.0], 1, 2) for i in range(30)]
    table = spark.createDataFrame(rows, SCHEMA + ", cell int, vector int")
    assert found(neighbours.nearest(table, F.col("id") == 0, k=2))[0] == [(1.0, 1, 1), (2.0, 2, 2)]
