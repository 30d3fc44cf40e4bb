import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillwright.llm import mixing


@settings(deadline=None, max_examples=60)
@given(st.lists(st.floats(0.01, 50), min_size=1, max_size=12), st.integers(50, 400))
def test_period_stays_within_a_block_of_the_weights(weights, resolution):
    quotas = mixing.shares(dict(enumerate(weights)), resolution)
    assert sum(quotas.values()) == resolution
    slots = mixing.period(quotas)
    owner = {slot: s for s, mine in slots.items() for slot in mine}
    assert sorted(owner) == list(range(resolution))
    done = Counter()
    for now in range(resolution):
        done[owner[now]] += 1
        for s, quota in quotas.items():
            assert abs(done[s] * resolution - quota * (now + 1)) < resolution
    for s, mine in slots.items():
        for j, slot in enumerate(mine):
            assert j * resolution // quotas[s] <= slot < -(-(j + 1) * resolution // quotas[s])


def test_schedule_stays_within_a_block_of_the_weights_given():
    weights = {"hot": 0.9, **{n: 0.1 / 99 for n in range(98)}, "rare": 1e-6}
    exact = {s: Fraction(w) for s, w in weights.items()}
    total = sum(exact.values())
    names, slots = mixing.schedule(weights, {s: max(1, int(w * 20_000)) for s, w in weights.items()})
    assert len({tuple(r) for r in slots[:, :2].tolist()}) == len(slots) == len(set(slots[:, 2].tolist()))
    for n, j, slot, release, deadline in slots.tolist():
        w = exact[names[n]] / total
        assert release == math.floor(j / w) <= slot < math.ceil((j + 1) / w) == deadline
    assert len(mixing.schedule(dict.fromkeys(range(12_000), 1), dict.fromkeys(range(12_000), 1))[1]) == 12_000


def test_rows_follow_the_weights_given(docs):
    out = mixing.mix(table(docs, {"a": 600, "b": 60, None: 7}), weights={"a": 1, "b": 1e-3, None: 1e-3}, block_rows=1).collect()
    assert len({r["slot"] for r in out}) == len(out) == 667
    for source, w in (("a", Fraction(1)), ("b", Fraction(1e-3)), (None, Fraction(1e-3))):
        w /= 1 + 2 * Fraction(1e-3)
        mine = [r for r in out if r["source"] == source]
        assert sorted(r["block"] for r in mine) == list(range(len(mine)))
        assert all(r["release"] == math.floor(r["block"] / w) <= r["slot"] < math.ceil((r["block"] + 1) / w) for r in mine)


def table(docs, sizes):
    rows, n = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            rows.append((n, f"t{n}", "en", source))
            n += 1
    random.Random(1).shuffle(rows)
    return docs(rows)


@pytest.mark.parametrize("weights", [None, {"a": 6, "b": 3, "c": 1, None: 2}])
def test_every_row_once_in_pfair_order(docs, weights):
    sizes = {"a": 700, "b": 150, "c": 41, None: 30}
    rows = table(docs, sizes)
    out = mixing.mix(rows, order=["doc_id"], weights=weights, block_rows=4, resolution=100).collect()
    assert sorted(r["doc_id"] for r in out) == list(range(sum(sizes.values())))
    quotas = mixing.shares(weights or {s: n**0.5 for s, n in sizes.items()}, 100)
    by_slot = defaultdict(list)
    for r in out:
        by_slot[r["slot"]].append(r)
        assert r["release"] <= r["slot"] < r["deadline"]
        assert r["release"] == r["block"] * 100 // quotas[r["source"]]
    last = {s: max(r["slot"] for r in out if r["source"] == s) for s in sizes}
    done = Counter()
    for slot in range(max(by_slot) + 1):
        block = by_slot.get(slot, [])
        assert len({(r["source"], r["block"]) for r in block}) <= 1
        assert sorted(r["place"] for r in block) == list(range(len(block)))
        for r in block[:1]:
            done[r["source"]] += 1
        for s, quota in quotas.items():
            if slot <= last[s]:
                assert abs(done[s] * 100 - quota * (slot + 1)) < 100
    for s, size in sizes.items():
        assert Counter(r["block"] for r in out if r["source"] == s) == Counter(i // 4 for i in range(size))


def test_repeated_rows_ids_and_nulls_keep_their_places(docs):
    rows = [(None, None, "en", "a"), (None, None, "en", "a"), (1, "x", "en", "a"), (1, "x", "en", "a"), (1, "y", "en", None)]
    out = mixing.mix(docs(rows), block_rows=1, resolution=10).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in out) == sorted((i or 0, t or "") for i, t, *_ in rows)
    assert len({(r["slot"], r["place"]) for r in out}) == len(rows)


def test_hot_source_is_numbered_by_many_tasks(docs):
    rows = table(docs, {"hot": 3000, "b": 100})
    ranked = mixing.numbered(rows.select("source", "doc_id"), "source", [rows["doc_id"]]).collect()
    for source, size in (("hot", 3000), ("b", 100)):
        mine = sorted((r["_rank"], r["doc_id"]) for r in ranked if r["source"] == source)
        assert [n for n, _ in mine] == list(range(size))
        assert [d for _, d in mine] == sorted(d for _, d in mine)


def test_empty_table_clashes_and_bad_weights(docs):
    assert mixing.mix(docs([])).count() == 0
    clashing = docs([(1, "x"), (2, "y")]).selectExpr("doc_id", "source", "5 AS slot", "6 AS _rank", "7 AS _source", "8 AS _data")
    out = mixing.mix(clashing)
    assert [c for c in out.columns if c not in mixing.ADDED] == ["doc_id", "source", "_rank", "_source", "_data"]
    assert {r["_source"] for r in out.collect()} == {7}
    with pytest.raises(ValueError):
        mixing.mix(docs([(1, "x", "en", "a"), (2, "x", "en", "b")]), weights={"a": 1})
    with pytest.raises(ValueError):
        mixing.shares({"a": 0})


def test_weights_too_small_for_any_slot():
    with pytest.raises(ValueError, match="too small"):
        mixing.schedule({"a": 1.0, "b": 1e-25}, {"a": 3, "b": 2})
    names, slots = mixing.schedule({"a": 1.0, "b": 1e-15}, {"a": 3, "b": 2})
    assert sorted(slots[:, 1][slots[:, 0] == names.index("b")].tolist()) == [0, 1]
