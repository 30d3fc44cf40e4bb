import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import words as plain_words
from tillwright.llm import words as W

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAzZ09 .\n\t\x0bé漢𝒳_", max_size=30)), max_size=8)


def shown(words):
    return [bytes(words.data[s:e]).decode() for s, e in zip(words.starts, words.ends)]


@settings(deadline=None, max_examples=150)
@given(TEXTS)
def test_split_matches_the_patterns(texts):
    column = pa.array(texts, type=pa.string())
    for rule, of in ((W.LOWERED, plain_words), (W.NON_SPACE, lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or ""))):
        words = W.split(column, rule)
        assert shown(words) == [w for t in texts for w in of(t)]
        assert words.counts.tolist() == [len(of(t)) for t in texts]


def test_sliced_columns_and_chunks():
    column = pa.array(["one two", None, "three", "", "four five six"])
    assert shown(W.split(column[1:4], W.NON_SPACE)) == ["three"]
    batch = pa.record_batch([column], names=["text"])
    parts = list(W.chunks(batch, "text", limit=8))
    assert [t for p in parts for t in p.column(0).to_pylist()] == column.to_pylist()
    assert len(parts) > 1


@pytest.mark.parametrize("size", [1, 2, 3, 5, 7, 18, 35])
def test_grams_are_equal_exactly_for_equal_runs(size):
    values = W.mixed(np.random.default_rng(0).integers(1, 4, 3000).astype(np.uint64))
    grams = W.grams(values, size)
    assert len(grams) == len(values) - size + 1
    seen = {}
    for i, gram in enumerate(grams.tolist()):
        assert seen.setdefault(values[i : i + size].tobytes(), gram) == gram
    assert len(set(seen.values())) == len(seen)


def test_hash_covers_long_words():
    column = pa.array(["x" * 50, "x" * 51, "x" * 50, "y" + "x" * 49])
    one, two, three, four = W.hashes(W.split(column, W.NON_SPACE)).tolist()
    assert one == three and len({one, two, four}) == 3
