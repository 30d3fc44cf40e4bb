import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import sample_table
from tillwright.llm import tokens

ENCODING = tokens._encoding(tokens.TOKENIZER)
TEXT = st.text(alphabet="abcE 's12.,!\n\t\x1f  é漢", max_size=200)


def full(text):
    return len(ENCODING.encode_ordinary(text))


def counted(text):
    sizes, begin, counts = tokens.leaves(text), 0, []
    for size in sizes:
        counts.append(full(text[begin : begin + size]))
        begin += size
    return tokens.Counted(text, sizes, tokens.tree(counts))


def consistent(state):
    nodes, half = state.nodes, len(state.nodes) // 2
    assert all(nodes[i] == nodes[2 * i] + nodes[2 * i + 1] for i in range(1, half))
    assert sum(state.sizes) == len(state.text)
    assert nodes[1] == full(state.text)


@settings(deadline=None, max_examples=200)
@given(TEXT, st.lists(st.tuples(st.integers(0, 200), st.integers(0, 60), TEXT), max_size=5), st.integers(1, 12))
def test_counts_after_edits_match_a_full_count(text, drawn, leaf):
    before = tokens.LEAF_CHARS
    tokens.LEAF_CHARS = leaf
    try:
        state = counted(text)
        consistent(state)
        edits, done, want, at = [], 0, "", 0
        for start, size, new in sorted(drawn):
            start = max(min(start, len(text)), done)
            end = min(start + size, len(text))
            edits.append((start, end, new))
            want += text[at:start] + new
            at = done = end
        state.apply(edits, full)
        assert state.text == want + text[at:]
        consistent(state)
    finally:
        tokens.LEAF_CHARS = before


def test_an_edit_encodes_little_of_a_long_text():
    text = "some words here " * 20_000
    state = counted(text)
    state.apply([(150_000, 150_004, "more")], full)
    consistent(state)
    assert 0 < state.reencoded < 3 * tokens.LEAF_CHARS
    with pytest.raises(ValueError):
        state.apply([(5, 9, ""), (7, 8, "")], full)


def test_table_of_edits(spark, docs):
    rows = [(1, "one two three " * 200), (2, None), (3, ""), (1, "one two three " * 200), (4, "x" * 5000), (None, "a b")]
    state = tokens.count_tokens(docs(rows))
    assert sorted(r["_n_tokens"] for r in state.collect()) == sorted(full(t or "") for _, t in rows)
    edits = spark.createDataFrame([(1, 0, 3, "1"), (1, 100, 100, " new"), (2, 0, 0, "text"), (4, 10, 20, None), (99, 0, 0, "x")], "doc_id bigint, start int, end int, replacement string")
    out = tokens.apply_edits(tokens.with_edits(state, edits, "doc_id")).collect()
    first = "1" + rows[0][1][3:100] + " new" + rows[0][1][100:]
    want = {(1, full(first)), (2, full("text")), (3, 0), (4, full("x" * 4990)), (None, full("a b"))}
    assert {(r["doc_id"], r["_n_tokens"]) for r in out} == want and len(out) == 6


def test_table_counts_and_clashing_columns(spark, docs):
    table = sample_table(spark, "documents")
    got = {r["doc_id"]: r["_n_tokens"] for r in tokens.count_tokens(table).collect()}
    assert got == {r["doc_id"]: full(r["text"]) for r in table.collect()}
    assert tokens.count_tokens(docs([])).count() == 0
    clashing = docs([(1, "a b c")]).selectExpr("doc_id", "text", "1 AS n_tokens", "2 AS tree")
    assert tokens.count_tokens(clashing).select("doc_id", "n_tokens", "tree", F.col("_n_tokens")).first() == (1, 1, 2, 3)
