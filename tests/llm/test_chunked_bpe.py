"""Chunk-wise tokens against the tokenizers library on whole texts."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PythonException
from tokenizers import Tokenizer

from tests.llm import helpers
from tillwright.llm import catalog, chunked_bpe

WHOLE = Tokenizer.from_file(chunked_bpe.installed(chunked_bpe.VOCABULARY))
KNOWN = chunked_bpe.vocabulary(chunked_bpe.VOCABULARY)


def ids_of(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


TEXT = st.one_of(
    st.text(max_size=60),
    st.lists(st.sampled_from([" ", "  ", "\n", "don't", "we'll", "12", "é", "ß", "中文", " ", "a", "!", "<|endoftext|>", "<|end", "x　", "👍"]), max_size=40).map("".join),
)


@settings(deadline=None, max_examples=400)
@given(TEXT, st.lists(st.integers(0, 200), max_size=8))
def test_any_cuts_are_repaired(text, places):
    cuts = sorted({0, len(text), *[p % (len(text) + 1) for p in places]})
    pieces = [KNOWN.encode(text[a:b].encode()) for a, b in zip(cuts, cuts[1:])]
    assert chunked_bpe.joined(pieces, KNOWN).tolist() == ids_of(text)


def test_chunks_follow_the_content():
    rng = random.Random(4)
    shared = "".join(rng.choice("abcdefgh éß中\n") for _ in range(4000))
    texts = [shared, "x" * 301 + shared, None, "", "y é" * 50 + shared, "z" * 5]
    part = pa.record_batch([pa.array(texts, pa.string())], names=["_text"])
    cut = list(chunked_bpe.chunked(part, 6))
    for text, chunks in zip(texts, cut):
        assert b"".join(chunks).decode() == (text or "")
        assert all(chunk.decode() for chunk in chunks)
    assert len(cut[0]) > 30
    for n in (1, 4):
        assert len(set(cut[0]) & set(cut[n])) >= len(set(cut[0])) - 2


def corpus():
    rng = random.Random(7)
    passage = helpers.prose(5, 700, 5000)
    rows = [(n, helpers.prose(n, 80, 9000) + " " + passage[rng.randrange(50) :] + helpers.prose(-n, 30)) for n in range(12)]
    rows += [(100 + n, passage) for n in range(9)] + [(None, None), (None, ""), (7, "  "), (7, "中文。" * 3000), (8, "中文。" * 3000 + "x")]
    rows += [(9, helpers.prose(9, 40_000, 20_000)), (10, "a" * 50_000), (11, passage + "<|endoftext|>" + passage), (12, "<|endoftext|>"), (13, "é \n\n\r\n x")]
    return rows


@pytest.mark.parametrize("chunk_bits", [5, 9])
def test_rows(docs, chunk_bits):
    rows = corpus()
    frame = docs(rows).withColumnsRenamed({"lang": "ids", "source": "at"})
    encoded = chunked_bpe.encode(frame, chunk_bits=chunk_bits)
    out = sorted(encoded.collect(), key=lambda r: str(r["ids"]))
    assert [r["ids"] for r in out] == sorted([ids_of(text) for _, text in rows], key=str)
    assert sorted(encoded.columns) == ["at", "doc_id", "ids", "n_chars"]
    texts = chunked_bpe.decode(encoded).collect()
    assert sorted((str(r["doc_id"]), r["decoded"]) for r in texts) == sorted((str(i), t or "") for i, t in rows)


def test_shared_chunks_are_encoded_once(docs, monkeypatch):
    frame = docs([(n, helpers.prose(1, 3000, 5000) + f" {n}") for n in range(30)])
    made = {}
    written = chunked_bpe.written
    monkeypatch.setattr(chunked_bpe, "written", lambda f, label: made.setdefault(label, written(f, label)))
    chunked_bpe.encode(frame).count()
    assert made["chunks"].count() == made["chunks"].select("key1", "key2").distinct().count() > 10
    assert made["references"].count() > 29 * made["chunks"].count()


def test_empty_table_and_odd_ids(spark, docs):
    assert chunked_bpe.encode(docs([])).collect() == []
    frame = spark.createDataFrame([(1, None), (2, []), (3, [50256, 198]), (4, [162])], "k int, ids array<int>")
    assert [r["decoded"] for r in chunked_bpe.decode(frame).collect()] == [
        WHOLE.decode(x, skip_special_tokens=False) for x in ([], [], [50256, 198], [162])
    ]
    with pytest.raises(PythonException, match="not in the vocabulary"):
        chunked_bpe.decode(spark.createDataFrame([([60000],)], "ids array<int>")).collect()


def test_query(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in helpers.sample_table(spark, "documents").collect()}
    out = {r["doc_id"]: r for r in catalog.registered()["op11_bpe"](spark, helpers.SF).collect()}
    assert sorted(out) == sorted(texts)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for doc_id, text in texts.items():
        ids = ids_of(text)
        r = out[doc_id]
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), sha(",".join(map(str, ids))))
        assert r["decoded_sha256"] == sha(WHOLE.decode(ids, skip_special_tokens=False))
    assert np.sum([r["n_tokens"] for r in out.values()]) > 10_000
