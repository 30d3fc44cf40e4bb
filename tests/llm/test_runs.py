"""Periodic runs against a look at every period of every place."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import helpers
from tillwright.llm import catalog, runs


def brute(words, min_length=12):
    """Maximal stretches of each period; of several periods of one stretch, the smallest."""
    found = {}
    for period in range(1, len(words) // 2 + 1):
        at = 0
        while at + period < len(words):
            end = at
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            length = end - at + period
            if length >= max(min_length, 2 * period):
                found.setdefault((at, length), period)
            at = end + 1
    return sorted((start, length, period) for (start, length), period in found.items())


def collapsed(words, found):
    gone = {i for start, length, period in found for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def numbers(words):
    return runs._numbered([str(w).encode() for w in words])


@settings(deadline=None, max_examples=400)
@given(st.lists(st.integers(0, 2), max_size=80), st.sampled_from([1, 2, 4, 12]))
def test_few_letters(letters, min_length):
    assert runs.periodic_runs(numbers(letters), min_length) == brute(letters, min_length)


@settings(deadline=None, max_examples=200)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 7)), max_size=12))
def test_repeated_phrases(phrases):
    letters = [x for phrase, times in phrases for x in phrase * times]
    assert runs.periodic_runs(numbers(letters)) == brute(letters)


def special():
    one, two, morse = "a", "ab", "ab"
    while len(two) < 1500:
        one, two = two, two + one
    while len(morse) < 1500:
        morse += morse.translate(str.maketrans("ab", "ba"))
    rng = random.Random(3)
    listed = [w for n in range(250) for w in ("the", "value", "of", "this", "item", "is", "now", str(rng.randrange(10**9)))]
    return [list(two), list(morse), ["a"] * 1500, list("ab" * 700 + "b" + "ab" * 300), listed, listed * 2]


@pytest.mark.parametrize("words", special(), ids=["fibonacci", "morse", "one", "two", "list", "twice"])
def test_special_words(words):
    assert runs.periodic_runs(numbers(words)) == brute(words)


def test_order_of_suffixes():
    rng = np.random.default_rng(5)
    for size in (1, 2, 50, 300):
        ids = rng.integers(0, 3, size)
        order, levels = runs.suffixes(ids)
        shared = runs.common_prefixes(order, levels)
        texts = [ids[i:].tolist() for i in range(size)]
        assert order.tolist() == sorted(range(size), key=lambda i: texts[i])
        for n in range(1, size):
            a, b = texts[order[n - 1]], texts[order[n]]
            assert shared[n] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_long_texts_take_time_in_proportion():
    phrase = [f"w{n}" for n in range(40)]
    listed = [w for n in range(30_000) for w in ("a", "b", "c", "d", "e", "f", "g", f"n{n}")]
    ids = numbers(["x"] * 200_000 + phrase * 3000 + listed)
    found = runs.periodic_runs(ids)
    assert found == [(0, 200_000, 1), (200_000, 120_000, 40)]


def test_rows(docs):
    rows = [(1, None), (1, ""), (2, " \t\n"), (None, "a b " * 8), (3, " ".join(helpers.prose(1, 50).split()) + " x" * 20 + " é y"),
            (3, "a b " * 8), (4, "q " + helpers.prose(2, 30_000, 9000)), (5, "A a " * 6)]
    frame = docs(rows).withColumnsRenamed({"lang": "runs", "source": "collapsed"})
    out = runs.find_runs(frame).collect()
    assert [r["doc_id"] for r in out] == [r[0] for r in rows]
    for r, (_, text) in zip(out, rows):
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        want = brute(words) if len(words) < 1000 else []
        assert (r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) == (len(words), want, collapsed(words, want))
    assert runs.find_runs(docs([])).collect() == []


def planted(doc_id, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def test_query(spark):
    texts = {r["doc_id"]: r["text"] for r in helpers.sample_table(spark, "documents").collect()}
    out = catalog.registered()["op13_periodic_runs"](spark, helpers.SF).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(texts)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    n_runs = 0
    for r in out:
        words = planted(r["doc_id"], texts[r["doc_id"]])
        found = brute(words)
        n_runs += len(found)
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        exponent = best[1] * 1000 // best[2] if found else None
        want = (len(found), *best, exponent, sha("".join(f"{s},{n},{p}\n" for s, n, p in found)), sha(collapsed(words, found)))
        assert tuple(r[c] for c in ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")) == want
    assert n_runs > 10
