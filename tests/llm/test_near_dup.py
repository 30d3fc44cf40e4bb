import itertools
import random

import numpy as np
import pyarrow as pa

from tests.llm.helpers import edited, prose, words
from tillwright.llm import near_dup
from tillwright.llm import words as W
from tillwright.llm.components import components


def classes(found):
    groups = {}
    for r in found:
        groups.setdefault(r["class_row"], []).append(r["id"])
    return sorted(sorted(g, key=str) for g in groups.values())


def brute_similarity(a, b):
    """Multiset Jaccard of the five-word shingles."""
    def shingles(t):
        w = words(t)
        seen, out = {}, set()
        for i in range(max(1, len(w) - 4)):
            s = tuple(w[i : i + 5])
            seen[s] = seen.get(s, 0) + 1
            out.add((s, seen[s]))
        return out
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y)


def brute(rows, threshold=0.8):
    """Components of pairs at the threshold, where no shared shingle changes places."""
    top = {i: i for i in range(len(rows))}
    def find(i):
        while top[i] != i:
            i = top[i]
        return i
    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = rows[i][1], rows[j][1]
        if words(a) == words(b) or (words(a) and words(b) and brute_similarity(a, b) >= threshold):
            top[find(i)] = find(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    return sorted(sorted(g, key=str) for g in groups.values())


def near(docs, rows):
    return near_dup.near_duplicates(docs(rows)).collect()


def test_matches_brute_force(docs):
    rng = random.Random(2)
    rows = []
    for group in range(12):
        base = prose(group, rng.randrange(60, 300), 5000)
        rows.append((len(rows), base))
        for copy in range(rng.randrange(6)):
            rows.append((len(rows), edited(base, copy, rng.choice([0, 1, 2, 4, 30]))))
    rows += [(len(rows) + i, prose(500 + i, 80, 5000)) for i in range(30)]
    rows += [(900, "Short text"), (901, "short, TEXT!"), (902, "short"), (903, None), (904, ""), (905, "..."), (906, rows[0][1]), (906, rows[0][1])]
    assert classes(near(docs, rows)) == brute(rows)


def test_large_group_of_near_copies_is_one_class(docs):
    base = prose(1, 200, 10_000)
    rows = [(i, edited(base, i, 2)) for i in range(300)] + [(1000 + i, prose(i + 50, 100, 10_000)) for i in range(50)]
    got = classes(near(docs, rows))
    assert sorted(len(g) for g in got) == [1] * 50 + [300]


def test_common_passage_does_not_join_documents(docs):
    passage = prose(9, 60, 10_000)
    rows = [(i, passage + " " + prose(i + 20, 90, 10_000)) for i in range(150)]
    assert len(classes(near(docs, rows))) == 150


def test_finer_buckets_keep_links(docs, monkeypatch):
    monkeypatch.setattr(near_dup, "PAIRED", 2)
    base = prose(1, 120, 10_000)
    rows = [(i, edited(base, i, i % 7)) for i in range(40)]
    assert classes(near(docs, rows)) == brute(rows)


def filled_templates(seed, count, slots=16):
    """Texts of `slots` passages, each one of two, and a copy of each text with another passage in one slot. All
    passages are in many texts, and the two texts are at 0.82."""
    rng = random.Random(seed)
    pool = [[prose(seed * 1000 + slot * 2 + n, 8, 10**6) for n in range(2)] for slot in range(slots)]
    rows = []
    for _ in range(count):
        picks = [rng.randrange(2) for _ in range(slots)]
        at = rng.randrange(1, slots - 1)
        for chosen in (picks, [p ^ (slot == at) for slot, p in enumerate(picks)]):
            rows.append((len(rows), " ".join(pool[slot][p] for slot, p in enumerate(chosen))))
    return rows


def test_links_inside_large_buckets_only_are_found(docs, monkeypatch):
    monkeypatch.setattr(near_dup, "PAIRED", 1)
    rows = filled_templates(1, 100)
    assert classes(near(docs, rows)) == brute(rows)


def test_prefixes_of_similar_texts_meet():
    rng = random.Random(4)
    for _ in range(3000):
        threshold, size, other = rng.choice([0.5, 0.8, 0.9, 1.0]), rng.randrange(1, 60), rng.randrange(1, 60)
        size, other = sorted((size, other))
        shared = rng.randrange(size + 1)
        one = set(rng.sample(range(200), size))
        two = set(rng.sample(sorted(one), shared)) | set(rng.sample(range(200, 400), other - shared))
        two = {x if x in one else (x if rng.random() < 0.5 else x - 400) for x in two}
        if len(one & two) >= threshold * len(one | two) - 1e-12:
            few, more = near_dup.prefix_sizes(size, threshold)[0], near_dup.prefix_sizes(other, threshold)[1]
            assert set(sorted(one)[:few]) & set(sorted(two)[:more])


def test_similarity_respects_order_and_band():
    def labelled(text):
        return near_dup.labelled(W.mixed(W.hashes(W.split(pa.array([text]), W.LOWERED))))
    halves = [prose(1, 50, 10_000), prose(2, 50, 10_000)]
    one, two = labelled(" ".join(halves)), labelled(" ".join(reversed(halves)))
    assert near_dup.similarity(one, one) == 1.0
    assert near_dup.similarity(one, two) < 0.8
    a, b = prose(3, 200, 10_000), edited(prose(3, 200, 10_000), 4, 2)
    assert near_dup.similarity(labelled(a), labelled(b)) == brute_similarity(a, b)
    assert near_dup.labelled(W.mixed(np.zeros(9, np.uint64) + np.uint64(1))).shape == (5,)


def test_one_per_class_keeps_rows_whole(docs):
    rows = [(0, prose(1, 80)), (1, prose(1, 80)), (2, prose(2, 80)), (2, prose(2, 80)), (3, None), (4, "")]
    out = near_dup.one_per_class(docs(rows))
    assert out.columns == docs(rows).columns
    texts = [r["text"] or "" for r in out.collect()]
    assert sorted(texts) == sorted([prose(1, 80), prose(2, 80), ""])


def test_empty_table_and_clashing_columns(docs):
    assert near_dup.near_duplicates(docs([])).count() == 0
    rows = docs([(1, "a b c d e f"), (2, "a b c d e f")]).selectExpr("doc_id", "text", "1 AS row", "2 AS key1", "3 AS size")
    assert near_dup.near_duplicates(rows).select("class_row").distinct().count() == 1
    assert near_dup.one_per_class(rows).columns == rows.columns


def test_components_of_chains_and_stars(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100 + i, 99) for i in range(1, 60)] + [(300, 200), (300, 250), (300, 200)]
    found = {r["u"]: r["v"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert all(found[i] == 0 for i in range(1, 41)) and all(found[i] == 99 for i in range(100, 160) if i > 100)
    assert found[300] == found[250] == 200 and 200 not in found
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def templated(count, slots, fixed):
    """Texts of one template: `fixed` words, then one of two wordings for each slot."""
    rng = random.Random(count + slots)
    wordings = [[prose(1000 * slot + side, 12, 5000) for side in range(2)] for slot in range(slots)]
    opening = prose(7, fixed, 5000) if fixed else ""
    return [(n, " ".join([opening, *[rng.choice(w) for w in wordings]])) for n in range(count)]


def test_compared_pairs_of_a_template_stay_few(docs, monkeypatch):
    compare, counts = near_dup._compare, []

    def counted(pairs, texts, threshold):
        counts.append(pairs.count())
        return compare(pairs, texts, threshold)

    monkeypatch.setattr(near_dup, "_compare", counted)
    for count in (300, 1200):  # all pairs: 45 thousand, 720 thousand
        counts.clear()
        near(docs, templated(count, 20, 90))
        assert sum(counts) < 4 * count


def test_parity_bounds_the_difference():
    rng = np.random.default_rng(8)
    for size, shared in ((10, 3), (300, 250), (900, 880), (5000, 100)):
        texts = W.mixed(rng.integers(0, 1 << 62, 2 * size - shared).astype(np.uint64))
        one, two = texts[:size], texts[size - shared :]
        bits = np.bitwise_count((near_dup.parity(one) ^ near_dup.parity(two)).view(np.uint64)).sum()
        assert bits <= 2 * (size - shared)
