import random

from tests.llm.helpers import prose, words
from tillwright.llm import decontaminate


def brute(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        mine, hit, found = words(text), set(), set()
        for item_id, item in items:
            other = words(item)
            size = min(window, len(other))
            wins = {tuple(other[i : i + size]) for i in range(len(other) - size + 1)} if size else set()
            for i in range(len(mine) - size + 1 if size else 0):
                if tuple(mine[i : i + size]) in wins:
                    hit |= set(range(i, i + size))
                    found.add(str(item_id) if item_id is not None else "null")
        out.append((str(doc_id), len(mine), len(hit), sorted(found)))
    return sorted(out, key=str)


def run(spark, docs, rows, items, **options):
    table = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.contamination(docs(rows), table, **options).collect()
    return sorted([(str(r["doc_id"]), r["n_words"], r["n_hit"], r["items"]) for r in found], key=str)


def test_matches_brute_force(spark, docs):
    rng = random.Random(1)
    items = [(i, prose(i, rng.choice([1, 3, 5, 9, 10, 11, 30]), 40)) for i in range(20)]
    items += [(20, None), (21, "--- ..."), (100, items[3][1]), (101, items[7][1]), (None, prose(50, 15)), (9, "w1 w2")]
    rows = [(i, prose(100 + i, rng.randrange(60), 40)) for i in range(40)]
    for i in range(20):
        part = items[i][1].split(" ")
        begin = rng.randrange(len(part))
        rows.append((50 + i, prose(i + 7, 12, 40) + " " + ", ".join(part[begin:]).upper() + "! " + prose(i, 5, 40)))
    rows += [(90, None), (91, ""), (None, items[19][1]), (60, rows[50][1]), (60, rows[50][1])]
    assert run(spark, docs, rows, items) == brute(rows, items)


def test_a_full_filter_changes_nothing(spark, docs):
    items = [(i, prose(i, 25)) for i in range(8)]
    rows = [(i, prose(i + 100, 20) + " " + prose(i % 10, 18)) for i in range(20)]
    assert run(spark, docs, rows, items, filter_bits=7) == run(spark, docs, rows, items) == brute(rows, items)


def test_repeated_words_and_ties(spark, docs):
    rows = [(0, "a " * 30), (1, "a " * 9), (2, "b " + "a " * 12)]
    items = [(0, "a " * 14), (1, "a a")]
    assert run(spark, docs, rows, items) == brute(rows, items)


def test_empty_tables(spark, docs):
    assert run(spark, docs, [], [(0, "x")]) == []
    assert run(spark, docs, [(0, "x y")], []) == [("0", 2, 0, [])]


def test_clashing_columns(spark, docs):
    rows = docs([(1, prose(1, 12))]).selectExpr("doc_id", "text", "1 AS row", "2 AS size", "3 AS win", "4 AS item_id")
    items = spark.createDataFrame([(7, prose(1, 12), 1)], "item_id bigint, text string, win int")
    found = decontaminate.contamination(rows, items).collect()
    assert [(r["n_hit"], r["items"]) for r in found] == [(12, ["7"])]
