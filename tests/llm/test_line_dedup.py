import hashlib
import random
from collections import defaultdict

import pytest

from tests.llm.helpers import documents, lowered
from tillwright.llm import line_dedup

SPACE = " \t\n\x0b\x0c\r"


def brute(rows, min_docs, keep="none"):
    found = defaultdict(set)
    for row in set(rows):
        for line in (row[1] or "").split("\n"):
            if key := lowered(line.strip(SPACE)):
                found[key].add(row)
    bad = {k for k, docs in found.items() if len(docs) >= min_docs}
    return [[x for x in (t or "").split("\n") if lowered(x.strip(SPACE)) not in bad] for _, t in rows]


def test_matches_brute_force(spark, docs):
    rng = random.Random(3)
    lines = ["", "  ", "Common line", " common LINE\t", "other", "É", "é", "x\r", "\x85odd\x85"]
    rows = [(i, "\n".join(rng.choice(lines) + rng.choice(["", "", str(rng.randrange(40))]) for _ in range(rng.randrange(9)))) for i in range(60)]
    rows += [(60, None), (61, ""), (None, "other\nmine"), (5, rows[5][1])]
    want = brute(rows, 4)
    found = line_dedup.keep_bitmaps(docs(rows), min_docs=4)
    got = found.select("_id", "_text", "_n_lines", "_n_dropped", line_dedup.kept_text().alias("kept")).collect()
    expected = sorted((str(i), str(t), len((t or "").split("\n")), "\n".join(k)) for (i, t), k in zip(rows, want))
    assert sorted((str(r[0]), str(r[1]), r[2], r[4]) for r in got) == expected
    assert all(r["_n_lines"] - r["_n_dropped"] == len(k.split("\n")) or k == "" for r in got for k in [r["kept"]])


def test_first_occurrence_stays_once(docs):
    rows = [(i, f"head {i}\nshared\nshared\ntail {i}") for i in range(12)]
    out = [r["text"] for r in line_dedup.dedup_lines(docs(rows), min_docs=10, keep="first").collect()]
    assert sum(t.split("\n").count("shared") for t in out) == 1
    assert all(f"head {i}\n" in t and t.endswith(f"tail {i}") for i in range(12) for t in out if f"head {i}\n" in t)


def test_threshold_counts_documents_not_lines(docs):
    rows = [(0, "a\n" * 20), *[(i, "b") for i in range(1, 10)]]
    out = line_dedup.keep_bitmaps(docs(rows), min_docs=10).collect()
    assert {r["_n_dropped"] for r in out} == {0}


def test_empty_table_and_other_columns(spark, docs):
    assert line_dedup.dedup_lines(docs([])).columns == docs([]).columns
    clashing = docs([(i, "same\nown %d" % i) for i in range(10)]).selectExpr("doc_id", "text", "1 AS _k1", "2 AS _pos", "3 AS lines", "4 AS _keep")
    out = line_dedup.dedup_lines(clashing, min_docs=10)
    assert out.columns == clashing.columns
    assert {(r["_k1"], r["_pos"], r["lines"], r["_keep"]) for r in out.collect()} == {(1, 2, 3, 4)}
    assert sorted(r["text"] for r in out.collect()) == [f"own {i}" for i in range(10)]


def test_long_text_and_bad_mode(docs):
    long = "\n".join(f"line {i % 5000}" if i % 2 else "every" for i in range(20_000))
    out = line_dedup.keep_bitmaps(docs([(0, long), *[(i, "every") for i in range(1, 10)]]), min_docs=10)
    row = out.where("_id = 0").select("_n_dropped", line_dedup.kept_text().alias("t")).first()
    assert row[0] == 10_000 and hashlib.md5(row[1].encode()).digest() == hashlib.md5(
        "\n".join(f"line {i % 5000}" for i in range(20_000) if i % 2).encode()).digest()
    with pytest.raises(ValueError):
        line_dedup.keep_bitmaps(documents(out.sparkSession, []), keep="last")
