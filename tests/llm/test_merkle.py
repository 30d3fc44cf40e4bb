"""Merkle manifests against a plain fold of the whole tree."""

import hashlib
import zlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from tests.llm import helpers
from tillwright.llm import catalog, merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def coded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(doc_id, text, lang, source):
    return H(*map(coded, (doc_id, source, lang, None if text is None else len(text), text)))


def fold(digests, arity):
    """Root, and the proof of each digest as steps (before, after)."""
    proofs, spans = [[] for _ in digests], [[n] for n in range(len(digests))]
    while len(digests) > 1:
        up, own = [], []
        for at in range(0, len(digests), arity):
            run = digests[at : at + arity]
            for n in range(len(run)):
                for below in spans[at + n]:
                    proofs[below].append(("".join(run[:n]), "".join(run[n + 1 :])))
            up.append(H(*run))
            own.append([b for s in spans[at : at + arity] for b in s])
        digests, spans = up, own
    return digests[0], proofs


def brute(rows, arity=8):
    """Per (doc_id, leaf): subroot, root and proof."""
    first = lambda value: (value is not None, value if value is not None else 0)
    bytewise = lambda value: (value is not None, (value or "").encode())
    ordered = sorted(rows, key=lambda r: (bytewise(r[2]), first(r[0]), leaf(*r)))
    trees = []
    for _, own in groupby(ordered, key=lambda r: r[2]):
        own = list(own)
        trees.append((own, *fold([leaf(*r) for r in own], arity)))
    root, over = fold([t[1] for t in trees], arity) if trees else (None, [])
    return root, sorted(
        (str(r[0]), leaf(*r), subroot, root, proof + top)
        for (own, subroot, proofs), top in zip(trees, over)
        for r, proof in zip(own, proofs)
    )


def found(frame):
    steps = F.transform("proof", lambda s: F.struct(F.lower(F.hex(s["left"])), F.lower(F.hex(s["right"]))))
    out = frame.select(
        F.coalesce(F.col("id").cast("string"), F.lit("None")), *[F.lower(F.hex(c)) for c in ("leaf", "subroot", "root")], steps.alias("steps"),
    ).collect()
    return sorted((*r[:4], [tuple(s) for s in r[4]]) for r in out)


def table(sizes):
    rows, n = [], 100
    for lang, size in sizes.items():
        for _ in range(size):
            rows.append((n, f"Text {n} é", lang, f"s{n % 3}"))
            n += 7
    return rows


@pytest.mark.parametrize(
    "sizes, arity",
    [({"en": 1}, 8), ({"en": 9}, 8), ({"en": 65, "de": 1, None: 2}, 8), ({"en": 75, "": 64, "é": 3}, 2), ({f"l{n}": 1 + n % 4 for n in range(70)}, 8)],
)
def test_equals_plain_fold(docs, sizes, arity):
    rows = table(sizes)
    out = merkle.manifest(docs(rows), arity=arity)
    root, want = brute(rows, arity)
    assert found(out) == want
    assert {r[0] for r in out.select(merkle.folded(F.col("leaf"), F.col("proof"))).collect()} == {root}


def test_nulls_ties_copies_and_long_texts(docs):
    rows = [(None, None, None, None), (None, "", "en", ""), (3, "x" * 200_000, "en", "s"), (3, "y", "en", "s")] + [(5, "copy", "en", "s")] * 40
    assert found(merkle.manifest(docs(rows))) == brute(rows)[1]


def test_presented_rows(docs):
    frame = docs(table({"en": 30, "de": 4})).withColumn("leaf", F.lit("clash")).withColumn("root", F.lit(1))
    out = merkle.manifest(frame, presented={"text": F.lit("other")}, altered=F.col("doc_id") % 2 == 0)
    for r in out.withColumn("ok", merkle.folded(F.col("presented"), F.col("proof")) == F.lower(F.hex("root"))).collect():
        assert r["ok"] == (r["id"] % 2 == 1)


def test_empty_table(docs):
    assert merkle.manifest(docs([])).collect() == []


def test_one_changed_row_changes_the_root(docs):
    rows = table({"en": 20, "de": 20})
    roots = {bytes(merkle.manifest(docs(r)).first()["root"]) for r in (rows, rows[:-1], [(100, "Text", "en", "s1"), *rows[1:]])}
    assert len(roots) == 3


def test_few_rounds(docs):
    """Paths double: their number of joins follows the logarithm of the height."""
    assert merkle._height(8**7, 8) == 7 and merkle._height(1, 8) == 0 and merkle._height(9, 8) == 2


def test_query(spark):
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in helpers.sample_table(spark, "documents").collect()]
    root, want = brute(rows)
    by_id = {int(doc_id): (own, subroot, steps) for doc_id, own, subroot, _, steps in want}
    given = {r[0]: r for r in rows}
    for r in catalog.registered()["op12_merkle_manifest"](spark, helpers.SF).collect():
        own, subroot, steps = by_id[r["doc_id"]]
        doc_id, text, lang, source = given[r["doc_id"]]
        if zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None:
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        at = leaf(doc_id, text, lang, source)
        for before, after in steps:
            at = H(before, at, after)
        assert (r["leaf"], r["subroot"], r["root"], r["folded_root"]) == (own, subroot, root, at)
        assert r["proof_sha256"] == H(*[x for step in steps for x in step]) and r["verified"] == (at == root)
